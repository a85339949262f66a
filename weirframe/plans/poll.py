"""Polls: flood events, linked weather snapshots and station readings.

Any number of polls run as one batch: their bodies are read and parsed once, and one fold
applies all of them in order. Poll by poll, the result is the same.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirframe.functions.scalars import all_present, coerce, first_reason, misfit_reason, surrogate_id, truthy
from weirframe.operators.dedup import first_wins, last_wins
from weirframe.operators.filters import complete_coords
from weirframe.operators.heavy import heavy_keys
from weirframe.operators.lookup import left_lookup
from weirframe.operators.merge import ACTIONS, UpsertRule, absent, drop_replayed, fold_steps, insert_ignore
from weirframe.session import Scratch, require_utc
from weirframe.sources import landed, quarantine
from weirframe.sources.audit import audit
from weirframe.sources.schemas import (
    FLOOD_EVENTS,
    STATION_READINGS,
    WEATHER_SNAPSHOTS,
    Table,
)
from weirframe.sources.tables import PY_HOUR_FORMAT, TableStore, partition_values

EVENT_RULE = UpsertRule(
    keys=list(FLOOD_EVENTS.key),
    guard=["severity_level", "message", "time_severity_changed"],
    carried=["severity_label"],
)
ARRIVAL = ["step", "page", "pos"]
#: Pages of a poll, as a power of two: the place of a row is its step, then its page.
PAGE_BITS = 32


class RejectedPoll(ValueError):
    """A value of the poll does not fit its column. Nothing of it was written."""


@dataclass(frozen=True)
class PollRun:
    """``summary``: one row of counts. ``rejected``: announced polls that wrote nothing, and why."""

    summary: DataFrame
    rejected: dict[tuple[str, datetime.datetime], str]


def to_hour(moment: datetime.datetime) -> datetime.datetime:
    """UTC hour of a poll; polls of the same hour share their keys."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=datetime.timezone.utc)
    return aware.astimezone(datetime.timezone.utc).replace(minute=0, second=0, microsecond=0)


def _typed(frame: DataFrame, table: Table, keep: list[str]) -> DataFrame:
    """Table columns that the frame has, coerced, and in ``reason`` the first value that does not fit."""
    typed, reasons = [], []
    for field in table.columns.fields:
        if field.name in frame.columns:
            column = F.col(field.name)
            if frame.schema[field.name].dataType != field.dataType:
                fitted = coerce(column, field.dataType).cast(field.dataType)
                reasons.append(misfit_reason(column, fitted, field.name))
                column = fitted
            typed.append(column.alias(field.name))
    return frame.select(*typed, *keep, first_reason(reasons).alias("reason"))


def area_coords(documents: DataFrame) -> DataFrame:
    """Complete areas of each poll; a repeated notation keeps its last entry."""
    scanned = landed.areas(documents)
    complete = scanned.filter(complete_coords(F.col("notation"), F.col("lat"), F.col("lon")))
    return last_wins(complete, ["poll", "notation"], ["page", "pos"]).select("poll", "notation", "lat", "lon")


def event_batch(warnings: DataFrame, coords: DataFrame, runs: DataFrame) -> DataFrame:
    """Warnings as typed flood event rows, with the coordinates of their area in their poll.

    ``runs`` has ``poll``, ``step`` and ``polled_at`` (the hour), one small row for each run.
    """
    located = left_lookup(warnings, coords, {"poll": "poll", "flood_area_id": "notation"}, ["lat", "lon"])
    placed = located.join(F.broadcast(runs), "poll")
    keyed = surrogate_id(F.col("flood_area_id"), F.col("polled_at"))
    keyless = surrogate_id(F.col("poll"), F.col("page"), F.col("pos"))
    identified = placed.withColumn("id", F.when(F.col("flood_area_id").isNotNull(), keyed).otherwise(keyless))
    return _typed(identified, FLOOD_EVENTS, ARRIVAL)


def event_steps(events: DataFrame, stored: DataFrame | None, heavy_source: DataFrame) -> DataFrame:
    """The flood events after each poll (see ``merge.fold_steps``)."""
    place = F.shiftleft(F.col("step").cast("long"), PAGE_BITS) + F.col("page")
    heavy = heavy_keys(heavy_source.filter(all_present(EVENT_RULE.keys)), EVENT_RULE.keys, place)
    return fold_steps(events, EVENT_RULE, ARRIVAL, F.col("step"), stored, heavy)


def snapshot_attempts(steps: DataFrame, coords: DataFrame, runs: DataFrame) -> DataFrame:
    """Events that a poll inserted or updated and whose area has non-zero coordinates.

    The coordinates are that poll's, not the stored ones, and are tested unrounded.
    """
    touched = steps.filter((F.col("n_insert") + F.col("n_update") > 0) & F.col("flood_area_id").isNotNull())
    located = left_lookup(
        touched.select("id", "flood_area_id", "polled_at", "step", "n_insert", "n_update").join(
            F.broadcast(runs.select("step", "poll")), "step"
        ),
        coords,
        {"poll": "poll", "flood_area_id": "notation"},
        ["lat", "lon"],
    )
    return located.filter(truthy(F.col("lat")) & truthy(F.col("lon")))


def snapshot_rows(attempts: DataFrame, weather: DataFrame) -> DataFrame:
    """One snapshot per event, of the first poll that tries it; without a weather document all measures are NULL."""
    one_per_area = first_wins(weather, ["poll", "area"], ["page", "document"]).withColumnRenamed("area", "flood_area_id")
    tried = attempts.select(F.col("id").alias("flood_event_id"), "flood_area_id", "polled_at", "step", "poll")
    first = first_wins(tried, list(WEATHER_SNAPSHOTS.key), ["step"])
    joined = first.join(one_per_area, ["poll", "flood_area_id"], "left")
    identified = joined.withColumn("id", surrogate_id(F.col("flood_event_id"), F.col("polled_at")))
    return _typed(identified, WEATHER_SNAPSHOTS, ["step"])


def reading_batch(readings: DataFrame, runs: DataFrame) -> DataFrame:
    """Typed readings; a poll that runs twice reads them once."""
    placed = readings.join(F.broadcast(runs.groupBy("poll").agg(F.min("step").alias("step"))), "poll")
    typed = _typed(placed, STATION_READINGS, ["poll", *ARRIVAL])
    keyed = surrogate_id(F.col("station_ref"), F.col("reading_at"))
    keyless = surrogate_id(F.col("poll"), F.col("page"), F.col("pos"))
    return (
        typed.withColumn("id", F.when(F.col("reading_at").isNotNull(), keyed).otherwise(keyless))
        .withColumn("polled_at", F.current_timestamp())
        .withColumn("reading_date", F.col("reading_at").cast("date"))
        .drop("poll")
    )


def poll_once(
    spark: SparkSession, landing: str, store: TableStore, poll: str, polled_at: datetime.datetime
) -> DataFrame:
    """Runs the poll whose bodies landed under ``poll`` and returns its one-row summary.

    ``poll`` is also the batch id: running it again with the same ``polled_at``
    repairs a run that was cut off. A value that does not fit raises ``RejectedPoll``.
    """
    run = poll_many(spark, landing, store, [(poll, polled_at)])
    for reason in run.rejected.values():
        raise RejectedPoll(reason)
    return run.summary


def poll_many(
    spark: SparkSession, landing: str, store: TableStore, polls: Sequence[tuple[str, datetime.datetime]]
) -> PollRun:
    """Runs some polls, in the given order, as one batch.

    The bodies are listed and parsed once and all counts are taken while frames are written.
    A poll with a bad value is left out and reported; malformed bodies go to the quarantine.
    All values are coerced before the first write. Writes go snapshots, readings, events:
    event ids are known beforehand, and a re-run of the same polls still sees the events as new
    until everything else is in place.
    """
    require_utc(spark)
    store.recover(FLOOD_EVENTS)
    # A poll that was announced twice for one hour changes nothing the second time.
    announced = list(dict.fromkeys((poll, to_hour(moment)) for poll, moment in polls))
    moments = {(poll, to_hour(moment)): moment for poll, moment in reversed(list(polls))}
    with Scratch(spark, "poll") as scratch:
        rows = [(step, poll, hour.strftime("%Y-%m-%dT%H:%M:%SZ")) for step, (poll, hour) in enumerate(announced)]
        runs = spark.createDataFrame(rows, "step int, poll string, hour string")
        runs = runs.select("step", "poll", F.col("hour").cast("timestamp").alias("polled_at"))

        bodies = landed.live_bodies(spark, landing, sorted({poll for poll, _ in announced}))
        documents, seen = scratch.keep_counted(landed.live_documents(bodies), "documents", malformed=F.count_if("malformed"))
        if seen["malformed"]:
            quarantine.add(store, quarantine.malformed_bodies(documents))
        coords, n_areas = scratch.keep_counted(area_coords(documents), "coords", rows=F.count(F.lit(1)))
        tallies = {"rows": F.count(F.lit(1)), "bad": F.count("reason")}
        events, n_events = scratch.keep_counted(event_batch(landed.warnings(documents), coords, runs), "events", **tallies)
        readings, n_readings = scratch.keep_counted(reading_batch(landed.readings(documents), runs), "readings", **tallies)
        rejected: dict[int, str] = {}
        for frame, counted in ((events, n_events), (readings, n_readings)):
            if counted["bad"]:
                _reject(store, frame, announced, rejected)

        for turn in range(len(announced) + 1):
            result = _write_plan(scratch, store, runs, documents, coords, events, readings, announced, rejected, turn)
            if not result["snapshots"][1]["bad"]:
                break
            # Weather counts only where a snapshot uses it; without the polls that it fails, all is folded again.
            _reject(store, result["snapshots"][0], announced, rejected)

        if rejected:
            good = ~F.col("step").isin(list(rejected))
            n_events["rows"], n_readings["rows"] = events.filter(good).count(), readings.filter(good).count()
        (folded, actions), (_, tried), (snapshots, stored), (new_readings, added) = (
            result[name] for name in ("steps", "attempts", "snapshots", "new_readings")
        )
        summary = {
            "n_areas": n_areas["rows"],
            "n_warnings": n_events["rows"],
            "n_readings": n_readings["rows"],
            "n_events_inserted": actions["n_insert"],
            "n_events_updated": actions["n_update"],
            "n_events_stored": actions["n_insert"] + actions["n_update"],
            "n_events_noop": actions["n_noop"],
            "n_snapshots_stored": stored["rows"],
            "n_snapshots_skipped": tried["rows"] - stored["rows"],
            "n_readings_stored": added["rows"],
            "n_malformed_bodies": seen["malformed"],
        }
        store.append(WEATHER_SNAPSHOTS, snapshots)
        store.append(STATION_READINGS, new_readings)
        if summary["n_events_stored"] > 0:
            last = folded.filter("is_last").drop("step", "is_last")
            store.replace_partitions(FLOOD_EVENTS, last, announced[0][0] if len(announced) == 1 else f"{announced[0][0]}-{len(announced)}")
        hours = sorted({hour for _, hour in announced})
        touched = {
            FLOOD_EVENTS.name: [hour.strftime(PY_HOUR_FORMAT) for hour in hours],
            WEATHER_SNAPSHOTS.name: sorted({hour.date() for hour in hours}),
            STATION_READINGS.name: partition_values(new_readings, "reading_date"),
        }
        audit(store, {name: (values, None) for name, values in touched.items() if values})
    made = spark.createDataFrame([tuple(summary.values())], ", ".join(f"{name} bigint" for name in summary))
    return PollRun(made, {(announced[step][0], moments[announced[step]]): reason for step, reason in sorted(rejected.items())})


def _reject(store: TableStore, frame: DataFrame, announced: list, rejected: dict[int, str]) -> None:
    """Notes the first bad value of each poll, one row per poll."""
    place = [c for c in ("page", "pos") if c in frame.columns]
    first = F.min(F.struct(*place, "reason")).alias("first")
    found = frame.filter("reason is not null").groupBy("step").agg(first).select("step", "first.*").collect()
    for row in found:
        if row["step"] not in rejected:
            rejected[row["step"]] = row["reason"]
            at = row.asDict()
            quarantine.add(store, quarantine.entry(store.spark, "poll", announced[row["step"]][0], at.get("page"), at.get("pos"), row["reason"]))


def _write_plan(scratch, store, runs, documents, coords, events, readings, announced, rejected, turn) -> dict:
    """What the polls that are not rejected would write, written aside and counted."""

    def keep(frame: DataFrame, name: str, **metrics):
        return scratch.keep_counted(frame, f"{name}-{turn}", **metrics)

    if rejected:
        good = ~F.col("step").isin(list(rejected))
        events, readings = events.filter(good), readings.filter(good)
    events, readings = events.drop("reason"), readings.drop("reason")
    hours = {hour for _, hour in announced}
    # Only rows of these hours can share a key with the batch.
    stored_events = store.read(FLOOD_EVENTS, sorted(hour.strftime(PY_HOUR_FORMAT) for hour in hours))
    fresh = drop_replayed(events, stored_events, EVENT_RULE.keys)
    counts = {name: F.sum(name) for name in ACTIONS}
    steps = keep(event_steps(fresh, stored_events, events), "steps", **counts)

    tried = F.sum(F.col("n_insert") + F.col("n_update"))
    attempts = keep(snapshot_attempts(steps[0], coords, runs), "attempts", rows=tried)
    made = snapshot_rows(attempts[0], landed.current_weather(documents))
    days = sorted({hour.date() for hour in hours})
    new = absent(made, store.read(WEATHER_SNAPSHOTS, days), list(WEATHER_SNAPSHOTS.key))
    snapshots = keep(new, "snapshots", rows=F.count(F.lit(1)), bad=F.count("reason"))

    stored_readings = store.read(STATION_READINGS, partition_values(readings, "reading_date"))
    key = list(STATION_READINGS.key)
    added = insert_ignore(drop_replayed(readings, stored_readings, key), key, ARRIVAL, stored_readings)
    return {"steps": steps, "attempts": attempts, "snapshots": snapshots, "new_readings": keep(added, "new_readings", rows=F.count(F.lit(1)))}
