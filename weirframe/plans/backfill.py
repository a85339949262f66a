"""Resumable backfills of river levels and weather history.

Each is one job over all pending units instead of a loop: units that are done are
skipped, a unit with one bad value fails as a whole, and valid units are marked done
after their rows are written.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirframe.fixed import END_YEAR, FIRST_YEAR, LAST_YEAR, LEVEL_SOURCE, START_DATE, START_YEAR, WHOLE_RANGE_YEAR
from weirframe.functions import arrays
from weirframe.functions.scalars import BAD_VALUE, as_date, coerce, first_reason, misfit_reason
from weirframe.operators import checks, ledger
from weirframe.operators.dedup import first_entries
from weirframe.operators.filters import complete_coords, in_dates, in_year, non_empty, passes_quality
from weirframe.operators.lookup import size_checked
from weirframe.operators.merge import insert_ignore
from weirframe.session import Scratch, require_utc
from weirframe.sources import landed, ledger_files, quarantine
from weirframe.sources.audit import audit
from weirframe.sources.schemas import CORRUPT, RIVER_LEVELS, STATION_BUCKETS, WEATHER_HISTORY, WEATHER_VARIABLES, Table
from weirframe.sources.tables import TableStore, partition_values, station_bucket

UNIT = ["station_ref", "year"]
MEASURES = [f for f in WEATHER_HISTORY.columns.fields if f.name in WEATHER_VARIABLES.values()]


@dataclass(frozen=True)
class BackfillResult:
    """``summary``: one row of counts. ``units``: one row per unit touched by this run.

    ``units`` reads the job's scratch files until ``release`` drops them.
    """

    summary: DataFrame
    units: DataFrame
    scratch: Scratch

    def release(self) -> None:
        self.scratch.drop()


@contextmanager
def dropped_on_failure(scratch: Scratch) -> Iterator[Scratch]:
    """A job that returns keeps its scratch files, since its result reads them."""
    try:
        yield scratch
    except BaseException:
        scratch.drop()
        raise


def stations(catalogue: DataFrame, usable: Column, values: list[str]) -> DataFrame:
    """First usable entry per reference, with the number of usable entries."""
    first = first_entries(catalogue, ["station_ref"], ["page", "pos"], values, {"entry": usable})
    return first.filter("entry is not null").select("station_ref", "entry.*", F.col("entry_entries").alias("entries"))


def level_source() -> Column:
    """Who a level comes from: the same in every row."""
    return F.lit(LEVEL_SOURCE)


def parse_levels(documents: DataFrame, last_year: int = LAST_YEAR) -> DataFrame:
    """Level documents -> one typed row per item, judged.

    ``kept`` marks good items of the unit's year and those without a valid date; ``reason``
    says why a row fails its unit. A document without items is one row that is not kept.
    """
    item = documents.select(
        *UNIT,
        "page",
        F.col(CORRUPT).isNotNull().alias("corrupt"),
        F.posexplode_outer("items").alias("pos", "item"),
    )
    date, value = as_date(F.col("item.date")), coerce(F.col("item.value"), RIVER_LEVELS.columns["value_m"].dataType)
    typed = item.select(
        *UNIT,
        "page",
        "pos",
        "corrupt",
        date.alias("date"),
        value.alias("value_m"),
        F.col("item.quality").alias("quality"),
        level_source().alias("source"),
        F.coalesce(passes_quality(F.col("item.quality"), F.col("item.value")), F.lit(False)).alias("good"),
        F.col("item.date").alias("date_text"),
        F.col("item.value").alias("value_text"),
    )
    kept = F.col("good") & (F.col("date").isNull() | in_year(F.col("date"), F.col("year")))
    reasons = [
        _misfit("date", F.col("date_text"), F.col("date")),
        _misfit("value_m", F.col("value_text"), F.col("value_m")),
        _unrouted(last_year),
    ]
    return _judged(typed.withColumn("kept", F.coalesce(kept, F.lit(False))), reasons).drop("good", "date_text", "value_text")


def _misfit(name: str, text: Column, coerced: Column) -> Column:
    """Why a required value fails its row."""
    shown = F.coalesce(text.cast("string"), F.lit("null"))
    return F.when(coerced.isNull(), F.concat(F.lit(f"{BAD_VALUE} for {name}: "), shown))


def _unrouted(last_year: int) -> Column:
    fits = checks.routable(F.col("date"), FIRST_YEAR, last_year)
    return F.when(~fits, F.concat(F.lit("no partition for "), F.col("date").cast("string")))


def _judged(rows: DataFrame, reasons: list[Column]) -> DataFrame:
    """Malformed bodies fail their unit whatever they hold, rows only where they are kept."""
    bad = F.when(F.col("corrupt"), F.lit(quarantine.MALFORMED)).when(F.col("kept"), first_reason(reasons))
    return rows.withColumn("reason", bad).drop("corrupt")


def parse_weather(
    documents: DataFrame, start_date: str, end_date: str | None, last_year: int = LAST_YEAR
) -> DataFrame:
    """Weather documents -> one typed row per day of the axis, judged as ``parse_levels`` does.

    The axis is exploded first, and every other array is read by position.
    """
    covered = F.coalesce(arrays_cover_axis(F.col("daily")), F.lit(True))
    days = documents.select(
        *UNIT,
        "page",
        F.col(CORRUPT).isNotNull().alias("corrupt"),
        "null_array",
        covered.alias("covered"),
        *[F.col("daily").getField(source).alias(f"_{table}") for source, table in WEATHER_VARIABLES.items()],
        F.posexplode_outer(F.col("daily.time")).alias("pos", "day"),
    )
    raw = days.select(
        *UNIT,
        "page",
        "pos",
        "covered",
        "corrupt",
        "null_array",
        as_date(F.col("day")).alias("date"),
        F.col("day").alias("day_text"),
        *[F.get(f"_{f.name}", F.col("pos")).alias(f"_{f.name}") for f in MEASURES],
    )
    typed = raw.select("*", *[coerce(F.col(f"_{f.name}"), f.dataType).alias(f.name) for f in MEASURES])
    in_range = F.col("date").isNull() | in_dates(F.col("date"), start_date, end_date)
    whole = F.col("covered") & ~(F.col("null_array") & F.col("pos").isNotNull())
    kept = whole & F.col("pos").isNotNull() & in_range
    reasons = [_misfit("date", F.col("day_text"), F.col("date")), _unrouted(last_year)]
    reasons += [misfit_reason(F.col(f"_{f.name}"), F.col(f.name), f.name) for f in MEASURES]
    judged = _judged(typed.withColumn("kept", F.coalesce(kept, F.lit(False))), reasons)
    array = F.when(~F.col("covered"), F.lit("an array is shorter than its days")).when(~whole, F.lit("an array is null"))
    judged = judged.withColumn("reason", F.coalesce("reason", array))
    return judged.drop("covered", "null_array", "day_text", *[f"_{f.name}" for f in MEASURES])


def arrays_cover_axis(daily: Column) -> Column:
    axis = daily.getField("time")
    condition = F.lit(True)
    for source in WEATHER_VARIABLES:
        condition = condition & arrays.covers(daily.getField(source), axis)
    return axis.isNull() | condition


def unit_outcomes(parsed: DataFrame) -> DataFrame:
    """Per unit: rows kept, and whether any of its documents is bad. Reduced per task before the shuffle."""
    bad = F.col("reason").isNotNull()
    return parsed.groupBy(*UNIT).agg(F.count_if("kept").alias("n_rows"), F.bool_or(bad).alias("failed"))


def unit_reasons(parsed: DataFrame) -> DataFrame:
    """The first bad value of each failed unit, with its place. Other rows are left out before the shuffle."""
    first = F.min(F.struct("page", "pos", "reason")).alias("first_bad")
    return parsed.filter("reason is not null").groupBy(*UNIT).agg(first)


def accepted_rows(parsed: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Kept rows of the units that did not fail."""
    failed = outcomes.filter("failed").select(*UNIT)
    return parsed.filter("kept").join(failed, UNIT, "left_anti").drop("kept", "reason")


def backfill_rivers(
    spark: SparkSession,
    landing: str,
    store: TableStore,
    ledger_path: str,
    catalogue_cache: str,
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
    reset: bool = False,
    last_year: int | None = None,
) -> BackfillResult:
    """Daily levels of every station and year of the range.

    A unit without a daily measure is done with no rows, one without a landed
    document stays pending, and one with malformed or misfitting data fails, as does one
    with a date after ``last_year`` (none: this year).
    """
    require_utc(spark)
    with dropped_on_failure(Scratch(spark, "rivers")) as scratch:
        return _backfill_rivers(
            spark, scratch, landing, store, ledger_path, catalogue_cache, start_year, end_year, reset, last_year or checks.newest_year()
        )


def _backfill_rivers(
    spark, scratch, landing, store, ledger_path, catalogue_cache, start_year, end_year, reset, last_year
) -> BackfillResult:
    if reset:
        ledger_files.reset(spark, ledger_path)
    catalogue = landed.saved_catalogue(spark, landing, catalogue_cache)
    chosen = stations(catalogue, non_empty(F.col("station_ref")), ["daily_level_measure_url"])
    frames = _pending(spark, scratch, ledger.with_key(ledger.unit_grid(chosen, start_year, end_year)), ledger_path)
    todo = frames.todo

    measured = todo.filter(non_empty(F.col("daily_level_measure_url"))).select(*UNIT)
    documents = landed.daily_levels(spark, landing, frames.buckets)
    # Pruned to the pending years and buckets by folder; the join prunes further at run time.
    wanted = documents.filter(F.col("year").isin(partition_values(measured, "year"))).join(
        size_checked(measured, frames.n_todo), UNIT
    )
    without_measure = todo.filter(~F.coalesce(non_empty(F.col("daily_level_measure_url")), F.lit(False)))
    return _run(
        spark,
        scratch,
        store,
        RIVER_LEVELS,
        parse_levels(wanted, last_year),
        frames,
        without_measure.select(*UNIT),
        ledger_path,
        catalogue.count() * max(0, end_year - start_year + 1),
    )


def backfill_weather(
    spark: SparkSession,
    landing: str,
    store: TableStore,
    ledger_path: str,
    catalogue_cache: str,
    start_date: str = START_DATE,
    end_date: str | None = None,
    reset: bool = False,
    last_year: int | None = None,
) -> BackfillResult:
    """Daily weather of every station with coordinates; one unit spans the whole range.

    The ledger year is a fixed marker, so a wider range does not reopen a unit.
    """
    require_utc(spark)
    with dropped_on_failure(Scratch(spark, "weather")) as scratch:
        return _backfill_weather(
            spark, scratch, landing, store, ledger_path, catalogue_cache, start_date, end_date, reset, last_year or checks.newest_year()
        )


def _backfill_weather(
    spark, scratch, landing, store, ledger_path, catalogue_cache, start_date, end_date, reset, last_year
) -> BackfillResult:
    if reset:
        ledger_files.reset(spark, ledger_path)
    catalogue = landed.saved_catalogue(spark, landing, catalogue_cache)
    usable = complete_coords(F.col("station_ref"), F.col("lat"), F.col("lon"))
    chosen = stations(catalogue, usable, ["lat", "lon"]).withColumn("year", F.lit(WHOLE_RANGE_YEAR))
    frames = _pending(spark, scratch, ledger.with_key(chosen), ledger_path)
    todo = frames.todo

    documents = landed.weather_history(spark, landing, frames.buckets)
    # The filter tells Spark that the pending side is selective, so that folders of done
    # stations are pruned at run time.
    open_units = todo.filter(F.col("year") == WHOLE_RANGE_YEAR).select(*UNIT)
    wanted = documents.join(size_checked(open_units, frames.n_todo), "station_ref")
    return _run(
        spark,
        scratch,
        store,
        WEATHER_HISTORY,
        parse_weather(wanted, start_date, end_date, last_year),
        frames,
        todo.filter("false").select(*UNIT),
        ledger_path,
        None,
    )


@dataclass(frozen=True)
class Frames:
    """Units of a run, counted while they were written."""

    grid: dict[str, int]
    done: DataFrame
    n_done: int
    todo: DataFrame
    n_todo: int
    todo_entries: int
    buckets: list[int]


def _pending(spark: SparkSession, scratch: Scratch, units: DataFrame, ledger_path: str) -> Frames:
    counts = {"rows": F.count(F.lit(1)), "entries": F.sum("entries")}
    grid, n_grid = scratch.keep_counted(units, "grid", **counts)
    done, n_done = scratch.keep_counted(ledger_files.read(spark, ledger_path), "ledger", rows=F.count(F.lit(1)))
    # For each bucket, whether a pending station lies in it.
    bucket = station_bucket(F.col("station_ref"))
    seen = {f"bucket_{k}": F.max((bucket == k).cast("int")) for k in range(STATION_BUCKETS)}
    todo, n_todo = scratch.keep_counted(ledger.pending(grid, done, ["unit_key"]), "pending", **counts, **seen)
    buckets = [k for k in range(STATION_BUCKETS) if n_todo[f"bucket_{k}"]]
    return Frames(n_grid, done, n_done["rows"], todo, n_todo["rows"], n_todo["entries"], buckets)


def _run(spark, scratch, store, table: Table, parsed, frames: Frames, empty_units, ledger_path, total) -> BackfillResult:
    """Shared tail: unit status, insert-ignore, audit, ledger, summary. No frame is read to be counted."""
    parsed = scratch.keep(parsed, "parsed")
    no_rows = empty_units.select(*UNIT, F.lit(0).cast("long").alias("n_rows"), F.lit(False).alias("failed"))
    outcomes = unit_outcomes(parsed).unionByName(no_rows)
    status, counts = scratch.keep_counted(
        frames.todo.select(*UNIT, "entries").join(outcomes, UNIT, "left"),
        "status",
        failed=F.count_if("failed"),
        done=F.count_if(~F.col("failed")),
        pending=F.count_if(F.col("failed").isNull()),
        repeats=F.sum(F.when(~F.col("failed"), F.col("entries") - 1)),
    )
    accepted = status.filter(~F.col("failed"))
    reasons = scratch.keep(unit_reasons(parsed), "reasons")
    if counts["failed"]:
        quarantine.add(store, quarantine.failed_units(table.name, reasons))

    batch = accepted_rows(parsed, status).withColumnRenamed("year", "unit_year")
    years = partition_values(batch.select(F.year("date").alias("y")), "y")
    # Of the stored rows, only those of this run's stations can share a key with the batch.
    stations = size_checked(accepted.select("station_ref").distinct(), counts["done"])
    stored = store.read(table, years, frames.buckets).join(stations, "station_ref", "left_semi")
    added, n_added = scratch.keep_counted(
        insert_ignore(batch, list(table.key), ["page", "pos"], stored, null_keys=False), "added", rows=F.count(F.lit(1))
    )

    store.append(table, added)
    audit(store, {table.name: (years, frames.buckets)})
    ledger_files.append(ledger.with_key(accepted), frames.done, ledger_path)

    inserted = added.groupBy("station_ref", F.col("unit_year").alias("year")).agg(F.count(F.lit(1)).alias("n_inserted"))
    units = (
        status.filter("failed is not null")
        .join(inserted, UNIT, "left")
        .join(reasons, UNIT, "left")
        .withColumn("n_inserted", F.coalesce("n_inserted", F.lit(0)))
        .withColumn("status", F.when(F.col("failed"), "failed").otherwise("done"))
        .select(*UNIT, "n_rows", "n_inserted", "status", F.col("first_bad.reason").alias("reason"))
    )
    # As a station-by-station loop reports it: a repeated catalogue entry of a done unit is one more skip.
    values = {
        "inserted": n_added["rows"],
        "skipped": frames.grid["entries"] - frames.todo_entries + counts["repeats"],
        "failed": counts["failed"],
        "done": counts["done"],
        "pending": counts["pending"],
        "total": frames.grid["rows"] if total is None else total,
        "completed": frames.n_done + counts["done"],
    }
    summary = spark.createDataFrame([tuple(values.values())], ", ".join(f"{name} bigint" for name in values))
    return BackfillResult(summary, units, scratch)
