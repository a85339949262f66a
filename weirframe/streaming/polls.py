"""Repeated polls and keyed upserts as Structured Streaming jobs.

State is the target table itself: a late or repeated row meets its key there, so no
watermark forgets it.
"""

from __future__ import annotations

import datetime
import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirframe.functions.scalars import all_present
from weirframe.operators.heavy import heavy_keys
from weirframe.operators.merge import ACTIONS, UpsertRule, drop_replayed, fold
from weirframe.sources import files
from weirframe.plans.poll import poll_many, to_hour
from weirframe.session import Scratch
from weirframe.sources.schemas import POLL_DOC, Table
from weirframe.sources.tables import TableStore, partition_values

LOG = logging.getLogger(__name__)
REJECTED = "rejected_polls"
REJECTED_COLUMNS = "announcement string, poll string, polled_at string, reason string, rejected boolean"
def rejected_polls(spark: SparkSession, store: TableStore) -> DataFrame:
    """Polls that wrote nothing: those whose last record is a rejection."""
    path = f"{store.root}/{REJECTED}"
    if not files.exists(spark, path):
        return spark.createDataFrame([], REJECTED_COLUMNS).drop("rejected")
    records = spark.read.schema(f"{REJECTED_COLUMNS}, at timestamp").parquet(path)
    last = records.groupBy("announcement").agg(F.max_by(F.struct(*records.columns), "at").alias("last"))
    return last.select("last.*").filter("rejected").drop("rejected", "at")


def _record(spark: SparkSession, store: TableStore, rows: list[tuple]) -> None:
    frame = spark.createDataFrame([(*row, row[-1] is not None) for row in rows], REJECTED_COLUMNS)
    frame.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{store.root}/{REJECTED}")


NO_POLL = "the announcement has no poll or no time"


def _run_announced(
    spark: SparkSession, landing: str, store: TableStore, rows: list[tuple[str | None, str | None, str | None]]
) -> int:
    """Runs announced polls as one batch and records what is rejected; returns how many are."""
    valid: dict[tuple, tuple[str, datetime.datetime]] = {}
    reasons: dict[tuple, str | None] = {}
    for row in rows:
        try:
            moment = datetime.datetime.fromisoformat(row[2]) if row[1] and row[2] else None
        except ValueError:
            moment = None
        if moment is None:
            reasons[row] = NO_POLL
        else:
            valid[row] = (row[1], moment)
    if valid:
        ordered = sorted(valid.values(), key=lambda one: (to_hour(one[1]), one[1].isoformat(), one[0]))
        rejected = {(poll, to_hour(moment)): why for (poll, moment), why in poll_many(spark, landing, store, ordered).rejected.items()}
        reasons |= {row: rejected.get((poll, to_hour(moment))) for row, (poll, moment) in valid.items()}
    for row, reason in reasons.items():
        if reason is not None:
            LOG.warning("poll %s is rejected: %s", row[1], reason)
    known = {row["announcement"] for row in rejected_polls(spark, store).collect()} if reasons else set()
    noted = [(*row, reason) for row, reason in reasons.items() if reason is not None or row[0] in known]
    if noted:
        _record(spark, store, noted)
    return sum(reason is not None for reason in reasons.values())


def rerun_rejected(spark: SparkSession, landing: str, store: TableStore) -> int:
    """Tries rejected polls again, in order; returns how many are still rejected."""
    rows = [(r["announcement"], r["poll"], r["polled_at"]) for r in rejected_polls(spark, store).collect()]
    return _run_announced(spark, landing, store, rows)


def stream_polls(
    spark: SparkSession,
    landing: str,
    store: TableStore,
    checkpoint: str,
    polls_per_batch: int = 100,
) -> StreamingQuery:
    """Runs every landed poll that was not run yet, then stops.

    A poll is announced by a small document in ``polls`` once its bodies are in place. The
    polls of a micro-batch run together, in the order of their times (see ``poll_many``).
    A poll with a value that does not fit its column writes nothing, and an announcement
    without poll or time cannot be run. Neither holds up the other polls: they are
    recorded in ``rejected_polls`` and can be run by ``rerun_rejected`` once mended. Any
    other failure stops the stream.
    """
    announced = (
        spark.readStream.schema(POLL_DOC)
        .option("multiLine", True)
        .option("maxFilesPerTrigger", polls_per_batch)
        .json(f"{landing}/polls")
        .select("poll", "polled_at", F.col("_metadata.file_name").alias("announcement"))
    )

    def run(batch: DataFrame, _batch_id: int) -> None:
        # At most polls_per_batch small rows.
        rows = [(r["announcement"], r["poll"], r["polled_at"]) for r in batch.collect()]
        _run_announced(batch.sparkSession, landing, store, rows)

    return (
        announced.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_upserts(
    source: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    rule: UpsertRule,
    order: list[str],
    place: Column,
    store: TableStore,
    table: Table,
    checkpoint: str,
    row_id: str,
) -> StreamingQuery:
    """Folds each micro-batch into the table partitions that it touches.

    ``place`` is a whole number along the order, at which a heavy key is cut. ``row_id``
    tells keyless rows apart, so that a repeated batch adds none twice.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        store.recover(table)
        with Scratch(batch.sparkSession, table.name) as scratch:
            rows = scratch.keep(prepare(batch), "batch")
            touched = partition_values(store.routed(table, rows), table.partition)
            stored = store.read(table, touched)
            fresh = drop_replayed(rows, stored, rule.keys, row_id)
            heavy = heavy_keys(rows.filter(all_present(rule.keys)), rule.keys, place)
            merged = fold(fresh, rule, order, stored, heavy=heavy).drop(*ACTIONS)
            store.replace_partitions(table, merged, f"batch-{batch_id}")

    return (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
