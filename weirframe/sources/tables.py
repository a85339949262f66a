"""Target tables: Parquet folders partitioned by a column derived from the key."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirframe.sources import files
from weirframe.sources.schemas import BUCKET, STATION_BUCKETS, Table


#: Partition of an hour, and the same for Python datetimes.
HOUR_FORMAT, PY_HOUR_FORMAT = "yyyy-MM-dd-HH", "%Y-%m-%d-%H"


class TableStore:
    """Tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.name}"

    def create_if_absent(self, *tables: Table) -> None:
        for table in tables:
            files.make_dir(self.spark, self.path(table))

    def read(self, table: Table, partitions: list | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The table's columns; ``partitions`` and ``buckets`` limit the scan to those folders."""
        self.create_if_absent(table)
        frame = self.spark.read.schema(table.stored).parquet(self.path(table))
        if partitions is not None:
            column = F.col(table.partition)
            wanted = column.isin([p for p in partitions if p is not None])
            frame = frame.filter(wanted | column.isNull() if None in partitions else wanted)
        if buckets is not None and table.bucketed:
            frame = frame.filter(F.col(BUCKET).isin(buckets))
        return frame.select(*table.columns.names)

    def read_dates(self, table: Table, start: datetime.date, end: datetime.date) -> DataFrame:
        """Rows dated within the range. The year bounds are added so that partitions are pruned."""
        self.create_if_absent(table)
        frame = self.spark.read.schema(table.stored).parquet(self.path(table))
        return (
            frame.filter(F.col(table.partition).between(start.year, end.year))
            .filter(F.col(table.partition_source).between(F.lit(start), F.lit(end)))
            .select(*table.columns.names)
        )

    def routed(self, table: Table, frame: DataFrame) -> DataFrame:
        """Table columns in order, plus the partition column."""
        source = F.col(table.partition_source)
        if table.partition == "year":
            value = F.year(source)
        elif table.partition == "polled_hour":
            value = F.date_format(source, HOUR_FORMAT)
        else:
            value = source.cast("date")
        bucket = [station_bucket(F.col("station_ref")).alias(BUCKET)] if table.bucketed else []
        return frame.select(*table.columns.names, value.alias(table.partition), *bucket)

    def balanced(self, table: Table, frame: DataFrame) -> DataFrame:
        """Few files per partition; a large partition is split by size, not held in one task."""
        return self.routed(table, frame).hint("rebalance", *[F.col(folder.name) for folder in table.folders])

    def append(self, table: Table, frame: DataFrame) -> None:
        (
            self.balanced(table, frame)
            .write.mode("append")
            .partitionBy(*[folder.name for folder in table.folders])
            .parquet(self.path(table))
        )

    def replace_partitions(self, table: Table, frame: DataFrame, batch: str) -> None:
        """Overwrites the partitions present in the frame.

        The frame may read the table itself: it is first written to a pending folder, and
        its partition folders are then moved into the table, so each row is written
        once. ``recover`` goes on with a publication that was cut off.
        """
        pending = f"{self._pending(table)}/{batch}"
        (
            self.balanced(table, frame)
            .write.mode("overwrite")
            .partitionBy(*[folder.name for folder in table.folders])
            .parquet(pending)
        )
        self._publish(table, pending)

    def recover(self, table: Table) -> None:
        """Publishes complete pending folders again and drops incomplete ones."""
        for batch in files.child_names(self.spark, self._pending(table)):
            pending = f"{self._pending(table)}/{batch}"
            if files.exists(self.spark, f"{pending}/_SUCCESS"):
                self._publish(table, pending)
            else:
                files.remove(self.spark, pending)

    def _pending(self, table: Table) -> str:
        return f"{self.root}/_pending/{table.name}"

    def _publish(self, table: Table, pending: str) -> None:
        self.create_if_absent(table)
        for folder in files.child_names(self.spark, pending):
            if folder.startswith(f"{table.partition}="):
                files.move(self.spark, f"{pending}/{folder}", f"{self.path(table)}/{folder}")
        files.remove(self.spark, pending)


def station_bucket(ref: Column) -> Column:
    return F.pmod(F.xxhash64(ref), F.lit(STATION_BUCKETS)).cast("int")


def partition_values(frame: DataFrame, column: str) -> list:
    """Distinct partition values of a batch: at most one per partition of the table."""
    return [row[0] for row in frame.select(column).distinct().collect()]
