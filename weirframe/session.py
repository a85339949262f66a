"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(
    app: str = "weirframe", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """Session with the settings the jobs rely on.

    Shuffle width is left to the cluster and to AQE; only local runs pin it.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Capturing a call site per column expression slows the building of wide plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # A skewed lookup is split even where that costs one more shuffle.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Instants without an offset are read in the session zone, which must be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir`` of the session.

    A local master without that setting gets a fresh temporary folder. A cluster
    without it is refused, since a driver-local folder would not be shared.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="/tmp/run-")


class Scratch:
    """Materialised intermediate frames of one job, under the shared folder.

    ``keep`` writes a frame once and reads it back, which cuts the lineage and lets
    several later steps use it without parsing their input again.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        frame.write.mode("error").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def keep_counted(self, frame: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict[str, int]]:
        """``keep``, with aggregates of the rows gathered while they are written. No rows give zeros."""
        observed = Observation(name)
        kept = self.keep(frame.observe(observed, *[column.alias(metric) for metric, column in metrics.items()]), name)
        found = observed.get
        return kept, {metric: found.get(metric) or 0 for metric in metrics}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def drop(self) -> None:
        from weirframe.sources.files import remove

        remove(self.spark, self.root)

    def drop_one(self, name: str) -> None:
        """Drop a kept frame that nothing reads any more."""
        from weirframe.sources.files import remove

        remove(self.spark, self.path(name))

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_exc: object) -> None:
        self.drop()
