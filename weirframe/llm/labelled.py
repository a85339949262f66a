"""Bounded samples of labelled rows, for models that are trained on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(labels: DataFrame, label_col: str, rows: int, id_col: str = "doc_id", keep: Column | None = None) -> DataFrame:
    """``doc_id`` and ``label`` of at most ``rows`` labelled documents, chosen by a hash of the id.

    Rows without id or label are left out; of several labels of one id the largest counts.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    if keep is not None:
        known = known.filter(keep)
    one = known.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.max(F.col(label_col).cast("int")).alias("label")
    )
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def with_labels(docs: DataFrame, chosen: dict[int, int], id_col: str, text_col: str) -> DataFrame:
    """``text`` and ``label`` of the documents in ``chosen``, one row each; the sample bounds their number."""
    spark = docs.sparkSession
    table = spark.createDataFrame([(int(k), int(v)) for k, v in chosen.items()], "doc_id long, label int")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return one_row_each(source.join(F.broadcast(table), "doc_id")).select("doc_id", "text", "label")


def one_row_each(rows: DataFrame) -> DataFrame:
    """One row of each ``doc_id``, that with the least hash of its text, so that a bound on ids is one on rows.

    Tasks reduce their rows before the shuffle, however many one id has.
    """
    others = [name for name in rows.columns if name != "doc_id"]
    least = F.min(F.struct(F.xxhash64("text").alias("turn"), *others)).alias("least")
    return rows.groupBy("doc_id").agg(least).select("doc_id", *[F.col(f"least.{name}").alias(name) for name in others])
