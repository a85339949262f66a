"""Quality classifier by co-training of a text view and a metadata view.

The text view sees the shares of byte values and how words repeat; the metadata view
sees language, source and stated length, never the text. Both are logistic regressions.
They start from the same labelled documents. In each round every view labels the
unlabelled documents it is surest of, and these pseudo-labels go to the other view's
training set. At the end each view is calibrated (Platt scaling) on labelled documents
that neither was trained on, and a last regression on the two calibrated log odds
combines them. All documents are then scored in one pass.

At most ``LABELLED_ROWS`` labelled documents are used, one in ``CALIBRATION`` of them
for calibration, and at most ``UNLABELLED_ROWS`` others, each chosen by a hash of the id.

Nulls: a null text is empty; null metadata is a value of its own; a null id stays null
and is not learnt from. Missing metadata columns count as null. Repeated rows get equal
scores. Without labels of both kinds every score is the share of label 1 (one without
labels). Columns other than id, text and metadata are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirframe.llm.batches import slices, utf8
from weirframe.llm.labelled import one_row_each, sample
from weirframe.llm.weak_toxicity import logistic

LABELLED_ROWS, UNLABELLED_ROWS = 8_000, 8_000
CALIBRATION = 3
ROUNDS, PER_ROUND = 4, 400
SURE = 0.9
LEAST_SCORE = 0.5
METADATA = ("lang", "source", "n_chars")
SOURCE_BUCKETS, LANG_BUCKETS = 64, 16
HIGH = 64


def text_view(texts: list[bytes]) -> np.ndarray:
    """Root shares of byte values (those over 127 in pairs), and word statistics."""
    rows = np.zeros((len(texts), 128 + HIGH + 5), np.float32)
    for row, text in enumerate(texts):
        if not text:
            continue
        seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        rows[row, :128] = seen[:128]
        rows[row, 128 : 128 + HIGH] = seen[128:].reshape(HIGH, -1).sum(axis=1)
        rows[row, : 128 + HIGH] = np.sqrt(rows[row, : 128 + HIGH] / len(text))
        words = text.split()
        n = max(len(words), 1)
        repeats = sum(map(bytes.__eq__, words[1:], words))
        lines = text.count(b"\n") + 1
        rows[row, 128 + HIGH :] = (
            np.log1p(len(words)) / 5, len(set(words)) / n, repeats / n, len(text) / n / 10, np.log1p(n / lines) / 3,
        )
    return rows


def metadata_view(langs: list[str | None], sources: list[str | None], sizes: list[int | None]) -> np.ndarray:
    rows = np.zeros((len(langs), LANG_BUCKETS + SOURCE_BUCKETS + 4), np.float32)
    for row, (lang, source, size) in enumerate(zip(langs, sources, sizes, strict=True)):
        rows[row, zlib.crc32(str(lang).encode()) % LANG_BUCKETS] = 1
        rows[row, LANG_BUCKETS + zlib.crc32(str(source).encode()) % SOURCE_BUCKETS] = 1
        at = LANG_BUCKETS + SOURCE_BUCKETS
        if size is None:
            rows[row, at] = 1
        else:
            length = np.log1p(max(size, 0)) / 5
            rows[row, at + 1 :] = (length, length * length, size < 200)
    return rows


@dataclass
class View:
    weight: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def odds(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * (rows @ self.weight + self.bias) + self.shift, -12, 12)

    def calibrate(self, rows: np.ndarray, labels: np.ndarray) -> None:
        self.slope, self.shift = 1.0, 0.0
        slope, shift = logistic(self.odds(rows)[:, None], smooth(labels), ridge=1e-3)
        self.slope, self.shift = max(float(slope[0]), 0.0), shift


@dataclass
class Judge:
    text: View | None
    metadata: View | None
    weight: np.ndarray
    bias: float

    def score(self, text_rows: np.ndarray, metadata_rows: np.ndarray) -> np.ndarray:
        odds = np.full(len(text_rows), self.bias)
        if self.text is not None and self.metadata is not None:
            odds += np.column_stack([self.text.odds(text_rows), self.metadata.odds(metadata_rows)]) @ self.weight
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def smooth(labels: np.ndarray) -> np.ndarray:
    """Platt's targets: a little off 0 and 1, by the number of either label."""
    ones = labels.sum()
    return np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))


def co_train(text: np.ndarray, metadata: np.ndarray, labels: np.ndarray) -> Judge:
    """Both views over rows of which ``labels`` has 0 and 1, or -1 where there is none."""
    known = np.flatnonzero(labels >= 0)
    others = np.flatnonzero(labels < 0)
    held, learnt = known[::CALIBRATION], np.delete(known, np.s_[::CALIBRATION])
    truth = labels.astype(float)
    if len(set(truth[held])) < 2 or len(set(truth[learnt])) < 2:
        share = float(np.clip(truth[known].mean(), 1e-6, 1 - 1e-6)) if len(known) else 1 - 1e-6
        return Judge(None, None, np.zeros(2), float(np.log(share / (1 - share))))
    views = [text, metadata]
    given: list[dict[int, float]] = [{}, {}]
    models: list[View] = []

    def fit_both() -> None:
        models.clear()
        for rows, extra in zip(views, given, strict=True):
            at = np.concatenate([learnt, np.fromiter(extra, np.int64, len(extra))])
            goal = np.concatenate([truth[learnt], np.fromiter(extra.values(), float, len(extra))])
            view = View(*logistic(rows[at], goal, ridge=0.3))
            view.calibrate(rows[held], truth[held])
            models.append(view)

    fit_both()
    for _ in range(ROUNDS):
        before = sum(map(len, given))
        for side, view in enumerate(models):
            free = np.array([row for row in others if row not in given[1 - side]], np.int64)
            if not len(free):
                continue
            chance = 1 / (1 + np.exp(-view.odds(views[side][free])))
            order = np.argsort(chance, kind="stable")
            for row, p in [(r, chance[r]) for r in (*order[:PER_ROUND], *order[-PER_ROUND:])]:
                if p >= SURE or p <= 1 - SURE:
                    given[1 - side][int(free[row])] = float(p >= SURE)
        if sum(map(len, given)) == before:
            break
        fit_both()
    odds = np.column_stack([view.odds(rows[held]) for view, rows in zip(models, views, strict=True)])
    weight, bias = logistic(odds, smooth(truth[held]), ridge=1e-2)
    return Judge(models[0], models[1], weight, bias)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    known = {column.lower() for column in docs.columns}
    kinds = {"lang": "string", "source": "string", "n_chars": "long"}
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *[
            (F.col(name) if name in known else F.lit(None)).cast(kinds[name]).alias(name) for name in METADATA
        ],
    )


def _metadata(part: pa.RecordBatch) -> np.ndarray:
    return metadata_view(*(part.column(name).to_pylist() for name in METADATA))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> Judge:
    """Both views, co-trained on bounded samples."""
    chosen = {row["doc_id"]: row["label"] for row in sample(labels, label_col, LABELLED_ROWS).collect()}
    others = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"))
        .filter(F.col("doc_id").isNotNull())
        .join(labels.select(F.col(id_col).cast("long").alias("doc_id")), "doc_id", "left_anti")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(UNLABELLED_ROWS)
    )
    for row in others.collect():
        chosen.setdefault(row["doc_id"], -1)
    spark = docs.sparkSession
    table = spark.createDataFrame([(int(k), int(v)) for k, v in chosen.items()], "doc_id long, label int")
    rows = one_row_each(_source(docs, id_col, text_col).join(F.broadcast(table), "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                packed = [
                    pa.array([row.astype("<f4").tobytes() for row in view], pa.binary())
                    for view in (text_view(utf8(part, "text")), _metadata(part))
                ]
                yield pa.RecordBatch.from_arrays([part.column("label"), *packed], ["label", "words", "facts"])

    found = rows.mapInArrow(run, "label int, words binary, facts binary").toPandas()
    found = found.sort_values(["words", "facts", "label"])
    found = found.sample(frac=1, random_state=7) if len(found) else found
    views = [
        np.frombuffer(b"".join(found[name]), "<f4").reshape(len(found), -1) if len(found) else np.zeros((0, 1))
        for name in ("words", "facts")
    ]
    return co_train(views[0], views[1], found["label"].to_numpy())


def score(docs: DataFrame, judge: Judge, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``score`` and ``kept`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = judge.score(text_view(utf8(part, "text")), _metadata(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(found), pa.array(found >= LEAST_SCORE)], ["doc_id", "score", "kept"]
                )

    return _source(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, kept boolean")
