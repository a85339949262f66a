"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Voters. Lexicon voters are words and word beginnings, and the same found more than once,
that stand out in toxic training documents, found by counting over the labelled sample;
pattern voters are fixed rules over a text's shape. A voter fires or abstains on a document; the given label is one
more voter, which only labelled documents have.

Label model. It estimates the share of toxic documents and, for each voter, how often it
fires on toxic and on other documents. What voters fire together beyond that is their
correlation; a voter's vote counts in inverse proportion to the voters it repeats.
Rates and correlations are fitted by turns (expectation maximisation). The model ends
in a posterior label for each training document, labelled or not.

Classifier. Logistic regression over the voters' counts and their density is trained on
the posterior labels and scores every text. Ids, labels, languages and sources are no
inputs of a score.

Only documents whose CRC-32 of the id, as text, is not 2 modulo 4 are learnt from; at
most ``LABELLED_ROWS`` labelled ones (chosen by a hash of the id) and as many without
label as that leaves of ``SAMPLE_ROWS``.

Nulls: a null text is empty and gets the score of a text without any sign; a null id
stays null, is not held out and is not learnt from. Repeated rows get equal scores.
Without labels of both kinds no voter stands out and every score is the share of label
1 (zero without labels). Columns other than id and text are ignored by ``score`` and
kept by ``keep_clean``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirframe.llm.batches import lean, numbered, slices, small_batches, starts_of, strings
from weirframe.llm.labelled import sample, with_labels

LABELLED_ROWS, SAMPLE_ROWS = 12_000, 15_000
FOLDS, HELD_OUT_FOLD = 4, 2
THRESHOLD = 0.3
#: A lexicon voter fires on this many toxic training documents at least, and that share of its documents is toxic.
LEAST_DOCS, LEAST_SHARE, LEXICON = 4, 0.5, 600
#: Lengths of word beginnings that may become voters; marked by a trailing star.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Marks an entry that a text must match more than once.
TWICE = "+"
GOLD_ACCURACY = 0.99
#: Entries that a task counts before it passes their counts on.
COUNTED = 1 << 17
#: Rows that training works on at a time beyond the inputs themselves.
CHUNK = 1024
WORD = re.compile(r"\w+")
PATTERNS = {
    "shouting": re.compile(r"\b[A-Z]{4,}\b"),
    "insult_mark": re.compile(r"!{2,}|[@#$%*]{3,}"),
}
FEATURES_AFTER = ["total", "distinct", "density"]


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that nothing is learnt from; false without id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def signs(word: str) -> list[str]:
    """The lexicon entries that a word can match: itself and its beginnings."""
    return [word, *[f"{word[:size]}*" for size in BEGINNINGS if len(word) >= size]]


def _words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    split = [WORD.findall(text.lower()) for text in texts]
    distinct, numbers = numbered([word for part in split for word in part])
    return distinct, numbers, np.fromiter(map(len, split), np.int64, len(split))


class Voters:
    """Counts of each voter in texts."""

    def __init__(self, lexicon: list[str]) -> None:
        self.names = [*lexicon, *PATTERNS]
        bases = sorted({entry.removesuffix(TWICE) for entry in lexicon})
        self.place = {base: at for at, base in enumerate(bases)}
        self.base = np.array([self.place[entry.removesuffix(TWICE)] for entry in lexicon], np.int64)
        self.less = np.array([float(entry.endswith(TWICE)) for entry in lexicon], np.float32)

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Voter counts (a row for each text) and words of each text."""
        distinct, numbers, sizes = _words(texts)
        hits = [[self.place[s] for s in signs(word) if s in self.place] for word in distinct]
        per_word = np.fromiter(map(len, hits), np.int64, len(hits))
        hit_at = starts_of(per_word)
        flat = np.array([at for found in hits for at in found], np.int64)
        found = np.flatnonzero(per_word[numbers])
        text = np.repeat(np.arange(len(texts)), sizes)[found]
        again = per_word[numbers[found]]
        ends = starts_of(again)
        bases = flat[np.repeat(hit_at[numbers[found]] - ends[:-1], again) + np.arange(ends[-1])]
        counts = np.zeros((len(texts), len(self.place)), np.float32)
        np.add.at(counts, (np.repeat(text, again), bases), 1)
        shapes = [[len(pattern.findall(text)) for pattern in PATTERNS.values()] for text in texts]
        shapes = np.array(shapes, np.float32).reshape(len(texts), len(PATTERNS))
        return np.column_stack([np.maximum(counts[:, self.base] - self.less, 0), shapes]), sizes


def features(counts: np.ndarray, sizes: np.ndarray, lexicon: int) -> np.ndarray:
    """Inputs of the classifier: log counts, and how many signs there are in all."""
    own = counts[:, :lexicon]
    total = own.sum(axis=1)
    after = [np.log1p(total), np.log1p((own > 0).sum(axis=1)), np.log1p(1000 * total / np.maximum(sizes, 1))]
    return np.column_stack([np.log1p(counts), *after])


def label_model(fires: np.ndarray, given: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior of label 1 for each row of votes; ``given`` is 0, 1 or -1 (not labelled).

    Rates are first taken from labelled rows alone, so that a crowd of correlated voters
    cannot make its common vote the label before the correlations are known.
    """
    fires = fires.astype(np.float32)
    n, voters = fires.shape
    together = (fires.T @ fires).astype(float)
    gold = np.where(given < 0, 0.0, np.where(given > 0, 1, -1)) * np.log(GOLD_ACCURACY / (1 - GOLD_ACCURACY))
    known = (given >= 0).astype(float)
    posterior = np.where(given > 0, 1.0, 0.0)
    counted = np.ones(voters)

    def product(rows: np.ndarray) -> np.ndarray:
        return (rows.astype(np.float32) @ fires).astype(float)

    def rates(weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        toxic, other = posterior * weight, (1 - posterior) * weight
        return (
            (product(toxic) + 0.5) / (toxic.sum() + 1),
            (product(other) + 0.5) / (other.sum() + 1),
            float(np.clip(toxic.sum() / max(weight.sum(), 1), 0.005, 0.995)),
        )

    def vote(on_toxic: np.ndarray, on_other: np.ndarray, share: float) -> np.ndarray:
        for_fire = np.log(on_toxic / on_other) * counted
        for_none = np.log((1 - on_toxic) / (1 - on_other)) * counted
        votes = fires @ (for_fire - for_none).astype(np.float32)
        odds = np.log(share / (1 - share)) + gold + votes + for_none.sum()
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    found = rates(known if known.any() else np.ones(n))
    posterior = vote(*found)
    for _ in range(2):
        # Products of what is left of the votes when each row's expected vote is taken off.
        sides = np.stack([posterior, 1 - posterior])
        expected = np.stack(found[:2])
        cross = np.stack([product(side) for side in sides]).T @ expected
        rest = (together - cross - cross.T + expected.T @ (sides @ sides.T) @ expected) / n
        spread = np.sqrt(np.maximum(np.diag(rest), 0)) + 1e-6
        correlation = rest / np.outer(spread, spread)
        np.fill_diagonal(correlation, 0)
        counted = 1 / (1 + np.maximum(correlation, 0).sum(axis=0))
        for _ in range(rounds):
            found = rates(np.ones(n))
            posterior = vote(*found)
    return posterior


@dataclass
class Model:
    lexicon: list[str]
    weight: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        counts, sizes = Voters(self.lexicon).count(texts)
        odds = features(counts, sizes, len(self.lexicon)) @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def logistic(rows: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Weights and bias for soft labels, by Newton steps with a ridge on the weights."""
    inputs = np.empty((rows.shape[0], rows.shape[1] + 1), np.float32)
    inputs[:, :-1] = rows
    inputs[:, -1] = 1
    penalty = np.full(inputs.shape[1], ridge)
    penalty[-1] = 1e-6
    weight = np.zeros(inputs.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(inputs @ weight.astype(np.float32), -30, 30)))
        curve = np.maximum(p * (1 - p), 1e-6).astype(np.float32)
        slope, bend = penalty * weight, np.diag(penalty)
        for at in range(0, len(inputs), CHUNK):
            part = inputs[at : at + CHUNK]
            slope += (p - target)[at : at + CHUNK] @ part.astype(float)
            bend += ((part * curve[at : at + CHUNK, None]).T @ part).astype(float)
        step = np.linalg.solve(bend, slope)
        weight -= step
        if np.abs(step).max() < 1e-3:
            break
    return weight[:-1], float(weight[-1])


def mine(training: DataFrame) -> list[str]:
    """Lexicon voters: entries that stand out in the toxic documents of ``training``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, all_docs = Counter(), Counter()

        def emit() -> pa.RecordBatch:
            # Entries without a toxic document so far matter for the share alone.
            columns = [pa.array(list(all_docs), pa.string()), pa.array([toxic[s] for s in all_docs], pa.int64()), pa.array(list(all_docs.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["entry", "toxic", "docs"])

        for batch in batches:
            for part in slices(batch, "text"):
                for text, label in zip(strings(part, "text"), part.column("label").to_pylist(), strict=True):
                    seen = Counter()
                    for word, times in Counter(WORD.findall(text.lower())).items():
                        for sign in signs(word):
                            seen[sign] += times
                    found = [*seen, *[sign + TWICE for sign, times in seen.items() if times > 1]]
                    all_docs.update(found)
                    if label:
                        toxic.update(found)
                if len(all_docs) > COUNTED:
                    yield emit()
                    toxic.clear()
                    all_docs.clear()
        yield emit()

    counted = (
        training.mapInArrow(lean(run), "entry string, toxic long, docs long")
        .groupBy("entry")
        .agg(F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs"))
        .filter((F.col("toxic") >= LEAST_DOCS) & (F.col("toxic") >= LEAST_SHARE * F.col("docs")))
    )
    best = counted.orderBy(F.desc(F.col("toxic") * F.col("toxic") / F.col("docs")), "entry").limit(LEXICON)
    return sorted(row["entry"] for row in best.collect())


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Model:
    """Model from a bounded sample of the folds that are not held out."""
    chosen = {
        row["doc_id"]: row["label"]
        for row in sample(labels, label_col, LABELLED_ROWS, keep=~held_out(F.col("doc_id"))).collect()
    }
    share = sum(map(bool, chosen.values())) / len(chosen) if chosen else 0.0
    if not 0 < share < 1:
        return Model([], np.zeros(len(PATTERNS) + len(FEATURES_AFTER)), _odds(share))
    lexicon = mine(with_labels(small_batches(docs), chosen, id_col, text_col))
    others = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"))
        .filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_ROWS)
    )
    for row in others.collect():
        if len(chosen) < SAMPLE_ROWS:
            chosen.setdefault(row["doc_id"], -1)
    voters = Voters(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts, sizes = voters.count(strings(part, "text"))
                # Few voters fire on a document: send their places and counts.
                packed = [
                    np.stack([at, row[at]], axis=1).astype("<f4").tobytes()
                    for row in counts
                    for at in [np.flatnonzero(row)]
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array(packed, pa.binary()), pa.array(sizes)], ["label", "counts", "words"]
                )

    table = with_labels(small_batches(docs), chosen, id_col, text_col).mapInArrow(lean(run), "label int, counts binary, words long").toPandas()
    if not len(table):
        return Model([], np.zeros(len(PATTERNS) + len(FEATURES_AFTER)), _odds(share))
    table = table.sort_values(["counts", "words", "label"])
    counts = np.zeros((len(table), len(voters.names)), np.float32)
    for row, packed in enumerate(table["counts"]):
        found = np.frombuffer(packed, "<f4").reshape(-1, 2)
        counts[row, found[:, 0].astype(np.int64)] = found[:, 1]
    posterior = label_model(counts > 0, table["label"].to_numpy())
    weight, bias = logistic(features(counts, table["words"].to_numpy(), len(lexicon)), posterior)
    return Model(lexicon, weight, bias)


def _odds(share: float) -> float:
    return float(np.log(share / (1 - share))) if 0 < share < 1 else (30.0 if share else -30.0)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(model.score(strings(part, "text")))], ["doc_id", "score"]
                )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(pa.array(model.score(strings(part, text_col)) < THRESHOLD))

    return small_batches(docs).mapInArrow(lean(run), docs.schema)
