"""Quality rules learnt as gradient-boosted trees over document statistics.

Each task computes the statistics of its texts in numpy, whole texts at a time in
bounded slices. Trees are fitted on the driver on at most ``TRAINING_ROWS`` labelled
documents (second-order boosting on binned statistics). Statistics in ``FALLING`` carry
a monotonic constraint: where one of them rises, all others equal, the score cannot
rise. The forest is flattened into arrays of nodes, one row per tree, and scored for
all rows of a slice at once, level by level.

A document that fails the base rules (under ``LEAST_WORDS`` words, or over
``MOST_REPEATED`` percent of its words in repeated eight-word windows) is not kept;
for all others the forest decides.

Nulls: a null text has no words, so it fails; a null id stays null. Repeated rows get
equal results. Without labels of both kinds the base rules decide alone. Columns other
than id and text are ignored by ``judge`` and kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirframe.llm.batches import lean, mix, numbered, slices, small_batches, starts_of, utf8
from weirframe.llm.labelled import sample, with_labels

TRAINING_ROWS = 12_000
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
TREES, DEPTH, RATE, BINS, RIDGE = 60, 3, 0.2, 64, 1.0
LEAST_SCORE = 0.5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATISTICS = [
    "log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share",
    "digit_share", "mark_share", "stop_share", "words_per_line", "wide_share",
]
#: Where these rise, the score must not rise.
FALLING = ["symbol_share", "dup_line_share", "repeat_share"]
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"


def statistics(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``COUNTS`` (integers) and ``STATISTICS`` of UTF-8 texts, a row for each."""
    split = [text.split() for text in texts]
    n_words = np.fromiter(map(len, split), np.int64, len(split))
    _, words = numbered([word for part in split for word in part])
    repeated, distinct = _repeats(words, n_words)
    seen = np.zeros((len(texts), 256), np.int64)
    lines, dup_lines = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for row, text in enumerate(texts):
        seen[row] = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        with_word = [line for line in text.split(b"\n") if line.strip()]
        lines[row] = len(with_word)
        dup_lines[row] = len(with_word) - len(set(with_word))
    points = seen.sum(axis=1) - seen[:, 0x80:0xC0].sum(axis=1)
    word_chars = points - seen[:, list(SPACES)].sum(axis=1)
    symbols = seen[:, list(SYMBOLS)].sum(axis=1)
    counts = np.stack([n_words, word_chars, symbols, dup_lines, repeated], axis=1)
    word, char, line = (np.maximum(n, 1) for n in (n_words, word_chars, lines))
    shares = np.stack(
        [
            np.log1p(n_words),
            word_chars / word,
            symbols / char,
            dup_lines / line,
            repeated / word,
            distinct / word,
            seen[:, 0x41:0x5B].sum(axis=1) / char,
            seen[:, 0x30:0x3A].sum(axis=1) / char,
            seen[:, list(b"!?")].sum(axis=1) / char,
            seen[:, list(b".,;:")].sum(axis=1) / char,
            n_words / line,
            (points - seen[:, :0x80].sum(axis=1)) / char,
        ],
        axis=1,
    )
    return counts, shares


def _repeats(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words inside windows found again in their text, and distinct words, of each text."""
    starts = starts_of(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    pair = np.unique(text * (words.max(initial=0) + 1) + words)
    distinct = np.bincount(pair // (words.max(initial=0) + 1), minlength=len(sizes))
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.zeros(len(sizes), np.int64), distinct
    hashed = mix(words)
    for gap in (1, 2, 4):
        hashed = mix(hashed[:-gap] * np.uint64(0x9E3779B97F4A7C15) + hashed[gap:])
    at = np.flatnonzero(text[:n] == text[WINDOW - 1 :])
    key = mix(hashed[at] + text[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + WINDOW, -1)
    inside = starts_of(np.cumsum(cover[:-1]) > 0)
    return inside[starts[1:]] - inside[starts[:-1]], distinct


@dataclass
class Forest:
    """Flattened trees: children of node ``i`` are ``2i + 1`` and ``2i + 2``."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        tree = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(rows), len(self.feature)), np.int64)
        row = np.arange(len(rows))[:, None]
        for _ in range(DEPTH):
            at = 2 * at + 1 + (rows[row, self.feature[tree, at]] > self.threshold[tree, at])
        return 1 / (1 + np.exp(-(self.base + self.value[tree, at].sum(axis=1))))


def fit(rows: np.ndarray, labels: np.ndarray, falling: list[int]) -> Forest:
    """Boosted trees for the probability of label 1, never rising in the features ``falling``."""
    n, width = rows.shape
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], rows[:, f], side="left") for f in range(width)], axis=1)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    nodes = 2 ** (DEPTH + 1) - 1
    feature = np.zeros((TREES, nodes), np.int64)
    threshold = np.full((TREES, nodes), np.inf)
    value = np.zeros((TREES, nodes))
    margin = np.full(n, base)
    for tree in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        gradient, curve = labels - p, np.maximum(p * (1 - p), 1e-6)
        todo = [(0, np.arange(n), -np.inf, np.inf)]
        while todo:
            node, at, low, high = todo.pop()
            own = float(np.clip(gradient[at].sum() / (curve[at].sum() + RIDGE), low, high))
            value[tree, node] = RATE * own
            margin_now = value[tree, node]
            if 2 * node + 2 >= nodes:
                margin[at] += margin_now
                continue
            split = _best(binned, gradient, curve, at, cuts, falling, low, high)
            if split is None:
                # Rows go left at an infinite threshold, down to a leaf of the same value.
                left = node
                while 2 * left + 1 < nodes:
                    left = 2 * left + 1
                    value[tree, left] = margin_now
                margin[at] += margin_now
                continue
            f, cut, a, b = split
            feature[tree, node], threshold[tree, node] = f, cuts[f][cut]
            goes_right = binned[at, f] > cut
            middle = (a + b) / 2
            bounds = ((middle, high), (low, middle)) if f in falling else ((low, high), (low, high))
            todo.append((2 * node + 1, at[~goes_right], *bounds[0]))
            todo.append((2 * node + 2, at[goes_right], *bounds[1]))
    return Forest(feature, threshold, value, base)


def _best(binned, gradient, curve, at, cuts, falling, low, high):
    """Feature, cut and side values of the split with the largest gain, if any gains."""
    found, most = None, 1e-6
    whole_g, whole_h = gradient[at].sum(), curve[at].sum()
    before = whole_g**2 / (whole_h + RIDGE)
    for f, borders in enumerate(cuts):
        if not len(borders):
            continue
        g = np.bincount(binned[at, f], gradient[at], len(borders) + 1).cumsum()[:-1]
        h = np.bincount(binned[at, f], curve[at], len(borders) + 1).cumsum()[:-1]
        a = np.clip(g / (h + RIDGE), low, high)
        b = np.clip((whole_g - g) / (whole_h - h + RIDGE), low, high)
        gain = 2 * (a * g + b * (whole_g - g)) - a * a * (h + RIDGE) - b * b * (whole_h - h + RIDGE) - before
        gain[(h < 1e-3) | (whole_h - h < 1e-3)] = 0
        if f in falling:
            gain[a < b] = 0
        cut = int(np.argmax(gain))
        if gain[cut] > most:
            most, found = gain[cut], (f, cut, float(a[cut]), float(b[cut]))
    return found


def train(
    docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality",
) -> Forest | None:
    """Forest fitted on at most ``rows`` labelled documents; none if labels are not of both kinds."""
    chosen = {r["doc_id"]: r["label"] for r in sample(labels, label_col, rows).collect()}
    if not chosen:
        return None
    schema = ", ".join(["label int", *(f"{name} double" for name in STATISTICS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                _, shares = statistics(utf8(part, "text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), *map(pa.array, shares.T)], ["label", *STATISTICS]
                )

    table = with_labels(small_batches(docs), chosen, id_col, text_col).mapInArrow(lean(run), schema).toPandas()
    truth = table["label"].to_numpy(dtype=float)
    if len(set(truth)) < 2:
        return None
    # Rows come in any order; sorting them makes equal input give equal trees.
    table = table.sort_values([*STATISTICS, "label"])
    return fit(
        table[STATISTICS].to_numpy(), table["label"].to_numpy(dtype=float), [STATISTICS.index(f) for f in FALLING]
    )


def verdicts(texts: list[bytes], forest: Forest | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts, failed by the base rules, score (1 without forest) and kept, of each text."""
    counts, shares = statistics(texts)
    failed = (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])
    score = forest.score(shares) if forest is not None else np.ones(len(texts))
    return counts, failed, score, ~failed & (score >= LEAST_SCORE)


def judge(docs: DataFrame, forest: Forest | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``score`` and ``kept`` of every row."""
    names = ["doc_id", *COUNTS, "base_failed", "kept", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts, failed, score, kept = verdicts(utf8(part, "text"), forest)
                columns = [part.column("doc_id"), *map(pa.array, counts.T), *map(pa.array, (failed, kept, score))]
                yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = ", ".join(f"{name} long" for name in COUNTS)
    return source.mapInArrow(run, f"doc_id long, {counts}, base_failed boolean, kept boolean, score double")


def keep(docs: DataFrame, forest: Forest | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(pa.array(verdicts(utf8(part, text_col), forest)[3]))

    return small_batches(docs).mapInArrow(lean(run), docs.schema)
