"""Spelling variants of a corpus' words, found by pivotal grams.

Two words are near if one inserted, deleted or replaced code point turns one into the other.
A word's form is its near word of the largest count, if that is at least ``RATIO`` times the
word's own; its root is reached by following forms.

Index. Bigrams are ordered by the number of words that have them, rarest first. A word's
prefix is its three rarest bigrams and all further occurrences of them, and its two pivots are
disjoint bigrams of the prefix that occur in the fewest words together, chosen by dynamic
programming over their positions. One edit touches one of two disjoint bigrams at most, so of
two near words, that whose prefix ends no later in the order has a pivot that the other one
still holds, and holds in its prefix. What lies on one side of that bigram is unchanged too,
which fixes its position from that end, and one half of what lies on the other side: pivots
and prefix grams are filed with the whole text on either side and both halves of the rest.
Pairs that share a key and differ in length by one at most are verified by their edit
distance. All pairs are found.

Scale: tasks add up words before the shuffle; later steps work on distinct words. The table
of bigrams has one row for each pair of letters, 90 squared at most, which bounds what tasks
are sent. Keys with many words are joined as a skewed join, not collected.

Nulls: a null text has no words; a null id counts as an empty one. Repeated rows count again.
An empty table gives no rows. Texts are taken whole, however long. Ties between near words of
equal count go to the smallest in code-point order; a form has at least ``RATIO`` times its
word's count, so following forms ends. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirframe.llm.batches import slices, utf8
from weirframe.session import Scratch

LEAST_CHARS = 6
LEAST_COUNT = 5
RATIO = 5
#: One of so many runs loses a code point, chosen by its checksum.
DAMAGED = 199
HASH_SEED = 42
#: Words that a task counts before it passes their counts on.
COUNTED = 1 << 18
#: Grams of a prefix: one more than one edit can touch.
PREFIX = 3


def word_of(run: str, checksum: int) -> str:
    """The run, without one code point if its checksum says so."""
    if checksum % DAMAGED:
        return run
    at = checksum % len(run)
    return run[:at] + run[at + 1 :]


def counted(docs: DataFrame, id_col: str, text_col: str, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Partial counts of tasks: ``word`` and ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = re.compile("[a-zÀ-ÿ]{%d,}" % least_chars)
        held: Counter[str] = Counter()

        def emit() -> pa.RecordBatch:
            columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), utf8(part, "text"), strict=True):
                    head = crc32(b"" if doc_id is None else b"%d" % doc_id)
                    head = crc32(b":", head)
                    for found, n in Counter(letters.findall(text.lower().decode())).items():
                        word = word_of(found, crc32(found.encode(), head))
                        if len(word) >= least_chars:
                            held[word] += n
                if len(held) > COUNTED:
                    yield emit()
                    held.clear()
        yield emit()

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "word string, n long")


def pivots(cost: list[int], at: list[int]) -> tuple[int, int]:
    """Places in ``at`` (rising positions of bigrams) of two disjoint ones with the least sum of costs.

    ``one`` is the cheapest bigram that ends before position ``p``, for the positions so far.
    """
    best, chosen = None, (0, 0)
    one: list[int] = []
    for k in range(len(at)):
        before = [one[j] for j in range(k) if at[j] + 2 <= at[k]]
        if before and (best is None or cost[before[-1]] + cost[k] < best):
            best, chosen = cost[before[-1]] + cost[k], (before[-1], k)
        one.append(k if not one or cost[k] < cost[one[-1]] else one[-1])
    return chosen


def grams_of(word: str, order: dict[str, int], frequency: dict[str, int]) -> tuple[list[int], list[int], int]:
    """Positions of a word's prefix grams and of its two pivots, and the order of its last prefix gram."""
    ranks = [order[word[k : k + 2]] for k in range(len(word) - 1)]
    last = sorted(ranks)[PREFIX - 1]
    prefix = [k for k, rank in enumerate(ranks) if rank <= last]
    pair = pivots([frequency[word[k : k + 2]] for k in prefix], prefix)
    return prefix, [prefix[k] for k in pair], last


def keys_of(word: str, at: int) -> list[bytes]:
    """A bigram with the text on one side of it, and an unchanged half of the text on the other.

    Of two texts of ``a`` and ``b`` code points that are one edit apart, the first or the last
    ``min(a, b) // 2`` are equal; with ``a`` known, that is one of two numbers.
    """
    keys = []
    for side, whole, rest in (("<", word[: at + 2], word[at + 2 :]), (">", word[at:], word[:at])):
        for half in sorted({max(0, len(rest) - 1) // 2, len(rest) // 2}):
            keys.append(f"{side}{whole}[{rest[:half]}")
            if half:
                keys.append(f"{side}{whole}]{rest[len(rest) - half :]}")
    return [key.encode() for key in keys]


def filed(words: DataFrame, frequency: dict[str, int]) -> DataFrame:
    """``key``, ``word``, ``size``, ``last`` and ``pivot`` (else prefix) of every filed gram."""
    order = {gram: k for k, (_, gram) in enumerate(sorted((n, gram) for gram, n in frequency.items()))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in batches:
            rows: list[tuple[int, str, int, int, bool]] = []
            for word in batch.column("word").to_pylist():
                prefix, chosen, last = grams_of(word, order, frequency)
                for pivot, places in ((False, prefix), (True, chosen)):
                    for at in places:
                        for key in keys_of(word, at):
                            rows.append((digest(key, HASH_SEED) - (1 << 63), word, len(word), last, pivot))
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.bool_())
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "word", "size", "last", "pivot"])

    return words.select("word").mapInArrow(run, "key long, word string, size int, last int, pivot boolean")


def near_pairs(words: DataFrame, scratch: Scratch) -> DataFrame:
    """``a`` and ``b`` of all pairs of near words, both ways. ``words`` has distinct words of four code points at least."""
    grams = words.select(F.explode(F.expr("array_distinct(transform(sequence(1, length(word) - 1), k -> substring(word, k, 2)))")).alias("gram"))
    frequency = {gram: n for gram, n in grams.groupBy("gram").count().collect()}
    entries = scratch.keep(filed(words, frequency), "grams")
    asking = entries.filter("pivot").select("key", F.col("word").alias("a"), F.col("size").alias("a_size"), F.col("last").alias("a_last"))
    holding = entries.filter("not pivot").select("key", F.col("word").alias("b"), F.col("size").alias("b_size"), F.col("last").alias("b_last"))
    met = asking.join(holding.hint("merge"), "key").filter(
        (F.abs(F.col("a_size") - F.col("b_size")) <= 1) & (F.col("a_last") <= F.col("b_last")) & (F.levenshtein("a", "b", 1) == 1)
    )
    once = scratch.keep(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near")
    return once.unionByName(once.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word`` and ``root`` of words with a ``form``: every round doubles the steps taken."""
    reached, step = scratch.keep(forms.select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = reached.join(further, "root", "left")
        step += 1
        reached = scratch.keep(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), f"roots-{step}")
        if reached.filter("moved").isEmpty():
            return reached.select("word", "root")
        reached = reached.select("word", "root")


def variants(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of the words of ``docs``."""
    totals = counted(docs, id_col, text_col).groupBy("word").agg(F.sum("n").alias("n"))
    words = scratch.keep(totals.filter(F.col("n") >= LEAST_COUNT), "words")
    pairs = near_pairs(words, scratch)
    with_n = pairs.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    best = with_n.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), "b")).alias("best")
    )
    found = words.join(best, "word", "left")
    takes = -F.col("best.less") >= RATIO * F.col("n")
    placed = scratch.keep(
        found.select(
            "word",
            F.when(takes, F.col("best.b")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(takes, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(placed.filter("form is not null"), scratch)
    return placed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
