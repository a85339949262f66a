"""Document fingerprints by consistent weighted sampling.

Terms are words, weighted by how often the text has them. For each term and each of
``SAMPLES`` samples, two gamma variates ``r`` and ``c`` and a uniform ``b`` are drawn
from a hash of the term, and with weight ``w`` the term's bid is ``a = c / (y exp r)``,
where ``t = floor(ln w / r + b)`` and ``y = exp(r (t - b))``. The lowest bid wins the
sample. Two texts have the same winner, with the same ``t``, with a probability equal to
the generalised Jaccard similarity of their weights (sum of the lesser over sum of the
greater). The lowest bid itself identifies the winner, so a signature keeps 16 hashed
bits of it for each sample.

The edited text of a document takes its last quarter from the next document. To find
the next one, documents are dealt by ranges of ids; the first document of each range is
copied to the range before. Each range is sorted and read once.

Nulls: a null text is empty; texts without words have no bids, are alike (1) among each
other and unlike (0) all others. Rows with a null id come first. Rows with equal ids are
taken in the order of their texts. An empty table gives an empty result; a single
document is its own next. Columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirframe.llm.batches import mix, numbered, slices, starts_of, strings

SAMPLES = 64
SEED = 0x5EED
#: Terms whose bids are computed or compared at a time.
ROWS = 1 << 14
BITS = 16
#: Bytes of text whose terms share their bids.
SLICE_BYTES = 4 << 20
#: Ranges of ids for each shuffle partition, so that partitions come out even.
RANGES_PER_TASK = 4
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _uniform(bits: np.ndarray) -> np.ndarray:
    return (bits.astype(np.float64) + 0.5) / 2**32


def bids(hashes: np.ndarray, weights: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """Log bids of terms (rows) for each sample (columns)."""
    seeds = mix(np.arange(samples, dtype=np.uint64) + np.uint64(SEED))
    first = mix(hashes[:, None] ^ seeds[None, :])
    second, third = mix(first), mix(first ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    low = np.uint64(0xFFFFFFFF)
    r = -np.log(_uniform(first & low) * _uniform(first >> np.uint64(32)))
    log_c = np.log(-np.log(_uniform(second & low) * _uniform(second >> np.uint64(32))))
    b = _uniform(third & low)
    t = np.floor(np.log(weights)[:, None] / r + b)
    return (log_c - r * (t - b) - r).astype(np.float32)


def signatures(texts: list[str], samples: int = SAMPLES) -> np.ndarray:
    """``samples`` numbers of ``BITS`` bits for each text; all zero without words."""
    split = [text.split() for text in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    distinct, words = numbered([word for part in split for word in part])
    span = max(len(distinct), 1)
    pair, weights = np.unique(np.repeat(np.arange(len(texts)), sizes) * span + words, return_counts=True)
    text, term = pair // span, pair % span
    # Bids depend on the term and its weight alone: compute those of each such pair once.
    top = int(weights.max(initial=1)) + 1
    kinds, kind = np.unique(term * top + weights, return_inverse=True)
    hashes = np.array(
        [int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for w in distinct],
        np.uint64,
    )
    table = np.empty((len(kinds), samples), np.float32)
    for at in range(0, len(kinds), ROWS):
        part = kinds[at : at + ROWS]
        table[at : at + ROWS] = bids(hashes[part // top], (part % top).astype(np.float64), samples)
    found = np.full((len(texts), samples), np.inf, np.float32)
    borders = starts_of(np.bincount(text, minlength=len(texts)))
    at = 0
    while at < len(texts):
        # As many whole texts as fit, or a part of a text that is larger.
        end = max(at + 1, bisect_right(borders, borders[at] + ROWS) - 1)
        rows = kind[borders[at] : borders[end]]
        if len(rows) > ROWS:
            for k in range(0, len(rows), ROWS):
                found[at] = np.minimum(found[at], table[rows[k : k + ROWS]].min(axis=0))
        elif len(rows):
            filled = np.flatnonzero(np.diff(borders[at : end + 1]))
            cuts = (borders[at:end] - borders[at])[filled]
            found[at + filled] = np.minimum.reduceat(table[rows], cuts, axis=0)
        at = end
    code = (mix(found.view(np.uint32)) >> np.uint64(64 - BITS)).astype(">u2")
    code[sizes == 0] = 0
    return code


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of samples with the same winner: estimates the generalised Jaccard similarity."""
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the start of the following one."""
    size = len(text) // 4
    return text[: len(text) - size] + following[:size]


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and its edited text, with their likenesses."""
    spark = docs.sparkSession
    source = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("at"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = RANGES_PER_TASK * tasks
    cuts = source.stat.approxQuantile("at", [k / ranges for k in range(1, ranges)], 0.2 / ranges)
    bounds = sorted({int(cut) for cut in cuts or []})
    dealt = source.withColumn("part", _range_of(F.col("at"), bounds))
    # The least id of each range that has rows: as many numbers as there are ranges.
    heads = sorted((row["part"], row["least"]) for row in dealt.groupBy("part").agg(F.min("at").alias("least")).collect())
    if not heads:
        return spark.createDataFrame([], SCHEMA)
    # By range: its least id, and the range before it that has rows (for the first, the last).
    least, before = [None] * (len(bounds) + 1), [None] * (len(bounds) + 1)
    for k, (part, first) in enumerate(heads):
        least[part], before[part] = first, heads[k - 1][0]

    def of_range(values: list[int | None]) -> Column:
        return F.get(F.array(*[F.lit(value).cast("long") for value in values]), F.col("part"))

    copied = F.when(F.col("at") == of_range(least), of_range(before).cast("int"))
    rows = dealt.select(
        "doc_id", "at", "text",
        F.explode(
            F.when(copied.isNull(), F.array(F.struct(F.col("part"), F.lit(False).alias("ghost")))).otherwise(
                F.array(
                    F.struct(F.col("part"), F.lit(False).alias("ghost")),
                    F.struct(copied.alias("part"), F.lit(True).alias("ghost")),
                )
            )
        ).alias("to"),
    ).select("doc_id", "at", "text", "to.part", "to.ghost")
    ordered = rows.repartition(tasks, "part").sortWithinPartitions("part", "ghost", "at", F.xxhash64("text"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None
        for batch in batches:
            for piece in slices(batch, "text", SLICE_BYTES):
                columns = (piece.column(name).to_pylist() for name in ("doc_id", "text", "part", "ghost"))
                pairs = []
                for doc_id, text, part, ghost in zip(*columns, strict=True):
                    if waiting is not None and waiting[2] == part:
                        pairs.append((waiting[0], waiting[1], text))
                        waiting = None
                    if not ghost:
                        waiting = (doc_id, text, part)
                if pairs:
                    yield _result(pairs)

    return ordered.mapInArrow(run, SCHEMA)


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most ``value``, by halving."""
    if not bounds:
        return F.lit(0)
    middle = len(bounds) // 2
    return F.when(value < bounds[middle], _range_of(value, bounds[:middle])).otherwise(
        _range_of(value, bounds[middle + 1 :]) + (middle + 1)
    )


def _result(pairs: list[tuple]) -> pa.RecordBatch:
    ids = [doc_id for doc_id, _, _ in pairs]
    texts = [text for _, text, _ in pairs]
    changed = [edited(text, following) for _, text, following in pairs]
    # A following text is mostly the next text of the list; others go to its end.
    all_texts, place = list(texts), []
    for k, (_, _, following) in enumerate(pairs):
        if k + 1 < len(texts) and texts[k + 1] is following:
            place.append(k + 1)
        else:
            place.append(len(all_texts))
            all_texts.append(following)
    found = signatures([*all_texts, *changed])
    own, new, following = found[: len(texts)], found[len(all_texts) :], found[place]
    columns = [
        pa.array(ids, pa.int64()),
        pa.array([len(text) for text in texts], pa.int64()),
        pa.array([hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest() for text in changed]),
        pa.array([row.tobytes().hex() for row in own]),
        pa.array([row.tobytes().hex() for row in new]),
        pa.array([likeness(a, b) for a, b in zip(own, new, strict=True)]),
        pa.array([likeness(a, b) for a, b in zip(own, following, strict=True)]),
    ]
    return pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in SCHEMA.split(", ")])
