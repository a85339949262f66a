"""Near-duplicates by SimHash and multi-index hashing.

A fingerprint is the bitwise majority of the XXH64 of a text's word shingles. Two
fingerprints link at ``MAX_DISTANCE`` or fewer differing bits; components are closed
over links. Every step works on distinct fingerprints, so copies cost nothing.

Index. The 64 bits are two segments of 32. Of two linked fingerprints, one segment
differs in at most 2 bits, so the balls of radius 1 around both values of that segment
meet. Each fingerprint is filed under the 33 values of either ball (66 keys), and
fingerprints that share a key are candidates, verified over all 64 bits.

Crowded keys. All pairs of a crowd are never made. First every member is compared with
the key's least member; keys whose members that already puts into one component are
done. In the others, the members outside the key's largest component, where they are up
to ``REST_LIMIT``, are compared with all members of other components, which is linear in
the key's members. The remaining keys use the middle point: fingerprints at distance 4 or less share a point
within 2 bits of both, and fingerprints that share such a point are that close. Each
member is filed under its points that agree with the key (529 or 33 of them), and all
members of a point link to the least one. So work grows with the members, and no link
between different texts is lost.

Nulls: a null text has no words, and fingerprint zero, as an empty one; zero links like
any other. A null id counts as larger than all ids. Repeated rows share a component.
An empty table gives an empty result. Columns other than id and text are ignored by
``fingerprints`` and kept by ``keep_one``, which has a rule of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirframe.llm import near_texts
from weirframe.llm.batches import slices, utf8
from weirframe.llm.connect import connected
from weirframe.session import Scratch

SHINGLE_WORDS = 4
HASH_SEED = 42
MAX_DISTANCE = 4
HALF = 32
REST_LIMIT = 32
#: Hashes whose bits are counted at a time.
CHUNK = 1 << 16


def simhash(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """64-bit majority fingerprint of UTF-8 text; zero without words."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - width + 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    first = (ends - sizes)[:n].tolist()
    last = ends[len(words) - n :].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        hashes = np.array(
            [digest(joined[a:b], HASH_SEED) for a, b in zip(first[at : at + CHUNK], last[at : at + CHUNK], strict=True)],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = np.array([simhash(text) for text in utf8(part, "text")], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"]
                )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, fp long")


def _masks(radius: int, bits: int = HALF) -> list[int]:
    return [sum(1 << bit for bit in picked) for r in range(radius + 1) for picked in combinations(range(bits), r)]


def _low(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _high(fp: Column) -> Column:
    return F.shiftrightunsigned(fp, HALF)


def _close(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= MAX_DISTANCE


def _probes(fps: DataFrame) -> DataFrame:
    """``key`` (segment and value, 33 bits) and ``fp``: the balls of both segments."""
    ball = F.array(*[F.lit(mask) for mask in _masks(1)])
    low = F.transform(ball, lambda mask: _low(F.col("fp")).bitwiseXOR(mask))
    high = F.transform(ball, lambda mask: _high(F.col("fp")).bitwiseXOR(mask).bitwiseOR(F.lit(1 << HALF)))
    return fps.select(F.explode(F.concat(low, high)).alias("key"), "fp")


def _middle_points(members: DataFrame) -> DataFrame:
    """``point`` and ``fp``: points within 2 bits of a member that agree with its key."""
    low_key = F.col("key") < (1 << HALF)
    value = _low(F.col("key"))
    own = F.when(low_key, _low(F.col("fp"))).otherwise(_high(F.col("fp")))
    rest = F.when(low_key, _high(F.col("fp"))).otherwise(_low(F.col("fp")))
    near = F.array(*[F.lit(mask) for mask in _masks(1)])
    far = F.array(*[F.lit(mask) for mask in _masks(2)])
    moved = F.explode(F.when(own == value, far).otherwise(near))
    point = F.when(F.col("low_key"), F.shiftleft(F.col("other"), HALF).bitwiseOR(F.col("value"))).otherwise(
        F.shiftleft(F.col("value"), HALF).bitwiseOR(F.col("other"))
    )
    return (
        members.select("fp", low_key.alias("low_key"), value.alias("value"), rest.alias("rest"), moved.alias("mask"))
        .select("fp", "low_key", "value", F.col("rest").bitwiseXOR(F.col("mask")).alias("other"))
        .select(point.alias("point"), "fp")
    )


def _members_to_least(rows: DataFrame, key: str) -> DataFrame:
    """Edges from each ``fp`` of a key to the key's least one."""
    least = rows.groupBy(key).agg(F.min("fp").alias("u"), F.max("fp").alias("most")).filter("u < most")
    return rows.join(least.select(key, "u"), key).filter("fp <> u").select("u", F.col("fp").alias("v"))


def links(fps: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges ``u, v`` between distinct fingerprints whose closure is the closure of all links."""
    probes = _probes(fps)
    keys = scratch.keep(
        probes.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v"))
        .filter("n > 1"),
        "keys",
    )
    pairs = keys.filter("n = 2").filter(_close(F.col("u"), F.col("v"))).select("u", "v")
    # Without the hint small inputs would broadcast the keys; they grow with the input.
    crowded = keys.filter("n > 2").select("key", "u").hint("merge")
    members = scratch.keep(probes.join(crowded, "key"), "members")
    to_least = members.filter("fp <> u").filter(_close(F.col("u"), F.col("fp"))).select("u", F.col("fp").alias("v"))
    first = scratch.keep(pairs.union(to_least).distinct(), "first-edges")

    parts = connected(first, scratch, "first")
    placed = members.join(parts, members["fp"] == parts["node"], "left").select(
        "key", "fp", F.coalesce("root", "fp").alias("part")
    )
    placed = scratch.keep(placed, "placed")
    sizes = placed.groupBy("key", "part").agg(F.count("*").alias("size"))
    open_keys = (
        sizes.groupBy("key")
        .agg(F.count("*").alias("parts"), F.max_by("part", F.struct("size", "part")).alias("big"),
             (F.sum("size") - F.max("size")).alias("rest"))
        .filter("parts > 1")
        .select("key", "big", "rest")
    )
    unsettled = scratch.keep(placed.join(open_keys, "key"), "unsettled")
    few, many = unsettled.filter(F.col("rest") <= REST_LIMIT), unsettled.filter(F.col("rest") > REST_LIMIT)
    left = few.filter("part <> big").select("key", F.col("fp").alias("u"), F.col("part").alias("a"))
    right = few.select("key", F.col("fp").alias("v"), F.col("part").alias("b"), "big")
    differ = (F.col("b") == F.col("big")) | ((F.col("a") != F.col("b")) & (F.col("u") < F.col("v")))
    across = left.join(right, "key").filter(differ & _close(F.col("u"), F.col("v"))).select("u", "v")
    points = _middle_points(many).distinct()
    return first.union(across).union(_members_to_least(points, "point"))


def components(fps: DataFrame, scratch: Scratch) -> DataFrame:
    """``fp``, ``root`` (least fingerprint) and ``component_id`` of every distinct fingerprint."""
    nodes = scratch.keep(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    roots = connected(links(nodes.select("fp"), scratch), scratch, "all")
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    ids = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return placed.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` of every row of ``docs``."""
    fps = scratch.keep(fingerprints(docs, id_col, text_col), "fingerprints")
    return fps.join(components(fps, scratch), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each near-duplicate group of ``near_texts``, not of the fingerprints' links."""
    return near_texts.keep_one(docs, scratch, id_col, text_col)
