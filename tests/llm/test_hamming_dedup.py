import random
import re

import numpy as np
import pytest
import xxhash

from weirframe.llm import hamming_dedup as H
from weirframe.session import Scratch

SF_DIR = "/root/testdata/sf0.01"


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_roots(fps):
    """Least member of each fingerprint's component, by comparing all pairs."""
    values = np.array(sorted(set(fps)), dtype=np.uint64)
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(values)):
        near = np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= H.MAX_DISTANCE) + i + 1
        for j in near.tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {int(v): find(k) for k, v in enumerate(values.tolist())}


def expected_components(rows):
    roots = plain_roots([fp for _, fp in rows])
    least = {}
    for doc_id, fp in rows:
        old = least.get(roots[fp])
        if doc_id is not None and (old is None or doc_id < old):
            least[roots[fp]] = doc_id
        least.setdefault(roots[fp], None)
    return sorted((doc_id if doc_id is not None else -1, fp, least[roots[fp]]) for doc_id, fp in rows)


def found_components(frame):
    return sorted(
        (r["doc_id"] if r["doc_id"] is not None else -1, r["fp"] & (2**64 - 1), r["component_id"]) for r in frame.collect()
    )


def test_fingerprints_and_components_of_the_given_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r["doc_id"], plain_simhash(r["text"])) for r in docs.collect()]
    with Scratch(spark, "t") as scratch:
        assert found_components(H.near_duplicates(docs, scratch)) == expected_components(rows)


@pytest.mark.parametrize("rest_limit", [0, 32])
def test_links_in_crowds_and_chains(spark, monkeypatch, rest_limit):
    monkeypatch.setattr(H, "REST_LIMIT", rest_limit)
    rng = random.Random(5)
    fps = [0, 2**64 - 1, *(rng.getrandbits(64) for _ in range(60))]
    for _ in range(3):  # crowds around centres: some members are near each other only
        centre = rng.getrandbits(64)
        for _ in range(120):
            fp = centre
            for bit in rng.sample(range(64), rng.randint(0, 9)):
                fp ^= 1 << bit
            fps.append(fp)
    low = rng.getrandbits(32)  # one half in common, the other at random distances
    other = rng.getrandbits(32)
    for _ in range(120):
        high = other
        for bit in rng.sample(range(32), rng.randint(0, 8)):
            high ^= 1 << bit
        fps.append(high << 32 | low)
    chain = rng.getrandbits(64)
    for k in range(15):
        fps.append(chain)
        for bit in range(4 * k, 4 * k + 4):
            chain ^= 1 << bit
    rows = list(enumerate([*fps, *fps[:50]]))
    table = spark.createDataFrame([(i, fp - 2**64 if fp >= 2**63 else fp) for i, fp in rows], "doc_id long, fp long")
    with Scratch(spark, "t") as scratch:
        found = table.join(H.components(table, scratch), "fp")
        assert found_components(found) == expected_components(rows)


def test_odd_rows(spark):
    long_text = "word " * 300_000
    rows = [(1, None), (2, ""), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, long_text), (None, "q w e r t")]
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, fp int, turn string")
    with Scratch(spark, "t") as scratch:
        found = H.near_duplicates(docs, scratch)
        expected = expected_components([(i, plain_simhash(t)) for i, t in rows])
        assert found_components(found) == expected
    with Scratch(spark, "t") as scratch:
        kept = H.keep_one(docs, scratch)
        assert kept.columns == docs.columns
        assert sorted((r["doc_id"] or 0, (r["text"] or "")[:11]) for r in kept.collect()) == [
            (0, "q w e r t"), (1, ""), (3, "a b c d e f"), (4, "word word w"),
        ]
    empty = docs.limit(0)
    with Scratch(spark, "t") as scratch:
        assert H.near_duplicates(empty, scratch).count() == 0
    with Scratch(spark, "t") as scratch:
        assert H.keep_one(empty, scratch).count() == 0
