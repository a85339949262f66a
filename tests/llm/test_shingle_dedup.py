import random

import numpy as np
from pyspark.sql import functions as F

from weirframe.llm import hamming_dedup as H
from weirframe.llm import near_texts as N
from weirframe.llm import shingles as S
from weirframe.llm.queries import table
from weirframe.session import Scratch

SF_DIR = "/root/testdata/sf0.01"


def plain_kept(rows):
    """Least id of each group closed over a 5-word Jaccard similarity of 0.8, by comparing all pairs of sets."""
    sets = {}
    for doc_id, text in rows:
        words = text.lower().split()
        found = frozenset(" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
        sets[found] = min(doc_id, sets.get(found, doc_id))
    groups = {found: {doc_id} for found, doc_id in sets.items()}
    for a in sets:
        for b in sets:
            if 0.8 * max(len(a), len(b)) <= min(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
                merged = groups[a] | groups[b]
                for found in [f for f in sets if groups[f] & merged]:
                    groups[found] = merged
    return {min(group) for group in groups.values()}


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    with Scratch(spark, "t") as scratch:
        return {r["doc_id"] for r in H.keep_one(docs, scratch).collect()}


def test_given_table(spark):
    rows = [(r["doc_id"], r["text"] or "") for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    assert kept(spark, rows) == plain_kept(rows)


def test_edited_copies_at_both_sides_of_the_threshold(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(25):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(8, 300))]
        texts.append(words)
        for _ in range(6):
            copy = list(words)
            for at in rng.sample(range(len(copy)), max(1, len(copy) // rng.choice((30, 45, 60, 100)))):
                copy[at] = f"x{rng.randrange(10**6)}"
            texts.append(copy)
    rng.shuffle(texts)
    rows = [(k, " ".join(words)) for k, words in enumerate(texts)]
    expected = plain_kept(rows)
    assert 30 < len(expected) < len(rows) - 30
    assert kept(spark, rows) == expected


def test_crowds_of_unlike_texts_lose_no_link(spark):
    rng = random.Random(4)
    base = [f"b{k}" for k in range(300)]
    rows = []
    for k in range(16):  # similarity of about 0.7 to each other, each with one copy above 0.8
        own = base + [f"o{k}-{j}" for j in range(60)]
        rows += [(2 * k, " ".join(own)), (2 * k + 1, " ".join([*own[:-8], "end"]))]
    rng.shuffle(rows)
    expected = plain_kept(rows)
    assert len(expected) == 16
    assert kept(spark, rows) == expected


def test_crowd_of_copies_edited_to_all_degrees(spark):
    rng = random.Random(6)
    base = [f"b{k}" for k in range(150)]
    rows = [(1000, " ".join(base))]
    for k in range(200):  # similarities to the base from 0.3 to 1, about half of them above 0.8
        copy = list(base)
        for at in sorted(rng.sample(range(150), rng.randint(1, 8)), reverse=True):
            copy[at : at + 1] = rng.choice(([f"x{rng.randrange(40)}"], [], [copy[at], "y"]))
        rows.append((k, " ".join(copy)))
    expected = plain_kept(rows)
    assert 5 < len(expected) < 150
    assert kept(spark, rows) == expected


def test_prefixes_find_what_pivots_miss(spark, monkeypatch):
    """Without pivots, every link must come from the prefixes."""
    monkeypatch.setattr(N, "_pivot_pairs", lambda members: members.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0))
    rng = random.Random(7)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randint(20, 120))]
        for _ in range(8):
            copy = list(words)
            for at in rng.sample(range(len(copy)), len(copy) // 60):
                copy[at] = f"x{rng.randrange(50)}"
            texts.append(copy + ["tail"] * rng.randint(0, 3))
    rows = [(k, " ".join(words)) for k, words in enumerate(texts)]
    expected = plain_kept(rows)
    assert len(expected) < len(rows) - 10
    assert kept(spark, rows) == expected


def test_odd_rows(spark):
    same = "One two  three\nfour five six"
    rows = [(None, same), (5, same), (5, same.upper()), (5, same), (3, "one two three four five six seven"), (7, None), (8, ""), (None, " \n"), (9, "a b"), (10, "A  b"), (11, "b a")]
    schema = "doc_id long, text string, node string, marked int, row_key string, stays int, turn int, bands int, size int"
    docs = spark.createDataFrame([(*r, "n", 1, "k", 0, 2, 3, 4) for r in rows], schema)
    with Scratch(spark, "t") as scratch:
        found = H.keep_one(docs, scratch)
        assert found.columns == docs.columns
        assert sorted((r["doc_id"], (r["text"] or "").lower().split()) for r in found.collect()) == [
            (3, "one two three four five six seven".split()), (5, same.lower().split()), (7, []), (9, ["a", "b"]), (11, ["b", "a"]),
        ]
    with Scratch(spark, "t") as scratch:
        assert H.keep_one(docs.limit(0), scratch).count() == 0


def test_long_text(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**6)}" for _ in range(300_000)]
    near = [*words[:-1000], "end"]
    assert kept(spark, [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(words[:200_000]))]) == {1, 3}


def test_recall_of_the_keys():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(20, 400)
        common = {rng.getrandbits(64) for _ in range(8 * n)}
        a, b = (S.signature(np.array(sorted(common | {rng.getrandbits(64) for _ in range(n)}), np.uint64)) for _ in range(2))
        assert set(S.band_keys(a).tolist()) & set(S.band_keys(b).tolist())


def test_hashed_shingles_are_shingles():
    rng = random.Random(9)
    texts = [[b"w%d" % rng.randrange(6) for _ in range(n)] for n in (0, 1, 3, 4, 5, 6, 40, 400)]
    texts += [[b"w1"] * 4, [b"w1"] * 5, [b"w1"] * 9]
    found = S.hashed(texts)
    plain = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in texts]
    names = {}
    for hashes, shingles in zip(found, plain, strict=True):
        assert len(hashes) == len(shingles)
        for one in shingles:
            names.setdefault(one, S.hashed([list(one)])[0][0])
        assert set(hashes.tolist()) == {names[one] for one in shingles}
    assert len(set(names.values())) == len(names)


def plain_fingerprint(found, size_class):
    """Segment and majority bits, one shingle and bit at a time."""
    halvings = max(0, size_class - 3)
    dealt = {}
    for one in found:
        if one < 1 << (64 - halvings):
            segment = int(S.mix(np.array([one ^ int(S._SEGMENT_SEED)], np.uint64))[0]) % S.CLASSES[min(size_class, 3)][1]
            dealt.setdefault(size_class * 64 + segment, []).append(int(S.mix(np.array([one], np.uint64))[0]))
    return {place: sum((2 * sum(h >> k & 1 for h in hashes) > len(hashes)) << k for k in range(64)) for place, hashes in dealt.items()}


def test_fingerprints_are_majorities_of_segments():
    """A shingle more changes no other segment, and each size is filed with all sizes that may resemble it."""
    rng = random.Random(10)
    for n in (1, 2, 16, 17, 20, 21, 57, 70, 112, 113, 225, 280, 281, 448, 449, 560, 561, 1121, 5000):
        found = sorted(rng.getrandbits(64) for _ in range(n))
        rows = S.signature(np.array(found, np.uint64)).tolist()
        classes = sorted({place // 64 for place, _ in rows})
        assert classes == sorted({S._class_of(k) for k in (n, n * 5 // 4)})
        expected = {}
        for size_class in classes:
            expected |= plain_fingerprint(found, size_class)
        assert dict(map(tuple, rows)) == expected and len(rows) == len(expected)
    a = S.signature(np.array(sorted(found[:200]), np.uint64)).tolist()
    b = S.signature(np.array(sorted(found[:201]), np.uint64)).tolist()
    assert len(set(map(tuple, a)) ^ set(map(tuple, b))) <= 2


def test_keys_are_segments_of_the_fingerprint():
    rng = random.Random(11)
    for n in (3, 30, 100, 250, 700):
        fingerprint = S.signature(np.array(sorted(rng.getrandbits(64) for _ in range(n)), np.uint64))
        keys = S.band_keys(fingerprint)
        assert len(set(keys.tolist())) == len(fingerprint)
        fingerprint[0, 1] ^= np.uint64(1)
        assert (S.band_keys(fingerprint) != keys).tolist() == [True] + [False] * (len(keys) - 1)
