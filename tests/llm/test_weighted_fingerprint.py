import hashlib
from collections import Counter

import numpy as np

from weirframe.llm import weighted_fingerprint as W
from weirframe.llm.queries import op3_fingerprints

SF_DIR = "/root/testdata/sf0.01"


def jaccard(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    terms = a.keys() | b.keys()
    most = sum(max(a[t], b[t]) for t in terms)
    return sum(min(a[t], b[t]) for t in terms) / most if most else 1.0


def plain_signature(text):
    """The lowest bid of each sample, term by term."""
    counts = Counter(text.split())
    if not counts:
        return np.zeros(W.SAMPLES, ">u2")
    best = np.full(W.SAMPLES, np.inf, np.float32)
    for term, weight in counts.items():
        digest = np.array([int.from_bytes(hashlib.blake2b(term.encode(), digest_size=8).digest(), "little")], np.uint64)
        best = np.minimum(best, W.bids(digest, np.array([float(weight)]))[0])
    return (W.mix(best.view(np.uint32)) >> np.uint64(48)).astype(">u2")


def test_given_table(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    found = {r["doc_id"]: r for r in op3_fingerprints(spark, SF_DIR).collect()}
    assert len(found) == len(docs)
    errors = []
    for k, (doc_id, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        size = len(text) // 4
        changed = text[: len(text) - size] + following[:size]
        row = found[doc_id]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        if k % 25 == 0:
            assert row["fingerprint"] == plain_signature(text).tobytes().hex()
            assert row["edited_fingerprint"] == plain_signature(changed).tobytes().hex()
        errors.append((row["near_edited"] - jaccard(text, changed), row["near_next"] - jaccard(text, following)))
    assert np.abs(np.mean(errors, axis=0)).max() < 0.01  # unbiased
    assert np.sqrt(np.mean(np.square(errors), axis=0)).max() < 0.075  # binomial spread of 64 samples


def test_weights_count():
    a, b = "x " * 9 + "y", "x " * 3 + "y z z"
    samples = 4096
    found = W.likeness(*W.signatures([a, b], samples))
    assert abs(found - jaccard(a, b)) < 0.03


def test_long_and_many_texts_alike(monkeypatch):
    texts = [" ".join(f"w{k * i % 977}" for k in range(n)) for i, n in enumerate([0, 5, 3000, 1, 0, 700], 1)]
    whole = W.signatures(texts)
    monkeypatch.setattr(W, "ROWS", 16)
    assert (W.signatures(texts) == whole).all()


def test_odd_rows(spark):
    rows = [(5, "a b c d"), (None, "n n n n"), (7, None), (7, "z y"), (9, ""), (5, "a b c d"), (-3, "q" * 100_001)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, part int").repartition(3)
    found = W.fingerprint_pairs(docs).collect()
    order = [(None, "n n n n"), (-3, "q" * 100_001), (5, "a b c d"), (5, "a b c d"), (7, ""), (7, "z y"), (9, "")]
    by_id = Counter((r["doc_id"], r["n_chars"]) for r in found)
    assert by_id == Counter((i, len(t)) for i, t in order)
    same = [r for r in found if r["doc_id"] == 5]
    assert len({r["fingerprint"] for r in same}) == 1
    minus = next(r for r in found if r["doc_id"] == -3)
    assert minus["edited_sha256"] == hashlib.sha256(("q" * 75_001 + "a b c d").encode()).hexdigest()
    last = next(r for r in found if r["doc_id"] == 9)
    assert last["near_next"] == 0.0 and last["near_edited"] == 1.0
    assert W.fingerprint_pairs(docs.limit(0)).count() == 0
    one = W.fingerprint_pairs(docs.filter("doc_id = 9")).collect()
    assert [(r["doc_id"], r["near_next"]) for r in one] == [(9, 1.0)]
