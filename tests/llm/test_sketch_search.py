import math
import os
import random
import re
import sys
from collections import Counter

import numpy as np
import pyarrow as pa

from weirframe.llm import sketch_search as S
from weirframe.llm.queries import SQL, op11_sketch_search
from weirframe.session import Scratch

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from compare import compare  # noqa: E402

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, best=S.BEST):
    """Every document scored for every item."""
    tfs = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    tfs = [(doc_id, tf, sum(tf.values())) for doc_id, tf in tfs if tf]
    n_docs, n_terms = len(tfs), sum(n for _, _, n in tfs)
    df = Counter(term for _, tf, _ in tfs for term in tf)
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(plain_terms(text))
    rows = []
    for item_id, terms in asked.items():
        found = []
        for doc_id, tf, n in tfs:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = 0
            for term in terms & tf.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += w * ((1000000000 * tf[term]) // (1000 * tf[term] + 8 * m))
            if score > 0:
                found.append((-score, math.inf if doc_id is None else doc_id))
        for k, (score, doc_id) in enumerate(sorted(found)[:best]):
            rows.append((item_id, k + 1, None if doc_id == math.inf else doc_id, -score))
    return sorted(rows, key=repr)


def searched(spark, docs, items):
    with Scratch(spark, "t") as scratch:
        left = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], "doc_id long, text string, rank int, sketch string, n int")
        right = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, term int")
        return sorted((tuple(r) for r in S.search(left, right, scratch).collect()), key=repr)


def some_text(rng, n):
    marks = [" ", ", ", "\n", "-", "_", "'", "\x7f", "\x00"]
    return "".join(rng.choice(("Ab", "c9", "É", "ß", "ſ", "中文", "z")) * (rng.random() < 0.3) + f"w{int(rng.random() ** 3 * 300)}" + rng.choice(marks) for _ in range(n))


def test_given_tables_equal_sql(spark):
    assert compare(spark, "/root/testdata/sf0.01", op11_sketch_search, SQL["op11_sketch_search"]) > 300


def test_ranking_equals_scoring_everything(spark):
    rng = random.Random(1)
    docs = [(k, some_text(rng, rng.choice((1, 3, 20, 60, 400)))) for k in range(250)]
    docs += [(1000 + k, docs[7][1]) for k in range(15)]  # ties beyond the tenth place
    docs += [(None, docs[7][1]), (None, None), (5000, ""), (5001, "-- \n"), (3, docs[3][1])]
    docs.append((6000, some_text(rng, 60_000)))
    items = [(k, some_text(rng, rng.choice((1, 5, 30)))) for k in range(30)]
    items += [(7, docs[7][1]), (40, None), (41, ""), (42, "neverseen"), (None, "w1 w2"), (None, "w3"), (43, docs[9][1])]
    assert searched(spark, docs, items) == plain_search(docs, items)


def test_blocks_of_queries_change_nothing(spark, monkeypatch):
    rng = random.Random(2)
    docs = [(k, some_text(rng, 40)) for k in range(80)]
    items = [(k, some_text(rng, 12)) for k in range(25)]
    one = searched(spark, docs, items)
    monkeypatch.setattr(S, "BLOCK_TERMS", 50)
    assert searched(spark, docs, items) == one == plain_search(docs, items)


def test_empty_tables(spark):
    assert searched(spark, [], [(1, "a")]) == searched(spark, [(1, "a")], []) == searched(spark, [(1, None)], [(1, "a")]) == []


def test_bounds_hold_and_spare_most_texts():
    rng = random.Random(3)
    docs = [(k, some_text(rng, rng.choice((5, 50, 500)))) for k in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs]), pa.array([t for _, t in docs])], ["doc_id", "text"])
    distinct, sizes, rows, terms, tf = S._split(batch)
    n_terms = int(sizes.sum())
    found = S.impacts(tf, sizes[rows], len(docs), n_terms)
    units, made = S.fold(rows, S.hashes(distinct)[terms], found, len(docs))
    queries = [[(t, rng.randint(1, 9000)) for t in dict.fromkeys(S.terms_of(some_text(rng, 8).encode()))] for _ in range(20)]
    work = S.Block(queries, len(docs), n_terms, 10)
    bounds = work.bounds(units, made)
    exact = np.array([[work.score(q, Counter(S.terms_of(t.encode())), int(sizes[d])) for q in range(20)] for d, t in docs])
    assert (bounds >= exact).all()
    part = pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(units), pa.array(made), batch.column(1)], ["doc_id", "n", "unit", "sketch", "text"])
    assert work.take(part) < 0.5 * exact.size
    for q, best in enumerate(work.best):
        assert [-score for score, _, _ in best] == sorted((s for s in exact[:, q].tolist() if s > 0), reverse=True)[:10]


def test_marks_are_bits_of_hashes(spark):
    terms = ["a", "zz9", "é", "中文"]
    marks = S._marks(spark.createDataFrame([(t,) for t in terms], "term string"))
    places = {int(h % np.uint64(S.MARK_BITS)) for h in S.hashes([t.encode() for t in terms])}
    assert set(np.flatnonzero(np.unpackbits(np.frombuffer(marks, np.uint8), bitorder="little")).tolist()) == places
