import math

import numpy as np
import pytest

from weirframe.llm import one_bit_search as O
from weirframe.llm.queries import op12_one_bit_search, table
from weirframe.session import Scratch


def plain_search(rows, step=O.QUERY_STEP, best=O.BEST):
    """All inner products of usable rows, in double precision."""
    good = [
        (i, np.array(v, np.float64))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    queries = {}
    for i, v in good:
        if i % step == 0 and (i not in queries or list(v) < list(queries[i])):
            queries[i] = v
    out = []
    for q, point in queries.items():
        found = {}
        for i, v in good:
            if i != q and len(v) == len(point):
                found[i] = max(float((point * v).sum()), found.get(i, -math.inf))
        ranked = sorted((-s, i) for i, s in found.items())[:best]
        out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(ranked)]
    return sorted(out)


def searched(spark, rows, kind="float", step=O.QUERY_STEP):
    with Scratch(spark, "t") as scratch:
        frame = spark.createDataFrame([(*r, 1, "x") for r in rows], f"vec_id long, embedding array<{kind}>, code int, tile string")
        return sorted(tuple(r) for r in O.neighbours(frame, scratch, step).collect())


def recall(found, expected):
    wanted = {(q, i) for q, _, i, _ in expected}
    return len({(q, i) for q, _, i, _ in found} & wanted) / len(wanted)


def check_scores(found, rows):
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    for q, _, i, score in found:
        assert score == pytest.approx(float((vectors[q] * vectors[i]).sum()), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_table(spark, sf):
    frame = table(spark, f"/root/testdata/{sf}", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    found, expected = sorted(tuple(r) for r in op12_one_bit_search(spark, f"/root/testdata/{sf}").collect()), plain_search(rows)
    assert len(found) == len(expected)
    assert recall(found, expected) >= 0.99
    check_scores(found, rows)


def test_recall_without_clusters_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(O, "SEGMENT_ROWS", 200)
    monkeypatch.setattr(O, "QUERY_BYTES", 20_000)
    rng = np.random.default_rng(1)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.standard_normal((1500, 100)).astype(np.float32))]
    found, expected = searched(spark, rows), plain_search(rows)
    assert len(found) == len(expected) == 75 * 20
    assert recall(found, expected) >= 0.98
    check_scores(found, rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, None), (7, []),
        (8, [None, 1.0]), (9, [3.0, 0.0]), (None, [9.0, 9.0]), (10, [1.0, 2.0, 3.0]), (20, [1.0, 0.0, 0.0]), (40, [-1.0, -2.0]),
        (0, [1.0, 2.0]), (0, [5.0, 5.0]), (9, [1.0, 4.0]), (9, [3.0, 0.0]), (60, [0.0, 0.0]), (80, [4.0]), (-20, [1.0, 1e-30]), (11, [-0.5, 0.25]),
    ]
    found = searched(spark, rows, "double")
    assert [(q, k, i) for q, k, i, _ in found] == [(q, k, i) for q, k, i, _ in plain_search(rows)]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in plain_search(rows)])
    assert searched(spark, []) == searched(spark, [(0, [1.0])]) == searched(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_ties_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(O, "SEGMENT_ROWS", 50)
    rng = np.random.default_rng(2)
    common = rng.standard_normal(32).astype(np.float32).tolist()
    rows = [(k, common if k % 3 else rng.standard_normal(32).astype(np.float32).tolist()) for k in range(600)]
    rows += [(1, common)] * 200 + [(20, common)] * 100
    found, expected = searched(spark, rows), plain_search(rows)
    near = {q for q, k, _, s in expected if k == 1 and s > 10}
    assert near
    assert [r[:3] for r in found if r[0] in near] == [r[:3] for r in expected if r[0] in near]
    assert recall(found, expected) >= 0.95


def test_estimates_hold_their_bounds_and_spare_most_vectors():
    rng = np.random.default_rng(4)
    for dims in (1, 7, 64, 130):
        points, queries = rng.standard_normal((4000, dims)), rng.standard_normal((30, dims))
        centres = points.mean(axis=0, keepdims=True)
        cell, words, length, factor = O.code(points, centres)
        assert words.shape == (4000, -(-dims // 64))
        work = O.Queries(np.arange(30), queries, centres, 20)
        guess, width = work.estimates(slice(0, 30), cell, words, length, factor)
        wrong = np.abs(guess - queries @ points.T) > width + 1e-9
        assert wrong.mean() < 0.06
        reranked = work.take(np.arange(1000, 5000), points, cell, words, length, factor)
        assert reranked < 0.4 * 30 * 4000 or dims == 1
