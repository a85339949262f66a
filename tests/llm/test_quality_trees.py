import re
from collections import Counter

import numpy as np

from weirframe.llm import quality_trees as Q
from weirframe.llm.queries import op4_quality_rules

SF_DIR = "/root/testdata/sf0.01"


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    inside = {k for i, w in enumerate(windows) if times[w] > 1 for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)]


def test_counts_of_the_given_table_and_labels(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    found = op4_quality_rules(spark, SF_DIR).collect()
    assert len(found) == len(texts)
    right = []
    for r in found:
        counts = [r[name] for name in Q.COUNTS]
        assert counts == plain_counts(texts[r["doc_id"]])
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
        if r["doc_id"] in truth and not failed:
            right.append(r["kept"] == bool(truth[r["doc_id"]]))
    assert np.mean(right) > 0.97


def test_odd_texts():
    texts = ["", " \n\t ", "a\xa0b c\x85d", "x " * 100, "é É\n\né É\n é É", "a b c d e f g h " * 2, "#*$%&|<> \r\nq\r\nq\r\n"]
    counts, shares = Q.statistics([t.encode() for t in texts])
    assert counts.tolist() == [plain_counts(t) for t in texts]
    assert np.isfinite(shares).all()


def test_forest_fits_held_out_rows_and_is_monotonic():
    rng = np.random.default_rng(0)
    rows = rng.random((4000, 3))
    labels = ((rows[:, 0] < 0.5) ^ (rng.random(4000) < 0.05) ^ ((rows[:, 1] > 0.8) & (rows[:, 0] < 0.3))).astype(float)
    forest = Q.fit(rows[:3000], labels[:3000], [0])
    assert ((forest.score(rows[3000:]) >= 0.5) == labels[3000:]).mean() > 0.85
    for _ in range(50):
        line = np.repeat(rng.random((1, 3)), 200, axis=0)
        line[:, 0] = np.linspace(0, 1, 200)
        assert (np.diff(forest.score(line)) <= 1e-12).all()


def plain_score(forest, row):
    total = forest.base
    for tree in range(len(forest.feature)):
        at = 0
        for _ in range(Q.DEPTH):
            at = 2 * at + 1 + int(row[forest.feature[tree, at]] > forest.threshold[tree, at])
        total += forest.value[tree, at]
    return 1 / (1 + np.exp(-total))


def test_flattened_scoring_equals_a_walk():
    rng = np.random.default_rng(1)
    rows = rng.random((300, 4))
    forest = Q.fit(rows, (rows[:, 2] > 0.4).astype(float), [])
    assert np.allclose(forest.score(rows[:20]), [plain_score(forest, row) for row in rows[:20]])


def test_odd_rows(spark):
    rows = [(1, None, 3), (None, "a b", 3), (2, "word " * 200_000, 3), (1, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    none = spark.createDataFrame([(1, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert Q.train(docs, none) is None and Q.train(docs, none.limit(0)) is None
    found = Q.judge(docs, None).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["kept"]) for r in found) == [
        (0, 2, False), (1, 0, False), (1, 0, False), (2, 200_000, False),
    ]
    assert Q.keep(docs, None).columns == docs.columns and Q.keep(docs, None).count() == 0
    assert Q.judge(docs.limit(0), None).count() == 0
