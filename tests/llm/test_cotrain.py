import numpy as np

from weirframe.llm import cotrain as C
from weirframe.llm.queries import op5_cotraining

SF_DIR = "/root/testdata/sf0.01"


def test_given_table(spark):
    found = {r["doc_id"]: r for r in op5_cotraining(spark, SF_DIR).collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    assert len(found) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert np.mean([found[r["doc_id"]]["kept"] == bool(r["quality"]) for r in labels]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_views_teach_each_other():
    """Few labels; each view is noisy, and unlabelled rows link them."""
    rng = np.random.default_rng(3)
    truth = rng.integers(0, 2, 3000)
    text = np.where(truth, 1.0, -1.0)[:, None] + rng.normal(0, 1.0, (3000, 4))
    facts = np.where(truth, 1.0, -1.0)[:, None] + rng.normal(0, 1.6, (3000, 3))
    labels = np.full(3000, -1)
    labels[:90] = truth[:90]
    judge = C.co_train(text[:2000], facts[:2000], labels[:2000])
    right = (judge.score(text[2000:], facts[2000:]) >= 0.5) == truth[2000:]
    alone = (judge.text.odds(text[2000:]) >= 0) == truth[2000:]
    assert right.mean() > 0.95 and right.mean() >= alone.mean() - 0.01
    score = judge.score(text[2000:], facts[2000:])
    for low in (0.0, 0.5):  # calibrated: scores match shares
        part = (score >= low) & (score < low + 0.5)
        assert abs(score[part].mean() - truth[2000:][part].mean()) < 0.08


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 3), (None, "a b", 3), (2, "w " * 100_000, 3)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    for known, share in ((labels, 1.0), (labels.limit(0), 1.0)):
        found = C.score(docs, C.train(docs, known)).collect()
        assert len(found) == 3 and all(abs(r["score"] - share) < 1e-3 for r in found)
    assert C.score(docs.limit(0), C.train(docs.limit(0), labels)).count() == 0
    assert np.isfinite(C.metadata_view([None, "en"], [None, "s"], [None, -5])).all()
