import zlib

import numpy as np

from weirframe.llm import weak_toxicity as T
from weirframe.llm.queries import op10_toxicity

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy_on_the_given_table(spark):
    found = {r["doc_id"]: r for r in op10_toxicity(spark, SF_DIR).collect()}
    truth = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    assert len(found) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for doc_id, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    out = [(found[r["doc_id"]]["predicted"], r["toxic"]) for r in truth if found[r["doc_id"]]["held_out"]]
    hit = sum(p and t for p, t in out)
    assert hit / sum(t for _, t in out) > 0.78 and hit / sum(p for p, _ in out) > 0.97


def test_nothing_is_learnt_from_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    flipped = labels.withColumn(
        "toxic", T.F.when(T.held_out(labels["doc_id"]), 1 - labels["toxic"]).otherwise(labels["toxic"])
    )
    a, b = T.train(docs, labels), T.train(docs, flipped)
    assert a.lexicon == b.lexicon and np.array_equal(a.weight, b.weight) and a.bias == b.bias


def test_label_model_finds_accuracies_and_discounts_copies():
    rng = np.random.default_rng(5)
    truth = rng.random(4000) < 0.2
    good = (rng.random((4000, 3)) < np.where(truth, 0.7, 0.03)[:, None]).astype(int)
    noise = (rng.random(4000) < 0.15).astype(int)
    votes = np.column_stack([good, *[noise] * 6])  # six copies of a voter that knows nothing
    posterior = T.label_model(votes, np.where(np.arange(4000) < 200, truth, -1).astype(int))
    assert ((posterior > 0.5) == truth).mean() > 0.95


def test_voters_count_like_a_scan():
    lexicon = ["idiot", "idio*", "idiot+", "scum*+"]
    counts, sizes = T.Voters(lexicon).count(["An IDIOT idiots idiot", "scum scummy", "", "SHOUT!! now"])
    assert counts.tolist() == [[2, 3, 1, 0, 1, 0], [0, 0, 0, 1, 0, 0], [0] * 6, [0, 0, 0, 0, 1, 1]]
    assert sizes.tolist() == [4, 2, 0, 2]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 3), (None, "a b", 3), (2, "w " * 100_000, 3)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        model = T.train(docs, known)
        found = T.score(docs, model).collect()
        assert len(found) == 3 and all(r["predicted"] == 0 for r in found)
        assert {r["held_out"] for r in found if r["doc_id"] is None} == {False}
        assert T.keep_clean(docs, model).count() == 3 and T.keep_clean(docs, model).columns == docs.columns
    assert T.score(docs.limit(0), T.train(docs.limit(0), labels)).count() == 0
