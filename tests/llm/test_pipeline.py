import numpy as np
from test_packing import check_pieces
from test_shingle_dedup import plain_kept
from test_surrogates import PRIVATE
from tokenizers import Tokenizer

import corpus_pipeline
from weirframe.llm import quality_trees, weak_toxicity
from weirframe.llm.queries import table, tokenizer_path
from weirframe.session import Scratch

SF_DIR = "/root/testdata/sf0.001"


def test_each_stage_against_a_plain_version_on_its_own_input(spark):
    docs = table(spark, SF_DIR, "documents")
    labels = table(spark, SF_DIR, "labels")
    frames = [docs]
    with Scratch(spark, "t") as scratch:
        for name, stage in corpus_pipeline.STAGES:
            frames.append(scratch.keep(stage(spark, frames[-1], SF_DIR), name))
        for frame in frames[:-1]:
            assert frame.columns == docs.columns
        rows = [{r["doc_id"]: r for r in frame.collect()} for frame in frames[:-1]]
        assert all(len(found) == frame.count() for found, frame in zip(rows, frames[:-1], strict=True))

        model = weak_toxicity.train(docs, labels)
        scores = {i: model.score([r["text"]])[0] for i, r in rows[0].items()}
        assert rows[1].keys() == {i for i, s in scores.items() if s < weak_toxicity.THRESHOLD}

        forest = quality_trees.train(frames[1], labels)
        assert rows[2].keys() == {i for i, r in rows[1].items() if quality_trees.verdicts([r["text"].encode()], forest)[3][0]}

        assert rows[3].keys() == plain_kept([(i, r["text"]) for i, r in rows[2].items()])

        assert rows[4].keys() == rows[3].keys()
        for i, r in rows[4].items():
            old = rows[3][i]
            assert PRIVATE.split(r["text"]) == PRIVATE.split(old["text"])
            assert not set(PRIVATE.findall(r["text"])) & set(PRIVATE.findall(old["text"]))
            assert r["n_chars"] == (len(r["text"]) if r["text"] != old["text"] else old["n_chars"])

        plain = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
        ids_of = {i: plain.encode(r["text"], add_special_tokens=False).ids for i, r in rows[4].items()}
        assert check_pieces(frames[5].collect(), ids_of) == 0
        assert np.sum([len(ids) + 1 for ids in ids_of.values()]) == frames[5].agg({"length": "sum"}).first()[0]


def test_run_applies_all_stages(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 100


def test_stages_take_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, node long, stays int, turn int"
    long = " ".join(f"word{k % 9973}" for k in range(60_000))
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, long, "en", "s", len(long)), (2, long, "en", "s", len(long)), (3, "a b", None, None, 3)]
    odd = spark.createDataFrame([(*r, 1.0, "x", 1, 2, 3) for r in rows], schema)
    with Scratch(spark, "t") as scratch:
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            for j, frame in enumerate((odd, odd.limit(0))):
                found = scratch.keep(stage(spark, frame, SF_DIR), f"{k}-{j}")
                if name != "packing":
                    assert found.columns == odd.columns
