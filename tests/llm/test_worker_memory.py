import re
import sys
from pathlib import Path

import pyarrow as pa
import pytest

from weirframe.llm import batches, near_texts, quality_trees, weak_toxicity
from weirframe.llm.batches import WORKER_STORE, kept_in_worker
from weirframe.llm.queries import table
from weirframe.session import Scratch

SF_DIR = "/root/testdata/sf0.001"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def anonymous_mb():
    found = re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
    return int(found.group(1)) / 1024


@pytest.fixture
def tasks(monkeypatch, spark):
    """Functions that frames are mapped with, each with a batch of its input."""
    found = []
    kind = type(spark.range(1))
    plain = kind.mapInArrow

    def noting(self, func, *args, **named):
        found.append((func, self.limit(5).toArrow().to_batches()[0]))
        return plain(self, func, *args, **named)

    monkeypatch.setattr(kind, "mapInArrow", noting)
    return found


def test_stages_before_packing_drop_what_it_keeps_in_a_worker(spark, tasks):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    weak_toxicity.keep_clean(docs, weak_toxicity.train(docs, labels))
    quality_trees.keep(docs, quality_trees.train(docs, labels))
    with Scratch(spark, "t") as scratch:
        near_texts.keep_one(docs, scratch)
        # Three of toxicity, two of the quality rules, three of near_duplicates.
        assert len(tasks) == 8
        for func, batch in tasks:
            kept_in_worker("encoder", object)
            assert list(func(iter([batch])))
            assert WORKER_STORE not in sys.modules


def test_stages_limit_their_arrow_batches(spark):
    docs = table(spark, SF_DIR, "documents")
    before = spark.conf.get(ARROW_ROWS)
    try:
        for stage in (lambda: quality_trees.keep(docs, None), lambda: near_texts.marks(docs, "doc_id", "text")):
            spark.conf.set(ARROW_ROWS, "10000")
            stage()
            assert int(spark.conf.get(ARROW_ROWS)) == batches.BATCH_ROWS <= 500
    finally:
        spark.conf.set(ARROW_ROWS, before)


def test_free_memory_is_given_back_between_batches():
    source = (pa.RecordBatch.from_arrays([pa.array(["x" * 5000] * 400)], ["text"]) for _ in range(1))
    held = []

    def run(found):
        for batch in found:
            # Many small pieces, freed at once, as those of a slice are.
            pieces = [pa.array(["y" * 2000] * 20) for _ in range(2000)]
            held.append(anonymous_mb())
            del pieces
            yield batch

    assert len(list(batches.lean(run)(source))) == 1
    assert anonymous_mb() < held[0] - 40
