"""Physical plans: what moves, what is pushed down, and that nothing is crossed."""

import re

import pytest
from pyspark.sql import functions as F

from weirframe.operators import dedup, heavy, lookup, merge, ordered
from weirframe.plans.queries import QUERIES
from weirframe.sources.schemas import RIVER_LEVELS
from weirframe.sources.tables import TableStore

SF_DIR = "/root/testdata/sf0.001"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(frame):
    return plan_of(frame).count("Exchange hashpartitioning")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", [name for name in QUERIES if name != "poll_stream"])
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for word in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert word not in plan


def test_dedup_limits_groups_before_the_shuffle(spark):
    plan = plan_of(QUERIES["insert_ignore_batch"](spark, SF_DIR))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    assert shuffles(dedup.first_wins(lines, ["l_orderkey"], ["l_linenumber"])) == 1


def test_insert_ignore_shuffles_batch_and_target_once(spark, no_broadcast):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    key = ["l_orderkey", "l_linenumber"]
    assert shuffles(merge.insert_ignore(lines, key, ["l_partkey"], lines, null_keys=False)) == 2


def test_fold_shuffles_rows_once_and_heavy_keys_twice(spark, monkeypatch):
    rows = spark.range(100).select((F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("g"), "id")
    rule = merge.UpsertRule(["k"], ["g"])
    folded = merge.fold(rows, rule, ["id"], null_keys=False)
    assert shuffles(folded) == 1 and plan_of(folded).count("Sort [") == 1
    monkeypatch.setattr(heavy, "HEAVY_ROWS", 10)
    found = heavy.heavy_keys(rows, ["k"], F.col("id"))
    # Light keys once; heavy ones by (key, piece), then one row of each piece by key.
    assert shuffles(merge.fold(rows, rule, ["id"], null_keys=False, heavy=found)) == 3


def test_previous_row_moves_rows_once(spark, no_broadcast):
    rows = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    linked = ordered.with_previous(rows, ["k"], ["id"], ["id"], ordered.chunk_of("id", 8))
    # Rows by (key, chunk); chunk tails by (key, chunk), by key, and back to the rows.
    assert shuffles(linked) == 4


def test_scans_read_and_filter_what_is_needed(spark):
    hours = plan_of(QUERIES["hour_bucket"](spark, SF_DIR))
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>", hours)
    lines = plan_of(QUERIES["quality_lines"](spark, SF_DIR))
    assert "EqualTo(l_returnflag,R)" in lines.split("PushedFilters")[1]


def test_writes_are_rebalanced_by_partition(spark, folder):
    rows = spark.range(3).selectExpr(
        "concat('a', id) station_ref", "date_add(date'2001-12-31', int(id)) date", "1.0BD value_m", "'Good' quality", "'EA' source"
    )
    plan = plan_of(TableStore(spark, folder).balanced(RIVER_LEVELS, rows))
    assert re.search(r"Exchange hashpartitioning\(year#\d+, bucket#\d+, \d+\), REBALANCE_PARTITIONS_BY_COL", plan)


def test_lookup_broadcasts_only_what_is_counted_to_be_small(spark, no_broadcast):
    rows = spark.range(1000)
    assert "BroadcastHashJoin" in plan_of(rows.join(lookup.size_checked(rows, 1000), "id"))
    assert "SortMergeJoin" in plan_of(rows.join(lookup.size_checked(rows, 1000, limit=10), "id"))
    assert "SortMergeJoin" in plan_of(rows.join(lookup.size_checked(rows), "id"))


def test_an_exploded_grid_is_not_broadcast(spark):
    grid = spark.range(400_000).select("id", F.explode(F.sequence(F.lit(1), F.lit(25))).alias("year"))
    assert grid._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1 << 25
    documents = spark.range(10).select("id", F.lit(1).alias("year"))
    assert "Broadcast" not in plan_of(documents.join(lookup.size_checked(grid, grid.count()), ["id", "year"]))
