"""Every query on tables where one key holds a third of the rows and some keys are null.

Chunks are narrow, so that hot keys span many of them.
"""

import glob
import os
import tempfile

import duckdb
import pytest
from compare import compare

from weirframe.operators import heavy, ordered
from weirframe.plans.oracle import SQL
from weirframe.plans.queries import QUERIES

PLAIN = "/root/testdata/sf0.001"
SKEWED = {
    "lineitem": """
        case when l_partkey % 3 = 0 then 7 else l_orderkey end as l_orderkey,
        case when l_partkey % 3 = 0 then 1 else l_linenumber end as l_linenumber,
        case when l_orderkey % 3 = 1 then 3 else l_suppkey end as l_suppkey""",
    "orders": "case when o_orderkey % 3 = 0 then 5 else o_custkey end as o_custkey",
    "events": """
        case when event_id % 3 = 0 then 7 when event_id % 50 = 1 then null else user_id end as user_id,
        case when event_id % 3 = 0 then timestamp '2024-01-05 03:00:00' + to_minutes(cast(event_id % 60 as integer))
             when event_id % 70 = 1 then null else ts end as ts""",
}


@pytest.fixture(scope="module")
def skewed():
    folder = tempfile.mkdtemp(prefix="/tmp/run-")
    connection = duckdb.connect()
    for path in glob.glob(f"{PLAIN}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        change = f"replace ({SKEWED[name]})" if name in SKEWED else ""
        connection.execute(f"copy (select * {change} from '{path}') to '{folder}/{name}.parquet' (format parquet)")
    return folder


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_on_skewed_tables(spark, skewed, name, monkeypatch):
    chunk_of = ordered.chunk_of
    monkeypatch.setattr(ordered, "chunk_of", lambda order: chunk_of(order, 64))
    monkeypatch.setattr(heavy, "HEAVY_ROWS", 20)
    compare(spark, skewed, QUERIES[name], SQL[name])
