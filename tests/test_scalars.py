from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirframe.functions import arrays, scalars
from weirframe.operators import ledger


def values(spark, rows, column):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i int, v string")
    return [r[0] for r in frame.orderBy("i").select(column(F.col("v"))).collect()]


def test_numeric_rules(spark):
    two = lambda v: scalars.coerce(v, T.DecimalType(5, 2))
    assert values(spark, ["2.675", "-2.675", "1", "1e2", "1000", "abc", "1.5f", "0x10", "", None], two) == [
        Decimal("2.68"), Decimal("-2.68"), Decimal("1.00"), Decimal("100.00"), None, None, None, None, None, None,
    ]
    whole = lambda v: scalars.coerce(v, T.IntegerType())
    assert values(spark, ["2.5", "-2.5", "2.4", "3000000000", "x"], whole) == [3, -3, 2, None, None]


def test_misfit_is_told_from_null(spark):
    flag = lambda v: scalars.misfit(v, scalars.coerce(v, T.DecimalType(8, 3)))
    assert values(spark, ["1", None, "abc", "123456.0"], flag) == [False, False, True, True]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_raises_in_any_mode(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="bad value for value_m: abc"):
            values(spark, ["1", "abc"], lambda v: scalars.strict(v, T.DecimalType(8, 3), "value_m"))
        assert values(spark, ["1.2345", None], lambda v: scalars.strict(v, T.DecimalType(8, 3), "v")) == [
            Decimal("1.235"),
            None,
        ]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_dates_and_instants(spark):
    text = lambda c: c.cast("string")
    instants = ["2024-01-01T10:00:00Z", "2024-01-01T10:00:00+01:00", "2024-01-01T10:00:00", "2024-01-01", "10:00", "x"]
    assert values(spark, instants, lambda v: text(scalars.as_instant(v))) == [
        "2024-01-01 10:00:00", "2024-01-01 09:00:00", "2024-01-01 10:00:00", "2024-01-01 00:00:00", None, None,
    ]
    assert values(spark, ["2005-03-01", "2005", "2005-02-30"], lambda v: text(scalars.as_date(v))) == [
        "2005-03-01", None, None,
    ]


def test_station_ref(spark):
    base = "http://x/data/readings/"
    known = {
        base + "1491TH-level-stage-i-15_min-mASD/2024-01-01T00-00-00Z": "1491TH",
        base + "1491TH-flow-x/2024": None,
        "http://x/data/other/1491TH-level-x/2024": None,
        base + "-level-x/2024": "",
    }
    assert values(spark, list(known), scalars.station_ref) == list(known.values())


def test_station_ref_of_odd_texts(spark):
    by_hand = {
        "": None,
        "/readings/": None,
        "-level-": None,
        "a-level-b": None,
        "readings/a-level-b": None,
        "/readings/a-level-": "a",
        "/readings/-level-": "",
        "/readings/a/-level-b": None,
        "/readings/a-level-b/c-level-d": "a",
        "/readings/a-level-b-level-c": "a",
        "/readings/a-level-b/readings/c-level-d": "c",
        "/readings/a-level-b/readings/c": None,
        "/readings/readings/a-level-b": None,
        "/readings//a-level-b": None,
        "/readings/.*-level-x": ".*",
        "x/readings/B1level--level-/": "B1level-",
    }
    assert values(spark, list(by_hand), scalars.station_ref) == list(by_hand.values())


def test_unit_keys_split_on_the_last_colon(spark):
    lines = spark.createDataFrame([(" 51107:2000 ",), ("51107:2000",), ("",), ("  ",), ("0503SO:0",), ("a:b:2001",)], "value string")
    got = {r["unit_key"]: (r["ref"], r["year"]) for r in ledger.parse(lines).collect()}
    assert got == {"51107:2000": ("51107", 2000), "0503SO:0": ("0503SO", 0), "a:b:2001": ("a:b", 2001)}
    assert ledger.completed_count(ledger.parse(lines)).first()[0] == 3


def test_pending_and_done_partition_the_grid(spark):
    refs = spark.createDataFrame([("E1750",), ("F1301",)], "station_ref string")
    grid = ledger.with_key(ledger.unit_grid(refs, 2000, 2024))
    done = ledger.parse(spark.createDataFrame([(f"E1750:{y}",) for y in (2000, 2001, 2002, 1999)], "value string"))
    pending = ledger.pending(grid, done, ["unit_key"])
    counts = {r["station_ref"]: r["count"] for r in pending.groupBy("station_ref").count().collect()}
    assert counts == {"E1750": 22, "F1301": 25}
    assert ledger.unit_grid(refs, 2001, 2000).count() == 0


def test_array_rules(spark):
    rows = [([1, 2, 3], [7, 8, 9, 10], None), ([1, 2], [7], None), ([], None, None), (None, [1], None)]
    frame = spark.createDataFrame(rows, "t array<int>, a array<int>, b array<int>")
    assert [r[0] for r in frame.select(arrays.head(F.col("t"))).collect()] == [1, 1, None, None]
    assert [r[0] for r in frame.select(arrays.first_match(F.col("t"), lambda x: x > 1)).collect()] == [2, 2, None, None]
    assert [r[0] for r in frame.select(arrays.covers(F.col("a"), F.col("t"))).collect()][:3] == [True, False, True]
    series = {"a": F.col("a"), "b": F.col("b")}
    zipped = frame.filter("size(t) = 3 or size(t) = 0").select(F.inline(arrays.zipped(F.col("t"), "t", series)))
    assert [tuple(r) for r in zipped.collect()] == [(1, 7, None), (2, 8, None), (3, 9, None)]
