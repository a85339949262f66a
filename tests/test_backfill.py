import json
import os
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from weirframe.operators import checks
from weirframe.operators.checks import ConstraintBreach
from weirframe.operators.ledger import completed_count
from weirframe.operators.paging import IncompleteListing
from weirframe.plans.backfill import backfill_rivers, backfill_weather
from weirframe.sources import landed, ledger_files, quarantine
from weirframe.sources.schemas import BUCKET, RIVER_LEVELS, STATION_BUCKETS, WEATHER_HISTORY
from weirframe.sources.tables import TableStore, station_bucket


def write(path, body):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(body if isinstance(body, str) else json.dumps(body))


DAILY = {"parameter": "level", "period": 86400, "@id": "m1"}


def station(ref, lat=51.0, lon=-1.0, measures=(DAILY,)):
    return {"stationReference": ref, "label": f"at {ref}", "lat": lat, "long": lon, "catchmentName": "c", "measures": list(measures)}


def level(day, value, quality="Good"):
    return {"date": day, "value": value, "quality": quality}


def ledger_keys(spark, path):
    return sorted(r["unit_key"] for r in ledger_files.read(spark, path).collect())


def test_catalogue_measures(spark, folder):
    cases = {
        "s1": [{"parameter": "flow", "period": 86400, "@id": "m0"}, DAILY, {"parameter": "level", "period": 86400, "@id": "m2"}],
        "s2": ["text", {"parameter": "level", "period": "86400", "@id": "m3"}],
        "s3": [{"parameter": "level", "period": 86400.0, "@id": "m4"}],
        "s4": [],
    }
    entries = [station(ref, measures=m) for ref, m in cases.items()] + [{"stationReference": "0503SO"}]
    write(f"{folder}/catalogue/page=0.json", {"items": entries})
    got = {r["station_ref"]: r for r in landed.catalogue(spark, folder).collect()}
    urls = {ref: row["daily_level_measure_url"] for ref, row in got.items()}
    assert urls == {"s1": "m1", "s2": "m3", "s3": None, "s4": None, "0503SO": None}
    assert (got["s1"]["lat"], got["s1"]["lon"], got["s1"]["catchment"]) == (51.0, -1.0, "c")


def test_catalogue_reads_on_after_a_short_page(spark, folder):
    write(f"{folder}/catalogue/page=0.json", {"items": [station(f"a{i}", measures=[]) for i in range(500)]})
    write(f"{folder}/catalogue/page=1.json", {"items": [station("b0")]})
    write(f"{folder}/catalogue/page=2.json", {"items": [station("c0")]})
    refs = {r["station_ref"] for r in landed.catalogue(spark, folder).collect()}
    assert len(refs) == 502 and {"b0", "c0"} <= refs


def test_incomplete_catalogue_raises_and_is_not_cached(spark, folder):
    cache = f"{folder}/cache"
    for page in (0, 2, 3):
        write(f"{folder}/catalogue/page={page}.json", {"items": [station(f"s{page}-{i}") for i in range(500)]})
    write(f"{folder}/catalogue/page=1.json", "not json")
    with pytest.raises(IncompleteListing, match="the first is page 1"):
        landed.saved_catalogue(spark, folder, cache)
    os.remove(f"{folder}/catalogue/page=1.json")
    with pytest.raises(IncompleteListing, match="1 pages are missing"):
        landed.saved_catalogue(spark, folder, cache)
    assert not os.path.exists(cache)
    write(f"{folder}/catalogue/page=1.json", {"items": [station(f"s1-{i}") for i in range(20)]})
    assert landed.saved_catalogue(spark, folder, cache).count() == 1520


def test_saved_catalogue(spark, folder):
    cache = f"{folder}/cache"
    assert landed.saved_catalogue(spark, folder, cache).count() == 0
    assert not os.path.exists(cache)
    write(f"{folder}/catalogue/page=0.json", {"items": [station("a")]})
    assert landed.saved_catalogue(spark, folder, cache).count() == 1
    write(f"{folder}/catalogue/page=0.json", {"items": [station("a"), station("b")]})
    assert landed.saved_catalogue(spark, folder, cache).count() == 1


def land_rivers(landing):
    entries = [
        station("2048"), station("0503SO"), station("nomeasure", measures=[]), station(""), station(None),
        station("2048", measures=[]), station("never"),
    ]
    write(f"{landing}/catalogue/page=0.json", {"items": entries})
    base = f"{landing}/daily_levels"
    write(
        f"{base}/station_ref=2048/year=2005/body.json",
        {
            "items": [
                level("2005-03-01", 0.5125),
                level("2005-03-01", 0.9),
                level("2005-03-02", 0.6, "Suspect"),
                level("2005-03-03", None),
                level("2005-03-04", "1.5"),
                level("2006-03-04", 1.0),
                {"date": "2005-03-05", "value": 1.0},
            ]
        },
    )
    write(f"{base}/station_ref=2048/year=2006/body.json", {"items": []})
    write(f"{base}/station_ref=0503SO/year=2005/body.json", {"items": [level("2005-01-01", 0.1), level(None, 0.7)]})
    write(f"{base}/station_ref=0503SO/year=2006/body.json", "not json")
    return base


def test_rivers(spark, folder):
    landing, ledger, cache = f"{folder}/l", f"{folder}/ledger", f"{folder}/cache"
    base = land_rivers(landing)
    store = TableStore(spark, f"{folder}/t")
    run = lambda **more: backfill_rivers(spark, landing, store, ledger, cache, 2005, 2006, **more)
    result = run()
    # Entries: 7, two years. The repeated entry of 2048 is skipped for both of its done years.
    assert result.summary.first().asDict() == {
        "inserted": 2, "skipped": 2, "failed": 2, "done": 4, "pending": 2, "total": 14, "completed": 4,
    }
    units = {(r["station_ref"], r["year"]): (r["n_rows"], r["n_inserted"], r["status"]) for r in result.units.collect()}
    assert units[("2048", 2005)] == (3, 2, "done") and units[("2048", 2006)] == (0, 0, "done")
    reasons = {(r["station_ref"], r["year"]): r["reason"] for r in result.units.collect() if r["reason"]}
    assert reasons == {("0503SO", 2005): "bad value for date: null", ("0503SO", 2006): "malformed body"}
    assert units[("0503SO", 2005)][2] == "failed" and units[("0503SO", 2006)][2] == "failed"
    assert ("never", 2005) not in units
    result.release()
    got = sorted(tuple(r) for r in store.read(RIVER_LEVELS).selectExpr("station_ref", "string(date)", "value_m", "quality", "source").collect())
    assert got == [
        ("2048", "2005-03-01", Decimal("0.513"), "Good", "EA"),
        ("2048", "2005-03-04", Decimal("1.500"), "Good", "EA"),
    ]
    done = ["2048:2005", "2048:2006", "nomeasure:2005", "nomeasure:2006"]
    assert ledger_keys(spark, ledger) == done
    assert completed_count(ledger_files.read(spark, ledger)).first()["completed"] == 4

    write(f"{base}/station_ref=0503SO/year=2005/body.json", {"items": [level("2005-01-01", 0.1)]})
    write(f"{base}/station_ref=0503SO/year=2006/body.json", {"items": [level("2006-01-01", 123456.0)]})
    again = run().summary.first()
    # Four done units, with one repeated entry for each of the two years of 2048.
    assert (again["inserted"], again["skipped"], again["failed"], again["pending"]) == (1, 6, 1, 2)
    assert ledger_keys(spark, ledger) == sorted([*done, "0503SO:2005"])

    # A run that was cut off before the ledger: stored rows stay and are not doubled.
    write(f"{base}/station_ref=2048/year=2005/body.json", {"items": [level("2005-03-01", 9.9), level("2005-03-09", 1.0)]})
    reset = run(reset=True).summary.first()
    assert reset["inserted"] == 1
    values = {str(r["date"]): r["value_m"] for r in store.read(RIVER_LEVELS).filter("station_ref = '2048'").collect()}
    assert values["2005-03-01"] == Decimal("0.513") and len(values) == 3


def daily(**arrays):
    return {"daily": arrays}


def test_weather(spark, folder):
    landing, ledger, cache = f"{folder}/l", f"{folder}/ledger", f"{folder}/cache"
    refs = ["680504", "short", "late", "empty", "nodaily", "text", "broken", "nullarray", "never"]
    entries = [station("680504", lat=None)] + [station(r) for r in refs] + [station("nowhere", lon=None), station("680504")]
    write(f"{landing}/catalogue/page=0.json", {"items": entries})
    base = f"{landing}/weather_history"
    days = ["2000-01-01", "2000-01-02", "1999-12-31"]
    bodies = {
        "680504": daily(
            time=days,
            precipitation_sum=[1.005, None, 3],
            winddirection_10m_dominant=[2.5, -2.5, 1],
            temperature_2m_mean=[1, 2, 3, 4],
        ),
        "short": daily(time=days, precipitation_sum=[1.0]),
        "late": daily(time=["2027-01-01"], precipitation_sum=[1.0]),
        "empty": daily(time=[]),
        "nodaily": {"other": 1},
        "text": daily(time=["2000-01-01"], precipitation_sum=["abc"]),
        "broken": "{",
        # A null array fails its unit; an absent one, or one of nulls, does not.
        "nullarray": {"daily": {"time": ["2000-01-01"], "precipitation_sum": None}},
    }
    for ref, body in bodies.items():
        write(f"{base}/station_ref={ref}/body.json", body)
    store = TableStore(spark, f"{folder}/t")
    run = lambda: backfill_weather(spark, landing, store, ledger, cache, "2000-01-01", "2027-12-31", last_year=2026)
    result = run()
    summary = result.summary.first().asDict()
    assert summary == {"inserted": 2, "skipped": 1, "failed": 5, "done": 3, "pending": 1, "total": 9, "completed": 3}
    status = {r["station_ref"]: r["status"] for r in result.units.collect()}
    assert {ref for ref, s in status.items() if s == "failed"} == {"short", "late", "text", "broken", "nullarray"}
    reasons = {r["station_ref"]: r["reason"] for r in result.units.collect() if r["reason"]}
    assert reasons == {
        "short": "an array is shorter than its days", "late": "no partition for 2027-01-01",
        "text": "bad value for precipitation_sum: abc", "broken": "malformed body", "nullarray": "an array is null",
    }
    found = {r["unit"]: (r["job"], r["pos"], r["reason"]) for r in quarantine.read(spark, store).collect()}
    assert found["text:0"] == ("historical_weather", 0, "bad value for precipitation_sum: abc") and len(found) == 5
    got = {str(r["date"]): r for r in store.read(WEATHER_HISTORY).collect()}
    assert set(got) == {"2000-01-01", "2000-01-02"}
    first, second = got["2000-01-01"], got["2000-01-02"]
    assert (first["precipitation_sum"], first["winddirection_dominant"]) == (Decimal("1.01"), 3)
    assert (second["precipitation_sum"], second["winddirection_dominant"]) == (None, -3)
    assert first["temperature_mean"] == Decimal("1.00") and first["temperature_min"] is None
    assert ledger_keys(spark, ledger) == ["680504:0", "empty:0", "nodaily:0"]
    assert run().summary.first()["skipped"] == 4


def test_history_read_prunes_partitions(spark, folder):
    import datetime

    store = TableStore(spark, folder)
    frame = spark.sql("select 'a' station_ref, explode(sequence(date'2000-01-01', date'2003-12-31')) date, cast(1 as decimal(8,3)) value_m, 'Good' quality, 'EA' source")
    store.append(RIVER_LEVELS, frame)
    part = store.read_dates(RIVER_LEVELS, datetime.date(2001, 12, 31), datetime.date(2002, 1, 2))
    assert part.count() == 3
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters and "2001" in filters and "2002" in filters


@pytest.mark.parametrize("name", ["historical_river_levels", "flood_events"])
def test_tables_can_be_created_twice(spark, folder, name):
    from weirframe.sources.schemas import TABLES

    store = TableStore(spark, folder)
    store.create_if_absent(*TABLES.values())
    store.create_if_absent(*TABLES.values())
    assert store.read(TABLES[name]).count() == 0
    assert store.read(TABLES[name]).schema == TABLES[name].columns


def folders_read(frame):
    """Folder filters and the number of files that the scans of a frame read."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan, len(frame.inputFiles())


def test_a_resume_reads_the_buckets_of_open_stations(spark, folder):
    refs = [f"s{k}" for k in range(200)]
    bucket_of = {r["ref"]: r["b"] for r in spark.createDataFrame([(r,) for r in refs], "ref string").withColumn("b", station_bucket(F.col("ref"))).collect()}
    assert len(set(bucket_of.values())) == STATION_BUCKETS
    body = F.to_json(F.struct(F.struct(F.array(F.lit("2001-01-01")).alias("time"), F.array(F.lit("1.5")).alias("precipitation_sum")).alias("daily")))
    bodies = spark.createDataFrame([(r,) for r in refs], "station_ref string").select("station_ref", F.lit(0).alias("page"), body.alias("body"), station_bucket(F.col("station_ref")).alias(BUCKET))
    landing, store = f"{folder}/l", TableStore(spark, f"{folder}/t")
    bodies.repartition(1).write.partitionBy(BUCKET).parquet(f"{landing}/weather_history_bodies")
    write(f"{landing}/catalogue/page=0.json", {"items": [station(r) for r in refs]})
    os.makedirs(f"{folder}/ledger")
    write(f"{folder}/ledger/done.txt", "\n".join(f"{r}:0" for r in refs if r != "s7"))
    result = backfill_weather(spark, landing, store, f"{folder}/ledger", f"{folder}/cache", "2000-01-01", "2002-01-01")
    assert result.summary.first()["inserted"] == 1 and result.summary.first()["completed"] == 200
    one = landed.history_bodies(spark, landing, "weather_history", "weather_history_bodies", False, [bucket_of["s7"]])
    plan, _ = folders_read(one)
    assert re.search(rf"PartitionFilters: \[.*bucket#\d+ = {bucket_of['s7']}", plan)
    # The table has one folder for the year and the bucket; reading another bucket finds none.
    assert os.listdir(f"{folder}/t/historical_weather/year=2001") == [f"bucket={bucket_of['s7']}"]
    assert store.read(WEATHER_HISTORY, [2001], [bucket_of["s7"]]).count() == 1
    assert store.read(WEATHER_HISTORY, [2001], [b for b in range(STATION_BUCKETS) if b != bucket_of["s7"]]).count() == 0


def test_a_planted_duplicate_stops_a_backfill_before_the_ledger(spark, folder):
    landing, ledger, cache = f"{folder}/l", f"{folder}/ledger", f"{folder}/cache"
    base = land_rivers(landing)
    store = TableStore(spark, f"{folder}/t")
    backfill_rivers(spark, landing, store, ledger, cache, 2005, 2006)
    store.append(RIVER_LEVELS, store.read(RIVER_LEVELS))
    write(f"{base}/station_ref=0503SO/year=2005/body.json", {"items": [level("2005-01-01", 0.1)]})
    before = ledger_keys(spark, ledger)
    twin = spark.createDataFrame([("0503SO",)], "station_ref string").select(F.lit("0503SO").alias("station_ref"), F.expr("date'2005-06-01'").alias("date"), F.expr("cast(1 as decimal(8,3))").alias("value_m"), F.lit("Good").alias("quality"), F.lit("EA").alias("source"))
    store.append(RIVER_LEVELS, twin.union(twin))
    with pytest.raises(ConstraintBreach, match="historical_river_levels: repeated key 0503SO, 2005-06-01"):
        backfill_rivers(spark, landing, store, ledger, cache, 2005, 2006)
    assert ledger_keys(spark, ledger) == before


def test_years_follow_the_clock():
    assert checks.newest_year() >= 2026
