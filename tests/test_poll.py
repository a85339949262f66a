import datetime
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from weirframe.plans.poll import RejectedPoll, poll_many, poll_once, to_hour
from weirframe.operators.checks import ConstraintBreach
from weirframe.sources import landed, quarantine
from weirframe.sources.schemas import FLOOD_EVENTS, STATION_READINGS, WEATHER_SNAPSHOTS
from weirframe.sources.tables import TableStore
from weirframe.streaming.polls import rejected_polls, rerun_rejected, stream_polls

AT = datetime.datetime(2024, 1, 1, 10, 25, tzinfo=datetime.timezone.utc)
READING = "http://x/data/readings/{}-level-stage-i-15_min-mASD/2024-01-01T00-00-00Z"


def write(path, body):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(body if isinstance(body, str) else json.dumps(body))


def area(notation, lat, lon):
    return {"notation": notation, "lat": lat, "long": lon}


def warning(area_id, level, label, message, description, **more):
    return {
        "floodAreaID": area_id,
        "severityLevel": level,
        "severity": label,
        "message": message,
        "description": description,
        "floodArea": {"county": "C", "riverOrSea": "R"},
        **more,
    }


AREAS = [area("A1", 51.5, -0.1), area("A1", 51.6, -0.2), area("A2", None, -1.0), area("", 50.0, -1.0), area("A0", 51.48, 0.0)]
WARNINGS = [
    warning("A1", 3, "alert", "m1", "d1"),
    warning("A1", 3, "ALERT", "m1", "d2"),
    warning("A1", 2, "warning", "m1", "d3", timeRaised="2024-01-01T09:00:00"),
    warning(None, 3, "alert", "m1", "d4"),
    warning("A0", 1, "severe", "m2", "d5", isTidal=True),
    warning("A3", 1, "severe", "m2", "d6"),
    warning("A4", 4, "gone", "m3", "d7"),
]
READINGS = [
    {"@id": READING.format("1491TH"), "value": 1.2345, "dateTime": "2024-01-01T00:00:00Z"},
    {"@id": READING.format("1491TH"), "value": "1.5", "dateTime": "2024-01-01T00:00:00Z"},
    {"@id": READING.format("0503SO"), "value": "1.5", "dateTime": None},
    {"@id": "http://x/data/readings/1491TH-flow-x/2024", "value": 1.0, "dateTime": "2024-01-01T00:00:00Z"},
    {"@id": "http://x/data/readings/-level-x/2024", "value": 1.0, "dateTime": "2024-01-01T00:00:00Z"},
    {"@id": READING.format("1491TH"), "value": None, "dateTime": "2024-01-02T00:00:00Z"},
]
WEATHER = {
    "current_weather": {"temperature": 7.125, "windspeed": 12.3, "winddirection": 2.5, "weathercode": 61},
    "hourly": {"precipitation": [0.4, 1.0], "relativehumidity_2m": [91, 90]},
}


def land(landing, poll, areas=AREAS, warnings=WARNINGS, readings=READINGS, weather=WEATHER):
    write(f"{landing}/areas/poll={poll}/page=0.json", {"items": areas})
    write(f"{landing}/warnings/poll={poll}/page=0.json", {"items": warnings})
    write(f"{landing}/readings/poll={poll}/page=0.json", {"items": readings})
    if weather is not None:
        write(f"{landing}/weather/poll={poll}/area=A1/body.json", weather)


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def state(store):
    return [
        rows(store.read(FLOOD_EVENTS), "*"),
        rows(store.read(WEATHER_SNAPSHOTS), "*"),
        rows(store.read(STATION_READINGS).drop("polled_at"), "*"),
    ]


def test_one_poll(spark, folder):
    land(f"{folder}/l", "p1")
    store = TableStore(spark, f"{folder}/t")
    summary = poll_once(spark, f"{folder}/l", store, "p1", AT).first().asDict()
    assert summary == {
        "n_areas": 2, "n_warnings": 6, "n_readings": 3,
        "n_events_inserted": 4, "n_events_updated": 1, "n_events_stored": 5, "n_events_noop": 1,
        "n_snapshots_stored": 1, "n_snapshots_skipped": 1, "n_readings_stored": 2, "n_malformed_bodies": 0,
    }
    events = {r["flood_area_id"]: r for r in store.read(FLOOD_EVENTS).collect()}
    a1 = events["A1"]
    assert (a1["severity_level"], a1["severity_label"], a1["message"], a1["description"]) == (2, "warning", "m1", "d1")
    assert (a1["lat"], a1["lon"]) == (Decimal("51.600000"), Decimal("-0.200000"))
    assert a1["time_raised"] is None and a1["is_tidal"] is False and events["A0"]["is_tidal"] is True
    assert events["A3"]["lat"] is None and events[None]["description"] == "d4"
    assert rows(store.read(FLOOD_EVENTS).select(F.col("polled_at").cast("string")).distinct(), "polled_at") == [
        ("2024-01-01 10:00:00",)
    ]
    snapshot = store.read(WEATHER_SNAPSHOTS).first()
    assert snapshot["flood_event_id"] == a1["id"]
    assert (snapshot["temperature_c"], snapshot["precipitation_mm"]) == (Decimal("7.13"), Decimal("0.40"))
    assert (snapshot["wind_direction_deg"], snapshot["weather_code"], snapshot["humidity_pct"]) == (3, 61, 91)
    assert rows(store.read(STATION_READINGS), "station_ref", "value_m", "station_label", "lat") == [
        ("0503SO", Decimal("1.500"), "", None),
        ("1491TH", Decimal("1.235"), "", None),
    ]


def test_second_run_of_a_batch_changes_nothing(spark, folder):
    land(f"{folder}/l", "p1")
    store = TableStore(spark, f"{folder}/t")
    poll_once(spark, f"{folder}/l", store, "p1", AT)
    before = state(store)
    summary = poll_once(spark, f"{folder}/l", store, "p1", AT).first()
    assert state(store) == before
    assert (summary["n_events_inserted"], summary["n_readings_stored"], summary["n_snapshots_stored"]) == (0, 0, 0)


def test_new_batch_in_the_hour_inserts_keyless_rows_again(spark, folder):
    store = TableStore(spark, f"{folder}/t")
    for poll in ("p1", "p2"):
        land(f"{folder}/l", poll)
        poll_once(spark, f"{folder}/l", store, poll, AT)
    assert store.read(FLOOD_EVENTS).filter("flood_area_id is null").count() == 2
    assert store.read(FLOOD_EVENTS).filter("flood_area_id = 'A1'").count() == 1
    assert store.read(STATION_READINGS).filter("reading_at is null").count() == 2


def test_missing_weather_and_envelopes(spark, folder):
    landing = f"{folder}/l"
    land(landing, "p1", weather=None)
    write(f"{landing}/readings/poll=p1/page=0.json", {"other": 1})
    write(f"{landing}/areas/poll=p1/page=1.json", "not json")
    store = TableStore(spark, f"{folder}/t")
    assert poll_once(spark, landing, store, "p1", AT).first()["n_malformed_bodies"] == 1
    snapshot = store.read(WEATHER_SNAPSHOTS).first()
    assert snapshot["temperature_c"] is None and snapshot["humidity_pct"] is None
    assert store.read(STATION_READINGS).count() == 0
    summary = poll_once(spark, landing, store, "absent", AT).first()
    assert (summary["n_areas"], summary["n_warnings"], summary["n_readings"]) == (0, 0, 0)


def test_later_poll_of_the_hour_keeps_coordinates_but_uses_its_own_for_weather(spark, folder):
    landing, store = f"{folder}/l", TableStore(spark, f"{folder}/t")
    land(landing, "p1", areas=[], warnings=[warning("A1", 3, "alert", "m", "d")], readings=[])
    poll_once(spark, landing, store, "p1", AT)
    assert store.read(WEATHER_SNAPSHOTS).count() == 0
    land(landing, "p2", warnings=[warning("A1", 1, "severe", "m", "d")], readings=[])
    poll_once(spark, landing, store, "p2", AT)
    event = store.read(FLOOD_EVENTS).first()
    assert event["lat"] is None and event["severity_level"] == 1
    assert store.read(WEATHER_SNAPSHOTS).count() == 1


def test_bad_value_stops_the_poll_before_any_write(spark, folder):
    landing, store = f"{folder}/l", TableStore(spark, f"{folder}/t")
    land(landing, "p1", readings=[{"@id": READING.format("1"), "value": "abc", "dateTime": None}])
    with pytest.raises(RejectedPoll, match="bad value for value_m: abc"):
        poll_once(spark, landing, store, "p1", AT)
    assert [len(part) for part in state(store)] == [0, 0, 0]


def test_run_that_was_cut_off_is_repaired(spark, folder, monkeypatch):
    landing, store = f"{folder}/l", TableStore(spark, f"{folder}/t")
    land(landing, "p1")
    poll_once(spark, landing, TableStore(spark, f"{folder}/whole"), "p1", AT)

    def cut_off(*_args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(TableStore, "replace_partitions", cut_off)
        with pytest.raises(RuntimeError, match="lost"):
            poll_once(spark, landing, store, "p1", AT)
    assert [len(part) for part in state(store)] == [0, 1, 2]
    with monkeypatch.context() as patch:
        patch.setattr(TableStore, "_publish", cut_off)
        with pytest.raises(RuntimeError, match="lost"):
            poll_once(spark, landing, store, "p1", AT)
    poll_once(spark, landing, store, "p1", AT)
    assert state(store) == state(TableStore(spark, f"{folder}/whole"))
    assert os.listdir(f"{folder}/t/_pending/flood_events") == []


def test_a_poll_touches_its_hour_alone(spark, folder):
    landing, store = f"{folder}/l", TableStore(spark, f"{folder}/t")
    for k, poll in enumerate(("p1", "p2")):
        land(landing, poll, readings=[])
        poll_once(spark, landing, store, poll, AT + datetime.timedelta(hours=k))
    table = f"{folder}/t/flood_events"
    assert sorted(os.listdir(table)) == ["polled_hour=2024-01-01-10", "polled_hour=2024-01-01-11"]
    first = {f: os.stat(f"{table}/polled_hour=2024-01-01-10/{f}").st_mtime_ns for f in os.listdir(f"{table}/polled_hour=2024-01-01-10")}
    land(landing, "p3", warnings=[warning("A1", 1, "severe", "m", "d")], readings=[])
    poll_once(spark, landing, store, "p3", AT + datetime.timedelta(hours=1))
    assert first == {f: os.stat(f"{table}/polled_hour=2024-01-01-10/{f}").st_mtime_ns for f in first}
    assert store.read(FLOOD_EVENTS).filter("severity_label = 'severe' and flood_area_id = 'A1'").count() == 1


def test_pages_are_read_in_order(spark, folder):
    landing, store = f"{folder}/l", TableStore(spark, f"{folder}/t")
    land(landing, "p1", warnings=[warning("A1", 3, "a", "m", "first")], readings=[])
    write(f"{landing}/warnings/poll=p1/page=10.json", {"items": [warning("A1", 1, "c", "m", "third")]})
    write(f"{landing}/warnings/poll=p1/page=2.json", {"items": [warning("A1", 2, "b", "m", "second")]})
    poll_once(spark, landing, store, "p1", AT)
    assert rows(store.read(FLOOD_EVENTS), "description", "severity_label") == [("first", "c")]


def test_hour_key():
    assert to_hour(AT) == datetime.datetime(2024, 1, 1, 10, tzinfo=datetime.timezone.utc)
    assert to_hour(datetime.datetime(2024, 1, 1, 10, 5)).hour == 10


def test_stream_records_rejected_polls_and_runs_them_again(spark, folder):
    landing, store = f"{folder}/l", TableStore(spark, f"{folder}/t")
    bad = [{"@id": READING.format("1"), "value": "abc", "dateTime": None}]
    land(landing, "p1", warnings=[warning("A9", 1, "late", "m", "d")], readings=bad)
    land(landing, "p2", warnings=[warning("A1", 1, "severe", "m", "d")])
    for poll in ("p1", "p2"):
        write(f"{landing}/polls/{poll}.json", {"poll": poll, "polled_at": f"2024-01-01T10:0{poll[1]}:00+00:00"})
    write(f"{landing}/polls/p3.json", "not json")
    write(f"{landing}/polls/p4.json", {"poll": "p4", "polled_at": "soon"})
    stream_polls(spark, landing, store, f"{folder}/c").awaitTermination()
    assert rows(store.read(FLOOD_EVENTS), "severity_label") == [("severe",)]
    assert rows(rejected_polls(spark, store), "announcement", "poll", "reason") == [
        ("p1.json", "p1", "bad value for value_m: abc"),
        ("p3.json", None, "the announcement has no poll or no time"),
        ("p4.json", "p4", "the announcement has no poll or no time"),
    ]
    write(f"{landing}/readings/poll=p1/page=0.json", {"items": []})
    assert rerun_rejected(spark, landing, store) == 2
    assert rows(store.read(FLOOD_EVENTS), "severity_label") == [("late",), ("severe",)]
    assert rows(rejected_polls(spark, store), "announcement") == [("p3.json",), ("p4.json",)]


def test_stream_runs_each_announced_poll_once(spark, folder):
    landing, store = f"{folder}/l", TableStore(spark, f"{folder}/t")
    land(landing, "p1", warnings=[warning("A1", 3, "alert", "m", "d")])
    land(landing, "p2", warnings=[warning("A1", 1, "severe", "m", "d")])
    write(f"{landing}/polls/p1.json", {"poll": "p1", "polled_at": "2024-01-01T10:05:00+00:00"})
    run = lambda: stream_polls(spark, landing, store, f"{folder}/c").awaitTermination()
    run()
    assert rows(store.read(FLOOD_EVENTS), "severity_label") == [("alert",)]
    write(f"{landing}/polls/p2.json", {"poll": "p2", "polled_at": "2024-01-01T10:35:00+00:00"})
    run()
    after = state(store)
    assert rows(store.read(FLOOD_EVENTS), "severity_label") == [("severe",)]
    run()
    assert state(store) == after


def backlog(landing):
    """Twelve polls of four hours, with changing areas, a rejected poll and weather that fails another one."""
    announced = []
    for k in range(12):
        poll = f"p{k}"
        areas = [area("A1", 51.5, k or None), area("A2", 50 + k, -1.0)] if k % 3 else [area("A2", 0, -1.0)]
        warnings = [
            warning(f"A{1 + j % 3}", 1 + (k * j) % 3, f"l{k}", f"m{(k + j) // 4}", f"d{k}-{j}", isTidal=None if j % 2 else k % 2 == 0)
            for j in range(5)
        ]
        warnings.append(warning(None, 2, "l", "m", f"k{k}"))
        readings = [{"@id": READING.format(f"S{j}"), "value": k + j, "dateTime": f"2024-01-0{1 + (k + j) % 4}T00:00:00Z" if j else None} for j in range(3)]
        if k == 4:
            readings.append({"@id": READING.format("S9"), "value": "abc", "dateTime": None})
        land(landing, poll, areas, warnings, readings, weather=None)
        for name in ("A1", "A2"):
            body = {"current_weather": {"temperature": "x" if (k, name) == (7, "A2") else k}, "hourly": None}
            write(f"{landing}/weather/poll={poll}/area={name}/body.json", body)
        announced.append((poll, AT.replace(hour=10 + k // 3, minute=k)))
    return announced


def test_a_backlog_as_one_batch_equals_poll_after_poll(spark, folder):
    landing = f"{folder}/l"
    announced = backlog(landing)
    whole, single = TableStore(spark, f"{folder}/whole"), TableStore(spark, f"{folder}/single")
    run = poll_many(spark, landing, whole, announced)
    rejected, summaries = {}, []
    for poll, moment in announced:
        try:
            summaries.append(poll_once(spark, landing, single, poll, moment).first().asDict())
        except RejectedPoll as error:
            rejected[(poll, moment)] = str(error)
    assert run.rejected == rejected
    assert set(rejected.values()) == {"bad value for value_m: abc", "bad value for temperature_c: x"}
    assert state(whole) == state(single)
    assert len(state(whole)[1]) > 3 and whole.read(FLOOD_EVENTS).filter("is_tidal is null").count() > 0
    total = run.summary.first().asDict()
    for name in total:
        if name not in ("n_areas", "n_malformed_bodies"):  # areas of rejected polls are read, too
            assert total[name] == sum(summary[name] for summary in summaries), name
    before = state(whole)
    # A poll that only its weather failed would pass by now, since its events are no news any more.
    poll_many(spark, landing, whole, [(poll, moment) for poll, moment in announced if (poll, moment) not in rejected])
    assert state(whole) == before
    reasons = {(r["unit"], r["page"], r["reason"]) for r in quarantine.read(spark, whole).collect()}
    assert ("p4", 0, "bad value for value_m: abc") in reasons


def test_bodies_as_rows_give_the_same_as_files(spark, folder):
    landing, rows_landing = f"{folder}/l", f"{folder}/rows"
    land(landing, "p1")
    write(f"{landing}/areas/poll=p1/page=1.json", "not json")
    bodies = landed.live_bodies(spark, landing, ["p1"]).select("poll", "source", "area", "page", "body")
    bodies.write.partitionBy("poll").parquet(f"{rows_landing}/poll_bodies")
    files_store, rows_store = TableStore(spark, f"{folder}/tf"), TableStore(spark, f"{folder}/tr")
    summaries = [poll_once(spark, at, store, "p1", AT).first() for at, store in ((landing, files_store), (rows_landing, rows_store))]
    assert summaries[0] == summaries[1] and summaries[0]["n_malformed_bodies"] == 1
    assert state(files_store) == state(rows_store)
    for store in (files_store, rows_store):
        assert rows(quarantine.read(spark, store), "job", "unit", "source", "page", "reason") == [("poll", "p1", "areas", 1, "malformed body")]


def test_explicit_null_flag_stays_null(spark, folder):
    landing, store = f"{folder}/l", TableStore(spark, f"{folder}/t")
    flags = {"A1": {"isTidal": None}, "A2": {}, "A3": {"isTidal": False}, "A4": {"isTidal": True}, "A5": {"isTidal": "null"}}
    land(landing, "p1", warnings=[warning(a, 1, "l", "m", "d", **more) for a, more in flags.items()][:4], readings=[])
    poll_once(spark, landing, store, "p1", AT)
    assert rows(store.read(FLOOD_EVENTS), "flood_area_id", "is_tidal") == [("A1", None), ("A2", False), ("A3", False), ("A4", True)]


@pytest.mark.parametrize("breach", ["duplicate", "orphan"])
def test_a_breach_of_a_constraint_stops_the_poll(spark, folder, breach):
    landing, store = f"{folder}/l", TableStore(spark, f"{folder}/t")
    land(landing, "p1")
    poll_once(spark, landing, store, "p1", AT)
    if breach == "duplicate":
        store.append(STATION_READINGS, store.read(STATION_READINGS).filter("reading_at is not null"))
        found = "station_readings: repeated key 1491TH"
    else:
        store.append(WEATHER_SNAPSHOTS, store.read(WEATHER_SNAPSHOTS).selectExpr("id", "flood_event_id + 1 as flood_event_id", "* except (id, flood_event_id)"))
        found = "weather_snapshots: flood_event_id without its row"
    land(landing, "p2", readings=[{"@id": READING.format("7"), "value": 1, "dateTime": "2024-01-01T00:00:00Z"}])
    with pytest.raises(ConstraintBreach, match=found):
        poll_once(spark, landing, store, "p2", AT)


def test_a_poll_runs_no_job_to_count(spark, folder):
    landing, store = f"{folder}/l", TableStore(spark, f"{folder}/t")
    land(landing, "p1")
    counted = []
    real = type(spark.range(1)).count
    try:
        type(spark.range(1)).count = lambda frame: counted.append(frame) or real(frame)
        poll_once(spark, landing, store, "p1", AT)
    finally:
        type(spark.range(1)).count = real
    assert not counted
