import random

import pytest
from pyspark.sql import functions as F

from weirframe.operators import checks, dedup, heavy, merge, ordered, paging

RULE = merge.UpsertRule(["case", "k"], ["g1", "g2", "g3"], ["label"])
SCHEMA = "case int, k string, g1 int, g2 string, g3 int, label string, note string, seq int"


def random_batch(rng, case, size, start=0):
    pick = lambda *values: rng.choice(values)
    return [
        (case, pick("a", "b", None), pick(1, 2, None), pick("x", None), pick(7, None), pick("p", "q", None), f"n{start + i}", start + i)
        for i in range(size)
    ]


def apply_rows(table, rows):
    """Row by row, as single statements would. Returns actions; ``table`` is changed."""
    actions = []
    for case, k, g1, g2, g3, label, note, _seq in rows:
        row = {"case": case, "k": k, "g": (g1, g2, g3), "label": label, "note": note}
        found = next((t for t in table if k is not None and t["case"] == case and t["k"] == k), None)
        if found is None:
            table.append(row)
            actions.append("insert")
        elif found["g"] != row["g"]:
            found["g"], found["label"] = row["g"], label
            actions.append("update")
        else:
            actions.append("noop")
    return actions


def flat(table):
    return sorted(((t["case"], t["k"], *t["g"], t["label"], t["note"]) for t in table), key=repr)


def frame_rows(frame):
    return sorted((tuple(r) for r in frame.select("case", "k", "g1", "g2", "g3", "label", "note").collect()), key=repr)


def without_order(spark, table):
    rows = [(t["case"], t["k"], *t["g"], t["label"], t["note"]) for t in table]
    return spark.createDataFrame(rows, SCHEMA.rsplit(",", 1)[0])


# Heavy rows and keys: all keys whole, some keys in pieces, and 50 keys of any size in pieces.
PATHS = [(1 << 20, 1000), (3, 1000), (0, 50)]


def cut_keys(frame, keys, place="seq"):
    return heavy.heavy_keys(frame.filter(F.concat(*keys).isNotNull()), keys, F.col(place))


@pytest.mark.parametrize(("heavy_rows", "most_keys"), PATHS)
def test_fold_equals_row_by_row(spark, monkeypatch, heavy_rows, most_keys):
    monkeypatch.setattr(heavy, "HEAVY_ROWS", heavy_rows)
    monkeypatch.setattr(heavy, "MOST_KEYS", most_keys)
    rng = random.Random(1)
    stored, batch, actions, after = [], [], {"insert": 0, "update": 0, "noop": 0}, []
    for case in range(400):
        table = []
        apply_rows(table, random_batch(rng, case, rng.randint(0, 4)))
        stored += [dict(t) for t in table]
        rows = random_batch(rng, case, rng.randint(0, 9))
        batch += rows
        for action in apply_rows(table, rows):
            actions[action] += 1
        after += table
    frame = spark.createDataFrame(batch, SCHEMA)
    found = cut_keys(frame, ["case", "k"])
    assert bool(found.found) == (heavy_rows < 100)
    folded = merge.fold(frame, RULE, ["seq"], without_order(spark, stored), heavy=found)
    assert frame_rows(folded) == flat(after)
    totals = merge.action_totals(folded).first()
    assert (totals["n_insert"], totals["n_update"], totals["n_noop"]) == tuple(actions.values())


@pytest.mark.parametrize(("heavy_rows", "most_keys"), PATHS)
def test_fold_with_negative_and_sparse_order_values(spark, monkeypatch, heavy_rows, most_keys):
    monkeypatch.setattr(heavy, "HEAVY_ROWS", heavy_rows)
    monkeypatch.setattr(heavy, "MOST_KEYS", most_keys)
    rule = merge.UpsertRule(["k"], ["g"])
    stored = spark.createDataFrame([("a", 9), ("b", 1)], "k string, g int")
    rows = [("a", 1, -3_145_728), ("a", 2, -1_048_581), ("a", 2, 7), ("b", 1, 2**60), ("c", 5, -(2**60))]
    frame = spark.createDataFrame(rows, "k string, g int, seq long")
    folded = merge.fold(frame, rule, ["seq"], stored, heavy=cut_keys(frame, ["k"]))
    assert sorted(map(tuple, folded.collect())) == [("a", 2, 0, 2, 1), ("b", 1, 0, 0, 1), ("c", 5, 1, 0, 0)]


@pytest.mark.parametrize(("heavy_rows", "most_keys"), PATHS)
def test_steps_equal_one_fold_after_the_other(spark, monkeypatch, heavy_rows, most_keys):
    monkeypatch.setattr(heavy, "HEAVY_ROWS", heavy_rows)
    monkeypatch.setattr(heavy, "MOST_KEYS", most_keys)
    rng = random.Random(8)
    stored, batch, after, actions = [], [], [], {}
    for case in range(250):
        table = []
        apply_rows(table, random_batch(rng, case, rng.randint(0, 3)))
        stored += [dict(t) for t in table]
        for step in range(4):
            rows = random_batch(rng, case, rng.randint(0, 4), 100 * step)
            batch += [(*row, step) for row in rows]
            for row, action in zip(rows, apply_rows(table, rows), strict=True):
                count = actions.setdefault((case, row[1], step), {"insert": 0, "update": 0, "noop": 0})
                count[action] += 1
        after += table
    frame = spark.createDataFrame(batch, f"{SCHEMA}, step int").withColumnRenamed("step", "turn")
    found = cut_keys(frame, ["case", "k"])
    steps = merge.fold_steps(frame, RULE, ["seq", "turn"], F.col("turn"), without_order(spark, stored), found)
    assert frame_rows(steps.filter("is_last")) == flat(after)
    of_step = steps.filter("step is not null")
    assert of_step.filter("k is not null").groupBy("case", "k", "step").count().filter("count > 1").count() == 0
    counted = of_step.groupBy("case", "k", "step").agg(*[F.sum(name) for name in merge.ACTIONS])
    got = {tuple(r)[:3]: tuple(r)[3:] for r in counted.collect()}
    assert got == {key: tuple(count.values()) for key, count in actions.items()}


def test_heavy_key_with_microsecond_orders_is_cut_evenly(spark, monkeypatch):
    """Two million rows of one key, at instants that crowd together towards the end."""
    n = 2_000_000
    micros = F.lit(1_700_000_000_000_000) + (F.pow(F.col("id") / n, 0.1) * 1e12).cast("long") * 1000 + F.col("id") % 1000
    busy = spark.range(n).select(F.lit("busy").alias("k"), (F.col("id") % 5 % 3).alias("g"), micros.alias("seq"), "id")
    calm = spark.range(3000).select(F.concat(F.lit("k"), F.col("id") % 900).alias("k"), (F.col("id") % 2).alias("g"), (F.col("id") * 10**9).alias("seq"), "id")
    batch = busy.unionByName(calm)
    found = heavy.heavy_keys(batch, ["k"], F.col("seq"))
    assert [key for key, _ in found.found] == ["busy"]
    table = found.table(spark, batch.select("k").schema)
    pieces = batch.join(table, "k").groupBy(heavy.piece_of("seq", "_cuts").alias("piece")).count().collect()
    assert len(pieces) == 8 and max(r["count"] for r in pieces) < heavy.HEAVY_ROWS // 3
    rule = merge.UpsertRule(["k"], ["g"])
    folded = merge.fold(batch, rule, ["seq", "id"], heavy=found)
    whole = merge.fold(batch, rule, ["seq", "id"])
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, whole.collect()))


def test_fold_runs_no_job_and_finding_heavy_keys_shuffles_one_row_per_task(spark):
    rows = spark.range(10_000).select((F.col("id") % 7).alias("k"), F.col("id").alias("seq"))
    tracker, group = spark.sparkContext.statusTracker(), "fold-jobs"
    spark.sparkContext.setJobGroup(group, group)
    merge.fold(rows.withColumn("g", F.lit(1)), merge.UpsertRule(["k"], ["g"]), ["seq"], rows.select("k", F.lit(2).alias("g")))
    assert not tracker.getJobIdsForGroup(group)
    heavy.heavy_keys(rows, ["k"], F.col("seq"))
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert stages and all(s is None or s.numTasks <= 8 for s in stages)
    spark.sparkContext.setJobGroup("tests", "tests")


def test_split_batch_gives_the_same_table(spark):
    rng = random.Random(2)
    batch = [row for case in range(100) for row in random_batch(rng, case, 8)]
    frame = spark.createDataFrame(batch, SCHEMA)
    whole = merge.guarded_upsert(frame, RULE, ["seq"])
    for cut in (0, 3, 8):
        first = merge.guarded_upsert(frame.filter(F.col("seq") < cut), RULE, ["seq"])
        both = merge.guarded_upsert(frame.filter(F.col("seq") >= cut), RULE, ["seq"], first)
        assert frame_rows(both) == frame_rows(whole)


def test_replay_leaves_keyed_rows_unchanged(spark):
    rng = random.Random(3)
    batch = [row for case in range(100) for row in random_batch(rng, case, 8) if row[1]]
    frame = spark.createDataFrame(batch, SCHEMA)
    once = merge.guarded_upsert(frame, RULE, ["seq"])
    assert frame_rows(merge.guarded_upsert(frame, RULE, ["seq"], once)) == frame_rows(once)


def test_label_change_alone_is_a_noop(spark):
    rows = [
        (0, "A1", 3, "m1", None, "alert", "d1", 0),
        (0, "A1", 3, "m1", None, "ALERT", "d2", 1),
        (0, "A1", 2, "m1", None, "warning", "d3", 2),
        (0, None, 3, "m1", None, "alert", "d4", 3),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    once = merge.fold(frame, RULE, ["seq"])
    assert frame_rows(once) == [(0, "A1", 2, "m1", None, "warning", "d1"), (0, None, 3, "m1", None, "alert", "d4")]
    replay = merge.fold(frame.filter("k is not null"), RULE, ["seq"], once.drop(*merge.ACTIONS))
    totals = merge.action_totals(replay).first()
    assert (totals["n_insert"], totals["n_update"], totals["n_noop"]) == (0, 2, 1)
    assert frame_rows(replay) == frame_rows(once)


def test_rule_without_carried_or_immutable_columns(spark):
    frame = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("b", 1, 2)], "k string, g int, seq int")
    rule = merge.UpsertRule(["k"], ["g"])
    merged = merge.guarded_upsert(frame, rule, ["seq"])
    assert sorted(map(tuple, merged.collect())) == [("a", 2), ("b", 1)]


def test_insert_ignore_equals_row_by_row(spark):
    rng = random.Random(4)
    stored, batch, expected = [], [], []
    for case in range(200):
        keys = {(rng.choice("ab"), rng.choice([1, 2])) for _ in range(rng.randint(0, 2))}
        table = [(case, *key, "old") for key in keys]
        stored += table
        for seq in range(rng.randint(0, 8)):
            row = (case, rng.choice(["a", "b", None]), rng.choice([1, 2, None]), f"n{seq}", seq)
            batch.append(row)
            key = row[1:3]
            if None in key or all(t[1:3] != key for t in table):
                table.append(row[:4])
                expected.append(row)
    added = merge.insert_ignore(
        spark.createDataFrame(batch, "case int, k string, day int, note string, seq int"),
        ["case", "k", "day"],
        ["seq"],
        spark.createDataFrame(stored, "case int, k string, day int, note string"),
    )
    assert sorted(map(tuple, added.collect()), key=repr) == sorted(expected, key=repr)


def test_replayed_keyless_rows_are_dropped(spark):
    rows = [(1, None, 5), (2, None, 6), (3, "a", 7)]
    frame = spark.createDataFrame(rows, "id long, k string, v int")
    stored = spark.createDataFrame([(1, None, 5), (9, "a", 7)], "id long, k string, v int")
    kept = merge.drop_replayed(frame, stored, ["k"])
    assert sorted(r["id"] for r in kept.collect()) == [2, 3]


def test_first_and_last_wins(spark):
    rows = [("A1", 51.5, 0), ("A1", 51.6, 1), ("A0", 51.48, 2)]
    frame = spark.createDataFrame(rows, "k string, lat double, pos int")
    assert sorted(map(tuple, dedup.last_wins(frame, ["k"], ["pos"]).collect())) == [("A0", 51.48, 2), ("A1", 51.6, 1)]
    assert sorted(map(tuple, dedup.first_wins(frame, ["k"], ["pos"]).collect())) == [("A0", 51.48, 2), ("A1", 51.5, 0)]


def test_first_entries_under_conditions(spark):
    rows = [("a", 0, None), ("a", 1, 5), ("a", 2, 6), ("b", 3, None)]
    frame = spark.createDataFrame(rows, "k string, pos int, lat int")
    got = dedup.first_entries(
        frame, ["k"], ["pos"], ["pos", "lat"], {"any": F.lit(True), "placed": F.col("lat").isNotNull()}
    )
    found = {r["k"]: r for r in got.collect()}
    assert found["a"]["any"]["lat"] is None and found["a"]["placed"]["lat"] == 5
    assert found["a"]["any_entries"] == 3 and found["a"]["placed_entries"] == 2
    assert found["b"]["placed"] is None and found["b"]["placed_entries"] == 0


def test_previous_row_over_chunks(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), seq, rng.choice([1, None])) for seq in range(300) if rng.random() < 0.6]
    frame = spark.createDataFrame(rows, "k string, seq int, v int")
    expected, last = [], {}
    for k, seq, v in rows:
        expected.append((seq, k in last, last.get(k)))
        last[k] = v
    for width in (1, 7, 1000):
        linked = ordered.with_previous(frame, ["k"], ["seq"], ["v"], ordered.chunk_of("seq", width))
        got = linked.select("seq", "has_previous", F.col("previous.v")).collect()
        assert sorted(map(tuple, got)) == expected


def test_position_over_chunks(spark):
    keys = random.Random(6).sample(range(1000), 200)
    frame = spark.createDataFrame([(k,) for k in keys], "k int")
    for width in (1, 16, 5000):
        got = ordered.with_position(frame, "k", ordered.chunk_of("k", width)).collect()
        assert [r["k"] for r in sorted(got, key=lambda r: r["position"])] == sorted(keys)
        assert sorted(r["position"] for r in got) == list(range(200))


@pytest.mark.parametrize(
    ("pages", "fault"),
    [
        ([], None),
        ([(0, False), (1, False), (2, False)], None),
        ([(0, False), (2, False)], "1 pages are missing"),
        ([(1, False)], "1 pages are missing"),
        ([(0, False), (1, True), (2, True)], "2 malformed pages, the first is page 1"),
    ],
)
def test_a_listing_must_be_complete(spark, pages, fault):
    frame = spark.createDataFrame(pages, "page int, malformed boolean")
    if fault is None:
        paging.require_complete(frame, "listing")
        return
    with pytest.raises(paging.IncompleteListing, match=fault):
        paging.require_complete(frame, "listing")


def test_unit_status_and_audits(spark):
    rows = [("a", 1, 5), ("a", 1, None), ("b", 1, 7), ("b", 1, 8)]
    frame = spark.createDataFrame(rows, "ref string, year int, v int")
    status = checks.unit_status(frame, ["ref", "year"], F.col("v").isNull())
    assert {r["ref"]: (r["n_rows"], r["status"]) for r in status.collect()} == {"a": (2, "failed"), "b": (2, "done")}
    assert {r["ref"]: r["n_rows"] for r in checks.duplicates(frame, ["ref", "year"]).collect()} == {"a": 2, "b": 2}
    parents = spark.createDataFrame([(5,), (7,)], "id int")
    assert [tuple(r) for r in checks.orphans(frame, "v", parents, "id").collect()] == [(8, 1)]
