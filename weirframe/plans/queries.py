"""The operators on the given tables: one query per operator group.

``events`` stands in for the polled warnings: a row is one warning of a user ("area")
in an hour. Earlier polls are the rows of the first 20 minutes of each hour.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirframe.functions import arrays, scalars
from weirframe.operators import checks, dedup, filters, ledger, merge, ordered, paging
from weirframe.operators.heavy import heavy_keys
from weirframe.operators.lookup import left_lookup
from weirframe.plans import backfill, poll
from weirframe.session import Scratch
from weirframe.sources import files, landed
from weirframe.sources.schemas import (
    BUCKET,
    CORRUPT,
    FLOOD_EVENTS,
    RIVER_LEVELS,
    STATION_READINGS,
    WEATHER_HISTORY,
    WEATHER_HISTORY_DOC,
    WEATHER_SNAPSHOTS,
    Table,
    columns_of,
)
from weirframe.sources.tables import TableStore, station_bucket
from weirframe.streaming.polls import stream_polls, stream_upserts

LINE_KEY = ["l_orderkey", "l_linenumber"]
EVENT_RULE = merge.UpsertRule(
    keys=["user_id", "hour"],
    guard=["level", "message", "changed"],
    carried=["label"],
)
EVENT_STATE = Table(
    "event_state",
    columns_of(
        "user_id long, hour timestamp_ntz, level string, message integer, changed integer,"
        " label string, created_by long, created_value double"
    ),
    ("user_id", "hour"),
    (),
    "state_date",
    T.DateType(),
    "hour",
)
FIRST_YEAR, LAST_YEAR = 1995, 2001
BACKLOG = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hour() -> Column:
    return scalars.hour_bucket(F.col("ts")).cast("timestamp_ntz")


def _noted() -> Column:
    """An instant that changes with the length of ``props``; none for some lengths."""
    day = F.nullif(F.length("props") % 3, F.lit(0))
    return F.concat(F.lit("2024-01-0"), day.cast("string"), F.lit("T10:00:00+01:00"))


def _earlier() -> Column:
    return F.coalesce(F.minute("ts") < 20, F.lit(False))


def _warnings(events: DataFrame) -> DataFrame:
    return events.select(
        "user_id",
        _hour().alias("hour"),
        F.col("event_type").alias("level"),
        F.nullif(F.floor(F.col("value") / 25).cast("int"), F.lit(0)).alias("message"),
        F.nullif(F.length("props") % 3, F.lit(0)).cast("int").alias("changed"),
        F.col("props").alias("label"),
        F.col("event_id").alias("created_by"),
        F.col("value").alias("created_value"),
        "event_id",
    )


def _folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    order = ["event_id"]
    # Keyless rows are split off once, at the scan, and not again from the earlier state.
    keyed, keyless = dedup.split_null_keys(events, ["user_id", "ts"])
    # Found over all events, so that both halves know them.
    found = heavy_keys(_warnings(keyed).select("user_id", "hour", "event_id"), EVENT_RULE.keys, F.col("event_id"))
    earlier = merge.guarded_upsert(_warnings(keyed.filter(_earlier())), EVENT_RULE, order, null_keys=False, heavy=found)
    folded = merge.fold(_warnings(keyed.filter(~_earlier())), EVENT_RULE, order, earlier, null_keys=False, heavy=found)
    return folded.unionByName(merge.unfolded(_warnings(keyless.filter(_earlier())), order, inserted=False)).unionByName(
        merge.unfolded(_warnings(keyless.filter(~_earlier())), order, inserted=True)
    )


def insert_ignore_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return merge.insert_ignore(lines, LINE_KEY, [c for c in lines.columns if c not in LINE_KEY])


def insert_ignore_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    order = [c for c in lines.columns if c not in LINE_KEY]
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    stored = Scratch(spark, "insert-ignore").keep(merge.insert_ignore(lines.filter(early), LINE_KEY, order), "stored")
    added = merge.insert_ignore(lines.filter(~early), LINE_KEY, order, stored)
    return stored.unionByName(added)


def null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")

    def keyed(part: DataFrame) -> DataFrame:
        return part.select(F.nullif("user_id", F.lit(0)).alias("user_key"), _hour().alias("hour"), "event_id")

    return merge.insert_ignore(
        keyed(events.filter(~_earlier())), ["user_key", "hour"], ["event_id"], keyed(events.filter(_earlier()))
    )


def guarded_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folded(spark, sf_dir).drop(*merge.ACTIONS)


def upsert_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.action_totals(_folded(spark, sf_dir))


def distinct_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.nullif("event_type", F.lit("error")).alias("level"),
        F.nullif(F.floor(F.col("value") / 25).cast("int"), F.lit(0)).alias("message"),
    )
    linked = ordered.with_previous(
        events, ["user_id"], ["event_id"], ["level", "message"], ordered.chunk_of("event_id")
    )
    return linked.select(
        "event_id",
        "user_id",
        "has_previous",
        scalars.distinct_from(F.col("level"), F.col("previous.level")).alias("level_distinct"),
        scalars.distinct_from(F.col("message"), F.col("previous.message")).alias("message_distinct"),
    )


def hour_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", _hour().alias("hour")).distinct()


def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    return dedup.last_wins(events, ["user_id"], ["event_id"])


def first_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    firsts = dedup.first_entries(
        table(spark, sf_dir, "orders"),
        ["o_custkey"],
        ["o_orderkey"],
        ["o_orderkey", "o_totalprice"],
        {"any": F.lit(True), "large": F.col("o_totalprice") > 200000},
    )
    return firsts.select(
        "o_custkey",
        F.col("any.o_orderkey").alias("first_orderkey"),
        F.col("any.o_totalprice").alias("first_price"),
        F.col("any_entries").alias("n_orders"),
        F.col("large.o_orderkey").alias("first_large_orderkey"),
        F.col("large.o_totalprice").alias("first_large_price"),
        F.col("large_entries").alias("n_large_orders"),
    )


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return dedup.last_wins(events, ["user_id", "event_type"], ["ts", "event_id"])


def left_lookup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    solvent = table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return left_lookup(orders, solvent, {"o_custkey": "c_custkey"}, ["c_nationkey", "c_acctbal"])


def snapshot_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Touched keys with a non-zero "latitude" get their "weather", if there is any.

    The fold leaves one row per key and the lookups add none, so a key has one snapshot.
    """
    customer = table(spark, sf_dir, "customer")
    touched = _folded(spark, sf_dir).select("user_id", "hour", (F.col("n_insert") + F.col("n_update")).alias("n_attempts"))
    located = left_lookup(touched.filter("n_attempts > 0"), customer, {"user_id": "c_custkey"}, ["c_nationkey"])
    attempts = located.filter(scalars.truthy(F.col("c_nationkey")))
    weather = customer.filter("c_acctbal > 0")
    return left_lookup(attempts, weather, {"user_id": "c_custkey"}, ["c_acctbal"])


def pending_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey")
    done = (
        table(spark, sf_dir, "lineitem")
        .filter("l_returnflag = 'R' and l_discount >= 0.1")
        .select(F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("year"))
    )
    return ledger.pending(ledger.unit_grid(suppliers, FIRST_YEAR, LAST_YEAR), done, ["s_suppkey", "year"])


def ledger_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = F.concat(F.lit("C:"), F.col("o_custkey").cast("string"))
    key = scalars.unit_key(ref, F.year("o_orderdate"))
    lines = table(spark, sf_dir, "orders").select(F.concat(F.lit("  "), key, F.lit(" ")).alias("value"))
    return ledger.parse(lines)


def ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))
    return ledger.additions(units, units.filter("year < 1998"), ["o_custkey", "year"])


def unit_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    bad = (F.col("l_quantity") >= 50) | ~checks.routable(day, FIRST_YEAR, 2000)
    rows = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    return checks.unit_status(rows, ["l_suppkey", "year"], bad)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = unit_status(spark, sf_dir)
    by_unit = status.agg(
        F.sum(F.when(F.col("status") == "done", F.col("n_rows"))).alias("inserted"),
        F.sum("n_rows").alias("scanned"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "done").alias("done"),
    ).unpivot([], ["inserted", "scanned", "failed", "done"], "metric", "total")
    expected = table(spark, sf_dir, "supplier").agg(
        (F.count(F.lit(1)) * (LAST_YEAR - FIRST_YEAR + 1)).alias("total")
    )
    waiting = pending_units(spark, sf_dir).agg(F.count(F.lit(1)).alias("total"))
    return by_unit.unionByName(expected.select(F.lit("expected").alias("metric"), "total")).unionByName(
        waiting.select(F.lit("pending").alias("metric"), "total")
    )


def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return labels.join(documents, "doc_id").filter(
        filters.passes_quality(F.col("quality"), F.col("n_chars"), accepted=1)
    )


def quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.filter(filters.passes_quality(F.col("l_returnflag"), F.col("l_quantity"), accepted="R"))


def severity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.substring("o_orderpriority", 1, 1).cast("int")
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_orderpriority", level.alias("severity_level"))
        .filter(filters.severe_enough(F.col("severity_level")))
    )


def coords_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_name", F.nullif("c_nationkey", F.lit(0)).alias("lat"), F.col("c_acctbal").alias("lon"))
        .filter(filters.complete_coords(F.col("c_name"), F.col("lat"), F.col("lon")))
    )


def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of two years, and with an open end those of the last year on."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    closed = filters.in_dates(F.col("day"), "1996-03-01", "1998-02-28")
    open_end = filters.in_dates(F.col("day"), "2001-01-01")
    return orders.filter(closed | open_end).withColumn("window", F.when(closed, "closed").otherwise("open"))


def year_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in yearly units; every seventh order stands in the unit of the year after its own and is dropped."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    year = F.year("day") + F.when(F.col("o_orderkey") % 7 == 0, 1).otherwise(0)
    return orders.filter(filters.in_year(F.col("day"), year)).select(
        "o_orderkey",
        "day",
        year.alias("year"),
        scalars.year_start(year).alias("year_start"),
        scalars.year_end(year).alias("year_end"),
        checks.routable(F.col("day"), 1996, 2000).alias("routable"),
    )


def const_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the scans add to a row that does not say it: the constants of live readings and of levels."""
    label, *coords = scalars.text_constants(landed.READING_CONSTANTS)
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", label, *[column.cast("double") for column in coords], backfill.level_source().alias("source")
    ).withColumnRenamed("station_label", "label")


def default_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags with the scans' default where there is none; a flag that is there and null stays null."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("toxic"), (F.col("doc_id") % 5 == 0).alias("blank"))
    given = F.when(~F.col("blank"), F.col("toxic"))
    flag = scalars.default_for_absent(given, F.lit(False), F.coalesce("blank", F.lit(False)))
    return documents.join(labels, "doc_id", "left").select("doc_id", "source", flag.alias("is_toxic"))


def zip_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel arrays of a vector; vectors whose second array is too short are dropped whole."""
    axis = F.transform("embedding", lambda _, n: n)
    kept = F.filter("embedding", lambda x: x > F.lit(-0.3).cast("float"))
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        axis.alias("axis"),
        F.col("embedding").cast("array<double>").alias("value"),
        F.transform(kept, lambda x: x.cast("double") * 2).alias("doubled"),
        F.lit(None).cast("array<double>").alias("absent"),
    )
    series = {name: F.col(name) for name in ("value", "doubled", "absent")}
    covered = [arrays.covers(column, F.col("axis")) for column in series.values()]
    valid = vectors.filter(covered[0] & covered[1] & covered[2])
    return valid.select("vec_id", F.inline(arrays.zipped(F.col("axis"), "pos", series)))


def first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First word of twelve letters or more, where it stands, and whether there is one."""
    words = F.split("text", " ")
    found = table(spark, sf_dir, "documents").select(
        "doc_id", words.alias("words"), arrays.first_match(words, lambda w: F.length(w) >= 12).alias("first_long_word")
    )
    return found.select(
        "doc_id",
        "first_long_word",
        (F.array_position("words", F.col("first_long_word")) - 1).cast("int").alias("first_long_pos"),
        F.col("first_long_word").isNotNull().alias("has_match"),
    )


def array_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First line after the opening line; NULL for one-line documents."""
    lines = F.split("text", "\n")
    rest = F.slice(lines, F.lit(2), F.size(lines))
    return table(spark, sf_dir, "documents").select("doc_id", arrays.head(rest).alias("second_line"))


def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.from_json("props", "k string")
    return table(spark, sf_dir, "events").select("event_id", scalars.as_integer(scalars.number(fields["k"])).alias("k"))


def extract_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = scalars.text_between(F.col("url"), "//", "/", ".example")
    return table(spark, sf_dir, "pages").select("page_id", ref.alias("ref")).filter("ref != ''")


def to_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    price = scalars.number(F.col("l_extendedprice").cast("string"))
    return lines.select(*LINE_KEY, "l_partkey", "l_shipdate", scalars.as_decimal(price, 12, 1).cast("string").alias("price"))


def to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        scalars.as_integer(F.col("value")).alias("rounded"),
        scalars.as_integer(-F.col("value")).alias("rounded_negative"),
        scalars.as_integer(F.round(F.col("value")) + 0.5).alias("half_up"),
    )


def page_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in pages of 500 by key."""
    return ordered.with_position(
        table(spark, sf_dir, "part").select("p_partkey"), "p_partkey", ordered.chunk_of("p_partkey"), "pos"
    ).select("p_partkey", "pos", paging.page_of(F.col("pos")).alias("page"))


def catalogue_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts landed as catalogue pages of 500 (every third page two entries short), then scanned.

    The landed pages stay in the shared folder, since the returned frame reads them.
    """
    scratch = Scratch(spark, "catalogue-pages")
    parts = ordered.with_position(
        table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice"),
        "p_partkey",
        ordered.chunk_of("p_partkey"),
        "pos",
    )
    block, place = paging.page_of(F.col("pos"), 1498), F.col("pos") % 1498
    entry = F.struct(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("stationReference"),
        F.col("p_name").alias("label"),
        F.col("p_size").alias("lat"),
        F.col("p_retailprice").cast("string").alias("long"),
        F.col("p_type").alias("catchmentName"),
        F.array(
            F.lit("text"),
            F.to_json(
                F.struct(
                    F.lit("level").alias("parameter"),
                    F.lit(86400).alias("period"),
                    F.concat(F.lit("m"), F.col("p_size").cast("string")).alias("@id"),
                )
            ),
        ).alias("measures"),
    )
    # 500, 498 and 500 entries: the middle page of each three is short.
    page = block * 3 + F.when(place < 500, 0).when(place < 998, 1).otherwise(2)
    pages = parts.select(page.cast("int").alias("page"), "pos", entry.alias("item"))
    bodies = pages.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("pos", "item"))).alias("rows"))
    bodies.select("page", F.col("rows.item").alias("items")).write.partitionBy("page").json(
        f"{scratch.path('landing')}/catalogue"
    )
    return landed.catalogue(spark, scratch.path("landing"))


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = table(spark, sf_dir, "orders").filter("o_totalprice > 100000")
    return checks.orphans(table(spark, sf_dir, "lineitem"), "l_orderkey", parents, "o_orderkey")


def unique_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicates(table(spark, sf_dir, "lineitem"), LINE_KEY)


def _level_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line as a landed level document of its (supplier, ship year) unit."""
    item = F.struct(
        F.col("l_shipdate").cast("date").cast("string").alias("date"),
        F.col("l_extendedprice").cast("string").alias("value"),
        F.when(F.col("l_returnflag") == "N", "Good").otherwise("Suspect").alias("quality"),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("station_ref"),
        F.year("l_shipdate").alias("year"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("page"),
        F.array(item).alias("items"),
        F.lit(None).cast("string").alias(CORRUPT),
    )


def level_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of every unit: years without a partition and prices too wide for the column fail it."""
    return backfill.unit_outcomes(backfill.parse_levels(_level_documents(spark, sf_dir)))


def failed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why units fail, and where: the first bad value of each, as the quarantine keeps it."""
    reasons = backfill.unit_reasons(backfill.parse_levels(_level_documents(spark, sf_dir)))
    return reasons.select("station_ref", "year", "first_bad.page.l_orderkey", "first_bad.page.l_linenumber", "first_bad.reason")


def level_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the level backfill would write for those documents.

    As in the job, parsed rows are written once; they stay in the shared folder, since
    the returned frame reads them.
    """
    parsed = Scratch(spark, "level-backfill").keep(backfill.parse_levels(_level_documents(spark, sf_dir)), "parsed")
    rows = backfill.accepted_rows(parsed, backfill.unit_outcomes(parsed))
    added = merge.insert_ignore(rows, ["station_ref", "date"], ["page", "value_m"], null_keys=False)
    return added.select("station_ref", "date", F.col("value_m").cast("string").alias("value_m"), "quality", "source")


def weather_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the weather backfill would write for vectors read as daily series, parsed once."""

    def texts(value: Callable[[Column], Column]) -> Column:
        whole = lambda x: F.round(x.cast("double") * 1000).cast("int")
        return F.transform("embedding", lambda x: value(whole(x)).cast("string"))

    series = {
        "time": F.transform("embedding", lambda _, n: F.date_add(F.lit("2020-01-01").cast("date"), n).cast("string")),
        "precipitation_sum": texts(lambda n: F.concat(n, F.lit(".125"))),
        "winddirection_10m_dominant": texts(lambda n: F.concat(n, F.lit(".5"))),
        "temperature_2m_mean": texts(lambda n: n * 3),
    }
    absent = F.lit(None).cast("array<string>")
    daily = F.struct(*[series.get(f.name, absent).alias(f.name) for f in WEATHER_HISTORY_DOC["daily"].dataType.fields])
    documents = table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("V"), F.col("vec_id").cast("string")).alias("station_ref"),
        F.lit(0).alias("year"),
        F.lit(0).alias("page"),
        daily.alias("daily"),
        F.lit(False).alias("null_array"),
        F.lit(None).cast("string").alias(CORRUPT),
    )
    parsed = backfill.parse_weather(documents, "2020-01-10", "2020-02-20")
    parsed = Scratch(spark, "weather-backfill").keep(parsed, "parsed")
    rows = backfill.accepted_rows(parsed, backfill.unit_outcomes(parsed))
    added = merge.insert_ignore(rows, ["station_ref", "date"], ["page", "pos"], null_keys=False)
    return added.select(
        "station_ref",
        "date",
        F.col("precipitation_sum").cast("string").alias("precipitation_sum"),
        "winddirection_dominant",
        F.col("temperature_mean").cast("string").alias("temperature_mean"),
        F.col("windspeed_max").cast("double").alias("windspeed_max"),
    )


def _land_catalogue(scratch: Scratch, stations: DataFrame) -> str:
    """One catalogue page of each 500 stations ``(n, entry)``, numbered from 0."""
    landing = scratch.path("landing")
    pages = stations.groupBy(paging.page_of(F.col("n")).cast("int").alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("n", "entry"))).alias("rows")
    )
    pages.select("page", F.col("rows.entry").alias("items")).write.partitionBy("page").json(f"{landing}/catalogue")
    return landing


def _station(ref: Column, lat: Column, measures: Column) -> Column:
    return F.struct(
        ref.alias("stationReference"),
        ref.alias("label"),
        lat.alias("lat"),
        F.lit(-1.5).alias("long"),
        F.lit("c").alias("catchmentName"),
        measures.alias("measures"),
    )


def _land_stations(spark: SparkSession, sf_dir: str, scratch: Scratch) -> str:
    """A catalogue of all suppliers. Every tenth has no daily measure."""
    ref = F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))
    measure = F.array(F.lit("7"), F.lit('{"parameter": "level", "period": 86400, "@id": "m"}'))
    measures = F.when(F.col("s_suppkey") % 10 == 0, F.array().cast("array<string>")).otherwise(measure)
    return _land_catalogue(
        scratch,
        table(spark, sf_dir, "supplier").select(
            (F.col("s_suppkey") - 1).alias("n"), _station(ref, F.lit(51.5), measures).alias("entry")
        ),
    )


def _land_levels(lines: DataFrame, landing: str) -> None:
    """Lines as readings of their suppliers, in bodies by year; seventh lines land in the year after their own."""
    item = F.struct(
        F.col("l_shipdate").cast("date").cast("string").alias("date"),
        F.col("l_extendedprice").alias("value"),
        F.when(F.col("l_returnflag") == "N", "Good").otherwise("Suspect").alias("quality"),
    )
    rows = lines.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("station_ref"),
        (F.year("l_shipdate") + F.when(F.col("l_linenumber") == 7, 1).otherwise(0)).alias("year"),
        # Bodies of a unit are cut by order, so that a hot supplier's fit in a task.
        F.call_function("div", F.col("l_orderkey"), F.lit(500)).cast("int").alias("page"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", item.alias("item")).alias("row"),
    )
    bodies = rows.groupBy("station_ref", "year", "page").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    bodies.select(
        "station_ref", "year", "page", F.to_json(F.struct(F.col("rows.item").alias("items"))).alias("body"),
        station_bucket(F.col("station_ref")).alias(BUCKET),
    ).write.mode("append").partitionBy("year", BUCKET).parquet(f"{landing}/daily_level_bodies")


def _backfilled(spark: SparkSession, scratch: Scratch, landing: str, **more) -> tuple[backfill.BackfillResult, DataFrame]:
    store = TableStore(spark, scratch.path("tables"))
    run = backfill.backfill_rivers(
        spark, landing, store, scratch.path("ledger"), scratch.path("catalogue"), FIRST_YEAR, LAST_YEAR, **more
    )
    return run, store.read(RIVER_LEVELS).withColumn("year", F.year("date"))


def landed_rivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels after a backfill of all lines landed as bodies, with the outcome of each unit.

    The tables stay in the shared folder, since the returned frame reads them.
    """
    scratch = Scratch(spark, "landed-rivers")
    landing = _land_stations(spark, sf_dir, scratch)
    _land_levels(table(spark, sf_dir, "lineitem"), landing)
    run, levels = _backfilled(spark, scratch, landing)
    joined = run.units.join(levels, backfill.UNIT, "left")
    return joined.select(
        "station_ref", "year", "status", "n_rows", "n_inserted", "date",
        F.col("value_m").cast("string").alias("value_m"), "quality", "source",
    )


def river_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of a second backfill, with the ledger reset, after the other half of the suppliers landed.

    The first run's catalogue is read again, although the landed one is gone by then, and rows
    of its units are not inserted twice.
    """
    scratch = Scratch(spark, "river-rerun")
    landing = _land_stations(spark, sf_dir, scratch)
    lines = table(spark, sf_dir, "lineitem")
    _land_levels(lines.filter("l_suppkey % 2 = 0"), landing)
    _backfilled(spark, scratch, landing)
    files.remove(spark, f"{landing}/catalogue")
    _land_levels(lines.filter("l_suppkey % 2 = 1"), landing)
    run, _ = _backfilled(spark, scratch, landing, reset=True)
    return run.units.select("station_ref", "year", "status", "n_rows", "n_inserted")


def landed_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather after a backfill of all vectors landed as bodies, by station bucket.

    Every seventh vector's second array is one day short and every thirteenth has an array
    that is null, which fails their units; every eleventh station has no latitude and is not
    a unit. The tables stay in the shared folder.
    """
    scratch = Scratch(spark, "landed-weather")
    vectors = table(spark, sf_dir, "embeddings")
    ref = F.concat(F.lit("V"), F.col("vec_id").cast("string"))
    lat = F.when(F.col("vec_id") % 11 != 0, F.lit(51.5))
    landing = _land_catalogue(
        scratch, vectors.select(F.col("vec_id").alias("n"), _station(ref, lat, F.array()).alias("entry"))
    )
    thousandths = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("int"))
    short = F.slice("whole", F.lit(1), F.size("whole") - F.when(F.col("vec_id") % 7 == 0, 1).otherwise(0))
    day = lambda _, n: F.date_add(F.lit("2020-01-01").cast("date"), n).cast("string")
    daily = F.struct(
        F.transform("embedding", day).alias("time"),
        F.transform("whole", lambda n: n / 100).alias("precipitation_sum"),
        F.transform(short, lambda n: n + F.lit(0.5)).alias("winddirection_10m_dominant"),
    )
    whole = vectors.select("vec_id", "embedding", ref.alias("station_ref"), thousandths.alias("whole"))
    body = F.to_json(F.struct(daily.alias("daily")))
    nulled = F.replace(body, F.lit('{"daily":{'), F.lit('{"daily":{"shortwave_radiation_sum": null,'))
    bodies = whole.select(
        "station_ref", F.lit(0).alias("page"), F.when(F.col("vec_id") % 13 == 0, nulled).otherwise(body).alias("body"),
        station_bucket(F.col("station_ref")).alias(BUCKET),
    )
    bodies.write.partitionBy(BUCKET).parquet(f"{landing}/weather_history_bodies")
    store = TableStore(spark, scratch.path("tables"))
    backfill.backfill_weather(
        spark, landing, store, scratch.path("ledger"), scratch.path("catalogue"), "2020-01-10", "2020-02-20"
    )
    return store.read(WEATHER_HISTORY).select(
        "station_ref",
        "date",
        F.col("precipitation_sum").cast("string").alias("precipitation_sum"),
        "winddirection_dominant",
        F.col("windspeed_max").cast("double").alias("windspeed_max"),
    )


def _land_bodies(landing: str, source: str, bodies: DataFrame) -> None:
    """Documents ``(poll, area, page, body)`` as rows of their poll."""
    rows = bodies.select("poll", F.lit(source).alias("source"), "area", "page", "body")
    rows.write.mode("append").partitionBy("poll").parquet(f"{landing}/poll_bodies")


def _paged(entries: DataFrame) -> DataFrame:
    """Entries ``(poll, n, entry)`` as bodies of 500 each. A flag of "null" becomes an explicit null."""
    cut = entries.groupBy("poll", paging.page_of(F.col("n")).cast("int").alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("n", "entry"))).alias("rows")
    )
    body = F.to_json(F.struct(F.col("rows.entry").alias("items")))
    explicit = F.replace(body, F.lit('"isTidal":"null"'), F.lit('"isTidal": null'))
    return cut.select("poll", F.lit(None).cast("string").alias("area"), "page", explicit.alias("body"))


def _warning() -> Column:
    """An event as a landed warning of its user's area; user 0 has none."""
    return F.struct(
        F.concat(F.lit("A"), F.nullif("user_id", F.lit(0)).cast("string")).alias("floodAreaID"),
        F.col("event_id").cast("string").alias("description"),
        F.struct(F.lit("C").alias("county"), F.lit("R").alias("riverOrSea")).alias("floodArea"),
        # Levels of more than 3 are not polled.
        (F.length("event_type") - 4).alias("severityLevel"),
        F.col("event_type").alias("severity"),
        F.when(F.col("event_id") % 3 == 0, "true").when(F.col("event_id") % 5 == 1, "null").alias("isTidal"),
        F.floor(F.col("value") / 25).cast("string").alias("message"),
        F.lit("2024-01-01T09:30:00+02:00").alias("timeRaised"),
        _noted().alias("timeSeverityChanged"),
    )


def _event_columns(*more: str) -> list[str | Column]:
    return [
        "flood_area_id", "description", "county", "severity_level", "severity_label", "is_tidal", "message",
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("string").alias("lon"),
        F.col("time_raised").cast("string").alias("time_raised"),
        F.col("time_severity_changed").cast("string").alias("changed_at"),
        F.col("polled_at").cast("string").alias("polled_at"),
        *more,
    ]


def _polled_tables(spark: SparkSession, sf_dir: str, scratch: Scratch, cut_off: bool = False) -> DataFrame:
    """Flood events, with their weather snapshots, after one poll of all events landed as bodies of 500.

    With ``cut_off`` the poll loses its events, which it writes last, and is run again.
    """
    landing, one = scratch.path("landing"), F.lit("p1").alias("poll")
    events = table(spark, sf_dir, "events")
    customer = table(spark, sf_dir, "customer")
    area = F.concat(F.lit("A"), F.col("c_custkey").cast("string"))
    place = F.struct(area.alias("notation"), F.col("c_nationkey").alias("lat"), (F.col("c_acctbal") / 100).alias("long"))
    _land_bodies(landing, "areas", _paged(customer.select(one, F.col("c_custkey").alias("n"), place.alias("entry"))))
    _land_bodies(landing, "warnings", _paged(events.select(one, F.col("event_id").alias("n"), _warning().alias("entry"))))
    current = F.struct(
        F.col("c_nationkey").alias("temperature"),
        (F.col("c_nationkey") + 0.5).alias("winddirection"),
        (F.col("c_nationkey") * 2).alias("weathercode"),
    )
    hourly = F.struct(F.array(F.lit(0.25), F.lit(9.0)).alias("precipitation"))
    body = F.to_json(F.struct(current.alias("current_weather"), hourly.alias("hourly"))).alias("body")
    weather = events.select(F.col("user_id").alias("c_custkey")).distinct().join(customer, "c_custkey").filter("c_acctbal > 0")
    _land_bodies(landing, "weather", weather.select(one, area.alias("area"), F.lit(0).alias("page"), body))
    store = TableStore(spark, scratch.path("tables"))
    for again in range(2 if cut_off else 1):
        if again:
            files.remove(spark, store.path(FLOOD_EVENTS))
        poll.poll_once(spark, landing, store, "p1", datetime.datetime(2024, 1, 1, 10, 25))
    snapshots = store.read(WEATHER_SNAPSHOTS).select(
        F.col("flood_event_id").alias("id"), "temperature_c", "precipitation_mm", "wind_direction_deg", "weather_code"
    )
    return store.read(FLOOD_EVENTS).join(snapshots, "id", "left").select(
        *_event_columns(),
        F.col("temperature_c").cast("double").alias("temperature_c"),
        F.col("precipitation_mm").cast("double").alias("precipitation_mm"),
        "wind_direction_deg", "weather_code",
    )


def landed_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables after that poll. They stay in the shared folder, since the returned frame reads them."""
    return _polled_tables(spark, sf_dir, Scratch(spark, "landed-poll"))


def poll_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after a run that was cut off before its events were in place, and a second run."""
    return _polled_tables(spark, sf_dir, Scratch(spark, "poll-repair"), cut_off=True)


def landed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station readings after one poll of all events as readings of users: the first of each station and day."""
    scratch = Scratch(spark, "landed-readings")
    landing = scratch.path("landing")
    day = F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    station = F.concat(F.lit("http://x/data/readings/U"), F.col("user_id").cast("string"), F.lit("-level-i-15_min/1"))
    reading = F.struct(station.alias("@id"), F.col("value"), day.alias("dateTime"))
    events = table(spark, sf_dir, "events")
    _land_bodies(landing, "readings", _paged(events.select(F.lit("p1").alias("poll"), F.col("event_id").alias("n"), reading.alias("entry"))))
    store = TableStore(spark, scratch.path("tables"))
    poll.poll_once(spark, landing, store, "p1", datetime.datetime(2024, 1, 1, 10, 25))
    return store.read(STATION_READINGS).select(
        "station_ref",
        "station_label",
        F.col("lat").cast("double").alias("lat"),
        F.col("value_m").cast("string").alias("value_m"),
        F.col("reading_at").cast("string").alias("reading_at"),
        F.col("polled_at").isNotNull().alias("has_polled_at"),
    )


def poll_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flood events after a stream found a backlog of 100 polls, three in an hour, and ran them as one batch.

    Event n is the (n div 100)th warning of poll n mod 100.
    """
    scratch = Scratch(spark, "poll-backlog")
    landing = scratch.path("landing")
    number = F.col("event_id") % BACKLOG
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("p"), number.cast("string")).alias("poll"),
        F.call_function("div", F.col("event_id"), F.lit(BACKLOG)).alias("n"),
        _warning().alias("entry"),
    )
    _land_bodies(landing, "warnings", _paged(events))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    at = F.date_format(start + F.make_dt_interval(mins=F.col("id").cast("int") * 20), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    announced = spark.range(0, BACKLOG, 1, 1).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("poll"), at.alias("polled_at"))
    announced.write.option("maxRecordsPerFile", 1).json(f"{landing}/polls")
    store = TableStore(spark, scratch.path("tables"))
    stream_polls(spark, landing, store, scratch.path("checkpoint"), BACKLOG).awaitTermination()
    return store.read(FLOOD_EVENTS).select(*_event_columns())


def _polled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """All events as the warnings of one poll: (events after it, area coordinates, area weather, runs)."""
    customer = table(spark, sf_dir, "customer")
    area = F.concat(F.lit("A"), F.col("c_custkey").cast("string"))
    one = F.lit("p1").alias("poll")
    coords = customer.select(
        one, area.alias("notation"), F.col("c_nationkey").cast("double").alias("lat"), (F.col("c_acctbal") / 100).alias("lon")
    )
    weather = customer.filter("c_acctbal > 0").select(
        one,
        area.alias("area"),
        F.lit(0).alias("page"),
        F.lit("body.json").alias("document"),
        F.concat(F.col("c_nationkey"), F.lit(".125")).alias("temperature_c"),
        F.concat(F.col("c_nationkey"), F.lit(".5")).alias("wind_direction_deg"),
        *[F.lit(None).cast("string").alias(c) for c in ("precipitation_mm", "wind_speed_kmh", "weather_code", "humidity_pct")],
    )
    warnings = table(spark, sf_dir, "events").select(
        one,
        paging.page_of(F.col("event_id")).alias("page"),
        F.col("event_id").alias("pos"),
        F.concat(F.lit("A"), F.nullif("user_id", F.lit(0)).cast("string")).alias("flood_area_id"),
        F.col("event_id").cast("string").alias("description"),
        F.lit("C").alias("county"),
        F.lit(None).cast("string").alias("river_or_sea"),
        F.length("event_type").cast("string").alias("severity_level"),
        F.col("event_type").alias("severity_label"),
        F.lit("false").alias("is_tidal"),
        F.nullif(F.floor(F.col("value") / 25).cast("string"), F.lit("0")).alias("message"),
        F.lit(None).cast("string").alias("time_raised"),
        _noted().alias("time_severity_changed"),
    )
    runs = spark.range(1).select(one, F.lit(0).alias("step"), F.lit("2024-01-01 10:00:00").cast("timestamp").alias("polled_at"))
    batch = poll.event_batch(warnings, coords, runs).drop("reason")
    return poll.event_steps(batch, None, batch), coords, weather, runs


def poll_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flood events after one poll of all events; user 0 has no area and never conflicts."""
    steps, *_ = _polled(spark, sf_dir)
    return steps.filter("is_last").select(
        "flood_area_id",
        "description",
        "severity_level",
        "severity_label",
        "message",
        F.col("lat").cast("double").alias("lat"),
        F.col("time_severity_changed").cast("string").alias("noted_at"),
        *merge.ACTIONS,
    )


def poll_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather snapshots of that poll, with the area of the event they link to."""
    steps, coords, weather, runs = _polled(spark, sf_dir)
    attempts = poll.snapshot_attempts(steps, coords, runs)
    areas = attempts.select(F.col("id").alias("flood_event_id"), "flood_area_id")
    snapshots = poll.snapshot_rows(attempts, weather)
    return snapshots.join(areas, "flood_event_id").select(
        "flood_area_id", F.col("temperature_c").cast("string").alias("temperature_c"), "wind_direction_deg", "humidity_pct"
    )


def poll_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two available-now runs over ``events``: the earlier polls, then the later ones.

    The table stays in the shared folder, since the returned frame reads it.
    """
    scratch = Scratch(spark, "poll-stream")
    store = TableStore(spark, scratch.path("tables"))
    schema = table(spark, sf_dir, "events").schema
    for name, part in (("earlier", _earlier()), ("later", ~_earlier())):
        # The bracket makes the path a glob, which a stream accepts for a file and a folder alike.
        source = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]").filter(part)
        stream_upserts(
            source,
            _warnings,
            EVENT_RULE,
            ["event_id"],
            F.col("event_id"),
            store,
            EVENT_STATE,
            scratch.path(f"checkpoint-{name}"),
            row_id="created_by",
        ).awaitTermination()
    return store.read(EVENT_STATE)


def hourly_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the merged hourly state with the nation of its customer."""
    state = guarded_upsert(spark, sf_dir)
    customer = table(spark, sf_dir, "customer")
    return left_lookup(state, customer, {"user_id": "c_custkey"}, ["c_nationkey", "c_mktsegment"])


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "insert_ignore_batch": insert_ignore_batch,
    "insert_ignore_existing": insert_ignore_existing,
    "null_keys": null_keys,
    "guarded_upsert": guarded_upsert,
    "upsert_actions": upsert_actions,
    "distinct_from": distinct_from,
    "hour_bucket": hour_bucket,
    "last_wins": last_wins,
    "first_entry": first_entry,
    "latest_per_key": latest_per_key,
    "left_lookup": left_lookup_query,
    "snapshot_enrich": snapshot_enrich,
    "pending_units": pending_units,
    "ledger_parse": ledger_parse,
    "ledger_append": ledger_append,
    "unit_status": unit_status,
    "run_summary": run_summary,
    "quality_filter": quality_filter,
    "quality_lines": quality_lines,
    "severity_filter": severity_filter,
    "coords_filter": coords_filter,
    "date_range": date_range,
    "year_units": year_units,
    "const_columns": const_columns,
    "default_missing": default_missing,
    "zip_explode": zip_explode,
    "first_match": first_match,
    "array_head": array_head,
    "json_field": json_field,
    "extract_ref": extract_ref,
    "to_decimal": to_decimal,
    "to_int": to_int,
    "page_cap": page_cap,
    "catalogue_pages": catalogue_pages,
    "fk_orphans": fk_orphans,
    "unique_audit": unique_audit,
    "level_units": level_units,
    "failed_units": failed_units,
    "level_backfill": level_backfill,
    "weather_backfill": weather_backfill,
    "landed_rivers": landed_rivers,
    "river_rerun": river_rerun,
    "landed_weather": landed_weather,
    "landed_poll": landed_poll,
    "landed_readings": landed_readings,
    "poll_repair": poll_repair,
    "poll_backlog": poll_backlog,
    "poll_events": poll_events,
    "poll_snapshots": poll_snapshots,
    "poll_stream": poll_stream,
    "hourly_state": hourly_state,
}
