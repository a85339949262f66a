"""Scans of landed response bodies.

Layout below a landing folder:

    polls/<any>.json                                   one {"poll", "polled_at"} each
    poll_bodies/poll=<p>/*.parquet                     source, area, page, body
    areas | warnings | readings / poll=<p>/page=<n>.json      or poll=<p>/page=<n>/<any>.json
    weather/poll=<p>/area=<id>/body.json
    catalogue/page=<n>.json                            or catalogue/page=<n>/<any>.json
    daily_levels/station_ref=<ref>/year=<y>/body.json
    weather_history/station_ref=<ref>/body.json

Bodies of polls and of history land as files or as rows of Parquet files. Rows are the layout
for many areas or units: listing and tasks follow bytes, and a body is a row whatever it says.

    daily_level_bodies/year=<y>[/bucket=<b>]/*.parquet        station_ref, page, body
    weather_history_bodies[/bucket=<b>]/*.parquet             station_ref, page, body

The bucket is ``tables.station_bucket`` of the station; with such folders, a resume reads the
buckets of pending stations alone.

A unit may have bodies in either layout. A malformed body still knows its unit there,
and finished years are pruned by folder without listing a file per unit.

Arrival order is (page, pos). A missing folder, a body without its envelope and an
empty one give no rows. Folder values are read as text to keep leading zeros.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirframe.fixed import DAILY_PARAMETER, DAILY_PERIOD
from weirframe.functions import arrays
from weirframe.functions.scalars import default_for_absent, number, station_ref, text_constants
from weirframe.operators.filters import severe_enough
from weirframe.operators.paging import require_complete
from weirframe.sources import files, schemas

PAGE_NUMBER = r"page=([0-9]+)"
#: What live readings do not say.
READING_CONSTANTS = {"station_label": "", "lat": None, "lon": None}


def read_documents(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    folders: dict[str, T.DataType] | None = None,
    below: str = "",
) -> DataFrame:
    """One row per document, with its folder values, page number (0 if unnamed) and file name.

    ``below`` narrows the scan to part of the tree. Malformed text is kept in the
    corrupt-record column.
    """
    folders = folders or {}
    full = T.StructType(
        [
            *schema.fields,
            T.StructField(schemas.CORRUPT, T.StringType()),
            *[T.StructField(name, kind) for name, kind in folders.items()],
        ]
    )
    path = f"{root}/{below}" if below else root
    if not files.exists(spark, path):
        fields = [field for field in full.fields if field.name != "page"]
        found = [T.StructField("page", T.IntegerType()), T.StructField("document", T.StringType())]
        return spark.createDataFrame([], T.StructType([*fields, *found]))
    documents = (
        spark.read.schema(full)
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", False)
        .option("basePath", root)
        .json(path)
    )
    page = F.regexp_extract("_metadata.file_name", PAGE_NUMBER, 1).try_cast("int")
    if "page" in folders:
        page = F.coalesce("page", page)
    return documents.withColumns({"page": F.coalesce(page, F.lit(0)), "document": F.col("_metadata.file_name")})


def _has_buckets(spark: SparkSession, path: str, by_year: bool) -> bool:
    names = files.child_names(spark, path)
    if by_year:
        years = [name for name in names if name.startswith("year=")]
        names = files.child_names(spark, f"{path}/{years[0]}") if years else []
    return any(name.startswith(f"{schemas.BUCKET}=") for name in names)


def history_bodies(
    spark: SparkSession, landing: str, source: str, rows: str, by_year: bool, buckets: list[int] | None
) -> DataFrame:
    """Bodies of one history source in both layouts: ``station_ref``, ``year`` if any, ``page, document, body``."""
    year = "year int" if by_year else ""
    keys = ["station_ref", *(["year"] if by_year else [])]
    found = [spark.createDataFrame([], ", ".join(filter(None, ["station_ref string", year, "page int, document string, body string"])))]
    if files.exists(spark, f"{landing}/{rows}"):
        bucketed = _has_buckets(spark, f"{landing}/{rows}", by_year)
        folders = [*([year] if by_year else []), *([f"{schemas.BUCKET} int"] if bucketed else [])]
        read = spark.read.schema(", ".join(["station_ref string, page int, body string", *folders])).parquet(f"{landing}/{rows}")
        if bucketed and buckets is not None:
            read = read.filter(F.col(schemas.BUCKET).isin(buckets))
        found.append(read.select(*keys, "page", F.col("_metadata.file_name").alias("document"), "body"))
    if files.exists(spark, f"{landing}/{source}"):
        schema = ", ".join(filter(None, ["value string, station_ref string", year]))
        read = spark.read.schema(schema).option("wholetext", True).option("pathGlobFilter", "*.json").text(f"{landing}/{source}")
        page = F.coalesce(F.regexp_extract("_metadata.file_name", PAGE_NUMBER, 1).try_cast("int"), F.lit(0))
        found.append(read.select(*keys, page.alias("page"), F.col("_metadata.file_name").alias("document"), F.col("value").alias("body")))
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole


def parse_bodies(bodies: DataFrame, schema: T.StructType, *more: Column) -> DataFrame:
    """Bodies with the fields of their document; malformed text stands in the corrupt-record column."""
    full = T.StructType([*schema.fields, T.StructField(schemas.CORRUPT, T.StringType())])
    parsed = F.from_json("body", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT})
    kept = [name for name in bodies.columns if name != "body"]
    return bodies.withColumn("parsed", parsed).select("parsed.*", *kept, *more)


def has_null_array(body: Column) -> Column:
    """Whether a daily array is there and null, which a typed read takes for an absent one."""
    names = ["time", *schemas.WEATHER_VARIABLES]
    # Most bodies have nulls only inside arrays and need no second parse.
    likely = body.rlike(rf'"(?:{"|".join(names)})"\s*:\s*null')
    variant = F.when(likely, F.try_parse_json(body))
    found = F.lit(False)
    for name in schemas.WEATHER_VARIABLES:
        found = found | F.coalesce(F.is_variant_null(F.try_variant_get(variant, f"$.daily.{name}", "variant")), F.lit(False))
    return found


def items(documents: DataFrame, *keep: str) -> DataFrame:
    """Array of objects -> rows, with the position inside the document."""
    return documents.select(*keep, "page", F.posexplode("items").alias("pos", "item")).select(
        *keep, "page", "pos", "item.*"
    )


LIVE_SCHEMAS = {
    "areas": schemas.AREAS_DOC,
    "warnings": schemas.WARNINGS_DOC,
    "readings": schemas.READINGS_DOC,
    "weather": schemas.CURRENT_WEATHER_DOC,
}
LIVE_ROWS = "poll string, source string, area string, page int, document string, body string"


def live_bodies(spark: SparkSession, landing: str, polls: list[str]) -> DataFrame:
    """Bodies of some polls as rows (``LIVE_ROWS``), in either layout. Only these polls' folders are listed."""
    found = [spark.createDataFrame([], LIVE_ROWS)]
    rows = [f"{landing}/poll_bodies/poll={poll}" for poll in polls]
    rows = [path for path in rows if files.exists(spark, path)]
    if rows:
        landed = spark.read.schema("source string, area string, page int, body string, poll string")
        read = landed.option("basePath", f"{landing}/poll_bodies").parquet(*rows)
        found.append(read.select("poll", "source", "area", "page", F.col("_metadata.file_name").alias("document"), "body"))
    for source in LIVE_SCHEMAS:
        paths = [f"{landing}/{source}/poll={poll}" for poll in polls]
        paths = [path for path in paths if files.exists(spark, path)]
        if not paths:
            continue
        folders = "poll string, area string" if source == "weather" else "poll string"
        read = (
            spark.read.schema(f"value string, {folders}")
            .option("wholetext", True)
            .option("pathGlobFilter", "*.json")
            .option("basePath", f"{landing}/{source}")
            .text(paths)
        )
        # The page is in the name of a folder or of the file.
        page = F.regexp_extract("_metadata.file_path", f".*{PAGE_NUMBER}", 1).try_cast("int")
        area = F.col("area") if source == "weather" else F.lit(None).cast("string")
        found.append(
            read.select("poll", F.lit(source).alias("source"), area.alias("area"), page.alias("page"), F.col("_metadata.file_name").alias("document"), F.col("value").alias("body"))
        )
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole.withColumn("page", F.coalesce("page", F.lit(0)))


def live_documents(bodies: DataFrame) -> DataFrame:
    """Every body parsed once, by its source's shape: a column for each source, null in the rows of others.

    ``malformed`` marks bodies that are no valid JSON. ``tidal_null`` tells, by position, which
    warnings have an explicit null as tidal flag, which a typed read takes for an absent one.
    """
    parsed, broken = [], F.lit(False)
    for source, schema in LIVE_SCHEMAS.items():
        full = T.StructType([*schema.fields, T.StructField(schemas.CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
        parsed.append(F.when(F.col("source") == source, F.from_json("body", full, options)).alias(source))
        document = F.col(source)
        broken = broken | F.coalesce(document[schemas.CORRUPT].isNotNull() & document[schema[0].name].isNull(), F.lit(False))
    # Bodies without the word need no second parse.
    variant = F.when((F.col("source") == "warnings") & F.contains("body", F.lit("null")), F.try_parse_json("body"))
    items = F.try_variant_get(variant, "$.items", "array<variant>")
    flags = F.transform(items, lambda item: F.coalesce(F.is_variant_null(F.try_variant_get(item, "$.isTidal", "variant")), F.lit(False)))
    kept = bodies.select("poll", "source", "area", "page", "document", flags.alias("tidal_null"), *parsed)
    return kept.withColumn("malformed", broken)


def _live_items(documents: DataFrame, source: str, *keep: str) -> DataFrame:
    one = documents.filter(F.col("source") == source)
    return one.select("poll", "page", *keep, F.posexplode(f"{source}.items").alias("pos", "item")).select(
        "poll", "page", "pos", *keep, "item.*"
    )


def areas(documents: DataFrame) -> DataFrame:
    return _live_items(documents, "areas").select(
        "poll", "page", "pos", "notation", number(F.col("lat")).alias("lat"), number(F.col("long")).alias("lon")
    )


def warnings(documents: DataFrame) -> DataFrame:
    """Flattened and renamed to the column names of the flood event table.

    Levels beyond the polled severity are dropped, as the request would have done.
    """
    raw = _live_items(documents, "warnings", "tidal_null")
    polled = F.coalesce(severe_enough(number(F.col("severityLevel"))), F.lit(True))
    explicit = F.coalesce(F.get("tidal_null", F.col("pos")), F.lit(False))
    return raw.filter(polled).select(
        "poll",
        "page",
        "pos",
        F.col("floodAreaID").alias("flood_area_id"),
        "description",
        F.col("floodArea.county").alias("county"),
        F.col("floodArea.riverOrSea").alias("river_or_sea"),
        F.col("severityLevel").alias("severity_level"),
        F.col("severity").alias("severity_label"),
        default_for_absent(F.col("isTidal"), F.lit("false"), explicit).alias("is_tidal"),
        "message",
        F.col("timeRaised").alias("time_raised"),
        F.col("timeSeverityChanged").alias("time_severity_changed"),
    )


def readings(documents: DataFrame) -> DataFrame:
    """Readings with a value and an extractable station reference."""
    raw = _live_items(documents, "readings")
    return (
        raw.filter(F.col("value").isNotNull())
        .select(
            "poll",
            "page",
            "pos",
            station_ref(F.col("`@id`")).alias("station_ref"),
            *text_constants(READING_CONSTANTS),
            F.col("value").alias("value_m"),
            F.col("dateTime").alias("reading_at"),
        )
        .filter("station_ref != ''")
    )


def current_weather(documents: DataFrame) -> DataFrame:
    """One row per area: scalars of the current block, first element of the hourly arrays."""
    return documents.filter("source = 'weather'").select(
        "poll",
        "area",
        "page",
        "document",
        F.col("weather.current_weather.temperature").alias("temperature_c"),
        arrays.head(F.col("weather.hourly.precipitation")).alias("precipitation_mm"),
        F.col("weather.current_weather.windspeed").alias("wind_speed_kmh"),
        F.col("weather.current_weather.winddirection").alias("wind_direction_deg"),
        F.col("weather.current_weather.weathercode").alias("weather_code"),
        arrays.head(F.col("weather.hourly.relativehumidity_2m")).alias("humidity_pct"),
    )


def daily_measure_url(measures: Column) -> Column:
    """``@id`` of the first daily level measure; elements that are no objects are skipped."""
    parsed = F.transform(measures, lambda m: F.from_json(m, schemas.MEASURE))
    daily = arrays.first_match(
        parsed,
        lambda m: (m.getField("parameter") == DAILY_PARAMETER) & (m.getField("period") == DAILY_PERIOD),
    )
    return daily.getField("@id")


def catalogue(spark: SparkSession, landing: str) -> DataFrame:
    """Station entries of all landed pages, in order.

    A malformed page or a gap in the page numbers raises, since later jobs would lack
    those stations without a word.
    """
    documents = read_documents(spark, f"{landing}/catalogue", schemas.CATALOGUE_DOC, {"page": T.IntegerType()})
    malformed = F.col(schemas.CORRUPT).isNotNull() & F.col("items").isNull()
    require_complete(documents.select("page", malformed.alias("malformed")), "catalogue")
    return items(documents).select(
        "page",
        "pos",
        F.col("stationReference").alias("station_ref"),
        "label",
        number(F.col("lat")).alias("lat"),
        number(F.col("long")).alias("lon"),
        F.col("catchmentName").alias("catchment"),
        daily_measure_url(F.col("measures")).alias("daily_level_measure_url"),
    )


def saved_catalogue(spark: SparkSession, landing: str, cache: str) -> DataFrame:
    """The saved catalogue, or a scan that is saved first. Only a complete scan with rows is saved."""
    if not files.exists(spark, f"{cache}/_SUCCESS"):
        scanned = catalogue(spark, landing)
        if scanned.isEmpty():
            return scanned
        scanned.write.mode("overwrite").parquet(cache)
    return spark.read.parquet(cache)


def daily_levels(spark: SparkSession, landing: str, buckets: list[int] | None = None) -> DataFrame:
    """Documents of (station_ref, year) units; of the stations in ``buckets`` where the layout tells."""
    bodies = history_bodies(spark, landing, "daily_levels", "daily_level_bodies", True, buckets)
    return parse_bodies(bodies, schemas.DAILY_LEVELS_DOC)


def weather_history(spark: SparkSession, landing: str, buckets: list[int] | None = None) -> DataFrame:
    """Documents of station_ref units: parallel daily arrays, and whether one of them is an explicit null."""
    bodies = history_bodies(spark, landing, "weather_history", "weather_history_bodies", False, buckets)
    return parse_bodies(bodies, schemas.WEATHER_HISTORY_DOC, has_null_array(F.col("body")).alias("null_array"))
