"""Shapes of the landed documents and of the target tables (fixed values).

Leaves of landed documents are read as text, so that a number, a numeric string and
an odd value such as 86400.0 stay apart until the coercion rules see them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT = T.StringType()
CORRUPT = "_corrupt_record"
#: Folder of a station's bucket, and how many there are. Stored data depends on the number.
BUCKET = "bucket"
STATION_BUCKETS = 16


def _text_fields(*names: str) -> list[T.StructField]:
    return [T.StructField(name, TEXT) for name in names]


def _items(element: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("items", T.ArrayType(element))])


AREAS_DOC = _items(T.StructType(_text_fields("notation", "lat", "long")))

WARNINGS_DOC = _items(
    T.StructType(
        [
            *_text_fields("floodAreaID", "description"),
            T.StructField("floodArea", T.StructType(_text_fields("county", "riverOrSea"))),
            *_text_fields("severityLevel", "severity", "isTidal", "message", "timeRaised", "timeSeverityChanged"),
        ]
    )
)

CURRENT_WEATHER_DOC = T.StructType(
    [
        T.StructField(
            "current_weather",
            T.StructType(_text_fields("temperature", "windspeed", "winddirection", "weathercode")),
        ),
        T.StructField(
            "hourly",
            T.StructType(
                [
                    T.StructField("precipitation", T.ArrayType(TEXT)),
                    T.StructField("relativehumidity_2m", T.ArrayType(TEXT)),
                ]
            ),
        ),
    ]
)

READINGS_DOC = _items(T.StructType(_text_fields("@id", "value", "dateTime")))

# Elements of ``measures`` may be non-objects, so each is kept as text.
CATALOGUE_DOC = _items(
    T.StructType(
        [
            *_text_fields("stationReference", "label", "lat", "long", "catchmentName"),
            T.StructField("measures", T.ArrayType(TEXT)),
        ]
    )
)
MEASURE = T.StructType(_text_fields("parameter", "period", "@id"))

DAILY_LEVELS_DOC = _items(T.StructType(_text_fields("date", "value", "quality")))

# Source array -> table column.
WEATHER_VARIABLES = {
    "precipitation_sum": "precipitation_sum",
    "precipitation_hours": "precipitation_hours",
    "windspeed_10m_max": "windspeed_max",
    "winddirection_10m_dominant": "winddirection_dominant",
    "temperature_2m_mean": "temperature_mean",
    "temperature_2m_min": "temperature_min",
    "et0_fao_evapotranspiration": "et0_evapotranspiration",
    "shortwave_radiation_sum": "shortwave_radiation_sum",
}
WEATHER_HISTORY_DOC = T.StructType(
    [
        T.StructField(
            "daily",
            T.StructType([T.StructField(name, T.ArrayType(TEXT)) for name in ("time", *WEATHER_VARIABLES)]),
        )
    ]
)

POLL_DOC = T.StructType(_text_fields("poll", "polled_at"))


@dataclass(frozen=True)
class Table:
    """A target table: columns, unique key, and the partition column derived from it.

    ``bucketed`` tables are split by ``BUCKET`` of the station below each partition.
    ``refers`` names a column, and the table and column in which its values must exist.
    """

    name: str
    columns: T.StructType
    key: tuple[str, ...]
    required: tuple[str, ...]
    partition: str
    partition_type: T.DataType
    partition_source: str
    bucketed: bool = False
    refers: tuple[str, str, str] | None = None

    @property
    def folders(self) -> list[T.StructField]:
        bucket = [T.StructField(BUCKET, T.IntegerType())] if self.bucketed else []
        return [T.StructField(self.partition, self.partition_type), *bucket]

    @property
    def stored(self) -> T.StructType:
        return T.StructType([*self.columns.fields, *self.folders])


def columns_of(text: str) -> T.StructType:
    """``"name kind, ..."`` with JSON type names; needs no running session."""
    schema = T.StructType()
    for column in text.split(", "):
        name, kind = column.split()
        schema.add(name, kind)
    return schema


def _table(
    name: str, columns: str, key: str, required: str, partition: str, partition_type: T.DataType, source: str,
    bucketed: bool = False, refers: tuple[str, str, str] | None = None,
) -> Table:
    return Table(
        name,
        columns_of(columns),
        tuple(key.split()),
        tuple(required.split()),
        partition,
        partition_type,
        source,
        bucketed,
        refers,
    )


RIVER_LEVELS = _table(
    "historical_river_levels",
    "station_ref string, date date, value_m decimal(8,3), quality string, source string",
    "station_ref date",
    "station_ref date source",
    "year",
    T.IntegerType(),
    "date",
    bucketed=True,
)
WEATHER_HISTORY = _table(
    "historical_weather",
    "station_ref string, date date, precipitation_sum decimal(7,2), precipitation_hours decimal(5,1),"
    " windspeed_max decimal(6,2), winddirection_dominant integer, temperature_mean decimal(5,2),"
    " temperature_min decimal(5,2), et0_evapotranspiration decimal(6,2), shortwave_radiation_sum decimal(7,2)",
    "station_ref date",
    "station_ref date",
    "year",
    T.IntegerType(),
    "date",
    bucketed=True,
)
FLOOD_EVENTS = _table(
    "flood_events",
    "id long, flood_area_id string, description string, county string, river_or_sea string,"
    " severity_level integer, severity_label string, is_tidal boolean, lat decimal(9,6), lon decimal(9,6),"
    " message string, time_raised timestamp, time_severity_changed timestamp, polled_at timestamp",
    "flood_area_id polled_at",
    "",
    "polled_hour",
    TEXT,
    "polled_at",
)
WEATHER_SNAPSHOTS = _table(
    "weather_snapshots",
    "id long, flood_event_id long, polled_at timestamp, temperature_c decimal(5,2),"
    " precipitation_mm decimal(6,2), wind_speed_kmh decimal(6,2), wind_direction_deg integer,"
    " weather_code integer, humidity_pct integer",
    "flood_event_id polled_at",
    "",
    "polled_date",
    T.DateType(),
    "polled_at",
    refers=("flood_event_id", "flood_events", "id"),
)
STATION_READINGS = _table(
    "station_readings",
    "id long, station_ref string, station_label string, lat decimal(9,6), lon decimal(9,6),"
    " value_m decimal(8,3), reading_at timestamp, polled_at timestamp",
    "station_ref reading_at",
    "",
    "reading_date",
    T.DateType(),
    "reading_at",
)
TABLES = {t.name: t for t in (RIVER_LEVELS, WEATHER_HISTORY, FLOOD_EVENTS, WEATHER_SNAPSHOTS, STATION_READINGS)}
