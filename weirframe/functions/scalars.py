"""Scalar rules: coercion to the table types, keys, time buckets, text markers.

Each coercion has a lenient form, which yields NULL for text that does not fit, and
``strict``, which raises for it. Lenient columns feed per-unit validity flags;
strict columns abort a whole poll.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirframe.fixed import REF_AFTER, REF_BEFORE, REF_UNTIL

# A plain decimal literal. Java would also parse "1.5f" or "0x1p3".
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
BAD_VALUE = "bad value"
DATE_TEXT = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"


def number(text: Column) -> Column:
    """Number or numeric text -> double, NULL where it is neither."""
    return F.when(text.cast("string").rlike(NUMBER_TEXT), text.cast("string").try_cast("double"))


def as_decimal(value: Column, precision: int, scale: int) -> Column:
    """Rounds half away from zero; NULL beyond the precision."""
    return value.try_cast(T.DecimalType(precision, scale))


def as_integer(value: Column) -> Column:
    """Rounds half away from zero, where a plain cast would truncate."""
    return F.round(value).try_cast("int")


def as_boolean(text: Column) -> Column:
    return text.try_cast("boolean")


def as_instant(text: Column) -> Column:
    """ISO text -> timestamp; text without an offset is in the session zone."""
    return F.when(text.rlike(DATE_TEXT), text.try_cast("timestamp"))


def as_date(text: Column) -> Column:
    return F.when(text.rlike(DATE_TEXT), text.try_cast("date"))


def coerce(text: Column, to: T.DataType) -> Column:
    """Landed text -> table type, by the rule for that type."""
    if isinstance(to, T.DecimalType):
        return as_decimal(number(text), to.precision, to.scale)
    if isinstance(to, T.IntegerType):
        return as_integer(number(text))
    if isinstance(to, T.DoubleType):
        return number(text)
    if isinstance(to, T.BooleanType):
        return as_boolean(text)
    if isinstance(to, T.TimestampType):
        return as_instant(text)
    if isinstance(to, T.DateType):
        return as_date(text)
    return text.cast(to)


def misfit(text: Column, coerced: Column) -> Column:
    """True where a present value did not fit its type."""
    return text.isNotNull() & coerced.isNull()


def strict(text: Column, to: T.DataType, name: str) -> Column:
    """``coerce`` that raises on a misfit, whatever the session's ANSI mode."""
    coerced = coerce(text, to)
    message = F.concat(F.lit(f"{BAD_VALUE} for {name}: "), text.cast("string"))
    return F.when(misfit(text, coerced), F.raise_error(message)).otherwise(coerced).cast(to)


def distinct_from(left: Column, right: Column) -> Column:
    """Null-safe inequality."""
    return ~left.eqNullSafe(right)


def all_present(columns: list[str]) -> Column:
    """Every named column is non-null."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns], F.lit(True))


def default_for_absent(value: Column, default: Column, explicit_null: Column | None = None) -> Column:
    """The default where a field is absent; a field that is there and null (``explicit_null``) stays null."""
    filled = F.coalesce(value, default)
    return filled if explicit_null is None else F.when(~explicit_null | value.isNotNull(), filled)


def text_constants(values: dict[str, str | None]) -> list[Column]:
    """Named columns with the same text, or none, in every row."""
    return [F.lit(value).cast("string").alias(name) for name, value in values.items()]


def first_reason(reasons: list[Column]) -> Column:
    """The first reason that is not null, cut to a length that fits a log."""
    return F.left(F.coalesce(*reasons, F.lit(None).cast("string")), F.lit(500))


def misfit_reason(text: Column, coerced: Column, name: str) -> Column:
    """Why a value fails what it belongs to; null if it fits."""
    return F.when(misfit(text, coerced), F.concat(F.lit(f"{BAD_VALUE} for {name}: "), text.cast("string")))


def truthy(value: Column) -> Column:
    """Present and not zero."""
    return value.isNotNull() & (value != 0)


def hour_bucket(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def year_start(year: Column) -> Column:
    return F.make_date(year, F.lit(1), F.lit(1))


def year_end(year: Column) -> Column:
    return F.make_date(year, F.lit(12), F.lit(31))


def unit_key(ref: Column, year: Column) -> Column:
    return F.concat_ws(":", ref, year.cast("string"))


def unit_ref(key: Column) -> Column:
    """The part before the last colon."""
    return F.regexp_extract(key, r"^(.*):[^:]*$", 1)


def unit_year(key: Column) -> Column:
    return F.substring_index(key, ":", -1).try_cast("int")


def text_between(text: Column, after: str, until: str, before: str) -> Column:
    """Text after the last ``after``, up to the next ``until``, cut at the first ``before``.

    NULL unless both ``after`` and, in the remaining segment, ``before`` occur.
    Markers are plain text and are matched from the left without overlap.
    """
    tail = F.element_at(F.split(text, _quoted(after)), -1)
    segment = F.get(F.split(tail, _quoted(until)), F.lit(0))
    cut = F.get(F.split(segment, _quoted(before)), F.lit(0))
    return F.when(F.contains(text, F.lit(after)) & F.contains(segment, F.lit(before)), cut)


def _quoted(marker: str) -> str:
    return rf"\Q{marker}\E"


def station_ref(reading_id: Column) -> Column:
    """Station reference inside a live reading's ``@id``."""
    return text_between(reading_id, REF_AFTER, REF_UNTIL, REF_BEFORE)


def surrogate_id(*parts: Column) -> Column:
    """64-bit id that depends on the key alone, so it is known before the write."""
    return F.xxhash64(*parts)
