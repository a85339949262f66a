"""Row predicates of the sources."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirframe.fixed import GOOD_QUALITY, MAX_SEVERITY_LEVEL
from weirframe.functions.scalars import year_end, year_start


def non_empty(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def complete_coords(name: Column, lat: Column, lon: Column) -> Column:
    """A usable station or area: it has a name and both coordinates."""
    return non_empty(name) & lat.isNotNull() & lon.isNotNull()


def passes_quality(quality: Column, value: Column, accepted: str | int = GOOD_QUALITY) -> Column:
    """Accepted quality flag and a present value. A missing flag is not accepted."""
    return (quality == F.lit(accepted)) & value.isNotNull()


def severe_enough(level: Column, at_most: int = MAX_SEVERITY_LEVEL) -> Column:
    """Lower levels are more severe."""
    return level <= at_most


def in_year(day: Column, year: Column) -> Column:
    return day.between(year_start(year), year_end(year))


def in_dates(day: Column, start: str | datetime.date, end: str | datetime.date | None = None) -> Column:
    """Both ends inclusive; an open end means today."""
    upper = F.current_date() if end is None else F.lit(str(end)).cast("date")
    return day.between(F.lit(str(start)).cast("date"), upper)
