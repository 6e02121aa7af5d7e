"""Date and number parsing where a bad value becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewright.functions.text import strip

_TIME = (
    r"(?:[ T](?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d{1,9})?)?"
    r"(?: ?(?:Z|[+-]\d{2}(?::?\d{2})?))?)?"
)
# (accepted shape, how to rewrite it into year-month-day). The time of day and
# the offset are checked and dropped: calendar fields come from the wall clock.
_YEAR_LAST = rf"^(\d{{1,2}})[-/](\d{{1,2}})[-/](\d{{4}}){_TIME}$"
DATE_SHAPES = (
    (rf"^(\d{{4}})[-/](\d{{1,2}})[-/](\d{{1,2}}){_TIME}$", "$1-$2-$3"),
    (_YEAR_LAST, "$3-$2-$1"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
)
_PLAIN_DATE = r"^\d{4}-\d{2}-\d{2}$"
_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"


def parse_date(
    value: Column,
    source: T.DataType | None = None,
    stripped: Column | None = None,
    month_first: bool = False,
) -> Column:
    """Date of a text (year first, or day first), date or timestamp column.

    ``stripped`` may give the stripped text where it is at hand. With
    ``month_first``, a text with the year last has its month first unless that
    is no date.
    """
    if isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value.cast("date")
    text = strip(value.cast("string")) if stripped is None else stripped
    parsed = F.when(text.rlike(_PLAIN_DATE), text.try_cast("date"))
    for shape, rewrite in DATE_SHAPES:
        orders = ["$3-$1-$2", rewrite] if month_first and shape == _YEAR_LAST else [rewrite]
        dates = [F.regexp_replace(text, shape, order).try_cast("date") for order in orders]
        parsed = parsed.when(text.rlike(shape), F.coalesce(*dates) if len(dates) > 1 else dates[0])
    return parsed


def parse_number(
    value: Column, source: T.DataType | None = None, stripped: Column | None = None
) -> Column:
    if isinstance(source, T.NumericType):
        number = value.cast("double")
        return F.when(~F.isnan(number), number)
    text = strip(value.cast("string")) if stripped is None else stripped
    # The pattern keeps out spellings only a JVM takes for numbers ("1d", "NaN").
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def year(date: Column) -> Column:
    return F.year(date)


def month(date: Column) -> Column:
    return F.month(date)


def quarter_label(date: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(date).cast("string"))


def iso_week(date: Column) -> Column:
    return F.weekofyear(date)
