"""Scalar column expressions. All of them stay inside whole-stage codegen."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlake.functions.columns import FLOATING
from creditlake.settings import ANCHOR_DATE, DAYS_PER_MONTH, DAYS_PER_YEAR, DECIMAL_PLACES

DAY = "yyyy-MM-dd"
MONTH = "yyyy-MM"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Conditions and flags


def is_missing(field: T.StructField) -> Column:
    """NULL, or NaN in a floating column."""
    column = F.col(field.name)
    if isinstance(field.dataType, FLOATING):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def one_hot(df: DataFrame, column: str, values: Iterable[int], prefix: str) -> DataFrame:
    """One 0/1 column ``prefix + value`` per value."""
    return df.withColumns({f"{prefix}{v}": flag(F.col(column) == v) for v in values})


def label_if(condition: Column, yes: str, no: str) -> Column:
    """``yes`` where the condition holds, else ``no`` (also for NULL)."""
    return F.when(condition, yes).otherwise(no)


def negate_positive(c: Column | str) -> Column:
    """The value with a negative sign."""
    return -F.abs(_column(c))


def null_of(type_name: str) -> Column:
    """A NULL of the given type."""
    return F.lit(None).cast(type_name)


# Ratios


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b``, NULL where ``b`` is 0."""
    return F.try_divide(_column(a), _column(b))


def ratio_or_zero(a: Column | str, b: Column | str) -> Column:
    """``a / b`` where ``b`` is positive, else 0."""
    return F.when(_column(b) > 0, _column(a) / _column(b)).otherwise(0)


def rate(a: Column | str, b: Column | str, places: int = DECIMAL_PLACES) -> Column:
    """``a / b`` rounded half up, NULL where ``b`` is 0."""
    return F.round(safe_ratio(a, b), places)


# Dates


def age_years(days: Column | str) -> Column:
    """Whole years in a number of days, sign ignored."""
    return (F.abs(_column(days)) / DAYS_PER_YEAR).try_cast("int")


def offset_date(days: Column | str, anchor: datetime.date | Column | None = ANCHOR_DATE) -> Column:
    """The date ``days`` after the anchor; ``None`` takes the day of the run."""
    return F.date_add(_anchor(anchor), _column(days).try_cast("int"))


def offset_to_date(
    days: Column | str, anchor: datetime.date | Column | None = ANCHOR_DATE, pattern: str = DAY
) -> Column:
    """:func:`offset_date` as text."""
    return _date_text(offset_date(days, anchor), pattern)


def month_offset(months: Column | str, anchor: datetime.date | Column | None = ANCHOR_DATE) -> Column:
    """``yyyy-MM`` of the date ``months`` times 30 days after the anchor."""
    return offset_to_date(_column(months) * DAYS_PER_MONTH, anchor, MONTH)


def shift_months(date: Column | str, months: Column | int) -> Column:
    """``yyyy-MM`` of a date moved by calendar months."""
    return _date_text(F.add_months(_column(date), months), MONTH)


def _anchor(anchor: datetime.date | Column | None) -> Column:
    if anchor is None:
        return F.current_date()
    return anchor if isinstance(anchor, Column) else F.lit(anchor)


def _date_text(date: Column, pattern: str) -> Column:
    # The two usual patterns are prefixes of the plain text of a date, which
    # costs far less per row than a formatter.
    if pattern == DAY:
        return date.cast("string")
    if pattern == MONTH:
        return F.substring(date.cast("string"), 1, 7)
    return F.date_format(date, pattern)


# Lookups


def map_values(c: Column | str, mapping: Mapping) -> Column:
    """The mapped value; NULL for a value that is not in the mapping."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.create_map(*pairs)[_column(c)]
