"""Operators on names, groups and types of columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.DoubleType, T.FloatType)


def lower_columns(df: DataFrame) -> DataFrame:
    """All column names in lower case."""
    return df.toDF(*[c.lower() for c in df.columns])


def key_first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` first, the other columns after them in their old order."""
    return df.select(*keys, *[c for c in df.columns if c not in keys])


def split_target(df: DataFrame, key: str, target: str) -> tuple[DataFrame, DataFrame]:
    """The label table ``(key, target)`` and the features without the label."""
    return df.select(key, target), df.drop(target)


def columns_of_type(df: DataFrame, *kinds: type[T.DataType]) -> list[str]:
    """Names of the columns whose type is one of ``kinds`` (floating types by default)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds or FLOATING)]


def columns_like(df: DataFrame, text: str) -> list[str]:
    """Names of the columns that contain ``text``."""
    return [c for c in df.columns if text in c]


def columns_with_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    """Names of the columns that start with one of ``prefixes``."""
    return [c for c in df.columns if c.startswith(prefixes)]


def cast_columns(df: DataFrame, columns: Iterable[str], to: str) -> DataFrame:
    """Cast ``columns``; a value that does not fit (NaN as integer) becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in columns})


def round_floats(df: DataFrame, places: int = 4) -> DataFrame:
    """Every floating column rounded half up."""
    return df.withColumns({c: F.round(c, places) for c in columns_of_type(df)})


def null_above(df: DataFrame, columns: Iterable[str], limit: float) -> DataFrame:
    """Values over ``limit`` become NULL. NaN counts as over every limit."""
    return df.withColumns({c: F.when(~(F.col(c) > limit), F.col(c)) for c in columns})


def fill_zero(df: DataFrame, prefixes: Sequence[str] = ()) -> DataFrame:
    """NULL becomes 0 in all numeric columns, or in those with one of ``prefixes``."""
    if not prefixes:
        return df.fillna(0)
    return df.fillna(0, columns_with_prefix(df, *prefixes))


def union_by_name(one: DataFrame, other: DataFrame, allow_missing: bool = False) -> DataFrame:
    """All rows of both; columns are matched by name, missing ones are NULL if allowed."""
    return one.unionByName(other, allowMissingColumns=allow_missing)
