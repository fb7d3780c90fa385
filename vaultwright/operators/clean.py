"""Cleansing and reshaping of a raw frame. Each operator is one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultwright.functions.text import blank_marker, clean_text

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


def cleanse(
    df: DataFrame,
    *,
    keep_case: Sequence[str] = ("url",),
    null_marker: str | None = None,
    null_int: int | None = None,
    round_digits: int | None = 4,
    prefix: str = "",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Cleanse every column by its type and upper-case the column names.

    Text is trimmed and upper-cased unless named in ``keep_case``, and the null
    marker becomes the empty text; floats are rounded; NULL integers become
    ``null_int``. ``prefix`` goes before the upper-cased names, to keep the sides
    of a join apart. Columns in ``keys`` (upper-cased names) are business keys: a
    missing, empty or marked one becomes or stays NULL.
    """
    kept = {name.lower() for name in keep_case}

    def cleansed(field: T.StructField) -> Column:
        column = F.col(field.name)
        if field.name.upper() in keys:
            if isinstance(field.dataType, T.StringType):
                column = column if field.name.lower() in kept else clean_text(column)
                column = F.when(~column.isin("", null_marker or "\\N"), column)
        elif isinstance(field.dataType, T.StringType) and field.name.lower() not in kept:
            column = clean_text(column)
            if null_marker is not None:
                column = blank_marker(column, null_marker)
        elif isinstance(field.dataType, _FLOATS) and round_digits is not None:
            column = F.round(column, round_digits)
        elif isinstance(field.dataType, _INTEGERS) and null_int is not None:
            column = F.coalesce(column, F.lit(null_int).cast(field.dataType))
        return column.alias(prefix + field.name.upper())

    return df.select(*[cleansed(field) for field in df.schema.fields])


def round_floats(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, _FLOATS) else F.col(f.name)
        for f in df.schema.fields
    ])


def blank_null_markers(df: DataFrame, marker: str = "\\N") -> DataFrame:
    """Whole-value null markers of text columns become the empty text."""
    return df.replace(marker, "")


def default_null_integers(df: DataFrame, value: int = -1) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, _INTEGERS)]
    return df.fillna(value, subset=names)


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Declared column defaults for values that are NULL."""
    return df.select(*[
        F.coalesce(F.col(f.name), F.lit(defaults[f.name]).cast(f.dataType)).alias(f.name)
        if f.name in defaults else F.col(f.name)
        for f in df.schema.fields
    ])


def add_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + name.upper() for name in df.columns])


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[name.removeprefix(prefix) for name in df.columns])


def rename_and_drop(df: DataFrame, renames: Mapping[str, str], drops: Sequence[str] = ()) -> DataFrame:
    return df.drop(*drops).withColumnsRenamed(dict(renames))
