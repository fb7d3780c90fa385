"""Inventory, preview and schema reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwright.spec import LOAD_DATE


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Table name, row count and last load timestamp of each table."""
    rows = [
        df.agg(F.count("*").alias("row_count"), F.max(LOAD_DATE).alias("last_load"))
        .select(F.lit(name).alias("table_name"), "row_count", "last_load")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def preview(df: DataFrame, order: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows in key order. Spark keeps the top rows of each partition."""
    return df.orderBy(*order).limit(rows)


def schema_report(df: DataFrame) -> DataFrame:
    """Name, type and observed nullability of each column.

    File scans declare every column nullable, so the flag comes from the data.
    """
    has_null = df.agg(*[F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False)).alias(c) for c in df.columns])
    fields = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f.name).alias("nullable"),
        )
        for position, f in enumerate(df.schema.fields, start=1)
    ]
    return has_null.select(F.inline(F.array(*fields)))
