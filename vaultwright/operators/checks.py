"""Declared constraints as jobs that return the violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pk_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count."""
    counted = df.groupBy(*key).agg(F.count("*").alias("row_count"))
    return counted.where(F.col("row_count") > 1)


def is_unique(df: DataFrame, key: Sequence[str]) -> bool:
    """Whether the key is unique. Shuffles the key columns only."""
    return pk_violations(df.select(*key), key).isEmpty()


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column and number of NULLs, for the columns that hold any, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns]
    return counts.select(F.inline(F.array(*pairs))).where(F.col("null_count") > 0)


def fk_violations(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key the parent does not hold; a NULL key is no violation.

    Only the distinct keys meet the parent, which keeps a busy key from filling
    one join task and the wide child rows out of that shuffle. The orphan keys,
    few in sound data, then pick their rows.
    """
    keys = child.where(F.col(child_key).isNotNull()).select(child_key).distinct()
    parents = parent.select(F.col(parent_key).alias("__parent"))
    orphans = keys.join(parents, keys[child_key] == parents["__parent"], "left_anti")
    return child.join(orphans, [child_key], "left_semi").select(*child.columns)


def violations(
    df: DataFrame,
    *,
    primary_key: Sequence[str] = (),
    not_null: Sequence[str] = (),
    lengths: Mapping[str, int] | None = None,
    parents: Mapping[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """What breaks the declared constraints: ``rule``, ``column_name``, ``key`` and ``row_count``.

    NULLs and lengths are counted in one pass over the named columns; keys only meet as
    distinct values with their counts. ``parents`` maps a column to the frame and key
    that must hold its values.
    """
    text = "rule string, column_name string, key string, row_count long"
    found = [df.sparkSession.createDataFrame([], text)]
    tests = [("not_null", c, F.col(c).isNull()) for c in not_null]
    tests += [("length", c, F.length(F.col(c)) > limit) for c, limit in (lengths or {}).items()]
    if tests:
        counts = df.agg(*[F.count_if(test).alias(f"__{n}") for n, (_, _, test) in enumerate(tests)])
        rows = [
            F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), F.lit(None).cast("string").alias("key"),
                     F.col(f"__{n}").alias("row_count"))
            for n, (rule, column, _) in enumerate(tests)
        ]
        found.append(counts.select(F.inline(F.array(*rows))).where(F.col("row_count") > 0))
    if primary_key:
        key = F.concat_ws("||", *[F.col(c).cast("string") for c in primary_key])
        found.append(pk_violations(df, primary_key).select(
            F.lit("primary_key").alias("rule"), F.lit(",".join(primary_key)).alias("column_name"), key.alias("key"), "row_count"))
    for column, (parent, parent_key) in (parents or {}).items():
        keys = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count("*").alias("row_count"))
        known = parent.select(F.col(parent_key).alias("__parent"))
        orphans = keys.join(known, keys["key"] == known["__parent"], "left_anti")
        found.append(orphans.select(
            F.lit("foreign_key").alias("rule"), F.lit(column).alias("column_name"), F.col("key").cast("string").alias("key"), "row_count"))
    return reduce(DataFrame.unionByName, found)


def length_violations(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """Rows with a text longer than declared."""
    too_long = [F.length(F.col(name)) > limit for name, limit in lengths.items()]
    return df.where(reduce(lambda a, b: a | b, too_long))
