"""Surrogate keys, checks, reports and views."""

from __future__ import annotations

import pytest
from conftest import plan, tuples

from vaultwright.operators import checks, report
from vaultwright.operators.surrogate import surrogate_key
from vaultwright.operators.views import create_stage_view


def test_surrogate_key_numbers_in_key_order(spark):
    keys = [f"k{n:04d}" for n in range(1000)]
    df = spark.createDataFrame([(k,) for k in reversed(keys)], "k string").repartition(7)
    out = surrogate_key(df, ["k"], "ID")
    assert out.columns == ["ID", "k"]
    assert sorted(map(tuple, out.collect())) == list(enumerate(keys, start=1))


def test_surrogate_key_start_and_empty_input(spark):
    df = spark.createDataFrame([("b",), ("a",)], "k string")
    assert tuples(surrogate_key(df, ["k"], start=101)) == [(101, "a"), (102, "b")]
    assert surrogate_key(df.limit(0), ["k"]).count() == 0


def test_surrogate_key_with_busy_key(spark):
    """A third of the rows share a key, some of them the whole row: ids stay gap-free
    and in key order, and no partition holds the busy key alone."""
    df = spark.range(0, 9000, 1, 4).selectExpr("if(id % 3 = 0, 500, id) AS k", "id % 9 AS v")
    out = surrogate_key(df, ["k"])
    rows = sorted(map(tuple, out.collect()))
    assert [r[0] for r in rows] == list(range(1, 9001))
    assert [r[1] for r in rows] == sorted(r[0] for r in df.select("k").collect())


def test_surrogate_key_has_no_window_over_the_data(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    text = plan(surrogate_key(df, ["k"]))
    window = text.index("Window")
    assert "HashAggregate" in text[window:]  # it orders counts, one per partition


def test_pk_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, v string")
    assert tuples(checks.pk_violations(df, ["k", "v"])) == [(1, "a", 2), (None, "c", 2)]
    assert not checks.is_unique(df, ["k"])
    assert checks.is_unique(df.distinct(), ["k", "v"])


def test_not_null_violations(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None)], "a int, b string, c string")
    assert tuples(checks.not_null_violations(df, ["a", "b", "c"])) == [("b", 1), ("c", 2)]


def test_fk_violations(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None), (4, 99), (5, 10)], "id int, parent int")
    parent = spark.createDataFrame([(10,), (11,)], "id int")
    assert tuples(checks.fk_violations(child, parent, "parent", "id")) == [(2, 99), (4, 99)]


def test_fk_violations_of_a_table_with_itself(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 9)], "id int, boss int")
    assert tuples(checks.fk_violations(df, df, "boss", "id")) == [(3, 9)]


def test_length_violations(spark):
    df = spark.createDataFrame([("abc", "x"), ("abcd", "x"), ("a", "xyz"), (None, None)], "a string, b string")
    assert tuples(checks.length_violations(df, {"a": 3, "b": 2})) == [("a", "xyz"), ("abcd", "x")]


def test_preview_keeps_top_rows_per_partition(spark):
    df = spark.range(1000, 0, -1).withColumnRenamed("id", "k")
    out = report.preview(df, ["k"], 3)
    assert [r[0] for r in out.collect()] == [1, 2, 3]
    assert "TakeOrderedAndProject" in plan(out)


def test_schema_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert tuples(report.schema_report(df)) == [(1, "a", "int", False), (2, "b", "string", True)]
    assert tuples(report.schema_report(df.limit(0)), "nullable") == [(False,), (False,)]


def test_stage_view(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert create_stage_view(df, "circuits") == "view created for circuits: stg_circuits"
    assert create_stage_view(df.union(df), "circuits")  # a second call replaces the view
    assert spark.table("stg_circuits").count() == 2
    with pytest.raises(ValueError):
        create_stage_view(df, "x; drop table y")
