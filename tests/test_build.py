"""Rows of one batch."""

from __future__ import annotations

import hashlib
from datetime import datetime

from conftest import plan, tuples

from vaultwright.operators import build
from vaultwright.spec import PASS_NULLS, SKIP_NULLS, HubSpec, LinkSpec, SatSpec

TS = datetime(2024, 1, 1)
HUB = HubSpec("THING", "id")
LINK = LinkSpec("PAIR", {"A": "a", "B": "b"})


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest().upper()


def test_hub_is_unique_and_leaves_out_null_keys(spark):
    staged = spark.createDataFrame([(7,), (7,), (8,), (None,)], "id int")
    out = build.hub_rows(staged, HUB, "x.csv", TS)
    assert out.columns == HUB.columns
    assert tuples(out, "THING_BK", "THING_HK", "RECORD_SOURCE") == [
        ("7", md5("7"), "X.CSV"), ("8", md5("8"), "X.CSV"),
    ]
    assert tuples(build.rejected_rows(staged, ["id"])) == [(None,)]


def test_hub_shuffles_the_key_before_hashing(spark):
    staged = spark.createDataFrame([(7, "x")], "id int, other string")
    lines = plan(build.hub_rows(staged, HUB, "x", TS)).splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert not any("md5" in line for line in lines[exchange:])
    assert sum("Exchange" in line for line in lines) == 1


def test_hub_of_several_feeds_keeps_the_first_source(spark):
    first = spark.createDataFrame([("1",), ("2",), ("2",)], "id string")
    second = spark.createDataFrame([(2, 0), (3, 0), (None, 0)], "thing int, other int")
    out = build.hub_rows_from_feeds(
        [(first, HUB, "first"), (second, HubSpec("THING", "thing"), "second")], TS
    )
    assert out.columns == HUB.columns
    assert tuples(out, "THING_BK", "RECORD_SOURCE") == [("1", "FIRST"), ("2", "FIRST"), ("3", "SECOND")]


def test_link_is_unique_and_needs_all_keys(spark):
    staged = spark.createDataFrame([(1, 2), (1, 2), (2, 1), (None, 1), (1, None)], "a int, b int")
    out = build.link_rows(staged, LINK, "x", TS)
    assert out.columns == ["A_HK", "B_HK", "PAIR_HK", "RECORD_SOURCE", "LOAD_DATE"]
    assert tuples(out, "A_HK", "B_HK", "PAIR_HK") == sorted(
        [(md5("1"), md5("2"), md5("1||2")), (md5("2"), md5("1"), md5("2||1"))]
    )


def test_satellite_keeps_versions_and_drops_copies(spark):
    spec = SatSpec("SAT", HUB, ("name", "n"))
    staged = spark.createDataFrame(
        [(1, "a", 1), (1, "a", 1), (1, "b", 1), (2, "a", 1), (None, "z", 1)], "id int, name string, n int"
    )
    out = build.sat_rows(staged, spec, "x", TS)
    assert out.columns == spec.columns
    assert tuples(out, "THING_HK", "name") == sorted([(md5("1"), "a"), (md5("1"), "b"), (md5("2"), "a")])
    # the parent enters the hash, so equal attributes of two parents differ
    assert out.select("HASH_DIFF").distinct().count() == 3
    assert md5("a||1||" + md5("1")) in {r["HASH_DIFF"] for r in out.collect()}


def test_satellite_is_unique_by_hash_diff_when_texts_collide(spark):
    staged = spark.createDataFrame([(1, ""), (1, None)], "id int, name string")
    out = build.sat_rows(staged, SatSpec("SAT", HUB, ("name",)), "x", TS)
    assert tuples(out, "name") == [("",), (None,)]
    staged = spark.createDataFrame([(1, "a", None), (1, None, "a")], "id int, x string, y string")
    out = build.sat_rows(staged, SatSpec("SAT", HUB, ("x", "y"), rule=SKIP_NULLS), "x", TS)
    assert tuples(out, "x", "y") == [(None, "a")]


def test_link_satellite_without_parent_in_hash(spark):
    spec = SatSpec("SAT", LINK, ("y", "name"), rule=PASS_NULLS, hash_parent=False)
    staged = spark.createDataFrame([(1, 2, 1999, "GP"), (1, 3, None, "GP")], "a int, b int, y int, name string")
    out = build.sat_rows(staged, spec, "x", TS)
    assert tuples(out, "PAIR_HK", "HASH_DIFF") == sorted(
        [(md5("1||2"), md5("1999GP")), (md5("1||3"), None)], key=repr
    )


def test_copies_change_the_work_not_the_rows(spark):
    spec = SatSpec("SAT", HUB, ("name",))
    unique = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    repeated = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, ""), (1, None), (2, "b"), (2, "b")], "id int, name string"
    )
    def rows(staged, copies):
        return build.sat_rows(staged, spec, "x", TS, copies=copies)

    assert "Exchange" not in plan(rows(unique, "none"))
    assert tuples(rows(unique, "none")) == tuples(rows(unique, "few")) == tuples(rows(unique, "many"))
    assert tuples(rows(repeated, "few")) == tuples(rows(repeated, "many"))
    assert tuples(rows(repeated, "few"), "name") == [("",), ("a",), ("b",), (None,)]


def test_only_rows_of_repeated_parents_are_grouped(spark, conf):
    spec = SatSpec("SAT", HUB, ("name",))
    unique = spark.range(40).selectExpr("cast(id as int) AS id", "cast(id % 4 as string) AS name")
    few = unique.unionByName(spark.createDataFrame(
        [(1, "1"), (1, "v2"), (2, ""), (2, None), (None, "lost"), (None, "lost")], "id int, name string"
    ))
    many = few.unionByName(few).unionByName(few)

    def by_count(staged):
        return build.sat_rows_by_count(staged, spec, "x", TS)

    assert "Exchange" not in plan(by_count(unique))
    assert by_count(unique.limit(0)).count() == 0
    apart, grouped, combined = plan(by_count(few)), plan(build.sat_rows(few, spec, "x", TS)), plan(by_count(many))
    assert "Union" in apart and "LeftAnti" in apart and "LeftSemi" in apart
    assert "LeftSemi" not in combined
    for staged in (unique, few, many):
        assert tuples(by_count(staged)) == tuples(build.sat_rows(staged, spec, "x", TS))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "LeftSemi" in apart and plan(by_count(few)).count("Exchange") == grouped.count("Exchange")
    assert tuples(by_count(few)) == tuples(build.sat_rows(few, spec, "x", TS))


def test_many_copies_are_combined_before_hashing(spark):
    spec = SatSpec("SAT", LINK, ("name", "a"))  # a key can be an attribute as well
    staged = spark.createDataFrame([(1, 2, "x")] * 3, "a int, b int, name string")
    lines = plan(build.sat_rows(staged, spec, "x", TS, copies="many")).splitlines()
    combine = next(i for i, line in enumerate(lines) if "HashAggregate" in line)
    assert not any("md5" in line for line in lines[combine:])


def test_busy_key_is_combined_before_the_shuffle(spark):
    """A third of the rows on one key: one row per key leaves each map task."""
    rows = spark.range(0, 30_000, 1, 4).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS id")
    out = build.hub_rows(rows, HUB, "x", TS)
    lines = [line for line in plan(out).splitlines() if "HashAggregate" in line]
    assert len(lines) == 2  # before and after the exchange
    assert out.count() == rows.distinct().count()
