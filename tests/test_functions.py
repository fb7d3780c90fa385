"""Hand-made values for expressions and cleansing."""

from __future__ import annotations

import hashlib
from datetime import date, datetime

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from vaultwright import functions as V
from vaultwright.operators import clean
from vaultwright.spec import PASS_NULLS, SKIP_NULLS, STANDARD, HashRule


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest().upper()


def one(df, column):
    return df.select(column.alias("x")).first()["x"]


def test_hash_key_of_one(spark):
    df = spark.createDataFrame([(1, "1", None)], "i int, s string, n string")
    assert one(df, V.hash_key("i")) == "C4CA4238A0B923820DCC509A6F75849B"
    assert one(df, V.hash_key("s")) == one(df, V.hash_key("i"))
    assert one(df, V.hash_key("n")) is None


def test_null_rules(spark):
    df = spark.createDataFrame([("a", None, "b")], "x string, y string, z string")
    columns = ["x", "y", "z"]
    assert one(df, V.hash_diff(df, columns, SKIP_NULLS)) == md5("ab")
    assert one(df, V.hash_diff(df, columns, PASS_NULLS)) is None
    assert one(df, V.hash_diff(df, columns, STANDARD)) == md5("a||\\N||b")


def test_position_of_null_counts_only_in_standard_rule(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    columns = ["x", "y", "z"]
    assert df.select(V.hash_diff(df, columns, SKIP_NULLS)).distinct().count() == 1
    assert df.select(V.hash_diff(df, columns, STANDARD)).distinct().count() == 2


def test_link_key_separator(spark):
    df = spark.createDataFrame([(1, 12), (11, 2)], "a int, b int")
    assert df.select(V.link_key(df, ["a", "b"], PASS_NULLS)).distinct().count() == 1
    assert df.select(V.link_key(df, ["a", "b"])).distinct().count() == 2
    assert df.select(V.link_key(df, ["a", "b"]).alias("k")).first()["k"] == md5("1||12")


def test_fixed_numbers_survive_any_double(spark):
    values = [1.0, 1e7, 0.00001, 1e20, float("nan"), float("inf"), None, -0.5]
    df = spark.createDataFrame([(v,) for v in values], "d double")
    texts = [r[0] for r in df.select(V.hash_diff(df, ["d"])).collect()]
    expected = ["1.0000", "10000000.0000", "1.0E-5", "1.0E20", "NaN", "Infinity", "\\N", "-0.5000"]
    assert texts == [md5(t) for t in expected]


def test_standard_hashes_tell_texts_apart(spark):
    rows = [("a||b", "c"), ("a", "b||c"), ("a", None), ("a", ""), ("a", "\\N"), ("a|", "|b"), ("a\\", "|b")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(V.hash_diff(df, ["x", "y"])).distinct().count() == len(rows)
    assert df.where("y IS NOT NULL").select(V.link_key(df, ["x", "y"])).distinct().count() == len(rows) - 1


def test_timestamp_text_does_not_depend_on_zone(spark, conf):
    df = spark.range(1).select(F.timestamp_micros(F.lit(1_700_000_000_123_456)).alias("t"))
    in_utc = one(df, V.hash_diff(df, ["t"]))
    conf("spark.sql.session.timeZone", "Asia/Tokyo")
    assert one(df, V.hash_diff(df, ["t"])) == in_utc


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_parsing_yields_null_for_bad_text(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    texts = ["1985-11-27", "\\N", "", "2021-02-30", None, "1985-11", "1985-1-2", "1985-11-27T00:00:00", "x1985-11-27"]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    parsed = [r[0] for r in df.select(V.parse_date(F.col("d"))).collect()]
    assert parsed == [date(1985, 11, 27)] + [None] * 8


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_date_and_time(spark, conf, zone):
    """Half past two on 10 March 2024 does not exist in New York, but is valid text."""
    conf("spark.sql.session.timeZone", zone)
    rows = [
        ("1950-05-13", "\\N"), ("2009-03-29", "06:00:00"), ("2024-03-10", "02:30:00"), ("2009-03-29", "25:00:00"),
        ("2009-03-29", "06:00"), (None, "06:00:00"),
    ]
    df = spark.createDataFrame(rows, "d string, t string")
    df = df.select(V.parse_datetime(F.col("d"), F.col("t")).alias("x"))
    assert df.dtypes == [("x", "timestamp_ntz")]
    expected = [None, datetime(2009, 3, 29, 6), datetime(2024, 3, 10, 2, 30), None, None, None]
    assert [r[0] for r in df.collect()] == expected


def test_unknown_hash_rule_is_refused():
    with pytest.raises(ValueError):
        HashRule(nulls="drop")
    with pytest.raises(ValueError):
        HashRule(numerics="rounded")


def test_cleanse_by_type(spark):
    df = spark.createDataFrame(
        [("  straße  ", "\\N", None, 1.23456, "http://x/Y "), ("a\\N", "b", 3, None, None)],
        "name string, code string, number int, lat double, url string",
    )
    out = clean.cleanse(df, null_marker="\\N", null_int=-1)
    assert out.columns == ["NAME", "CODE", "NUMBER", "LAT", "URL"]
    assert [tuple(r) for r in out.collect()] == [
        ("STRASSE ", "", -1, 1.2346, "http://x/Y "),
        ("A\\N", "B", 3, None, None),
    ]


def test_cleanse_leaves_what_it_is_not_told(spark):
    df = spark.createDataFrame([("\\N", None)], "code string, number int")
    assert clean.cleanse(df, prefix="r_").columns == ["r_CODE", "r_NUMBER"]
    assert clean.cleanse(df).first() == ("\\N", None)


def test_cleanse_is_one_projection(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    optimized = clean.cleanse(df)._jdf.queryExecution().analyzed().toString()
    assert optimized.count("Project") == 1


def test_prefix_roundtrip_and_rename(spark):
    df = spark.createDataFrame([(1, "x", 2)], "id int, location string, gone int")
    assert clean.add_prefix(df, "r_").columns == ["r_ID", "r_LOCATION", "r_GONE"]
    assert clean.strip_prefix(clean.add_prefix(df, "r_"), "r_").columns == ["ID", "LOCATION", "GONE"]
    assert clean.rename_and_drop(df, {"location": "city"}, ["gone"]).columns == ["id", "city"]


def test_defaults_fill_only_nulls(spark):
    df = spark.createDataFrame(
        [(None, None, float("nan"), None), (5, "x", 1.0, date(2020, 1, 1))], "i int, s string, f double, d date"
    )
    out = clean.fill_defaults(df, {"i": 0, "s": "", "d": "1970-01-01"})
    assert out.dtypes == df.dtypes
    rows = out.collect()
    assert (rows[0]["i"], rows[0]["s"], rows[0]["d"]) == (0, "", date(1970, 1, 1))
    assert str(rows[0]["f"]) == "nan"
    assert tuple(rows[1]) == (5, "x", 1.0, date(2020, 1, 1))


def test_null_markers_and_integers(spark):
    df = spark.createDataFrame([("\\N", "a\\N", None, None)], "a string, b string, i int, l bigint")
    assert tuples(clean.blank_null_markers(df), "a", "b") == [("", "a\\N")]
    assert tuples(clean.default_null_integers(df), "i", "l") == [(-1, -1)]


def test_audit_values_are_constants(spark):
    df = spark.range(2).select(V.record_source("driver.csv").alias("s"), V.load_date(datetime(2024, 1, 2, 3, 4, 5)).alias("t"))
    assert df.dtypes == [("s", "string"), ("t", "timestamp_ntz")]
    assert set(map(tuple, df.collect())) == {("DRIVER.CSV", datetime(2024, 1, 2, 3, 4, 5))}
