"""Cleansing, reshaping, parsing and numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwright.functions import parse_date as to_date_or_null
from vaultwright.functions import parse_datetime as to_datetime_or_null
from vaultwright.operators import clean
from vaultwright.operators.audit import with_audit
from vaultwright.operators.surrogate import surrogate_key as number_rows
from vaultwright.plans.registry import FIRST, query, sql_audit, table


def null_where(df: DataFrame, column: str, condition) -> DataFrame:
    return df.withColumn(column, F.when(condition, None).otherwise(F.col(column)))


@query("""
    SELECT c_custkey AS C_CUSTKEY, upper(trim('  ' || lower(c_name) || ' ', ' ')) AS C_NAME,
           c_nationkey AS C_NATIONKEY, round(c_acctbal, 4) AS C_ACCTBAL, lower(c_mktsegment) AS C_MKTSEGMENT
    FROM customer
""")
def cleanse_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").withColumns({
        "c_name": F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")),
        "c_mktsegment": F.lower("c_mktsegment"),
    })
    return clean.cleanse(raw, keep_case=("c_mktsegment",))


@query("SELECT p_partkey, round(p_retailprice / 7, 4) AS unit_price FROM part")
def round_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return clean.round_floats(part.select("p_partkey", (F.col("p_retailprice") / 7).alias("unit_price")))


@query("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal,
           CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS c_mktsegment
    FROM customer
""")
def null_marker_to_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.when(F.col("c_acctbal") < 0, "\\N").otherwise(F.col("c_mktsegment"))
    return clean.blank_null_markers(table(spark, sf_dir, "customer").withColumn("c_mktsegment", marked))


@query("SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN -1 ELSE p_size END AS p_size FROM part")
def int_null_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = null_where(table(spark, sf_dir, "part"), "p_size", F.col("p_type") == "ECONOMY")
    return clean.default_null_integers(part.select("p_partkey", "p_size"))


@query("""
    SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_name END AS p_name, p_brand, p_type,
           CASE WHEN p_type = 'ECONOMY' THEN 0 ELSE p_size END AS p_size, p_retailprice
    FROM part
""")
def column_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, economy = table(spark, sf_dir, "part"), F.col("p_type") == "ECONOMY"
    holes = null_where(null_where(part, "p_name", economy), "p_size", economy)
    return clean.fill_defaults(holes, {"p_name": "", "p_size": 0})


@query("""
    SELECT c_custkey AS C_CUSTKEY, c_name AS C_NAME, c_nationkey AS C_NATIONKEY, c_acctbal AS C_ACCTBAL,
           c_mktsegment AS C_MKTSEGMENT
    FROM customer
""")
def prefix_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.strip_prefix(clean.add_prefix(table(spark, sf_dir, "customer"), "r_"), "r_")


@query("SELECT c_custkey, c_name AS customer_name, c_acctbal, c_mktsegment FROM customer")
def rename_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.rename_and_drop(table(spark, sf_dir, "customer"), {"c_name": "customer_name"}, ["c_nationkey"])


@query(f"SELECT o_orderkey, o_custkey, {sql_audit('ORDERS.CSV')} FROM orders")
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_audit(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "orders.csv", FIRST.ts)


@query("""
    SELECT o_orderkey,
           try_strptime(CASE WHEN o_orderstatus = 'P' THEN '\\N' ELSE strftime(o_orderdate, '%Y-%m-%d') END,
                        '%Y-%m-%d')::DATE AS order_date
    FROM orders
""")
def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("o_orderdate").cast("date").cast("string")
    raw = F.when(F.col("o_orderstatus") == "P", "\\N").otherwise(text)
    return table(spark, sf_dir, "orders").select("o_orderkey", to_date_or_null(raw).alias("order_date"))


@query("""
    SELECT event_id,
           try_strptime(strftime(ts, '%Y-%m-%d') || ' ' ||
                        CASE WHEN event_type = 'error' THEN '\\N' ELSE strftime(ts, '%H:%M:%S') END,
                        '%Y-%m-%d %H:%M:%S')::TIMESTAMP AS event_ts
    FROM events
""")
def parse_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("ts").cast("string")
    date, clock = F.substring(text, 1, 10), F.substring(text, 12, 8)
    time = F.when(F.col("event_type") == "error", "\\N").otherwise(clock)
    return table(spark, sf_dir, "events").select("event_id", to_datetime_or_null(date, time).alias("event_ts"))


@query("SELECT row_number() OVER (ORDER BY o_orderkey) AS ID, o_orderkey, o_custkey FROM orders")
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"])
