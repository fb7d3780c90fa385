"""Declared constraints as violation reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwright.operators import checks
from vaultwright.plans.cleansing import null_where
from vaultwright.plans.registry import query, table


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.pk_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    SELECT 'p_name' AS column_name, count(*) AS null_count FROM part WHERE p_type = 'ECONOMY'
    UNION ALL
    SELECT 'p_size' AS column_name, count(*) AS null_count FROM part WHERE p_type = 'ECONOMY'
""")
def not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    economy = F.col("p_type") == "ECONOMY"
    part = null_where(null_where(table(spark, sf_dir, "part"), "p_name", economy), "p_size", economy)
    return checks.not_null_violations(part, ["p_partkey", "p_name", "p_brand", "p_size"])


_CHILD = """(SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1995-03-01' THEN -1 - o_custkey ELSE o_custkey END AS o_custkey
             FROM orders) AS child"""


@query(f"SELECT o_orderkey, o_custkey FROM {_CHILD} WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)")
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    early = F.col("o_orderdate") < F.lit("1995-03-01").cast("timestamp_ntz")
    customer_key = F.when(early, -1 - F.col("o_custkey")).otherwise(F.col("o_custkey"))
    child = table(spark, sf_dir, "orders").select("o_orderkey", customer_key.alias("o_custkey"))
    return checks.fk_violations(child, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey")


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE length(p_name) > 10 OR length(p_brand) > 7")
def length_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return checks.length_violations(part, {"p_name": 10, "p_brand": 7})
