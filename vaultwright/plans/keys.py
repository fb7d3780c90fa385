"""Hash keys, hash diffs and link keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwright import functions as V
from vaultwright.plans.cleansing import null_where
from vaultwright.plans.registry import query, sql_marked, sql_fixed, sql_hk, sql_joined, table
from vaultwright.spec import LINK_STANDARD, PASS_NULLS, SKIP_NULLS, STANDARD, HashRule

ATTRIBUTES = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]

# The customer table with an unknown segment for accounts in debt.
_CUSTOMER = """(SELECT c_custkey, c_name, c_nationkey, c_acctbal,
                       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer) AS c"""


def _hash_diffs(spark: SparkSession, sf_dir: str, rule: HashRule) -> DataFrame:
    customer = null_where(table(spark, sf_dir, "customer"), "c_mktsegment", F.col("c_acctbal") < 0)
    return customer.select("c_custkey", V.hash_diff(customer, ATTRIBUTES, rule).alias("HASH_DIFF"))


def _link_keys(spark: SparkSession, sf_dir: str, rule: HashRule) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = V.link_key(orders, ["o_custkey", "o_orderkey"], rule)
    return orders.select("o_custkey", "o_orderkey", key.alias("CUSTOMER_ORDER_HK"))


@query(f"SELECT c_custkey, {sql_hk('c_custkey')} AS CUSTOMER_HK FROM customer")
def hash_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", V.hash_key("c_custkey").alias("CUSTOMER_HK"))


@query(f"""
    SELECT c_custkey, upper(md5({sql_marked('c_name', 'c_nationkey', sql_fixed('c_acctbal'), 'c_mktsegment')})) AS HASH_DIFF
    FROM {_CUSTOMER}
""")
def hash_diff_keep_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hash_diffs(spark, sf_dir, STANDARD)


@query(f"""
    SELECT c_custkey,
           upper(md5(concat_ws('', c_name, cast(c_nationkey as varchar), cast(c_acctbal as varchar), c_mktsegment))) AS HASH_DIFF
    FROM {_CUSTOMER}
""")
def hash_diff_skip_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hash_diffs(spark, sf_dir, SKIP_NULLS)


@query(f"""
    SELECT c_custkey, upper(md5({sql_joined(*ATTRIBUTES, sep='')})) AS HASH_DIFF FROM {_CUSTOMER}
""")
def hash_diff_propagate_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hash_diffs(spark, sf_dir, PASS_NULLS)


@query(f"""
    SELECT o_custkey, o_orderkey, upper(md5({sql_joined('o_custkey', 'o_orderkey')})) AS CUSTOMER_ORDER_HK FROM orders
""")
def link_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _link_keys(spark, sf_dir, LINK_STANDARD)


@query(f"""
    SELECT o_custkey, o_orderkey, upper(md5({sql_joined('o_custkey', 'o_orderkey', sep='')})) AS CUSTOMER_ORDER_HK
    FROM orders
""")
def link_key_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _link_keys(spark, sf_dir, PASS_NULLS)
