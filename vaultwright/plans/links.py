"""Link loads."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwright.operators import build, newrows
from vaultwright.plans.hubs import fresh_vault
from vaultwright.plans.registry import FIRST, SECOND, query, sql_audit, sql_hk, sql_joined, table
from vaultwright.spec import BATCH_ID, LinkSpec

LNK_ORDER = LinkSpec("CUSTOMER_ORDER", {"CUSTOMER": "o_custkey", "ORDER": "o_orderkey"})
LNK_SUPPLY = LinkSpec("PART_SUPPLIER", {"PART": "l_partkey", "SUPPLIER": "l_suppkey"})
LNK_ITEM = LinkSpec(
    "ITEM", {"ORDER": "l_orderkey", "PART": "l_partkey", "SUPPLIER": "l_suppkey", "LINE": "l_linenumber"}
)

# The orders an earlier load had already brought.
LOADED_THROUGH = "1998-01-01"

SQL_ORDER_HK = f"upper(md5({sql_joined('o_custkey', 'o_orderkey')}))"
SQL_ITEM_HK = f"upper(md5({sql_joined('l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber')}))"
_ORDER_HKS = f"{sql_hk('o_custkey')} AS CUSTOMER_HK, {sql_hk('o_orderkey')} AS ORDER_HK, {SQL_ORDER_HK} AS CUSTOMER_ORDER_HK"


def loaded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit(LOADED_THROUGH).cast("timestamp_ntz"))


@query(f"SELECT DISTINCT {_ORDER_HKS}, {sql_audit('ORDERS.CSV')} FROM orders")
def link_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.link_rows(table(spark, sf_dir, "orders"), LNK_ORDER, "orders.csv", FIRST.ts)


@query(f"""
    SELECT DISTINCT {_ORDER_HKS}, {sql_audit('ORDERS.CSV', SECOND)} FROM orders
    WHERE {SQL_ORDER_HK} NOT IN (SELECT {SQL_ORDER_HK} FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_THROUGH}')
""")
def link_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = build.link_rows(loaded_orders(spark, sf_dir), LNK_ORDER, "orders.csv", FIRST.ts)
    keep = partial(newrows.new_rows, target=stored, on=LNK_ORDER.match, packed=True)
    return build.link_rows(table(spark, sf_dir, "orders"), LNK_ORDER, "orders.csv", SECOND.ts, keep=keep)


@query(f"""
    SELECT {_ORDER_HKS},
           CASE WHEN o_orderdate < TIMESTAMP '{LOADED_THROUGH}' THEN 'initial' ELSE 'incremental' END AS LOAD_MODE
    FROM orders
""")
def load_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, vault = table(spark, sf_dir, "orders"), fresh_vault(spark)
    first = vault.load_link(loaded_orders(spark, sf_dir), LNK_ORDER, "orders.csv", FIRST)
    second = vault.load_link(orders, LNK_ORDER, "orders.csv", SECOND)
    mode = F.when(F.col(BATCH_ID) == FIRST.id, first.mode).otherwise(second.mode)
    return vault.read(LNK_ORDER, orders).select(*LNK_ORDER.ref_hks, LNK_ORDER.hk, mode.alias("LOAD_MODE"))


@query(f"""
    SELECT DISTINCT {sql_hk('l_partkey')} AS PART_HK, {sql_hk('l_suppkey')} AS SUPPLIER_HK,
           upper(md5({sql_joined('l_partkey', 'l_suppkey')})) AS PART_SUPPLIER_HK, {sql_audit('LINEITEM.CSV')}
    FROM lineitem
""")
def link_pair_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.link_rows(table(spark, sf_dir, "lineitem"), LNK_SUPPLY, "lineitem.csv", FIRST.ts)


@query(f"""
    SELECT DISTINCT {sql_hk('l_orderkey')} AS ORDER_HK, {sql_hk('l_partkey')} AS PART_HK,
           {sql_hk('l_suppkey')} AS SUPPLIER_HK, {sql_hk('l_linenumber')} AS LINE_HK, {SQL_ITEM_HK} AS ITEM_HK,
           {sql_audit('LINEITEM.CSV')}
    FROM lineitem
""")
def link_wide_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.link_rows(table(spark, sf_dir, "lineitem"), LNK_ITEM, "lineitem.csv", FIRST.ts)
