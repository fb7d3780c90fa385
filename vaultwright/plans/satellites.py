"""Satellite and link satellite loads.

The stored customers are those in credit, from before the BUILDING segment had its
name. The stored orders are an earlier load, when urgent orders were still open.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwright.operators import build, newrows
from vaultwright.plans.hubs import fresh_vault
from vaultwright.plans.links import LNK_ITEM, LNK_ORDER, LOADED_THROUGH, SQL_ITEM_HK, SQL_ORDER_HK, loaded_orders
from vaultwright.plans.registry import (
    FIRST, SECOND, THIRD, query, sql_audit, sql_marked, sql_fixed, sql_hk, sql_joined, table,
)
from vaultwright.spec import BATCH_ID, PASS_NULLS, HubSpec, SatSpec

HUB_CUSTOMER = HubSpec("CUSTOMER", "c_custkey")
SAT_CUSTOMER = SatSpec("SAT_CUSTOMER", HUB_CUSTOMER, ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))
SAT_CUSTOMER_BY_KEY = SatSpec("SAT_CUSTOMER", HUB_CUSTOMER, SAT_CUSTOMER.attributes, policy="key")
SAT_CUSTOMER_LATEST = SatSpec("SAT_CUSTOMER", HUB_CUSTOMER, SAT_CUSTOMER.attributes, history="latest")
SAT_LNK_ORDER = SatSpec(
    "SAT_LNK_ORDER", LNK_ORDER, ("o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    rule=PASS_NULLS, hash_parent=False,
)
SAT_LNK_ITEM = SatSpec(
    "SAT_LNK_ITEM", LNK_ITEM,
    ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"),
)

_CUSTOMER_DIFF = f"""upper(md5({sql_marked(
    'c_name', 'c_nationkey', sql_fixed('c_acctbal'), 'c_mktsegment', sql_hk('c_custkey'))}))"""


def _customers(source: str, batch) -> str:
    return f"""SELECT DISTINCT {sql_hk('c_custkey')} AS CUSTOMER_HK, {_CUSTOMER_DIFF} AS HASH_DIFF, c_name, c_nationkey,
                      c_acctbal, c_mktsegment, {sql_audit('CUSTOMER.CSV', batch)} FROM {source}"""


_BEFORE = """(SELECT * REPLACE (CASE WHEN c_mktsegment = 'BUILDING' THEN 'UNNAMED' ELSE c_mktsegment END AS c_mktsegment)
              FROM customer WHERE c_acctbal >= 0) AS b"""

_ORDER_DIFF = "upper(md5({}))".format(
    sql_joined("o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", sep="")
)
_ORDER_VERSIONS = f"""SELECT DISTINCT {SQL_ORDER_HK} AS CUSTOMER_ORDER_HK, {_ORDER_DIFF} AS HASH_DIFF, o_orderstatus,
                             o_totalprice, o_orderdate, o_orderpriority"""


def _customers_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "UNNAMED").otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0).withColumn("c_mktsegment", segment)


def _incremental(spark: SparkSession, sf_dir: str, spec: SatSpec) -> DataFrame:
    stored = build.sat_rows(_customers_before(spark, sf_dir), spec, "customer.csv", FIRST.ts)
    keep = partial(newrows.new_versions, target=stored, spec=spec)
    return build.sat_rows(table(spark, sf_dir, "customer"), spec, "customer.csv", SECOND.ts, keep=keep)


@query(_customers("customer", FIRST))
def sat_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.sat_rows(table(spark, sf_dir, "customer"), SAT_CUSTOMER, "customer.csv", FIRST.ts)


@query(f"""
    {_customers('customer', SECOND)}
    WHERE c_custkey NOT IN (SELECT c_custkey FROM {_BEFORE})
""")
def sat_incremental_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir, SAT_CUSTOMER_BY_KEY)


@query(f"""
    {_customers('customer', SECOND)}
    WHERE {_CUSTOMER_DIFF} NOT IN (SELECT {_CUSTOMER_DIFF} FROM {_BEFORE})
""")
def sat_incremental_by_hashdiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir, SAT_CUSTOMER)


@query(f"""
    SELECT *, '{FIRST.id}' AS BATCH_ID FROM ({_customers('customer', FIRST)}) AS a
    UNION ALL
    SELECT *, '{SECOND.id}' AS BATCH_ID FROM ({_customers(_BEFORE, SECOND)} WHERE c_mktsegment = 'UNNAMED') AS b
    UNION ALL
    SELECT *, '{THIRD.id}' AS BATCH_ID
    FROM ({_customers('customer', THIRD)} WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING') AS c
""")
def sat_history_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segment loses its name in the second batch and has it again in the third:
    compared with the latest version, the return is a version of its own."""
    customers, vault = table(spark, sf_dir, "customer"), fresh_vault(spark)
    for batch, feed in ((FIRST, customers), (SECOND, _customers_before(spark, sf_dir)), (THIRD, customers)):
        vault.load_satellite(feed, SAT_CUSTOMER_LATEST, "customer.csv", batch)
    return vault.read(SAT_CUSTOMER_LATEST, customers).select(*SAT_CUSTOMER_LATEST.columns, BATCH_ID)


@query(f"{_ORDER_VERSIONS}, {sql_audit('ORDERS.CSV')} FROM orders")
def linksat_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.sat_rows(table(spark, sf_dir, "orders"), SAT_LNK_ORDER, "orders.csv", FIRST.ts)


@query(f"""
    {_ORDER_VERSIONS}, {sql_audit('ORDERS.CSV', SECOND)} FROM orders
    WHERE ({SQL_ORDER_HK}, {_ORDER_DIFF}) NOT IN (
        SELECT ({SQL_ORDER_HK}, {_ORDER_DIFF})
        FROM (SELECT * REPLACE (CASE WHEN o_orderpriority = '1-URGENT' THEN 'O' ELSE o_orderstatus END AS o_orderstatus)
              FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_THROUGH}') AS b)
""")
def linksat_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderpriority") == "1-URGENT", "O").otherwise(F.col("o_orderstatus"))
    before = loaded_orders(spark, sf_dir).withColumn("o_orderstatus", status)
    stored = build.sat_rows(before, SAT_LNK_ORDER, "orders.csv", FIRST.ts)
    keep = partial(newrows.new_versions, target=stored, spec=SAT_LNK_ORDER)
    return build.sat_rows(table(spark, sf_dir, "orders"), SAT_LNK_ORDER, "orders.csv", SECOND.ts, keep=keep)


@query(f"""
    SELECT DISTINCT {SQL_ITEM_HK} AS ITEM_HK,
           upper(md5({sql_marked(
               sql_fixed('l_quantity'), sql_fixed('l_extendedprice'), sql_fixed('l_discount'), sql_fixed('l_tax'),
               'l_returnflag', 'l_linestatus', 'l_shipdate', SQL_ITEM_HK)})) AS HASH_DIFF,
           l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
           {sql_audit('LINEITEM.CSV')}
    FROM lineitem
""")
def linksat_wide_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.sat_rows_by_count(table(spark, sf_dir, "lineitem"), SAT_LNK_ITEM, "lineitem.csv", FIRST.ts)


HUB_PRIORITY = HubSpec("PRIORITY", "code")
SAT_PRIORITY = SatSpec("SAT_PRIORITY", HUB_PRIORITY, ("label",))


@query(f"""
    SELECT DISTINCT {sql_hk("split_part(o_orderpriority, '-', 1)")} AS PRIORITY_HK,
           split_part(o_orderpriority, '-', 1) AS PRIORITY_BK,
           upper(md5(split_part(o_orderpriority, '-', 2) || '||' || {sql_hk("split_part(o_orderpriority, '-', 1)")})) AS HASH_DIFF,
           split_part(o_orderpriority, '-', 2) AS label
    FROM orders
""")
def code_hub_sat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code list as hub and satellite, taken from its use in the whole orders table."""
    codes = table(spark, sf_dir, "orders").select(
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("code"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("label"),
    )
    hub = build.hub_rows(codes, HUB_PRIORITY, "orders.csv", FIRST.ts).select("PRIORITY_HK", "PRIORITY_BK")
    sat = build.sat_rows(codes, SAT_PRIORITY, "orders.csv", FIRST.ts, copies="many").select("PRIORITY_HK", "HASH_DIFF", "label")
    return hub.join(sat, "PRIORITY_HK")
