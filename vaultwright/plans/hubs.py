"""Hub loads. The order hub is fed by lineitem first, then by orders."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwright.loading.vault import Vault
from vaultwright.operators import build, newrows
from vaultwright.plans.cleansing import null_where
from vaultwright.plans.registry import FIRST, SECOND, query, sql_audit, sql_hk, table
from vaultwright.session import scratch_path
from vaultwright.sources.store import FolderStore
from vaultwright.spec import BATCH_ID, HubSpec

HUB_CUSTOMER = HubSpec("CUSTOMER", "o_custkey")
HUB_ORDER = HubSpec("ORDER", "o_orderkey")
HUB_ORDER_OF_ITEM = HubSpec("ORDER", "l_orderkey")

_STORED = f"""SELECT DISTINCT {sql_hk('l_orderkey')} AS ORDER_HK, cast(l_orderkey as varchar) AS ORDER_BK,
                     {sql_audit('LINEITEM.CSV')} FROM lineitem"""
_NEW = f"""SELECT DISTINCT {sql_hk('o_orderkey')} AS ORDER_HK, cast(o_orderkey as varchar) AS ORDER_BK,
                  {sql_audit('ORDERS.CSV', SECOND)}
           FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""


def fresh_vault(spark: SparkSession) -> Vault:
    return Vault(FolderStore(spark, scratch_path(spark, "vault")))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.hub_rows(table(spark, sf_dir, "lineitem"), HUB_ORDER_OF_ITEM, "lineitem.csv", FIRST.ts)


@query(f"""
    SELECT DISTINCT {sql_hk('o_custkey')} AS CUSTOMER_HK, cast(o_custkey as varchar) AS CUSTOMER_BK,
           {sql_audit('ORDERS.CSV')} FROM orders
""")
def hub_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.hub_rows(table(spark, sf_dir, "orders"), HUB_CUSTOMER, "orders.csv", FIRST.ts)


@query(_NEW)
def hub_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = partial(newrows.new_rows, target=_stored(spark, sf_dir), on=HUB_ORDER.match, packed=True)
    return build.hub_rows(table(spark, sf_dir, "orders"), HUB_ORDER, "orders.csv", SECOND.ts, keep=keep)


@query(_NEW)
def hub_incremental_semi_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    keep = partial(
        newrows.new_rows_by_size,
        target=_stored(spark, sf_dir), on=HUB_ORDER.match, row_bound=orders.count(), packed=True,
    )
    return build.hub_rows(orders, HUB_ORDER, "orders.csv", SECOND.ts, keep=keep)


@query(f"""
    SELECT *, '{FIRST.id}' AS BATCH_ID FROM ({_STORED}) AS stored
    UNION ALL
    SELECT *, '{SECOND.id}' AS BATCH_ID FROM ({_NEW}) AS added
""")
def hub_after_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    vault = fresh_vault(spark)
    vault.load_hub([(items, HUB_ORDER_OF_ITEM, "lineitem.csv")], FIRST)
    vault.load_hub([(orders, HUB_ORDER, "orders.csv")], SECOND)
    vault.load_hub([(orders, HUB_ORDER, "orders.csv")], SECOND)  # a retry changes nothing
    return vault.read(HUB_ORDER, orders).select(*HUB_ORDER.columns, BATCH_ID)


@query(f"""
    SELECT *, '{FIRST.id}' AS BATCH_ID FROM ({_STORED}) AS stored
    UNION ALL
    SELECT *, '{SECOND.id}' AS BATCH_ID FROM ({_NEW}) AS added
""")
def hub_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh replaces what its file brought before; what another file brought stays."""
    vault, orders = fresh_vault(spark), table(spark, sf_dir, "orders")
    vault.load_hub([(table(spark, sf_dir, "lineitem"), HUB_ORDER_OF_ITEM, "lineitem.csv")], FIRST)
    vault.load_hub([(orders.withColumn("o_orderkey", -F.col("o_orderkey") - 1), HUB_ORDER, "orders.csv")], FIRST)
    Vault(vault.store, refresh=True).load_hub([(orders, HUB_ORDER, "orders.csv")], SECOND)
    return vault.read(HUB_ORDER, orders).select(*HUB_ORDER.columns, BATCH_ID)


@query(f"{_STORED} UNION ALL {_NEW.replace(str(SECOND.ts), str(FIRST.ts))}")
def hub_multi_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = [
        (table(spark, sf_dir, "lineitem"), HUB_ORDER_OF_ITEM, "lineitem.csv"),
        (table(spark, sf_dir, "orders"), HUB_ORDER, "orders.csv"),
    ]
    return build.hub_rows_from_feeds(feeds, FIRST.ts)


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS o_custkey
    FROM orders WHERE o_orderstatus = 'P'
""")
def null_key_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = null_where(table(spark, sf_dir, "orders"), "o_custkey", F.col("o_orderstatus") == "P")
    return build.rejected_rows(orders.select("o_orderkey", "o_custkey"), ["o_orderkey", "o_custkey"])


@query(f"""
    SELECT ORDER_HK, LOADED_FROM, o_custkey
    FROM (SELECT {sql_hk('o_orderkey')} AS ORDER_HK, o_custkey FROM orders) AS batch
    LEFT JOIN (SELECT ORDER_HK AS HELD, RECORD_SOURCE AS LOADED_FROM FROM ({_STORED}) AS s) AS stored ON HELD = ORDER_HK
""")
def right_outer_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, sf_dir)
    held = stored.select("ORDER_HK", F.col("RECORD_SOURCE").alias("LOADED_FROM"))
    orders = table(spark, sf_dir, "orders").select(build.hash_key("o_orderkey").alias("ORDER_HK"), "o_custkey")
    return newrows.right_outer_using(held, orders, "ORDER_HK")


@query(f"""
    SELECT HELD AS ORDER_HK, LOADED_FROM, r_ORDER_HK, r_o_custkey
    FROM (SELECT {sql_hk('o_orderkey')} AS r_ORDER_HK, o_custkey AS r_o_custkey FROM orders) AS batch
    LEFT JOIN (SELECT ORDER_HK AS HELD, RECORD_SOURCE AS LOADED_FROM FROM ({_STORED}) AS s) AS stored ON HELD = r_ORDER_HK
""")
def right_outer_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, sf_dir)
    held = stored.select("ORDER_HK", F.col("RECORD_SOURCE").alias("LOADED_FROM"))
    orders = table(spark, sf_dir, "orders").select(
        build.hash_key("o_orderkey").alias("r_ORDER_HK"), F.col("o_custkey").alias("r_o_custkey")
    )
    return newrows.right_outer_on(held, orders, "ORDER_HK", "r_ORDER_HK")
