"""Files, stage tables, views and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwright.loading.staging import stage
from vaultwright.operators import report
from vaultwright.operators.views import create_stage_view
from vaultwright.plans.cleansing import null_where
from vaultwright.plans.hubs import HUB_ORDER, fresh_vault
from vaultwright.plans.links import LNK_ORDER
from vaultwright.plans.registry import FIRST, query, table
from vaultwright.plans.satellites import SAT_LNK_ORDER
from vaultwright.session import scratch_path
from vaultwright.sources.csv import read_csv, write_csv
from vaultwright.sources.store import FolderStore
from vaultwright.spec import INT, LONG, REAL, TEXT, StageSpec, columns

STAGE_CUSTOMER = StageSpec(
    name="customer",
    schema=columns(
        c_custkey=LONG, c_name=TEXT, c_nationkey=INT, c_acctbal=REAL, c_mktsegment=TEXT
    ),
    source="customer.csv",
    renames={"C_MKTSEGMENT": "SEGMENT"},
    primary_key=("C_CUSTKEY",),
)
STAGE_SUPPLIER = StageSpec(
    name="supplier",
    schema=columns(
        s_suppkey=LONG, s_name=TEXT, s_nationkey=INT, s_acctbal=REAL
    ),
    source="supplier.csv",
    keep_case=("s_name",),
    defaults={"S_NAME": "", "S_NATIONKEY": 0},
    primary_key=("S_SUPPKEY",),
)


@query("SELECT * FROM customer")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "customer"), path)
    return read_csv(spark, path, STAGE_CUSTOMER.schema)


@query("SELECT * FROM orders")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, store = table(spark, sf_dir, "orders"), FolderStore(spark, scratch_path(spark, "store"))
    store.replace_table("ORDERS", orders)
    return store.read_table("ORDERS")


@query("""
    SELECT c_custkey AS C_CUSTKEY, upper(trim(c_name, ' ')) AS C_NAME, c_nationkey AS C_NATIONKEY,
           round(c_acctbal, 4) AS C_ACCTBAL, upper(trim(c_mktsegment, ' ')) AS SEGMENT
    FROM customer
""")
def stage_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fresh_vault(spark).stage(table(spark, sf_dir, "customer"), STAGE_CUSTOMER)


@query("""
    SELECT s_suppkey AS S_SUPPKEY, CASE WHEN s_acctbal < 1000 THEN '' ELSE s_name END AS S_NAME,
           CASE WHEN s_acctbal < 1000 THEN 0 ELSE s_nationkey END AS S_NATIONKEY, round(s_acctbal, 4) AS S_ACCTBAL
    FROM supplier
""")
def reference_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A natural-key stage whose missing cells take the declared defaults."""
    poor = F.col("s_acctbal") < 1000
    raw = null_where(null_where(table(spark, sf_dir, "supplier"), "s_name", poor), "s_nationkey", poor)
    return stage(raw, STAGE_SUPPLIER)


@query("""
    SELECT 'HUB_ORDER' AS table_name, count(DISTINCT o_orderkey) AS row_count, TIMESTAMP '2024-01-01' AS last_load FROM orders
    UNION ALL
    SELECT 'LNK_CUSTOMER_ORDER', count(DISTINCT (o_custkey, o_orderkey)), TIMESTAMP '2024-01-01' FROM orders
    UNION ALL
    SELECT 'SAT_LNK_ORDER',
           count(DISTINCT (o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)),
           TIMESTAMP '2024-01-01' FROM orders
""")
def vault_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, vault = table(spark, sf_dir, "orders"), fresh_vault(spark)
    vault.load_hub([(orders, HUB_ORDER, "orders.csv")], FIRST)
    vault.load_link(orders, LNK_ORDER, "orders.csv", FIRST)
    vault.load_satellite(orders, SAT_LNK_ORDER, "orders.csv", FIRST)
    return report.inventory({spec.name: vault.read(spec, orders) for spec in (HUB_ORDER, LNK_ORDER, SAT_LNK_ORDER)})


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def preview_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.preview(table(spark, sf_dir, "orders"), ["o_orderkey"], 5)


@query("""
    SELECT 1 AS position, 'p_partkey' AS column_name, 'bigint' AS data_type, bool_or(p_partkey IS NULL) AS nullable FROM part
    UNION ALL SELECT 2, 'p_name', 'string', bool_or(p_type = 'ECONOMY') FROM part
    UNION ALL SELECT 3, 'p_brand', 'string', bool_or(p_brand IS NULL) FROM part
    UNION ALL SELECT 4, 'p_type', 'string', bool_or(p_type IS NULL) FROM part
    UNION ALL SELECT 5, 'p_size', 'int', bool_or(p_size IS NULL) FROM part
    UNION ALL SELECT 6, 'p_retailprice', 'double', bool_or(p_retailprice IS NULL) FROM part
""")
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = null_where(table(spark, sf_dir, "part"), "p_name", F.col("p_type") == "ECONOMY")
    return report.schema_report(part)


@query("SELECT * FROM orders")
def stage_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    create_stage_view(table(spark, sf_dir, "orders"), "orders")
    return spark.table("stg_orders")
