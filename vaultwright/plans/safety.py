"""Loads that must lose nothing: shared hubs, batch order, missing keys, hash identity, damaged files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwright import functions as V
from vaultwright.loading.motorsport import LNK_CIRCUITS_CONSTRUCTOR, RACES, load_circuits_constructor, run_files
from vaultwright.loading.vault import Vault
from vaultwright.plans.hubs import HUB_ORDER, fresh_vault
from vaultwright.plans.jobs import _circuits, _races, _results
from vaultwright.plans.links import LNK_ORDER
from vaultwright.plans.registry import FIRST, SECOND, THIRD, query, sql_escaped, sql_hk, sql_joined, table
from vaultwright.session import scratch_path
from vaultwright.sources.csv import RAW_LINE, read_csv, write_csv
from vaultwright.sources.store import FolderStore
from vaultwright.spec import BATCH_ID, FEED, LONG, PASS_NULLS, REAL, TEXT, Batch, HubSpec, SatSpec, columns

HUB_CUSTOMER = HubSpec("CUSTOMER", "c_custkey")


@query(f"""
    SELECT {sql_hk('key')} AS CIRCUIT_HK, cast(key as varchar) AS CIRCUIT_BK, cast(key IN (SELECT s_suppkey FROM supplier) as boolean) AS HAS_SATELLITE
    FROM (SELECT s_suppkey AS key FROM supplier UNION SELECT o_custkey FROM orders) AS keys
""")
def job_refresh_shared_hub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files feed one hub, and both are refreshed, one after the other."""
    vault, folder = fresh_vault(spark), scratch_path(spark, "raw")
    vault.refresh = True
    write_csv(_circuits(table(spark, sf_dir, "supplier")), f"{folder}/circuits.csv")
    write_csv(_races(table(spark, sf_dir, "orders")), f"{folder}/races.csv")
    run_files(spark, vault, folder, FIRST, ["circuits", "races"])
    run_files(spark, vault, folder, SECOND, ["races", "circuits"])
    read = lambda name: vault.store.read_table(name)
    held = read("SAT_CIRCUITS").select("CIRCUIT_HK", F.lit(True).alias("HAS_SATELLITE"))
    return read("HUB_CIRCUITS").join(held, "CIRCUIT_HK", "full").select(
        "CIRCUIT_HK", "CIRCUIT_BK", F.coalesce("HAS_SATELLITE", F.lit(False)).alias("HAS_SATELLITE"))


@query(f"""
    SELECT {sql_hk('o_orderkey')} AS ORDER_HK, cast(o_orderkey as varchar) AS ORDER_BK,
           CASE WHEN year(min(o_orderdate)) < 1995 THEN '8' ELSE '9' END AS BATCH_ID
    FROM orders GROUP BY o_orderkey
""")
def hub_three_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches 8 and 9, then 10, which sorts before them as text and is refused; then 8 again."""
    orders, vault = table(spark, sf_dir, "orders"), fresh_vault(spark)
    early = orders.where(F.year("o_orderdate") < 1995)
    for batch_id, rows in (("8", early), ("9", orders), ("10", orders), ("8", early)):
        try:
            vault.load_hub([(rows, HUB_ORDER, "orders.csv")], Batch(batch_id, datetime(2024, 1, 1)))
        except ValueError:
            if batch_id != "10":
                raise
    return vault.read(HUB_ORDER, orders).select("ORDER_HK", "ORDER_BK", BATCH_ID)


HUB_ORDERER = HubSpec("CUSTOMER", "o_custkey")


@query(f"""
    SELECT {sql_hk('c_custkey')} AS CUSTOMER_HK, cast(c_custkey as varchar) AS CUSTOMER_BK,
           'CUSTOMER.CSV' AS RECORD_SOURCE, '{SECOND.id}' AS BATCH_ID FROM customer WHERE c_acctbal >= 0
    UNION ALL
    SELECT {sql_hk('o_custkey')}, cast(o_custkey as varchar), 'ORDERS.CSV', '{THIRD.id}'
    FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F') AS held
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
""")
def hub_feed_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds of one hub, then each refreshed with fewer keys: a key goes when neither holds it."""
    vault, customer, orders = fresh_vault(spark), table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    vault.load_hub([(customer, HUB_CUSTOMER, "customer.csv")], FIRST, shared=True)
    vault.load_hub([(orders, HUB_ORDERER, "orders.csv")], FIRST, shared=True)
    vault.refresh = True
    vault.load_hub([(customer.where("c_acctbal >= 0"), HUB_CUSTOMER, "customer.csv")], SECOND, shared=True)
    vault.load_hub([(orders.where("o_orderstatus = 'F'"), HUB_ORDERER, "orders.csv")], THIRD, shared=True)
    return vault.read(HUB_CUSTOMER, customer).select("CUSTOMER_HK", "CUSTOMER_BK", "RECORD_SOURCE", BATCH_ID)


class _DiesBeforePublishing(FolderStore):
    def publish(self, table: str, folders: Sequence[str]) -> None:
        raise ConnectionError("lost between write and publish")


@query(f"""
    SELECT {sql_hk('c_custkey')} AS CUSTOMER_HK, c_mktsegment, '{FIRST.id}' AS BATCH_ID FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT {sql_hk('c_custkey')}, c_mktsegment, '{SECOND.id}' FROM customer WHERE c_acctbal < 0
""")
def refresh_interrupted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh that dies after its rows are written leaves the table as it was; the next load goes on from there."""
    vault, customer = fresh_vault(spark), table(spark, sf_dir, "customer")
    spec = SatSpec("SAT_SEGMENT", HUB_CUSTOMER, ("c_mktsegment",))
    vault.load_satellite(customer.where("c_acctbal >= 0"), spec, "customer.csv", FIRST)
    dying = Vault(_DiesBeforePublishing(spark, vault.store.root), refresh=True)
    try:
        dying.load_satellite(customer.withColumn("c_mktsegment", F.lit("LOST")), spec, "customer.csv", SECOND)
    except ConnectionError:
        vault.load_satellite(customer, spec, "customer.csv", SECOND)
    return vault.read(spec, customer).select("CUSTOMER_HK", "c_mktsegment", BATCH_ID)


@query(f"""
    SELECT {sql_hk('c_custkey')} AS CUSTOMER_HK, c_mktsegment, '{FIRST.id}' AS BATCH_ID, c_acctbal >= 0 AS is_current FROM customer
    UNION ALL SELECT {sql_hk('c_custkey')}, 'GONE', '{SECOND.id}', c_mktsegment <> 'BUILDING' FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT {sql_hk('c_custkey')}, c_mktsegment, '{THIRD.id}', true FROM customer WHERE c_acctbal < 0 AND c_mktsegment = 'BUILDING'
""")
def sat_history_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments go, and some come back, the third batch twice: loads compare with the kept newest versions."""
    vault, customer, debt = fresh_vault(spark), table(spark, sf_dir, "customer"), F.col("c_acctbal") < 0
    spec = SatSpec("SAT_SEGMENT", HUB_CUSTOMER, ("c_mktsegment",), history="latest")
    gone = customer.withColumn("c_mktsegment", F.when(debt, "GONE").otherwise(F.col("c_mktsegment")))
    back = customer.withColumn("c_mktsegment", F.when(debt & (F.col("c_mktsegment") != "BUILDING"), "GONE").otherwise(F.col("c_mktsegment")))
    for batch, rows in ((FIRST, customer), (SECOND, gone), (THIRD, back), (THIRD, back)):
        vault.load_satellite(rows, spec, "customer.csv", batch)
    newest = vault.current(spec, THIRD).withColumn("is_current", F.lit(True))
    return vault.read(spec, customer).join(newest, ["CUSTOMER_HK", "HASH_DIFF", "LOAD_DATE"], "left").select(
        "CUSTOMER_HK", "c_mktsegment", BATCH_ID, F.coalesce("is_current", F.lit(False)).alias("is_current"))


@query(f"""
    SELECT {sql_hk('o_orderkey')} AS ORDER_HK, cast(o_orderkey as varchar) AS ORDER_BK, 'ORDERS.CSV' AS RECORD_SOURCE,
           CASE WHEN o_orderstatus = 'F' THEN '{FIRST.id}' WHEN year(o_orderdate) < 1996 THEN '{SECOND.id}' ELSE '{THIRD.id}' END AS BATCH_ID
    FROM orders WHERE NOT (o_orderstatus <> 'F' AND year(o_orderdate) < 1996 AND o_orderpriority = '1-URGENT')
       OR year(o_orderdate) >= 1996 OR o_orderstatus = 'F'
""")
def hub_after_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches are merged into few files, the second is then loaded again with fewer orders, and a third
    compares with what both hold."""
    vault, orders = fresh_vault(spark), table(spark, sf_dir, "orders")
    load = lambda rows, batch: vault.load_hub([(rows, HUB_ORDER, "orders.csv")], batch)
    filled, early = F.col("o_orderstatus") == "F", F.year("o_orderdate") < 1996
    load(orders.where(filled), FIRST)
    load(orders.where(filled | early), SECOND)
    vault.store.compact(HUB_ORDER.name, SECOND.id)
    load(orders.where(filled | (early & (F.col("o_orderpriority") != "1-URGENT"))), SECOND)
    load(orders.where(filled | ~early), THIRD)
    return vault.read(HUB_ORDER, orders).select("ORDER_HK", "ORDER_BK", "RECORD_SOURCE", BATCH_ID)


@query("""
    SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_acctbal < 0, c_custkey) AS ID FROM customer
""")
def surrogate_key_second_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in credit get their ids first; then all come, twice: known ones keep theirs."""
    vault, customer = fresh_vault(spark), table(spark, sf_dir, "customer")
    vault.number(customer.where("c_acctbal >= 0"), ["c_custkey"], "customer", "customer.csv", FIRST)
    vault.number(customer, ["c_custkey"], "customer", "customer.csv", SECOND)
    return vault.number(customer, ["c_custkey"], "customer", "customer.csv", SECOND).select("c_custkey", "c_name", "ID")


@query(f"""
    SELECT 'HUB_CUSTOMER' AS table_name, 'primary_key' AS rule, 'CUSTOMER_HK' AS column_name, {sql_hk('c_custkey')} AS key, 2 AS row_count
    FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'HUB_CUSTOMER', 'not_null', 'RECORD_SOURCE', NULL, n FROM (SELECT count(*) AS n FROM customer WHERE c_acctbal < 0) WHERE n > 0
    UNION ALL SELECT 'SAT_SEGMENT', 'length', 'HASH_DIFF', NULL, n FROM (SELECT count(*) AS n FROM customer WHERE c_acctbal < 0) WHERE n > 0
""")
def vault_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound loads of a hub and a satellite, then a batch that another program wrote past them: keys again,
    without a source, and hashes too long."""
    vault, customer = fresh_vault(spark), table(spark, sf_dir, "customer")
    sat = SatSpec("SAT_SEGMENT", HUB_CUSTOMER, ("c_mktsegment",))
    vault.load_hub([(customer, HUB_CUSTOMER, "customer.csv")], FIRST)
    vault.load_satellite(customer, sat, "customer.csv", FIRST)
    debt = customer.where("c_acctbal < 0").select(V.hash_key("c_custkey").alias("CUSTOMER_HK"))
    hub = vault.read(HUB_CUSTOMER, customer).drop(BATCH_ID, FEED).join(debt, "CUSTOMER_HK", "left_semi")
    versions = vault.read(sat, customer).drop(BATCH_ID, FEED).join(debt, "CUSTOMER_HK", "left_semi")
    vault.store.replace_batch("HUB_CUSTOMER", hub.withColumn("RECORD_SOURCE", F.lit(None).cast("string")), SECOND.id, "other")
    vault.store.replace_batch("SAT_SEGMENT", versions.withColumn("HASH_DIFF", F.concat("HASH_DIFF", F.lit("0"))), SECOND.id, "other")
    found = [
        vault.check_table(spec, customer.schema, batch).select(F.lit(spec.name).alias("table_name"), "*")
        for spec, batch in ((HUB_CUSTOMER, FIRST), (sat, FIRST), (HUB_CUSTOMER, SECOND), (sat, SECOND))
    ]
    return reduce(DataFrame.unionByName, found)


_NO_KEY = "o_orderstatus = 'P'"


@query(f"""
    SELECT 'HUB_CIRCUITS' AS table_name, cast(o_custkey as varchar) AS key FROM orders WHERE NOT {_NO_KEY} GROUP BY o_custkey
    UNION ALL SELECT 'HUB_RACES', cast(o_orderkey as varchar) FROM orders
    UNION ALL SELECT 'REJECTED_RACES', cast(o_orderkey as varchar) FROM orders WHERE {_NO_KEY}
""")
def job_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Races without a circuit, from file to rejects; no hub gets a key that no file held."""
    vault, folder = fresh_vault(spark), scratch_path(spark, "raw")
    orders = table(spark, sf_dir, "orders")
    raw = _races(orders.withColumn("o_custkey", F.when(~F.expr(_NO_KEY), F.col("o_custkey"))))
    write_csv(raw.fillna({"circuitId": -7}).withColumn(
        "circuitId", F.when(F.col("circuitId") == -7, "\\N").otherwise(F.col("circuitId").cast("string"))), f"{folder}/races.csv")
    run_files(spark, vault, folder, FIRST, ["races"])
    keys = {"HUB_CIRCUITS": "CIRCUIT_BK", "HUB_RACES": "RACE_BK", "REJECTED_RACES": "RACEID"}
    parts = [
        vault.store.read_table(name).select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("key"))
        for name, key in keys.items()
    ]
    return parts[0].union(parts[1]).union(parts[2])


SAT_LNK_SHIPPED = SatSpec("SAT_LNK_SHIPPED", LNK_ORDER, ("o_orderpriority", "o_orderdate"), rule=PASS_NULLS, hash_parent=False)
_SHIPPED = "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END"


@query(f"""
    SELECT DISTINCT upper(md5({sql_joined('o_custkey', 'o_orderkey')})) AS CUSTOMER_ORDER_HK,
           upper(md5({sql_joined('p', 'd', sep='')})) AS HASH_DIFF, p AS o_orderpriority, d AS o_orderdate, b AS BATCH_ID
    FROM (SELECT o_custkey, o_orderkey, o_orderpriority AS p, {_SHIPPED} AS d, '{FIRST.id}' AS b FROM orders
          UNION ALL SELECT o_custkey, o_orderkey, 'CHANGED', {_SHIPPED}, '{SECOND.id}' FROM orders WHERE o_orderstatus = 'P')
""")
def linksat_null_hash_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions whose hash diff is NULL still differ by their attributes."""
    orders, vault = table(spark, sf_dir, "orders"), fresh_vault(spark)
    first = orders.withColumn("o_orderdate", F.expr(_SHIPPED))
    changed = F.when(F.col("o_orderstatus") == "P", "CHANGED").otherwise(F.col("o_orderpriority"))
    for batch, rows in ((FIRST, first), (SECOND, first.withColumn("o_orderpriority", changed)), (SECOND, first.withColumn("o_orderpriority", changed))):
        vault.load_satellite(rows, SAT_LNK_SHIPPED, "orders.csv", batch)
    return vault.read(SAT_LNK_SHIPPED, first).select(*SAT_LNK_SHIPPED.columns[:4], BATCH_ID)


@query("""
    SELECT DISTINCT c_custkey, c_acctbal + fine AS c_acctbal FROM customer, (SELECT 0.0::double AS fine UNION ALL SELECT 0.00001::double)
""")
def sat_fine_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances that differ beyond the fourth decimal are versions of their own."""
    customer, vault = table(spark, sf_dir, "customer"), fresh_vault(spark)
    spec = SatSpec("SAT_FINE", HUB_CUSTOMER, ("c_custkey", "c_acctbal"))
    both = customer.union(customer.withColumn("c_acctbal", F.col("c_acctbal") + F.lit(0.00001)))
    vault.load_satellite(both, spec, "customer.csv", FIRST)
    return vault.read(spec, both).select("c_custkey", "c_acctbal")


@query("""
    SELECT DISTINCT c_custkey, c_mktsegment FROM
        (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS c_mktsegment FROM customer
         UNION ALL SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END FROM customer)
""")
def sat_null_against_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unknown segment and an empty one are two versions, over two batches."""
    customer, vault = table(spark, sf_dir, "customer"), fresh_vault(spark)
    spec, debt = SatSpec("SAT_SEGMENT", HUB_CUSTOMER, ("c_custkey", "c_mktsegment")), F.col("c_acctbal") < 0
    vault.load_satellite(customer.withColumn("c_mktsegment", F.when(debt, "").otherwise(F.col("c_mktsegment"))), spec, "customer.csv", FIRST)
    vault.load_satellite(customer.withColumn("c_mktsegment", F.when(~debt, F.col("c_mktsegment"))), spec, "customer.csv", SECOND)
    return vault.read(spec, customer).select("c_custkey", "c_mktsegment")


@query(f"""
    SELECT p_partkey, upper(md5({sql_escaped('a')} || '||' || {sql_escaped('b')})) AS PAIR_HK
    FROM (SELECT p_partkey, p_brand || '||' || p_name AS a, p_type AS b FROM part
          UNION ALL SELECT p_partkey, p_brand, p_name || '||' || p_type FROM part)
""")
def link_key_text_separator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text keys that hold the separator: both pairs of a part have a key of their own."""
    part = table(spark, sf_dir, "part")
    glued = part.select("p_partkey", F.concat_ws("||", "p_brand", "p_name").alias("a"), F.col("p_type").alias("b")).union(
        part.select("p_partkey", "p_brand", F.concat_ws("||", "p_name", "p_type")))
    return glued.select("p_partkey", V.link_key(glued, ["a", "b"]).alias("PAIR_HK"))


@query("SELECT doc_id, text FROM documents")
def csv_quoted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with quotes, separators and line breaks, written and read back."""
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return read_csv(spark, path, columns(doc_id=LONG, text=TEXT), multi_line=True)


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
           CASE WHEN o_orderstatus = 'P' THEN cast(o_orderkey as varchar) || ',1o5' END AS raw_line FROM orders
""")
def csv_bad_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that are no numbers keep the text of their line."""
    path = scratch_path(spark, "csv")
    price = F.when(F.col("o_orderstatus") == "P", "1o5").otherwise(F.col("o_totalprice").cast("string"))
    write_csv(table(spark, sf_dir, "orders").select("o_orderkey", price.alias("o_totalprice")), path)
    read = read_csv(spark, path, columns(o_orderkey=LONG, o_totalprice=REAL), report=True)
    return read.select("o_orderkey", "o_totalprice", F.col(RAW_LINE).alias("raw_line"))


_FEW = "(SELECT s_suppkey FROM supplier)"


@query(f"""
    SELECT 'foreign_key' AS rule, 'CIRCUITID' AS column_name, cast(o_custkey as varchar) AS key, count(*) AS row_count
    FROM orders WHERE o_custkey NOT IN {_FEW} GROUP BY o_custkey
    UNION ALL SELECT 'primary_key', 'RACEID', cast(o_orderkey as varchar), 2 FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'length', 'NAME', NULL, n FROM (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'P') WHERE n > 0
    UNION ALL SELECT 'not_null', 'CIRCUITID', NULL, n FROM (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'P') WHERE n > 0
""")
def job_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared constraints of the staged races: orphans, repeated keys, names too long."""
    vault, folder = fresh_vault(spark), scratch_path(spark, "raw")
    write_csv(_circuits(table(spark, sf_dir, "supplier")), f"{folder}/circuits.csv")
    orders = table(spark, sf_dir, "orders")
    again = _races(orders.where("o_orderstatus = 'P'")).withColumn("circuitId", F.lit(None).cast("long")).withColumn("name", F.repeat(F.lit("x"), F.lit(300)))
    write_csv(_races(orders).unionByName(again), f"{folder}/races.csv")
    run_files(spark, vault, folder, FIRST, ["circuits", "races"])
    return vault.check(RACES, FIRST)


@query(f"""
    SELECT DISTINCT {sql_hk('o_custkey')} AS CIRCUIT_HK, {sql_hk('l_suppkey')} AS CONSTRUCTOR_HK,
           upper(md5({sql_joined('o_custkey', 'l_suppkey')})) AS CIRCUIT_CONSTRUCTOR_HK
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def job_circuit_constructor_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    vault, folder = fresh_vault(spark), scratch_path(spark, "raw")
    write_csv(_races(table(spark, sf_dir, "orders")), f"{folder}/races.csv")
    run_files(spark, vault, folder, FIRST, ["races"], discard=True)
    write_csv(_results(table(spark, sf_dir, "lineitem")), f"{folder}/results.csv")
    run_files(spark, vault, folder, FIRST, ["results"], discard=True)
    load_circuits_constructor(vault, FIRST)
    return vault.store.read_table(LNK_CIRCUITS_CONSTRUCTOR.name).select(*LNK_CIRCUITS_CONSTRUCTOR.columns[:3])
