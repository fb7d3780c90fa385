"""Fixity audit of web archives by Merkle trees.

Each record is hashed, each range of offsets hashes the hashes of its records in order,
and ``FANOUT`` neighbouring ranges at a time are hashed together up to one root. Two
replicas with equal roots are equal. If the roots differ, only children of differing
nodes are compared, level by level, down to the records.

A record belongs to the range of its offset in the archive's index, which all replicas
share, so a missing or longer record does not move the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vaultwright.llm.common import table, written

FANOUT = 16
RANGE_BYTES = 1 << 18
LEAF, NODE = "leaf:", "node:"


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """A page as a WARC response record; nulls are empty."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: "), text(page_id),
        F.lit("\r\nWARC-Target-URI: "), text(url),
        F.lit("\r\nContent-Length: "), F.octet_length(text(html)).cast("string"),
        F.lit("\r\n\r\n"), text(html), F.lit("\r\n\r\n"),
    )


def leaf_hash(record: Column) -> Column:
    return F.sha2(F.concat(F.lit(LEAF), record), 256)


def with_offsets(records: DataFrame, order: list[str], n_bytes: str) -> DataFrame:
    """``records`` with ``offset``: the bytes of all records before in the given order.

    Rows are dealt out by ranges and written; a row's offset is its place in its part
    and the bytes of the parts before. Rows equal in ``order`` keep their input order.
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    dealt = written(
        records.withColumn("__in", F.monotonically_increasing_id()).repartitionByRange(*by, "__in")
        .sortWithinPartitions(*by, "__in").withColumn("__part", F.spark_partition_id())
        .withColumn("__at", F.monotonically_increasing_id()), "ordered-records")
    earlier = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part: bounded by the partitions of the sort, not by the data.
    parts_before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("__part").agg(F.sum(n_bytes).alias("__n"))
    parts = parts.select("__part", F.coalesce(F.sum("__n").over(parts_before), F.lit(0)).alias("__base"))
    return dealt.withColumn("__before", F.coalesce(F.sum(n_bytes).over(earlier), F.lit(0))).join(
        F.broadcast(parts), "__part").withColumn("offset", (F.col("__base") + F.col("__before")).cast("long")).drop(
        "__part", "__at", "__in", "__base", "__before", "__n")


def _hashed(children: DataFrame, node: Column, order: str) -> DataFrame:
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(order, "hash"))), lambda c: c.hash)
    return children.groupBy(node.alias("node")).agg(F.sha2(F.concat(F.lit(NODE), F.array_join(ordered, "")), 256).alias("hash"))


def merkle_levels(records: DataFrame, n_levels: int, range_bytes: int = RANGE_BYTES) -> list[DataFrame]:
    """Tables ``node``, ``hash``: the ranges first, the root (node 0) last.

    A node gathers the hashes of ``FANOUT`` children or of the records of one range,
    which are at most ``range_bytes`` over the shortest record.
    """
    levels = [written(_hashed(records.select("offset", "hash"), F.floor(F.col("offset") / range_bytes), "offset"), "merkle")]
    for _ in range(n_levels - 1):
        levels.append(written(_hashed(levels[-1], F.floor(F.col("node") / FANOUT), "node"), "merkle"))
    return levels


def audit(a: DataFrame, b: DataFrame, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records that differ between two replicas (``offset``, ``n_bytes``, ``hash`` each).

    ``status`` is missing (only in a), extra (only in b), resized or altered. Equal
    replicas, two empty ones included, give no rows. Records of one offset within a
    replica are compared as a set of hashes.
    """
    once = lambda r: r.select("offset", "n_bytes", "hash").distinct()
    a, b = once(a), once(b)
    last = max((r[0] for r in (a.agg(F.max("offset")).first(), b.agg(F.max("offset")).first()) if r[0] is not None), default=None)
    n_levels, width = 1, 0 if last is None else last // range_bytes
    while width > 0:
        width //= FANOUT
        n_levels += 1
    trees = [merkle_levels(r, n_levels, range_bytes) for r in (a, b)]
    suspects = None
    for level_a, level_b in zip(*(reversed(t) for t in trees), strict=True):
        if suspects is not None:
            parents = suspects.select(F.col("node").alias("parent"))
            level_a, level_b = (
                level.join(parents, F.floor(F.col("node") / FANOUT) == F.col("parent"), "left_semi") for level in (level_a, level_b))
        both = level_a.join(level_b.withColumnRenamed("hash", "other"), "node", "full")
        suspects = written(both.filter(~F.col("hash").eqNullSafe(F.col("other"))).select("node"), "suspects")
        if suspects.isEmpty():
            break
    inside = F.floor(F.col("offset") / range_bytes) == F.col("node")
    left, right = (r.join(suspects, inside, "left_semi") for r in (a, b))
    # What both hold at one offset is sound; of the rest each side is reported once.
    both = right.select("offset", F.col("hash").alias("hash"), F.col("n_bytes").alias("bytes_b"), F.lit(True).alias("in_b"))
    pairs = left.withColumn("in_a", F.lit(True)).join(both, ["offset", "hash"], "full").filter("in_a IS NULL OR in_b IS NULL")
    found = pairs.groupBy("offset").agg(
        F.max("n_bytes").alias("bytes_a"), F.max("bytes_b").alias("bytes_b"),
        F.max(F.when(F.col("in_a"), F.col("hash"))).alias("hash_a"), F.max(F.when(F.col("in_b"), F.col("hash"))).alias("hash_b"))
    status = (
        F.when(F.col("hash_b").isNull(), "missing").when(F.col("hash_a").isNull(), "extra")
        .when(F.col("bytes_a") != F.col("bytes_b"), "resized").otherwise("altered")
    )
    return found.select("offset", "bytes_a", "bytes_b", "hash_a", "hash_b", status.alias("status"))


def replicas(pages: DataFrame) -> DataFrame:
    """The index of an archive of ``pages`` and what a damaged replica holds at each offset.

    Damage strikes by hash of the page id: one in 97 records has a character changed, one
    in 101 lost its end, one in 103 is gone.
    """
    page, record = F.col("page_id"), F.col("record")
    strikes = lambda n: F.pmod(F.xxhash64(page.cast("long")), F.lit(n)) == 0
    middle = F.floor(F.char_length(record) / 2).cast("int")
    changed = F.concat(
        F.substr(record, F.lit(1), middle - 1), F.when(F.substr(record, middle, F.lit(1)) == "#", "!").otherwise("#"),
        F.substr(record, middle + 1))
    damaged = (
        F.when(strikes(103), F.lit(None).cast("string"))
        .when(strikes(101), F.substr(record, F.lit(1), F.char_length(record) - 7))
        .when(strikes(97), changed).otherwise(record)
    )
    hashed = pages.select(page, warc_record(page, F.col("url"), F.col("html")).alias("record")).select(
        "page_id", "record", damaged.alias("damaged")).select(
        "page_id", F.octet_length("record").cast("long").alias("n_bytes"), leaf_hash(record).alias("hash"),
        F.octet_length("damaged").cast("long").alias("bytes_b"), leaf_hash(F.col("damaged")).alias("hash_b"))
    return written(with_offsets(hashed, ["page_id", "hash"], "n_bytes"), "replicas")


def fixity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null pages ids and texts are empty fields of a record; repeated pages are records each."""
    index = replicas(table(spark, sf_dir, "pages"))
    a = index.select("offset", "n_bytes", "hash")
    b = index.filter("hash_b IS NOT NULL").select("offset", F.col("bytes_b").alias("n_bytes"), F.col("hash_b").alias("hash"))
    return audit(a, b).join(index.select("offset", "page_id"), "offset").select(
        "page_id", "offset", "bytes_a", "bytes_b", "hash_a", "hash_b", "status")
