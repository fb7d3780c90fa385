"""Gap-free surrogate ids in natural key order, without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vaultwright.session import scratch_path


def surrogate_key(df: DataFrame, keys: Sequence[str], name: str = "ID", *, start: int = 1) -> DataFrame:
    """Number the rows 1, 2, 3 ... in key order.

    The rows are range-partitioned, sorted and written to the shared folder; an id
    is the row's place in its file plus the rows of the files before. Row content
    and input position end the sort key, so rows of one key, however many, still
    split over partitions. Counts and ids read the same written files, also when a
    lost executor makes Spark compute parts again, and the counts read no columns
    of the data.
    """
    spark = df.sparkSession
    order = [*keys, "__content", "__position"]
    path = scratch_path(spark, "surrogate")
    (
        df.withColumns({
            "__content": F.xxhash64(*df.columns),
            "__position": F.monotonically_increasing_id(),
        })
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*df.columns, F.spark_partition_id().alias("__part"))
        .write.parquet(path)
    )
    placed = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row")
    )
    counts = placed.groupBy("__part", "__file").agg(F.count("*").alias("n"))
    # One row per file of the sort: bounded by the shuffle setting, not by the data.
    before = Window.orderBy("__part", "__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    return placed.join(F.broadcast(offsets), "__file").select(
        (F.col("__row") + F.col("__offset") + F.lit(start)).cast("long").alias(name), *df.columns
    )
