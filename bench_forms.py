"""Compare the forms of insert-only-new on stored hubs of the orders table.

For batches of 0.1 %, 10 % and 100 % of the orders, times the plain anti join, the
semi-then-anti form with broadcasts, and the plain anti join against a bucketed
target. Prints one JSON line per batch size.
"""

from __future__ import annotations

import json
import os
import time
from datetime import datetime

from pyspark.sql import functions as F

from vaultwright.loading.vault import Vault
from vaultwright.operators import build, newrows
from vaultwright.session import build_session, scratch_path
from vaultwright.sources.store import BucketedStore, FolderStore
from vaultwright.spec import Batch, HubSpec

HUB = HubSpec("ORDER", "o_orderkey")


def seconds(df) -> float:
    runs = []
    for _ in range(3):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - start)
    return round(min(runs), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "forms",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__sql__autoBroadcastJoinThreshold="-1",
    )
    spark.sparkContext.setLogLevel("ERROR")
    scratch = scratch_path(spark, "forms")
    spark.sql(f"CREATE DATABASE forms LOCATION '{scratch}/catalog'")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    first, total = Batch("1", datetime(2024, 1, 1)), orders.count()
    targets = {}
    for name, store in (
        ("folder", FolderStore(spark, f"{scratch}/folder")),
        ("bucketed", BucketedStore(spark, f"{scratch}/bucketed", int(cpus), "forms")),
    ):
        Vault(store).load_hub([(orders, HUB, "orders.csv")], first)
        targets[name] = store.read_others(HUB.name, HUB.schema(orders.schema), "2", "orders.csv")
    highest = orders.agg(F.max("o_orderkey")).first()[0]
    for share in (0.001, 0.1, 1.0):
        # Half of the batch is known, half of it new.
        size = int(total * share)
        staged = spark.range(highest - size // 2, highest - size // 2 + size).withColumnRenamed("id", "o_orderkey")
        path = f"{scratch}/batch-{share}"
        build.hub_rows(staged, HUB, "orders.csv", datetime(2024, 1, 2)).write.parquet(path)
        batch = spark.read.parquet(path)
        print(json.dumps({
            "batch_share": share,
            "batch_rows": size,
            "target_rows": total,
            "plain": seconds(newrows.new_rows(batch, targets["folder"], HUB.match, packed=True)),
            "semi_then_anti": seconds(newrows.new_rows_small_batch(batch, targets["folder"], HUB.match)),
            "plain_bucketed": seconds(newrows.new_rows(batch, targets["bucketed"], HUB.match)),
        }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
