"""Load raw files into a vault: ``python -m vaultwright --help``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from vaultwright.loading.motorsport import JOBS, load_circuits_constructor, run_files
from vaultwright.loading.vault import Vault
from vaultwright.session import build_session
from vaultwright.sources.store import FolderStore
from vaultwright.spec import Batch


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="vaultwright", description=__doc__)
    parser.add_argument("--raw", required=True, help="folder of the raw <name>.csv files")
    parser.add_argument("--vault", required=True, help="root folder of the vault")
    parser.add_argument("--batch-id", required=True, help="id that sorts after those of earlier batches")
    parser.add_argument("--batch-ts", required=True, type=datetime.fromisoformat, help="load timestamp, UTC")
    parser.add_argument("--format", default="parquet", help="table format (default: parquet)")
    parser.add_argument("--refresh", action="store_true", help="replace the tables instead of adding to them")
    parser.add_argument("--legacy-hashes", action="store_true", help="hash as vaults of the earlier convention do")
    parser.add_argument("--check", action="store_true", help="check the staged tables and write VIOLATIONS_<stage>")
    parser.add_argument("--pairs", action="store_true", help="load LNK_CIRCUITS_CONSTRUCTOR from staged results and races")
    parser.add_argument("names", nargs="+", choices=list(JOBS), metavar="name", help=", ".join(JOBS))
    options = parser.parse_args(arguments)
    spark = spark or build_session()
    vault = Vault(FolderStore(spark, options.vault, options.format), refresh=options.refresh)
    batch = Batch(options.batch_id, options.batch_ts)
    results = run_files(spark, vault, options.raw, batch, options.names, legacy_hashes=options.legacy_hashes)
    if options.pairs:
        results.append(load_circuits_constructor(vault, batch))
    if options.check:
        for name in options.names:
            print(f"VIOLATIONS_{name.upper()}", vault.check(JOBS[name].stage, batch).count())
    for result in results:
        print(result.table, result.mode)


if __name__ == "__main__":
    main()
