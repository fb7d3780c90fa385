"""Rows of one batch for hubs, links and satellites, unique by their key.

Business keys are made unique before they are hashed. The shuffle then carries
the short raw keys, Spark combines copies on the map side, so a key that fills a
third of the batch arrives once per map task, and MD5 runs once per key instead
of once per row. Rows with a NULL business key have no hash key; they are left
out here and reported by ``rejected_rows``.

``keep`` filters rows by what they are matched on, as insert-only-new does. It runs
before the columns that follow from others are added, so its joins do not carry
them. ``keep_keys`` filters the rows of a hub by the business key, in the column ``key``,
before it is hashed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultwright.functions.audit import load_date, record_source
from vaultwright.functions.hashing import hash_diff, hash_key, link_key
from vaultwright.operators.audit import with_audit
from vaultwright.operators.joins import ROW_BYTES, broadcast_limit, equal, renamed
from vaultwright.spec import HASH_DIFF, LOAD_DATE, RECORD_SOURCE, STANDARD, VERSION, HubSpec, LinkSpec, SatSpec

RowFilter = Callable[[DataFrame], DataFrame]


def keep_all(rows: DataFrame) -> DataFrame:
    return rows


def _all_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def complete_rows(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that have all of the business keys."""
    return staged.where(_all_present(keys))


def rejected_rows(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that cannot be loaded because a business key is NULL."""
    return staged.where(~_all_present(keys))


def hub_rows(
    staged: DataFrame, spec: HubSpec, source: str, ts: datetime, *, keep: RowFilter = keep_all, keep_keys: RowFilter = keep_all
) -> DataFrame:
    keys = keep_keys(staged.where(_all_present([spec.key])).select(F.col(spec.key).alias("key")).distinct())
    return finish_hub_rows(keep(keys.select(hash_key("key").alias(spec.hk), "key")), spec, source, ts)


def finish_hub_rows(keys: DataFrame, spec: HubSpec, source: str, ts: datetime) -> DataFrame:
    """Hub rows of hash keys and the keys in the column ``key``."""
    named = keys.select(spec.hk, F.col("key").cast("string").alias(spec.bk))
    return with_audit(named, source, ts).select(*spec.columns)


def hub_rows_from_feeds(
    feeds: Sequence[tuple[DataFrame, HubSpec, str]], ts: datetime, *, keep: RowFilter = keep_all, keep_keys: RowFilter = keep_all
) -> DataFrame:
    """One hub fed by several staged sources, given in order of precedence.

    A key that several sources bring keeps the first of them. All sources go
    through one aggregation with an integer buffer instead of one load each.
    """
    hub = feeds[0][1]
    kinds = {staged.schema[spec.key].dataType for staged, spec, _ in feeds}

    def ranked(rank: int) -> DataFrame:
        staged, spec, _ = feeds[rank]
        key = F.col(spec.key) if len(kinds) == 1 else F.col(spec.key).cast("string")
        return staged.where(_all_present([spec.key])).select(key.alias("key"), F.lit(rank).alias("feed"))

    keys = reduce(DataFrame.unionByName, map(ranked, range(len(feeds))))
    first = keep_keys(keys.groupBy("key").agg(F.min("feed").alias("feed")))
    rows = keep(first.select(hash_key("key").alias(hub.hk), "key", "feed"))
    sources = F.array(*[record_source(source) for _, _, source in feeds])
    return rows.select(
        hub.hk,
        F.col("key").cast("string").alias(hub.bk),
        F.get(sources, F.col("feed")).alias(RECORD_SOURCE),
        load_date(ts).alias(LOAD_DATE),
    )


# Rows that one task brings into order without spilling.
RANGE_ROWS = 2**21


def link_rows(
    staged: DataFrame, spec: LinkSpec, source: str, ts: datetime, *, rows: int | None = None, keep: RowFilter = keep_all
) -> DataFrame:
    """Link rows. ``rows`` is their count before copies are left out, where the caller has it: many are then
    dealt out by it, not by the bytes they are shuffled in."""
    keys = staged.where(_all_present(spec.keys)).select(*spec.keys)
    if spec.order and keep is keep_all:  # ranges of business keys that the shuffle for distinct rows keeps
        parts = -(-(rows or 0) // RANGE_ROWS)
        number = [parts] if parts > staged.sparkSession.sparkContext.defaultParallelism else []
        keys = keys.repartitionByRange(*number, *spec.order).distinct().sortWithinPartitions(*spec.order)
    else:
        keys = keys.distinct()
    rows = keep(keys.select(link_key(keys, spec.keys, spec.rule).alias(spec.hk), *spec.keys))
    hashed = rows.select(*[hash_key(key).alias(f"{entity}_HK") for entity, key in spec.refs.items()], spec.hk)
    return with_audit(hashed, source, ts).select(*spec.columns)


def sat_hashes(staged: DataFrame, spec: SatSpec) -> DataFrame:
    """Parent hash key, hash diff and attributes of every staged row with a parent."""
    keys = spec.parent_keys
    present = staged.where(_all_present(keys))
    parent = hash_key(keys[0]) if isinstance(spec.parent, HubSpec) else link_key(present, keys, spec.parent.rule)
    keyed = present.select(parent.alias(spec.hk), *[F.col(c) for c in spec.attributes])
    attributes = spec.hashed or spec.attributes
    hashed = [*attributes, spec.hk] if spec.hash_parent else list(attributes)
    return with_version(keyed.withColumn(HASH_DIFF, hash_diff(keyed, hashed, spec.rule)), spec)


def with_version(rows: DataFrame, spec: SatSpec) -> DataFrame:
    """Rows of a satellite with what tells their versions apart.

    Where a NULL passes on to the hash diff, that is a second hash of all attributes
    that keeps NULLs, so rows that differ elsewhere stay different.
    """
    if VERSION not in spec.version:
        return rows
    return rows.withColumn(VERSION, F.coalesce(HASH_DIFF, hash_diff(rows, spec.attributes, STANDARD)))


def one_per_version(hashes: DataFrame, spec: SatSpec) -> DataFrame:
    """One row per version of a parent.

    The hash diff is part of the grouping key, so the versions of one busy parent
    spread over all tasks. By the older rules equal hash diffs can stand for unequal
    values (NULL and empty text): the smallest row is kept, whatever order the rows
    arrive in. By the standard rule equal hashes mean equal rows.
    """
    others = [c for c in (spec.hk, HASH_DIFF, *spec.attributes) if c not in spec.version]
    smallest = F.min(F.struct(*others)).alias("row")
    rows = hashes.groupBy(*spec.version).agg(smallest).select(*spec.version, "row.*")
    return rows.select(*dict.fromkeys([spec.hk, HASH_DIFF, *spec.attributes, *spec.version]))


def _versions(staged: DataFrame, spec: SatSpec, copies: str) -> DataFrame:
    if copies == "none":
        return sat_hashes(staged, spec)
    if copies == "many":
        used = dict.fromkeys([*spec.parent_keys, *spec.attributes])
        staged = staged.where(_all_present(spec.parent_keys)).select(*used).distinct()
    return one_per_version(sat_hashes(staged, spec), spec)


def _versions_by_count(staged: DataFrame, spec: SatSpec) -> DataFrame:
    keys = spec.parent_keys
    counts = staged.where(_all_present(keys)).groupBy(*keys).agg(F.count("*").alias("n"))
    repeated = F.col("n") > 1
    # Business keys are texts of any length: what a broadcast would hold is measured.
    key_bytes = sum((F.octet_length(F.col(k).cast("string")) + F.lit(ROW_BYTES) for k in keys), F.lit(0))
    total = counts.agg(
        F.count("*").alias("parents"),
        F.count_if(repeated).alias("repeated"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("repeated_rows"),
        F.coalesce(F.sum(F.when(repeated, key_bytes)), F.lit(0)).alias("repeated_bytes"),
    ).first()
    if not total["repeated"]:
        return _versions(staged, spec, "none")
    if 2 * total["repeated_rows"] <= total["rows"] and total["repeated_bytes"] <= broadcast_limit(staged):
        again = renamed(counts.where(repeated), keys, "again_")
        once = staged.join(F.broadcast(again), equal("", "again_", keys), "left_anti")
        more = staged.join(F.broadcast(again), equal("", "again_", keys), "left_semi")
        return _versions(once, spec, "none").unionByName(_versions(more, spec, "few"))
    return _versions(staged, spec, "many" if total["rows"] >= 2 * total["parents"] else "few")


def finish_sat_rows(versions: DataFrame, spec: SatSpec, source: str, ts: datetime) -> DataFrame:
    return with_audit(versions, source, ts).select(*spec.columns)


def sat_rows(
    staged: DataFrame,
    spec: SatSpec,
    source: str,
    ts: datetime,
    *,
    copies: str = "few",
    keep: RowFilter = keep_all,
) -> DataFrame:
    """Satellite rows, one per parent and hash diff.

    ``copies`` tells how the staged rows repeat, and only changes the work, not the
    result, as long as it is true:

    none  one row per parent, so nothing is grouped and nothing shuffled
    few   rows are grouped once
    many  equal rows are combined before anything is hashed or sorted
    """
    return finish_sat_rows(keep(_versions(staged, spec, copies)), spec, source, ts)


def sat_rows_by_count(
    staged: DataFrame, spec: SatSpec, source: str, ts: datetime, *, unique: bool = False, keep: RowFilter = keep_all
) -> DataFrame:
    """Satellite rows with as little work as the parents' repetition allows.

    With ``unique`` the caller knows that no parent repeats, and nothing is counted.

    The parent keys are counted first, a narrow shuffle that decides over the wide
    one. If only a few parents repeat, and their keys fit a broadcast, the rows of
    all others stay where they are and only the repeated ones are grouped.
    """
    versions = _versions(staged, spec, "none") if unique else _versions_by_count(staged, spec)
    return finish_sat_rows(keep(versions), spec, source, ts)
