"""Insert-only-new: the rows of a batch whose key the target does not hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultwright.operators.build import with_version
from vaultwright.operators.joins import equal, fits_broadcast, pack, renamed, unpack
from vaultwright.spec import LOAD_DATE, VERSION, HubSpec, SatSpec


def new_rows(
    batch: DataFrame,
    target: DataFrame,
    on: Sequence[str],
    *,
    target_unique: bool = True,
    null_safe: Sequence[str] = (),
    packed: bool = False,
) -> DataFrame:
    """Batch rows without a match in the target.

    ``packed`` shuffles the hash keys of both sides as bytes. Leave it out where the rows
    are grouped by ``on``, or the target is bucketed by it: they meet as they are.

    Columns in ``null_safe`` also match where both sides are NULL. The others
    compare plainly: rows grouped by ``on`` then meet the target as they are
    partitioned, while a null-safe comparison would shuffle them once more.

    Where the target can hold a key many times (a satellite by parent), its keys
    are made unique first. That uses the shuffle the join needs anyway, combines
    on the map side, and no busy key lands on one join task.
    """
    held = renamed(pack(target.select(*on), on) if packed else target, on, "held_")
    if not target_unique:
        held = held.distinct()
    rows = (pack(batch, on) if packed else batch).join(held, equal("", "held_", on, null_safe), "left_anti")
    return unpack(rows, on) if packed else rows


def new_rows_small_batch(
    batch: DataFrame, target: DataFrame, on: Sequence[str], *, null_safe: Sequence[str] = ()
) -> DataFrame:
    """The same rows for a batch small enough to broadcast.

    The target is only filtered where it lies, never shuffled. The second
    broadcast holds the matched keys, at most as many as the batch has. Callers
    check the size: see ``new_rows_by_size``.
    """
    wanted = renamed(batch, on, "wanted_")
    held = renamed(target, on, "held_")
    hits = held.join(F.broadcast(wanted), equal("held_", "wanted_", on, null_safe), "left_semi").distinct()
    return batch.join(F.broadcast(hits), equal("", "held_", on, null_safe), "left_anti")


def new_rows_by_size(
    batch: DataFrame,
    target: DataFrame,
    on: Sequence[str],
    *,
    row_bound: int,
    target_unique: bool = True,
    null_safe: Sequence[str] = (),
    packed: bool = False,
) -> DataFrame:
    """The broadcast form where the batch provably fits, else the plain anti join.

    ``row_bound`` is a counted upper bound of the batch rows, such as the row count
    of its stage table, which parquet answers from file footers.
    """
    if fits_broadcast(batch, row_bound, on):
        return new_rows_small_batch(batch, target, on, null_safe=null_safe)
    return new_rows(batch, target, on, target_unique=target_unique, null_safe=null_safe, packed=packed)


def number_keys(target: DataFrame, hub: HubSpec, kind: T.DataType) -> DataFrame:
    """The business keys of a stored hub as numbers, in the column ``key``.

    A number is the same key as its plain text only: a stored "007" is not 7, and gives NULL.
    """
    number = F.col(hub.bk).try_cast(kind)
    return target.select(F.when(number.cast("string") == F.col(hub.bk), number).alias("key"))


def new_versions(
    rows: DataFrame, target: DataFrame, spec: SatSpec, *, row_bound: int | None = None
) -> DataFrame:
    """Satellite rows to insert, under the policy and history of the satellite.

    With ``row_bound``, a small batch takes the broadcast form.
    """
    rows = rows if VERSION in rows.columns else with_version(rows, spec)
    target = target if VERSION in target.columns else with_version(target, spec)
    if spec.policy == "hash_diff" and spec.history == "latest":
        return changed_since_latest(rows, target, spec.version, row_bound=row_bound)
    unique = spec.policy != "key"
    if row_bound is None:
        return new_rows(rows, target, spec.match, target_unique=unique)
    return new_rows_by_size(
        rows, target, spec.match, row_bound=row_bound, target_unique=unique
    )


def changed_since_latest(
    rows: DataFrame, target: DataFrame, version: Sequence[str], *, row_bound: int | None = None
) -> DataFrame:
    """Rows that differ from what their parent held at its latest load.

    ``version`` is the parent's key and what tells its versions apart. Both aggregates
    keep only a timestamp per group, so they combine on the map side and no parent's
    history is gathered in one task. If the keys of at most ``row_bound`` rows fit a
    broadcast, the target is first filtered to the parents of the batch where it lies:
    the rest of its history is never shuffled.
    """
    hk = version[0]
    target = target.select(*version, LOAD_DATE)
    if row_bound is not None and fits_broadcast(rows, row_bound, [hk]):
        wanted = renamed(rows, [hk], "wanted_")
        target = target.join(F.broadcast(wanted), equal("", "wanted_", [hk]), "left_semi")
    seen = (
        renamed(target, [*version, LOAD_DATE], "seen_")
        .groupBy(*["seen_" + c for c in version])
        .agg(F.max("seen_" + LOAD_DATE).alias("seen"))
    )
    last = renamed(target, [hk, LOAD_DATE], "last_").groupBy("last_" + hk).agg(F.max("last_" + LOAD_DATE).alias("last"))
    return (
        rows.join(seen, equal("", "seen_", version), "left")
        .join(last, equal("", "last_", [hk]), "left")
        .where(F.col("seen").isNull() | (F.col("seen") < F.col("last")))
        .select(*rows.columns)
    )


def newest_versions(rows: DataFrame, version: Sequence[str]) -> DataFrame:
    """``version`` and load date of what each parent held at its latest load.

    Several versions of one load are all newest. Dates and versions combine on the map
    side; a parent's history is never gathered in one task.
    """
    hk = version[0]
    versions = rows.groupBy(*version).agg(F.max(LOAD_DATE).alias(LOAD_DATE))
    last = renamed(rows, [hk, LOAD_DATE], "last_").groupBy("last_" + hk).agg(F.max("last_" + LOAD_DATE).alias("last"))
    held = versions.join(last, equal("", "last_", [hk]))
    return held.where(F.col(LOAD_DATE) == F.col("last")).select(*version, LOAD_DATE)


def renewed_versions(current: DataFrame, fresh: DataFrame, version: Sequence[str], *, row_bound: int) -> DataFrame:
    """``newest_versions`` after the rows ``fresh`` were added to those behind ``current``.

    Only the parents of ``fresh``, at most ``row_bound`` rows, are looked at again; if their
    keys fit a broadcast, the others stay where they lie.
    """
    hk = version[0]
    parents = renamed(fresh, [hk], "fresh_").distinct()
    parents = F.broadcast(parents) if fits_broadcast(fresh, row_bound, [hk]) else parents
    same = equal("", "fresh_", [hk])
    touched = current.join(parents, same, "left_semi").unionByName(fresh)
    return current.join(parents, same, "left_anti").unionByName(newest_versions(touched, version))


def rows_among(rows: DataFrame, fresh: DataFrame, spec: SatSpec) -> DataFrame:
    """The satellite rows whose version is among the new ones."""
    wanted = renamed(fresh, spec.match, "fresh_")
    return rows.join(wanted, equal("", "fresh_", spec.match), "left_semi")


def right_outer_using(target: DataFrame, batch: DataFrame, on: str) -> DataFrame:
    """All batch rows with their target match, sharing the key column."""
    return target.join(batch, [on], "right_outer")


def right_outer_on(target: DataFrame, batch: DataFrame, target_key: str, batch_key: str) -> DataFrame:
    """All batch rows with their target match, keys named differently."""
    return target.join(batch, target[target_key] == batch[batch_key], "right_outer")
