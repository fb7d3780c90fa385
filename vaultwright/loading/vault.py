"""Loads into a stored vault. Every load is: rows of the batch, minus what earlier
batches stored, written in place of any earlier try of the same batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, LongType, StringType, StructField, StructType, TimestampType

from vaultwright.functions.hashing import hash_key
from vaultwright.loading.staging import stage
from vaultwright.operators.build import (
    complete_rows, finish_hub_rows, finish_sat_rows, hub_rows, hub_rows_from_feeds, keep_all, link_rows, one_per_version, rejected_rows, sat_hashes, sat_rows_by_count,
    with_version,
)
from vaultwright.operators.checks import pk_violations, violations
from vaultwright.operators.joins import equal, fits_broadcast, pack, renamed, unpack
from vaultwright.operators.newrows import new_rows, new_rows_by_size, new_versions, newest_versions, number_keys, renewed_versions, rows_among
from vaultwright.operators.surrogate import surrogate_key
from vaultwright.operators.views import create_stage_view
from vaultwright.session import scratch_path
from vaultwright.sources.csv import RAW_LINE
from vaultwright.sources.store import FolderStore
from vaultwright.spec import BATCH_ID, FEED, HASH_DIFF, LOAD_DATE, RECORD_SOURCE, VERSION, Batch, HubSpec, LinkSpec, SatSpec, StageSpec


@dataclass(frozen=True)
class LoadResult:
    table: str
    mode: str  # "initial", "incremental" or "refresh"


def _new_keys(rows: DataFrame, target: DataFrame, on: Sequence[str], row_bound: int, packed: bool) -> DataFrame:
    if not fits_broadcast(rows, row_bound, on) and target.count() > row_bound:
        # Facts repeat keys: counting the distinct ones is cheaper than shuffling a
        # table larger than all of the batch.
        row_bound = rows.select(*on).count()
    return new_rows_by_size(rows, target, on, row_bound=row_bound, packed=packed)


def _stage_table(spec: StageSpec) -> str:
    return f"STAGE_{spec.name.upper()}"


class Vault:
    """A raw vault in a store. One writer per table at a time.

    With ``refresh`` every load replaces what its feed brought in any batch instead of
    adding what is new. What other feeds brought to a shared hub stays.
    """

    def __init__(self, store: FolderStore, *, refresh: bool = False) -> None:
        self.store, self.refresh = store, refresh

    def stage(self, raw: DataFrame, spec: StageSpec, keys: Sequence[str] = ()) -> DataFrame:
        """Refresh the stage table and return it as read back.

        ``keys`` are the business keys, which take no default.

        The written table is what the loads of a batch share: the file is scanned
        and cleansed once, and nothing has to be computed again from it when an
        executor is lost.
        """
        staged = stage(raw, spec, keys)
        self.store.replace_table(_stage_table(spec), staged)
        return self.staged(spec)

    def has_staged(self, spec: StageSpec) -> bool:
        return self.store.has_table(_stage_table(spec))

    def staged(self, spec: StageSpec) -> DataFrame:
        return self.store.read_table(_stage_table(spec))

    def create_view(self, spec: StageSpec) -> str:
        """Create or replace the view of a stage table; returns a status text."""
        return create_stage_view(self.staged(spec), spec.name)

    def reject(
        self, staged: DataFrame, name: str, keys: Sequence[str], batch: Batch, unfit: DataFrame | None = None
    ) -> None:
        """Keep the rows that no hub can take, those without a business key, and the
        raw text of the ``unfit`` lines that could not be read."""
        rows = rejected_rows(staged, keys).withColumn(RAW_LINE, F.lit(None).cast("string"))
        if unfit is not None:
            rows = rows.unionByName(unfit.select(RAW_LINE), allowMissingColumns=True)
        self.store.replace_batch(f"REJECTED_{name.upper()}", rows, batch.id, name)

    def check(self, spec: StageSpec, batch: Batch) -> DataFrame:
        """Check the stage table against its declared constraints; returns what was
        written to ``VIOLATIONS_<stage>``. Parents are the stage tables there are."""
        parents = {
            column: (self.store.read_table(f"STAGE_{parent.upper()}"), key)
            for column, (parent, key) in spec.foreign_keys.items() if self.store.has_table(f"STAGE_{parent.upper()}")
        }
        found = violations(
            self.staged(spec), primary_key=spec.primary_key, not_null=spec.not_null, lengths=spec.lengths, parents=parents)
        table = f"VIOLATIONS_{spec.name.upper()}"
        self.store.replace_batch(table, found, batch.id, spec.name)
        return self.store.read(table, found.schema).where((F.col(BATCH_ID) == batch.id) & (F.col(FEED) == spec.name)).select(*found.columns)

    def number(self, rows: DataFrame, keys: Sequence[str], name: str, source: str, batch: Batch, *, column: str = "ID") -> DataFrame:
        """``rows`` with a surrogate id that a key keeps over all batches.

        The ids are kept in the table ``IDS_<name>``. Keys that no earlier batch held get the
        numbers after the highest there is, in key order; a repeated batch gets the same
        again. NULL is a key like any other. One source numbers a table.
        """
        table, keyed = f"IDS_{name.upper()}", rows.select(*keys).distinct()
        schema = StructType([*keyed.schema.fields, StructField(column, LongType())])
        self.store.check_order(table, batch.id)
        start, new = 1, keyed
        if self.store.exists(table, schema):
            held = self.store.read_others(table, schema, batch.id, source)
            start = (held.agg(F.max(column)).first()[0] or 0) + 1
            new = new_rows(keyed, held, keys, null_safe=keys)
        self.store.replace_batch(table, surrogate_key(new, keys, column, start=start), batch.id, source)
        ids = self.store.read(table, schema).where(F.col(BATCH_ID) <= batch.id)
        same = equal("", "id_", keys, keys)
        return rows.join(renamed(ids, [*keys, column], "id_"), same).select(F.col("id_" + column).alias(column), *rows.columns)

    def check_table(self, spec: HubSpec | LinkSpec | SatSpec, staged: StructType, batch: Batch) -> DataFrame:
        """Check what one batch stored in a vault table; returns what was written to ``VIOLATIONS_<table>``.

        Its key must be unique over the whole table, no key, hash or audit column may be
        NULL, and hashes have 32 characters at most. Of the batches before only the keys are read, those
        of this batch where they lie if it is small.
        """
        stored = self.store.read(spec.name, spec.schema(staged))
        rows = stored.where(F.col(BATCH_ID) == batch.id)
        key = [spec.hk, HASH_DIFF] if isinstance(spec, SatSpec) else [spec.hk]
        hashes = [c for c in spec.columns if c.endswith("_HK") or c == HASH_DIFF]
        found = violations(rows, not_null=[*dict.fromkeys([*hashes, RECORD_SOURCE, LOAD_DATE])], lengths=dict.fromkeys(hashes, 32))
        own = rows.select(*key).distinct()
        bound = rows.count()
        own = F.broadcast(own) if fits_broadcast(own, bound, key) else own
        repeated = pk_violations(stored.where(F.col(BATCH_ID) <= batch.id).select(*key).join(own, key, "left_semi"), key)
        found = found.unionByName(repeated.select(
            F.lit("primary_key").alias("rule"), F.lit(",".join(key)).alias("column_name"), F.concat_ws("||", *key).alias("key"), "row_count"))
        table = f"VIOLATIONS_{spec.name.upper()}"
        self.store.replace_batch(table, found, batch.id, spec.name)
        return self.store.read(table, found.schema).where((F.col(BATCH_ID) == batch.id) & (F.col(FEED) == spec.name)).select(*found.columns)

    def load_hub(
        self, feeds: Sequence[tuple[DataFrame, HubSpec, str]], batch: Batch, row_bound: int | None = None, *,
        shared: bool = False,
    ) -> LoadResult:
        """Load a hub from its sources (staged frame, hub on its key, source name).

        A hub that files of several jobs feed is ``shared``: beside it is kept which feed ever
        brought which key, so that a refresh of one feed takes no key that another holds.

        ``row_bound``, here and below, is the row count of the staged frames where
        the caller has it already.
        """
        feed = "+".join(source for _, _, source in feeds)
        build = partial(hub_rows_from_feeds, feeds, batch.ts)
        kinds = {staged.schema[hub.key].dataType for staged, hub, _ in feeds}
        kind = kinds.pop() if len(kinds) == 1 else None
        if shared:
            first = [self._remember(*feed_of_one, batch, row_bound) for feed_of_one in feeds]
            if first == [True]:  # the distinct keys were just written down: they are not shuffled again
                build = partial(self._remembered, feeds[0][1], feeds[0][0].schema, kind, feed, batch)
        return self._load(feeds[0][1], build, [staged for staged, _, _ in feeds], feed, batch, row_bound, kind)

    def _unseen(
        self, spec: HubSpec | LinkSpec, target: DataFrame, row_bound: int, kind: DataType | None
    ) -> dict[str, Callable[[DataFrame], DataFrame]]:
        """How to leave out what the target holds. Hubs in plain folders compare numbers, if all business keys
        are of such a ``kind``: they take half the bytes of a hash, and lie where they were made unique."""
        if isinstance(spec, HubSpec) and isinstance(kind, IntegralType) and not self.store.bucketed:
            numbers = number_keys(target, spec, kind)
            return {"keep_keys": partial(_new_keys, target=numbers, on=["key"], row_bound=row_bound, packed=False)}
        return {"keep": partial(_new_keys, target=target, on=spec.match, row_bound=row_bound, packed=not self.store.bucketed)}

    def _members(self, hub: HubSpec) -> str:
        return f"FEEDS_{hub.name}"

    def _member_schema(self, hub: HubSpec, staged: StructType) -> StructType:
        """Plain folders hold the business keys alone: the hash keys follow from them."""
        fields = hub.schema(staged).fields
        return StructType(fields if self.store.bucketed else [f for f in fields if f.name != hub.hk])

    def _with_hash_keys(self, hub: HubSpec, members: DataFrame) -> DataFrame:
        return members if self.store.bucketed else members.withColumn(hub.hk, hash_key(hub.bk))

    def _remembered(
        self,
        hub: HubSpec,
        staged: StructType,
        kind: DataType | None,
        source: str,
        batch: Batch,
        *,
        keep: Callable[[DataFrame], DataFrame] = keep_all,
        keep_keys: Callable[[DataFrame], DataFrame] = keep_all,
    ) -> DataFrame:
        """The hub rows that the feed wrote down in this batch."""
        rows = self.store.read(self._members(hub), self._member_schema(hub, staged))
        rows = rows.where((F.col(BATCH_ID) == batch.id) & (F.col(FEED) == source))
        if keep_keys is not keep_all:  # the numbers are all that this needs to shuffle
            keys = keep_keys(rows.select(F.col(hub.bk).cast(kind).alias("key")))
            return finish_hub_rows(keys.withColumn(hub.hk, hash_key("key")), hub, source, batch.ts)
        return keep(self._with_hash_keys(hub, rows).select(*hub.columns))

    def _remember(self, staged: DataFrame, hub: HubSpec, source: str, batch: Batch, row_bound: int | None) -> bool:
        """Write down the keys that the feed brings and has not brought before; a refresh forgets the others.

        Returns whether these are all the keys that it brings.
        """
        table, schema = self._members(hub), self._member_schema(hub, staged.schema)
        if self.refresh:
            self.store.refresh(table, hub_rows(staged, hub, source, batch.ts).select(*schema.names), batch.id, source, hub.spread)
            return True
        unseen = {}
        if self.store.exists(table, schema):
            target = self.store.read_others(table, schema, batch.id, source).where(F.col(FEED) == source)
            if not target.isEmpty():
                bound = staged.count() if row_bound is None else row_bound
                unseen = self._unseen(hub, self._with_hash_keys(hub, target), bound, staged.schema[hub.key].dataType)
        rows = hub_rows(staged, hub, source, batch.ts, **unseen).select(*schema.names)
        self.store.replace_batch(table, rows, batch.id, source, hub.spread)
        return not unseen

    def _held_by_others(self, hub: HubSpec, schema: StructType, rows: DataFrame, feed: str) -> DataFrame | None:
        """Hub rows of the keys that only the refreshed feed had stored, but other feeds have brought as
        well, as the first of these brought them."""
        held = self._member_schema(hub, schema)
        if not self.store.exists(self._members(hub), held):
            return None
        first = F.min(F.struct(BATCH_ID, FEED, *[c for c in hub.columns if c != hub.hk])).alias("first")
        members = self._with_hash_keys(hub, self.store.read_other_feeds(self._members(hub), held, feed)).groupBy(hub.hk).agg(first)
        there = self.store.read_other_feeds(hub.name, schema, feed).select(hub.hk).union(rows.select(hub.hk))
        kept = new_rows(members.select(hub.hk, "first.*"), there, hub.match).select(*hub.columns, BATCH_ID, FEED)
        path = scratch_path(kept.sparkSession, "kept")
        kept.write.parquet(path)
        return kept.sparkSession.read.schema(kept.schema).parquet(path)

    def load_link(
        self, staged: DataFrame, spec: LinkSpec, source: str, batch: Batch, row_bound: int | None = None
    ) -> LoadResult:
        # Buckets deal the rows out anew, whatever order they come in.
        spec_here = replace(spec, order=()) if self.store.bucketed else spec
        build = partial(link_rows, staged, spec_here, source, batch.ts, rows=row_bound)
        return self._load(spec, build, [staged], source, batch, row_bound)

    def one_row_per_parent(self, staged: DataFrame, spec: SatSpec, source: str, batch: Batch, loaded: LoadResult) -> bool:
        """Whether no parent of the satellite is known to repeat among the staged rows, once the parents are
        ``loaded``. Where that load compared with nothing it stored every key once: two row counts tell."""
        if loaded.mode == "incremental":
            return False
        stored = self.read(spec.parent, staged).where((F.col(BATCH_ID) == batch.id) & (F.col(FEED) == source))
        return stored.count() == complete_rows(staged, spec.parent_keys).count()

    def load_satellite(
        self, staged: DataFrame, spec: SatSpec, source: str, batch: Batch, row_bound: int | None = None, *,
        unique: bool = False,
    ) -> LoadResult:
        """Load a satellite or link satellite; ``unique`` tells that no parent repeats among the staged rows."""
        build = partial(sat_rows_by_count, staged, spec, source, batch.ts, unique=unique)
        return self._load(spec, build, [staged], source, batch, row_bound)

    def _load(
        self,
        spec: HubSpec | LinkSpec | SatSpec,
        build: Callable[..., DataFrame],
        staged: Sequence[DataFrame],
        feed: str,
        batch: Batch,
        row_bound: int | None,
        kind: DataType | None = None,
    ) -> LoadResult:
        if not feed:
            raise ValueError("a load needs the name of its source")
        schema = spec.schema(staged[0].schema)
        self.store.check_order(spec.name, batch.id)
        if self.refresh:
            rows, kept = build(), None
            if isinstance(spec, HubSpec) and self.store.exists(spec.name, schema):
                others = self.store.read_other_feeds(spec.name, schema, feed)
                rows = build(keep=partial(new_rows, target=others, on=spec.match))
                kept = self._held_by_others(spec, schema, rows, feed)
            self.store.refresh(spec.name, rows, batch.id, feed, spec.spread, kept)
            return LoadResult(spec.name, "refresh")
        if not self.store.exists(spec.name, schema):
            self.store.replace_batch(spec.name, build(), batch.id, feed, spec.spread)
            self._renew_current(spec, schema, batch, [])
            return LoadResult(spec.name, "initial")
        target = self.store.read_others(spec.name, schema, batch.id, feed)
        before = self.store.loads_before(spec.name, batch.id, feed)
        bound = sum(df.count() for df in staged) if row_bound is None else row_bound
        if isinstance(spec, SatSpec):
            current, by = self._current(spec, before), spec
            if current is not None:  # one version per parent: what is not among them is new
                target, by = current, replace(spec, history="any")
            rows = self._new_versions(by, build, staged[0], target, feed, batch, bound)
        else:
            rows = build(**self._unseen(spec, target, bound, kind))
        self.store.replace_batch(spec.name, rows, batch.id, feed, spec.spread)
        self._renew_current(spec, schema, batch, before)
        return LoadResult(spec.name, "incremental")

    def _current(self, spec: SatSpec, entries: Sequence[str] | None) -> DataFrame | None:
        """The newest version of every parent in ``entries``, from ``CURRENT_<satellite>``; None if not kept.

        It is kept for satellites that compare with the newest version, in plain folders, for
        the loads that it follows from: after a refresh, a compaction or a reload of
        an older batch the history is read once, and the table kept anew.
        """
        if spec.policy != "hash_diff" or spec.history != "latest" or entries is None:
            return None
        names = [StructField(c, StringType()) for c in spec.version]
        return self.store.read_derived(f"CURRENT_{spec.name}", entries, StructType([*names, StructField(LOAD_DATE, TimestampType())]))

    def _renew_current(self, spec: HubSpec | LinkSpec | SatSpec, schema: StructType, batch: Batch, before: Sequence[str] | None) -> None:
        """Bring ``CURRENT_<satellite>`` from the loads ``before`` to those there are now; a repeated load finds both."""
        if not isinstance(spec, SatSpec) or spec.policy != "hash_diff" or spec.history != "latest":
            return
        entries = self.store.loads_before(spec.name, batch.id, None)
        if before is None or entries is None:
            return

        def versions(of: Sequence[str]) -> DataFrame:
            return with_version(self.store.read_loads(spec.name, schema, of), spec).select(*spec.version, LOAD_DATE)

        current = self._current(spec, before)
        if current is None:
            rows = newest_versions(versions(entries), spec.version)
        else:
            fresh = versions([entry for entry in entries if entry not in before])
            rows = renewed_versions(current, fresh, spec.version, row_bound=fresh.count())
        self.store.write_derived(f"CURRENT_{spec.name}", entries, rows, before)

    def current(self, spec: SatSpec, batch: Batch) -> DataFrame | None:
        """Key, version and load date of the newest version of each parent after ``batch``, if that is kept."""
        return self._current(spec, self.store.loads_before(spec.name, batch.id, None))

    def _new_versions(
        self,
        spec: SatSpec,
        build: Callable[..., DataFrame],
        staged: DataFrame,
        target: DataFrame,
        source: str,
        batch: Batch,
        row_bound: int,
    ) -> DataFrame:
        """Rows of the versions to insert.

        A large batch first finds them by their hashes alone and writes those down. Mostly a batch repeats what is stored: the few new versions then
        fit a broadcast, and the wide rows are filtered where they lie. Only what
        remains is grouped.
        """
        if fits_broadcast(staged, row_bound, spec.match):
            return build(keep=partial(new_versions, target=target, spec=spec, row_bound=row_bound))
        spark, path = staged.sparkSession, scratch_path(staged.sparkSession, "versions")
        hashes = sat_hashes(staged, spec)
        target = target if VERSION in target.columns else with_version(target, spec)
        batch_keys, target_keys = hashes.select(*spec.match), target.select(*spec.match, LOAD_DATE)
        if self.store.bucketed:  # the stored side is partitioned by the text already
            fresh = new_versions(batch_keys.distinct(), target_keys, spec)
        else:
            packed_keys = pack(batch_keys, spec.match).distinct()
            fresh = unpack(new_versions(packed_keys, pack(target_keys, spec.match), spec), spec.match)
        fresh.write.parquet(path)
        fresh = spark.read.parquet(path)
        if fits_broadcast(staged, fresh.count(), spec.match):
            rows = one_per_version(rows_among(hashes, F.broadcast(fresh), spec), spec)
            return finish_sat_rows(rows, spec, source, batch.ts)
        return build(keep=partial(rows_among, fresh=fresh, spec=spec))

    def read(self, spec: HubSpec | LinkSpec | SatSpec, staged: DataFrame) -> DataFrame:
        return self.store.read(spec.name, spec.schema(staged.schema))
