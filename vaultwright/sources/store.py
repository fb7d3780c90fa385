"""Stored tables of a vault: a folder per table, partitioned by batch and feed.

A load replaces only its own partition, so a retry leaves the same table as one
load did. What it compares with is every other partition up to its batch; Spark
prunes the scan to those.

Parquet tables are published at once. A load writes a folder of its own inside the
partition; then one small file in ``_published`` names the folders that make up the
table from now on. A load that dies in between leaves the table as it was, and a
reader never sees half of one. Read a table through its store, not by its path.

Old loads can be merged into few files: their rows then lie in one folder, with batch and
feed as columns, and the publication still names every load, with the folder that holds it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultwright.session import scratch_path
from vaultwright.spec import BATCH_ID, FEED

_MISSING = {
    "PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND",
    "DELTA_TABLE_NOT_FOUND", "DELTA_MISSING_DELTA_TABLE", "DELTA_PATH_DOES_NOT_EXIST",
}


# Hash keys are hexadecimal text: so written they take little more than half the bytes that snappy needs. Repeated ones
# are held once per row group, as far as a dictionary of that size has room.
_PARQUET = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.dictionary.page.size": str(4 * 2**20)}


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in (BATCH_ID, FEED)]])


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _partition(batch_id: str, feed: str) -> str:
    # Spark reads percent-escaped partition folders back as plain text.
    return f"{BATCH_ID}={quote(batch_id, safe='')}/{FEED}={quote(feed, safe='')}"


def _batch_and_feed(folder: str) -> tuple[str, str]:
    """What the name of a published folder says it holds."""
    batch, feed = folder.split("/")[:2]
    return unquote(batch.removeprefix(f"{BATCH_ID}=")), unquote(feed.removeprefix(f"{FEED}="))


# Stands between a load and the folder of merged loads that holds its rows; batch and feed are
# percent-escaped, so it is no part of them.
_WITHIN = "/>"


def _folder(entry: str) -> str:
    """Where the rows of a published load lie."""
    return entry.split(_WITHIN)[-1]


def _merged(entries: Iterable[str]) -> dict[str, list[tuple[str, str]]]:
    """Folders of merged loads, each with the batches and feeds it still stands for."""
    held: dict[str, list[tuple[str, str]]] = {}
    for entry in entries:
        if _WITHIN in entry:
            held.setdefault(_folder(entry), []).append(_batch_and_feed(entry))
    return held


def _of_loads(places: Sequence[tuple[str, str]]) -> Column:
    """Rows of the given batches and feeds."""
    batches: dict[str, list[str]] = {}
    for batch, feed in places:
        batches.setdefault(feed, []).append(batch)
    return reduce(Column.__or__, [(F.col(FEED) == feed) & F.col(BATCH_ID).isin(ids) for feed, ids in sorted(batches.items())])


def _digest(entries: Iterable[str]) -> str:
    return hashlib.md5(json.dumps(sorted(entries)).encode("utf-8")).hexdigest()


def _share_source(feed: str, other: str) -> bool:
    return bool(set(feed.split("+")) & set(other.split("+")))


def _by_partition(rows: DataFrame | None) -> list[tuple[tuple[str, str], DataFrame]]:
    """Rows apart by their batch and feed: at most one part for each load there was."""
    if rows is None:
        return []
    places = rows.select(BATCH_ID, FEED).distinct().collect()
    return [((b, f), rows.where((F.col(BATCH_ID) == b) & (F.col(FEED) == f)).drop(BATCH_ID, FEED)) for b, f in sorted(map(tuple, places))]


def _of_feed(feed: str) -> Column:
    """Rows that one of the sources of ``feed`` brought, alone or with others."""
    own = F.array(*[F.lit(source) for source in feed.split("+")])
    return F.arrays_overlap(F.split(FEED, r"\+"), own)


class FolderStore:
    """Tables below a root folder, in one format (parquet, or delta where installed)."""

    bucketed = False

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet") -> None:
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _files(self, path: str):
        """The Hadoop file system of a path, and the path as it names it."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def remove(self, path: str) -> None:
        """Delete a scratch file or folder."""
        files, path = self._files(path)
        files.delete(path, True)

    @contextmanager
    def written_apart(self, rows: DataFrame, label: str) -> Iterator[DataFrame]:
        """``rows`` as read back from a scratch folder, which goes afterwards."""
        path = scratch_path(self.spark, label)
        try:
            rows.write.options(**_PARQUET).parquet(path)
            yield self.spark.read.schema(rows.schema).parquet(path)
        finally:
            self.remove(path)

    def _names(self, path: str) -> list[str]:
        files, path = self._files(path)
        return [status.getPath().getName() for status in files.listStatus(path)] if files.exists(path) else []

    def published(self, table: str) -> list[str] | None:
        """The folders that make up a table, below its own; None if it was never published."""
        numbers = sorted(name for name in self._names(f"{self.path(table)}/_published") if name.isdigit())
        if not numbers:
            return None
        files, path = self._files(f"{self.path(table)}/_published/{numbers[-1]}")
        stream = files.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()

    def _current(self, table: str) -> list[str]:
        """The published folders; of a table written before there were any, its partitions."""
        folders = self.published(table)
        if folders is not None:
            return folders
        batches = [name for name in self._names(self.path(table)) if name.startswith(f"{BATCH_ID}=")]
        return [f"{batch}/{feed}" for batch in batches for feed in self._names(f"{self.path(table)}/{batch}") if feed.startswith(f"{FEED}=")]

    def publish(self, table: str, folders: Sequence[str]) -> None:
        """Make ``folders`` the table, in one step: a complete file takes its place under the next number.

        A number that is taken means that another writer was at work, which is an error.
        Folders that neither this nor the last publication names are deleted; the last ones stay
        for readers that have begun.
        """
        root = f"{self.path(table)}/_published"
        numbers = sorted(name for name in self._names(root) if name.isdigit())
        before = self.published(table) or []
        files, draft = self._files(f"{root}/_{uuid.uuid4().hex}")
        stream = files.create(draft, False)
        stream.write(bytearray(json.dumps(sorted(folders)).encode("utf-8")))
        stream.close()
        number = f"{int(numbers[-1]) + 1 if numbers else 0:020d}"
        _, target = self._files(f"{root}/{number}")
        if files.exists(target) or not files.rename(draft, target):
            raise RuntimeError(f"another writer published {table} as number {number}")
        for old in self._replaced(table, numbers, {*before, *folders}):
            files.delete(self._files(f"{self.path(table)}/{old}")[1], True)

    def _replaced(self, table: str, numbers: Sequence[str], kept: set[str]) -> list[str]:
        """Folders that the publication before the last named, and that are of no more use."""
        if len(numbers) < 2:
            return []
        files, path = self._files(f"{self.path(table)}/_published/{numbers[-2]}")
        if not files.exists(path):
            return []
        stream = files.open(path)
        try:
            named = json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()
        used = set(map(_folder, kept))
        return [folder for folder in dict.fromkeys(map(_folder, named)) if folder not in used]

    def _scan(self, table: str, schema: T.StructType | None) -> DataFrame:
        folders = None if self.fmt == "delta" else self.published(table)
        if folders is not None:
            return self.read_loads(table, schema, folders)
        reader = self.spark.read.format(self.fmt)
        if schema is not None and self.fmt != "delta":  # a delta table carries its schema
            reader = reader.schema(_stored(schema))
        return reader.load(self.path(table))

    def read_loads(self, table: str, schema: T.StructType | None, entries: Sequence[str]) -> DataFrame:
        """What the published ``entries`` hold; Spark prunes by batch and feed also within merged loads."""
        root, merged = self.path(table), _merged(entries)
        if merged and schema is None:
            found = self.spark.read.format(self.fmt).load(f"{root}/{next(iter(merged))}").schema
            schema = T.StructType([f for f in found.fields if f.name not in (BATCH_ID, FEED)])

        def reader():
            return self.spark.read.format(self.fmt) if schema is None else self.spark.read.format(self.fmt).schema(_stored(schema))

        own = [entry for entry in entries if _WITHIN not in entry]
        # Spark reads an escaped byte of a folder's name as one letter: such names are told here.
        named = [entry for entry in own if entry.startswith(f"{BATCH_ID}=") and not "".join(_batch_and_feed(entry)).isascii()]
        plain = [f"{root}/{entry}" for entry in own if entry not in named]
        parts = [reader().option("basePath", root).load(plain)] if plain or not (merged or named) else []
        for entry in named:
            batch, feed = _batch_and_feed(entry)
            parts.append(reader().load(f"{root}/{entry}").withColumns({BATCH_ID: F.lit(batch), FEED: F.lit(feed)}))
        parts += [reader().load(f"{root}/{folder}").where(_of_loads(places)) for folder, places in merged.items()]
        return reduce(DataFrame.unionByName, parts)

    def exists(self, table: str, schema: T.StructType) -> bool:
        """Whether the table was ever written. Any other failure is raised."""
        try:
            self._scan(table, schema)
        except AnalysisException as error:
            if error.getCondition() in _MISSING:
                return False
            raise
        return True

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        return self._scan(table, schema)

    def read_others(self, table: str, schema: T.StructType, batch_id: str, feed: str) -> DataFrame:
        """What a load compares with: earlier batches, and other feeds of its own."""
        batch = F.col(BATCH_ID)
        return self._scan(table, schema).where((batch < batch_id) | ((batch == batch_id) & (F.col(FEED) != feed)))

    def loads_before(self, table: str, batch_id: str, feed: str | None) -> list[str] | None:
        """The published entries that ``read_others`` reads, or all up to the batch without ``feed``.

        An entry never changes what it holds, so equal entries mean equal rows. None
        for tables that are not published that way.
        """
        entries = None if self.fmt == "delta" else self.published(table)
        if entries is None:
            return None
        places = [(entry, *_batch_and_feed(entry)) for entry in entries]
        return [entry for entry, b, f in places if b < batch_id or (b == batch_id and f != feed)]

    def read_derived(self, table: str, entries: Sequence[str], schema: T.StructType) -> DataFrame | None:
        """What ``write_derived`` kept for exactly these entries of another table; None if there is nothing."""
        part = f"of={_digest(entries)}/"
        for folder in self.published(table) or []:
            if folder.startswith(part):
                return self.spark.read.format(self.fmt).schema(schema).load(f"{self.path(table)}/{folder}")
        return None

    def write_derived(self, table: str, entries: Sequence[str], rows: DataFrame, before: Sequence[str]) -> None:
        """Keep ``rows``, which follow from ``entries``, next to what is kept for the entries ``before``."""
        kept = [folder for folder in self.published(table) or [] if folder.startswith(f"of={_digest(before)}/")]
        self.publish(table, [*kept, self._written(table, rows, f"of={_digest(entries)}")])

    def compact(self, table: str, through: str, *, file_bytes: int = 128 * 2**20) -> int:
        """Merge the loads of batches up to ``through`` into files of about ``file_bytes``; returns how many folders it merged.

        Batch and feed of a row stay, and a load that comes again still replaces its own rows
        only: the publication then no longer names it for the merged folder. Files are
        joined as they lie, without a shuffle, and sorted by batch and feed, so a scan
        skips row groups of other batches. Readers that have begun keep the old
        folders until the next but one publication.
        """
        if self.fmt == "delta":
            raise NotImplementedError("a delta table is compacted by its own means")
        entries = self._current(table)
        old = [entry for entry in entries if _batch_and_feed(entry)[0] <= through]
        folders = set(map(_folder, old))
        if len(folders) < 2:
            return 0
        sizes = [files.getContentSummary(path).getLength() for files, path in (self._files(f"{self.path(table)}/{f}") for f in folders)]
        rows = self.read_table(table).where(F.col(BATCH_ID) <= through)
        target = f"merged/v{uuid.uuid4().hex}"
        few = rows.coalesce(max(1, -(-sum(sizes) // file_bytes))).sortWithinPartitions(BATCH_ID, FEED)
        few.write.format(self.fmt).options(**_PARQUET).save(f"{self.path(table)}/{target}")
        places = [f"{_partition(*_batch_and_feed(entry))}{_WITHIN}{target}" for entry in old]
        self.publish(table, [*[entry for entry in entries if entry not in old], *places])
        return len(folders)

    def batch_ids(self, table: str) -> set[str]:
        """The batches a table holds, by the names of its partitions: no data is read."""
        if self.fmt == "delta":
            try:
                return {r[0] for r in self._scan(table, T.StructType()).select(BATCH_ID).distinct().collect()}
            except AnalysisException as error:
                if error.getCondition() in _MISSING:
                    return set()
                raise
        return {_batch_and_feed(folder)[0] for folder in self._current(table)}

    def check_order(self, table: str, batch_id: str) -> None:
        """Refuse a new batch whose id does not sort after all stored ones.

        Loads compare with the batches that sort before, so such a batch would take
        everything stored for unseen. A stored batch may be loaded again.
        """
        stored = self.batch_ids(table)
        if stored and batch_id not in stored and batch_id < max(stored):
            raise ValueError(f"batch id {batch_id!r} does not sort after {max(stored)!r}, which {table} already holds")

    def replace_batch(
        self, table: str, rows: DataFrame, batch_id: str, feed: str, spread: Sequence[str] = ()
    ) -> None:
        """Write the rows of one load in place of any earlier try of it."""
        if self.fmt == "delta":
            (
                rows.withColumns({BATCH_ID: F.lit(batch_id), FEED: F.lit(feed)})
                .write.format("delta").mode("overwrite").partitionBy(BATCH_ID, FEED)
                .option("replaceWhere", f"{BATCH_ID} = {_literal(batch_id)} AND {FEED} = {_literal(feed)}")
                .save(self.path(table))
            )
            return
        part = _partition(batch_id, feed)
        others = [folder for folder in self._current(table) if _batch_and_feed(folder) != (batch_id, feed)]
        self.publish(table, [*others, self._written(table, rows, part)])

    def _written(self, table: str, rows: DataFrame, part: str) -> str:
        """A new folder with the rows, not yet part of the table."""
        folder = f"{part}/v{uuid.uuid4().hex}" if part else f"v{uuid.uuid4().hex}"
        rows.write.format(self.fmt).options(**_PARQUET).save(f"{self.path(table)}/{folder}")
        return folder

    def read_other_feeds(self, table: str, schema: T.StructType, feed: str) -> DataFrame:
        """What a refresh leaves: the rows that only other feeds brought."""
        return self._scan(table, schema).where(~_of_feed(feed))

    def refresh(
        self, table: str, rows: DataFrame, batch_id: str, feed: str, spread: Sequence[str] = (), kept: DataFrame | None = None
    ) -> None:
        """Write the rows of one load in place of all that its feed brought in any batch.

        What other feeds brought stays where it lies; table and rows change over in one step.
        ``kept`` are further rows with the ``BATCH_ID`` and ``FEED`` they belong to.
        """
        if self.fmt == "delta":
            new = rows.withColumns({BATCH_ID: F.lit(batch_id), FEED: F.lit(feed)})
            if kept is not None:
                new = new.unionByName(kept)
            if self.exists(table, rows.schema):
                path = scratch_path(self.spark, "refresh")
                new.unionByName(self.read_other_feeds(table, rows.schema, feed)).write.parquet(path)
                new = self.spark.read.schema(new.schema).parquet(path)
            (
                new.write.format("delta").mode("overwrite").option("partitionOverwriteMode", "static")
                .partitionBy(BATCH_ID, FEED).save(self.path(table))
            )
            return
        others = [folder for folder in self._current(table) if not _share_source(_batch_and_feed(folder)[1], feed)]
        own = [self._written(table, rows, _partition(batch_id, feed))]
        own += [self._written(table, part, _partition(*place)) for place, part in _by_partition(kept)]
        self.publish(table, [*others, *own])

    def replace_table(self, table: str, rows: DataFrame) -> None:
        """Write a table without batches, such as a stage table, anew."""
        if self.fmt == "delta":
            rows.write.format("delta").mode("overwrite").save(self.path(table))
        else:
            self.publish(table, [self._written(table, rows, "")])

    def has_table(self, table: str) -> bool:
        """Whether a table without batches was ever written."""
        try:
            self.read_table(table)
        except AnalysisException as error:
            if error.getCondition() in _MISSING:
                return False
            raise
        return True

    def read_table(self, table: str) -> DataFrame:
        """A table with the schema of its files; batch and feed, where it has them, are text."""
        found = self._scan(table, None)
        if self.fmt == "delta" or BATCH_ID not in found.columns:
            return found
        return self._scan(table, T.StructType([f for f in found.schema.fields if f.name not in (BATCH_ID, FEED)]))


class BucketedStore(FolderStore):
    """Catalog tables bucketed by hash key, satellites by version.

    The stored side of an insert-only-new join is then read already partitioned by
    the join key: only the batch is shuffled, however large the table has grown.
    Tables written without ``spread`` columns stay in plain folders.
    """

    bucketed = True

    def __init__(self, spark: SparkSession, root: str, buckets: int, database: str = "default") -> None:
        """``root`` takes the stage tables, the catalog's ``database`` the others."""
        super().__init__(spark, root)
        self.buckets, self.database = buckets, database

    def _name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def _scan(self, table: str, schema: T.StructType | None) -> DataFrame:
        if self.spark.catalog.tableExists(self._name(table)):
            return self.spark.table(self._name(table))
        return super()._scan(table, schema)

    def loads_before(self, table: str, batch_id: str, feed: str | None) -> list[str] | None:
        return None if self.spark.catalog.tableExists(self._name(table)) else super().loads_before(table, batch_id, feed)

    def compact(self, table: str, through: str, *, file_bytes: int = 128 * 2**20) -> int:
        if self.spark.catalog.tableExists(self._name(table)):
            raise NotImplementedError("bucketed tables are not compacted: their files are one per bucket and load")
        return super().compact(table, through, file_bytes=file_bytes)

    def batch_ids(self, table: str) -> set[str]:
        if not self.spark.catalog.tableExists(self._name(table)):
            return super().batch_ids(table)
        parts = self.spark.sql(f"SHOW PARTITIONS {self._name(table)}").collect()
        return {unquote(r[0].split("/")[0].removeprefix(f"{BATCH_ID}=")) for r in parts}

    def replace_batch(
        self, table: str, rows: DataFrame, batch_id: str, feed: str, spread: Sequence[str] = ()
    ) -> None:
        if not spread:
            super().replace_batch(table, rows, batch_id, feed)
            return
        name, by = self._name(table), list(spread)
        part = f"PARTITION ({BATCH_ID} = {_literal(batch_id)}, {FEED} = {_literal(feed)})"
        if self.spark.catalog.tableExists(name):
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {part}")
        else:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, {BATCH_ID} STRING, {FEED} STRING) USING parquet "
                f"PARTITIONED BY ({BATCH_ID}, {FEED}) CLUSTERED BY ({', '.join(by)}) INTO {self.buckets} BUCKETS"
            )
        self._insert(table, rows, batch_id, feed, spread)

    def _insert(self, table: str, rows: DataFrame, batch_id: str, feed: str, spread: Sequence[str]) -> None:
        # One file per bucket; the keys are hashes, so the buckets are even.
        part = f"PARTITION ({BATCH_ID} = {_literal(batch_id)}, {FEED} = {_literal(feed)})"
        self.spark.sql(
            f"INSERT INTO {self._name(table)} {part} SELECT {', '.join(f'`{c}`' for c in rows.columns)} FROM {{rows}}",
            rows=rows.repartition(self.buckets, *spread),
        )

    def refresh(
        self, table: str, rows: DataFrame, batch_id: str, feed: str, spread: Sequence[str] = (), kept: DataFrame | None = None
    ) -> None:
        name = self._name(table)
        if self.spark.catalog.tableExists(name):
            path = scratch_path(self.spark, "refresh")
            rows.write.parquet(path)
            rows = self.spark.read.schema(rows.schema).parquet(path)
            for part in self.spark.sql(f"SHOW PARTITIONS {name}").collect():
                batch, of = (unquote(p.split("=", 1)[1]) for p in part[0].split("/"))
                if _share_source(of, feed):
                    self.spark.sql(f"ALTER TABLE {name} DROP PARTITION ({BATCH_ID} = {_literal(batch)}, {FEED} = {_literal(of)})")
        self.replace_batch(table, rows, batch_id, feed, spread)
        for place, part in _by_partition(kept):
            self._insert(table, part, *place, spread)
