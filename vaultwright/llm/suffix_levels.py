"""Removal of repeated passages by a logarithmic family of suffix arrays.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts somewhere else.

Of all suffixes only those are indexed that begin at the smallest run of ``ANCHOR``
bytes (by hash) within some window of ``LENGTH`` bytes: equal windows choose the same
one, so no repeat is missed, at about one suffix in 80 bytes. An entry stands for all
windows that chose it. It is ordered by the fingerprint of its anchor, then by the
fingerprint of all bytes its windows cover, which puts equal suffixes side by side as
their letters would, in 16 bytes each. A level is such an array as a table, with equal
entries counted.

A new batch of documents becomes an array of its own, which is scanned together with
the levels there are: an anchor met twice is a possible repeat, an anchor with different
surroundings may be the end of one. Before a batch is added, levels of equal size are
merged, so n batches leave about log n levels. Then the documents are read once more for
the entries of such anchors. Entries with equal surroundings are repeats as a whole;
the windows of the others are compared one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwright.llm.common import bounded_broadcast, table, text_key, tidy, written

LENGTH = 200
ANCHOR = 40
BITMAP_BITS = 1 << 24
HOT_CLASSES = 20_000
CHUNK = 1 << 22
PLACE_BITS = 24
MOST_BROADCAST_ROWS = 500_000


class Rolling:
    """Hashes of any stretch of a text from sums of its bytes, modulo 2^64."""

    def __init__(self, most: int = 1 << 16):
        rng = np.random.default_rng(20240101)
        self.letter = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1, 1 << 62)) * 4 + 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.grow(most)

    def grow(self, n: int) -> None:
        def powers(b: int) -> np.ndarray:
            out = np.ones(n, dtype=np.uint64)
            if n > 1:
                out[1:] = b
                np.multiply.accumulate(out, out=out)
            return out

        self.up, self.down = powers(self.base), powers(self.inverse)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(data) + 1 > len(self.up):
            self.grow(max(len(data) + 1, 2 * len(self.up)))
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.letter[data] * self.up[: len(data)], out=out[1:])
        return out

    def stretch(self, sums: np.ndarray, start, end) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.down[start])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def entries(data: np.ndarray, rolling: Rolling, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Of a text as bytes: anchor hash, hash of all it covers, first window, windows, anchor's place after it."""
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, max(len(data) - length + 1, 0), CHUNK):
        part = data[at : at + CHUNK + length - 1]
        sums = rolling.sums(part)
        n = len(part) - anchor + 1
        hashes = mix((sums[anchor:] - sums[:n]) * rolling.down[:n])
        placed = (hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(n, dtype=np.uint64)
        # The smallest of each window, by doubling: of equal ones the first.
        wide, least, span = length - anchor + 1, placed, 1
        while 2 * span <= wide:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        windows = n - wide + 1
        least = np.minimum(least[:windows], least[wide - span : wide - span + windows])
        first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        count = np.diff(np.append(first, windows))
        place = (least[first] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        covered = rolling.stretch(sums, first, first + count + length - 1)
        found.append((hashes[place], mix(covered + count.astype(np.uint64)), first + at, count, place - first))
    if not found:
        return tuple(np.empty(0, dtype=t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _bytes(text) -> bytes:
    return (text.as_py() or "").encode("utf-8", "surrogatepass")


def _count_entries(length: int, anchor: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            parts = [entries(np.frombuffer(_bytes(t), np.uint8), rolling, length, anchor)[:2] for t in batch.column(0)]
            if not parts:
                continue
            anchors, covered = (np.concatenate(c).view(np.int64) for c in zip(*parts, strict=True))
            _, where, counts = np.unique(covered, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors[where]), pa.array(covered[where]), pa.array(counts.astype(np.int64))], names=["anchor", "covered", "n"])

    return run


def _bit(value: Column, bits: int) -> Column:
    return value.bitwiseAND(F.lit(bits - 1))


def _bitmap(rows: DataFrame, value: Column, bits: int) -> np.ndarray:
    """Marks of hash buckets, as ``bits`` bits: what reaches the driver does not grow with the rows."""
    bit = rows.select(_bit(value, bits).alias("bit"))
    words = bit.groupBy(F.shiftright("bit", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")).toPandas()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["mask"].to_numpy(dtype=np.int64)
    return out


def _marked(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    bit = values.view(np.int64) & (64 * len(bitmap) - 1)
    return (bitmap[bit >> 6] >> (bit & 63)) & 1 == 1


class LevelFamily:
    """Suffix arrays of growing size, and which anchors repeat among all their batches."""

    def __init__(self, length: int = LENGTH, anchor: int = ANCHOR, bits: int = BITMAP_BITS):
        self.length, self.anchor, self.bits = length, anchor, bits
        self.levels: list[tuple[int, DataFrame]] = []
        self.shared = np.zeros(bits // 64, dtype=np.int64)
        self.mixed = np.zeros(bits // 64, dtype=np.int64)

    def add(self, texts: DataFrame) -> None:
        """Index a batch (column ``text``) and scan it together with the levels."""
        self._merge()
        counted = texts.select("text").mapInArrow(tidy(_count_entries(self.length, self.anchor)), "anchor long, covered long, n long")
        new = written(counted.groupBy("anchor", "covered").agg(F.sum("n").alias("n")).sortWithinPartitions("anchor", "covered"), "level")
        self.levels.append((0, new))
        every = new
        for _, level in self.levels[:-1]:
            every = every.union(level)
        met = every.groupBy("anchor").agg(F.sum("n").alias("n"), F.min("covered").alias("low"), F.max("covered").alias("high"))
        met = written(met.filter("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("mixed")), "met-anchors")
        self.shared |= _bitmap(met, F.col("anchor"), self.bits)
        self.mixed |= _bitmap(met.filter("mixed"), F.col("anchor"), self.bits)

    def _merge(self) -> None:
        """Two levels of one size become one of the next, until all sizes differ."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, b), (_, a) = self.levels.pop(), self.levels.pop()
            merged = a.union(b).groupBy("anchor", "covered").agg(F.sum("n").alias("n"))
            self.levels.append((size + 1, written(merged.sortWithinPartitions("anchor", "covered"), "level")))


HITS = "key binary, first int, count int, anchor long, covered long, place int, bytes binary"


def _hits(family: LevelFamily) -> Callable:
    """The entries of repeated anchors, with their bytes where surroundings differ."""
    length, anchor, shared, mixed = family.length, family.anchor, family.shared, family.mixed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            keys, parts, texts = [], [], []
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                raw = _bytes(text)
                anchors, covered, first, count, place = entries(np.frombuffer(raw, np.uint8), rolling, length, anchor)
                hit = np.flatnonzero(_marked(shared, anchors))
                if not len(hit):
                    continue
                parts.append([c[hit] for c in (first, count, anchors.view(np.int64), covered.view(np.int64), place)])
                keys.extend([key.as_py()] * len(hit))
                differs = _marked(mixed, anchors[hit])
                texts.extend(raw[f : f + c + length - 1] if d else None
                             for f, c, d in zip(first[hit], count[hit], differs, strict=True))
            if keys:
                first, count, anchors, covered, place = (np.concatenate(c) for c in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(anchors),
                     pa.array(covered), pa.array(place.astype(np.int32)), pa.array(texts, pa.binary())],
                    names=["key", "first", "count", "anchor", "covered", "place", "bytes"])

    return run


def _window_hashes(rows: pa.Table, rolling: Rolling, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window: its class (row number), its place in it, and a hash with anchor and place of the anchor."""
    texts, count = rows["bytes"].to_pylist(), rows["count"].to_numpy().astype(np.int64)
    sums = rolling.sums(np.frombuffer(b"".join(texts), np.uint8))
    begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]]).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = begins[row] + step
    before = (rows["place"].to_numpy().astype(np.int64)[row] - step).astype(np.uint64)
    anchors = rows["anchor"].to_numpy().view(np.uint64)[row]
    return row, step, mix(rolling.stretch(sums, start, start + length) + mix(anchors + before))


def _ranges(row: np.ndarray, step: np.ndarray, n_rows: int) -> list[list[dict]]:
    """Runs of consecutive steps of each row."""
    out: list[list[dict]] = [[] for _ in range(n_rows)]
    if len(row):
        cut = np.flatnonzero((np.diff(row) != 0) | (np.diff(step) != 1)) + 1
        for a, b in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(row)]]), strict=True):
            out[row[a]].append({"a": int(step[a]), "b": int(step[b - 1])})
    return out


REPEATS = "anchor long, covered long, ranges array<struct<a:int,b:int>>"
_RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _resolve(length: int, chunk_bytes: int = CHUNK) -> Callable:
    """Which windows of the classes of an anchor are in several of them; rows come sorted by anchor."""

    def resolved(rows: pa.Table, rolling: Rolling) -> pa.RecordBatch:
        row, step, hashes = _window_hashes(rows, rolling, length)
        _, place, times = np.unique(hashes, return_inverse=True, return_counts=True)
        again = (times[place] > 1) | (rows["n"].to_numpy()[row] > 1)
        ranges = _ranges(row[again], step[again], len(rows))
        table = pa.table([rows["anchor"], rows["covered"], pa.array(ranges, _RANGES)], names=["anchor", "covered", "ranges"])
        return table.filter(pa.array([bool(r) for r in ranges])).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, held, size = Rolling(), [], 0
        for batch in batches:
            if not len(batch):
                continue
            anchors = batch.column("anchor").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(anchors)) + 1, [len(anchors)]])
            if held and size > chunk_bytes and anchors[0] != held[-1].column("anchor")[-1].as_py():
                yield from resolved(pa.Table.from_batches(held), rolling).to_batches()
                held, size = [], 0
            at = 0
            for cut in cuts[1:-1]:
                # Only whole anchors are resolved; the last one of a batch may go on.
                if size + batch.slice(at, cut - at).nbytes > chunk_bytes:
                    yield from resolved(pa.Table.from_batches([*held, batch.slice(at, cut - at)]), rolling).to_batches()
                    held, size, at = [], 0, cut
            held.append(batch.slice(at))
            size += held[-1].nbytes
        if held:
            yield from resolved(pa.Table.from_batches(held), rolling).to_batches()

    return run


def _explode_windows(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            for at in range(0, len(batch), 2_000):
                rows = pa.Table.from_batches([batch.slice(at, 2_000)])
                row, step, hashes = _window_hashes(rows, rolling, length)
                yield pa.RecordBatch.from_arrays(
                    [rows["anchor"].combine_chunks().take(pa.array(row)), rows["covered"].combine_chunks().take(pa.array(row)),
                     pa.array(step.astype(np.int32)), pa.array(hashes.view(np.int64))], names=["anchor", "covered", "step", "window"])

    return run


def _repeats(hits: DataFrame, length: int) -> DataFrame:
    """Repeated windows of every class of equal entries, as ranges counted from its first."""
    classes = written(hits.groupBy("anchor", "covered").agg(
        F.count("*").alias("n"), F.first("count").alias("count"), F.first("place").alias("place"), F.first("bytes").alias("bytes")), "classes")
    whole = classes.filter("bytes IS NULL AND n > 1").select(
        "anchor", "covered", F.array(F.struct(F.lit(0).alias("a"), (F.col("count") - 1).alias("b"))).alias("ranges"))
    differing = classes.filter("bytes IS NOT NULL").select("anchor", "covered", "n", "count", "place", "bytes")
    hot = written(differing.groupBy(F.col("anchor").alias("hot")).agg(F.count("*").alias("c")).filter(F.col("c") > HOT_CLASSES), "hot-anchors")
    hot = bounded_broadcast(hot.select("hot"), hot.count(), MOST_BROADCAST_ROWS)
    few = differing.join(hot, F.col("anchor") == F.col("hot"), "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    few = few.mapInArrow(tidy(_resolve(length)), REPEATS)
    # Anchors with more classes than a task should hold: their windows meet by hash, in all tasks.
    many = differing.join(hot, F.col("anchor") == F.col("hot"), "left_semi")
    windows = many.mapInArrow(tidy(_explode_windows(length)), "anchor long, covered long, step int, window long")
    again = windows.groupBy(F.col("window").alias("again")).agg(F.count("*").alias("c")).filter("c > 1")
    single = windows.join(again, F.col("window") == F.col("again")).select("anchor", "covered", "step")
    several = many.filter("n > 1").select("anchor", "covered", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("step"))
    many = single.union(several).distinct().select(
        "anchor", "covered", F.array(F.struct(F.col("step").alias("a"), F.col("step").alias("b"))).alias("ranges"))
    return whole.union(few).union(many)


def _key_bit(keys: list[bytes]) -> np.ndarray:
    return np.array([int.from_bytes(k[:8], "big", signed=True) for k in keys], dtype=np.int64)


def _with_text(bitmap: np.ndarray) -> Callable:
    """Sizes and hashes of all texts; the text itself only where something may be removed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [_bytes(t) for t in batch.column(2)]
            touched = _marked(bitmap, _key_bit(batch.column(1).to_pylist())) if raw else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(r) for r in raw], pa.int64()),
                 pa.array([r if t else None for r, t in zip(raw, touched, strict=True)], pa.binary()),
                 pa.array([None if t else hashlib.sha256(r).hexdigest() for r, t in zip(raw, touched, strict=True)], pa.string())],
                names=["doc_id", "key", "n_bytes", "raw", "sha"])

    return run


def removed_runs(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of byte ranges as maximal runs."""
    runs: list[list[int]] = []
    for start, end in sorted(ranges):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return [(a, b) for a, b in runs]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list] = [[], [], [], []]
        for row in batch.to_pylist():
            runs = removed_runs([(r["s"], r["e"]) for r in row["ranges"] or []])
            sha, kept = row["sha"], None
            if row["raw"] is not None:
                at, pieces = 0, []
                for a, b in runs:
                    pieces.append(row["raw"][at:a])
                    at = b
                kept = b"".join([*pieces, row["raw"][at:]])
                sha = hashlib.sha256(kept).hexdigest()
            for column, value in zip(columns, ([{"s": a, "e": b} for a, b in runs], sum(b - a for a, b in runs), sha, kept), strict=True):
                column.append(value)
        spans = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(columns[1], pa.int64()), pa.array(columns[0], spans),
             pa.array(columns[2], pa.string()), pa.array(columns[3], pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256", "kept"])


def without_repeats(docs: DataFrame, *, length: int = LENGTH, anchor: int = ANCHOR, batches: int = 2) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``spans`` removed, ``kept_sha256``, ``kept``.

    ``kept`` holds the remaining bytes where something may have been removed; a null
    means the text as it is. Texts are judged as they came, in UTF-8, as many equal ones
    as there are; a match never spans two documents. Null texts are empty, texts shorter
    than ``length`` stay whole, null and repeated ids stay as they are. The rows are
    added to the index in ``batches`` batches, by hash of the text; the result does not
    depend on that number. Only ``doc_id`` and ``text`` are read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(text).alias("key"), text.alias("text"))
    family = LevelFamily(length, anchor)
    for n in range(batches):
        family.add(rows.filter(F.pmod(F.xxhash64("text"), F.lit(batches)) == n))
    hits = written(rows.select("key", "text").mapInArrow(tidy(_hits(family)), HITS), "hits")
    repeats = _repeats(hits, length)
    found = hits.select("key", "first", "anchor", "covered").join(repeats, ["anchor", "covered"]).select(
        "key", "first", F.explode("ranges").alias("r"))
    ranges = written(found.groupBy("key").agg(F.collect_set(F.struct(
        (F.col("first") + F.col("r.a")).cast("long").alias("s"), (F.col("first") + F.col("r.b") + length).cast("long").alias("e"))
    ).alias("ranges")), "ranges")
    high = F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("long")
    marked = rows.mapInArrow(tidy(_with_text(_bitmap(ranges, high, BITMAP_BITS))), "doc_id long, key binary, n_bytes long, raw binary, sha string")
    return marked.join(ranges, "key", "left").select("doc_id", "key", "n_bytes", "raw", "sha", "ranges").mapInArrow(
        tidy(_cut), "doc_id long, n_bytes long, n_removed long, spans array<struct<s:long,e:long>>, kept_sha256 string, kept binary")


def repeats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
