"""Near duplicates by SimHash, with candidates pruned by the pigeonring rule.

A fingerprint has 64 bits. For a distance of at most t it is cut into a ring of t+1
segments. If two fingerprints differ in t bits or fewer, there is a segment from which
every chain of l consecutive segments differs in at most l*t/(t+1) bits, rounded down:
none in the first, one in the first two, and so on. The first two links of that chain
make the join key: one segment as it is, the next with at most one bit changed. The
longer links and then the whole distance are checked on the pairs that remain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vaultwright.llm.common import bounded_broadcast, tidy, written
from vaultwright.llm.components import component_roots

SEED = 42
BITS = 64
MOST_BROADCAST_ROWS = 1_000_000


def shingle_hashes(text: str, words: int) -> Iterator[np.ndarray]:
    """XXH64 of the word shingles of a text, repeats included, in blocks."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return
    n = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 15):
        block = range(at, min(n, at + (1 << 15)))
        yield np.array([digest(b" ".join(tokens[i : i + words]), SEED) for i in block], dtype="<u8")


def simhash(text: str, words: int) -> int:
    """Each bit is 1 if it is set in over half of the hashes; 0 for a text without words."""
    ones, n = np.zeros(BITS, dtype=np.int64), 0
    for hashes in shingle_hashes(text, words):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """``docs`` with column ``__fp``, the fingerprint; a null text counts as one without words."""
    at = docs.columns.index("text")
    schema = StructType([*docs.schema.fields, StructField("__fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([simhash(text.as_py() or "", words) for text in batch.column(at)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "__fp"])

    return docs.mapInArrow(tidy(run), schema)


def segments(most_bits: int) -> list[tuple[int, int]]:
    """Offset and width of each segment of the ring."""
    n = most_bits + 1
    ends = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def _segment(value: Column, segment: tuple[int, int]) -> Column:
    offset, width = segment
    return F.shiftrightunsigned(value, offset).bitwiseAND(F.lit((1 << width) - 1))


def _keys(most_bits: int, *, changed: bool) -> Column:
    """The keys of a fingerprint: exact ones, or with one 0 of the second segment set.

    Of two segments that differ in one bit one has a 0 there, so setting zeros is enough.
    """
    ring, keys = segments(most_bits), []
    for n, segment in enumerate(ring):
        following = ring[(n + 1) % len(ring)]
        first, second = _segment(F.col("fp"), segment), _segment(F.col("fp"), following)
        place = F.lit(n).cast("long")
        if not changed:
            keys.append(F.struct(place.alias("n"), first.alias("x"), second.alias("y")))
            continue
        for bit in range(following[1]):
            mask = F.lit(1 << bit).cast("long")
            keys.append(F.when(second.bitwiseAND(mask) == 0, F.struct(
                place.alias("n"), first.alias("x"), second.bitwiseOR(mask).alias("y"))))
    return F.explode(F.filter(F.array(*keys), lambda key: key.isNotNull()))


def links(distinct: DataFrame, most_bits: int) -> DataFrame:
    """Pairs a, b of different fingerprints (column ``fp``) at ``most_bits`` or fewer."""
    if not 0 <= most_bits <= 7:
        raise ValueError("most_bits must be 0 to 7")
    if most_bits == 0:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    ring = segments(most_bits)
    index = distinct.select(_keys(most_bits, changed=False).alias("key"), F.col("fp").alias("b")).select("key.*", "b")
    exact = index.withColumnRenamed("b", "a").withColumn("exact", F.lit(True))
    near = distinct.select(_keys(most_bits, changed=True).alias("key"), F.col("fp").alias("a")).select(
        "key.*", "a", F.lit(False).alias("exact"))
    pairs = exact.union(near).join(index, ["n", "x", "y"]).filter(
        (F.col("a") != F.col("b")) & (~F.col("exact") | (F.col("a") < F.col("b")))
    )
    differing = F.col("a").bitwiseXOR(F.col("b"))
    chain_holds = F.lit(False)
    for start in range(len(ring)):
        holds, total = F.col("n") == start, F.lit(0)
        for length in range(1, len(ring)):
            total = total + F.bit_count(_segment(differing, ring[(start + length - 1) % len(ring)]))
            holds = holds & (total <= length * most_bits // len(ring))
        chain_holds = chain_holds | holds
    return (
        pairs.filter(chain_holds).filter(F.bit_count(differing) <= most_bits)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def _component_ids(found: DataFrame, most_bits: int, least: str) -> DataFrame:
    """``fp`` and ``component_id``: the smallest ``least`` of all fingerprints reachable from it."""
    own = written(found.groupBy(F.col("__fp").alias("fp")).agg(F.min(least).alias("least")), "fingerprints")
    roots = component_roots(links(own, most_bits)).withColumnRenamed("node", "fp")
    linked = written(roots.join(own, "fp"), "linked")
    joined = linked.join(linked.groupBy("root").agg(F.min("least").alias("reached")), "root").select("fp", "reached")
    return own.join(joined, "fp", "left").select("fp", F.coalesce("reached", "least").alias("component_id"))


def simhash_components(docs: DataFrame, *, words: int = 3, most_bits: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    ``component_id`` is the smallest ``doc_id`` that links lead to. Null texts and texts
    without words have fingerprint zero and link like any other; null ids take part and
    never become the id of a component that has another. Repeated rows each get their
    row. Work on links is done once per distinct fingerprint, however many share it.
    """
    found = written(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), words).drop("text"),
                    "simhash")
    ids = _component_ids(found, most_bits, "doc_id")
    return found.join(ids, found["__fp"] == ids.fp).select(
        "doc_id", F.lpad(F.lower(F.hex("__fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, *, words: int = 3, most_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each component: the smallest ``doc_id``, of equal ones the first.

    All columns stay. The rows are written once with their fingerprints; the rows that go
    are found by number and taken out where the others lie.
    """
    # The caller's columns travel as one, so none of their names can clash.
    rows = docs.select(F.struct("*").alias("doc"), F.col("text").cast("string").alias("text"))
    numbered = fingerprints(rows, words).select("__fp", F.monotonically_increasing_id().alias("__row"), "doc")
    kept = written(numbered, "simhash-rows")
    # Null ids come last: a row with an id is kept before one without.
    order = F.struct(F.col("doc.doc_id").isNull().alias("no"), F.col("doc.doc_id").alias("id"), F.col("__row").alias("row"))
    ranked = kept.select("__fp", order.alias("place"))
    ids = _component_ids(ranked, most_bits, "place").select("fp", F.col("component_id.row").alias("stays"))
    rows = kept.select("__row", "__fp")
    gone = written(rows.join(ids, rows["__fp"] == ids.fp).filter(F.col("__row") != F.col("stays")).select("__row"), "gone")
    return kept.join(bounded_broadcast(gone, gone.count(), MOST_BROADCAST_ROWS), "__row", "left_anti").select("doc.*")


def near_duplicates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
