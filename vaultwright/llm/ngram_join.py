"""Jaccard join on word n-grams by vertical partitioning.

A document is the set of its distinct n-grams. All n-grams have one global order, rare
ones first, and that order is cut into fragments. Three steps, each exact:

1. In one fragment (a quarter of the n-grams, by hash) the n-grams that a single set holds are
   counted per set. A set with more of them than a link may leave unmatched has no link.
2. Among the sets that remain, a link has to share an n-gram among the first of both
   in the global order. Sets meet on those; sizes and a parity sketch, which bounds
   the difference from below, prune the pairs.
3. The overlap of a pair is counted in each fragment apart and summed per pair.

Only the components are asked for. So sets first meet a few of those that share an n-gram
with them, and from then on only sets of other components: what a large group of near
copies brings forth stays in proportion to the group, and the last pass compares all that
is still apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwright.llm.common import bounded_broadcast, table, text_key, tidy, written
from vaultwright.llm.components import component_roots

MOST_BROADCAST_ROWS = 1_000_000
SKETCH_BITS = 1024
# Rounds against one set per n-gram, then against one set per n-gram and component.
SINGLE_ROUNDS = 3
COMPONENT_ROUNDS = 3
_ODD = np.uint64(0x9E3779B97F4A7C15)


def ngram_set(text: str, words: int) -> np.ndarray:
    """The distinct n-grams of a text as sorted 64-bit hashes; of a shorter text the whole sequence."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, tokens), dtype=np.uint64, count=len(tokens))
    size = min(words, len(tokens))
    n = len(tokens) - size + 1
    mixed = np.full(n, size, dtype=np.uint64)
    for at in range(size):
        mixed = (mixed ^ hashed[at : at + n]) * _ODD
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def set_key(grams: np.ndarray) -> bytes:
    return hashlib.md5(grams.tobytes()).digest()


def sketch(grams: np.ndarray) -> np.ndarray:
    """Per place of a bit field whether an odd number of n-grams falls there."""
    counts = np.bincount((grams % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((counts & 1).astype(bool)).view(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), F.col("text").cast("string").alias("text"))


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``text_key``, ``set_key`` (null without words) and ``n_shingles`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngram_set(text.as_py() or "", words) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([set_key(g) if len(g) else None for g in found], pa.binary()),
                 pa.array([len(g) for g in found], pa.int64())], names=["doc_id", "text_key", "set_key", "n_shingles"])

    return texts.mapInArrow(tidy(run), "doc_id long, text_key binary, set_key binary, n_shingles long")


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
    values = np.concatenate([np.empty(0, dtype=np.int64), *[g.view(np.int64) for g in found]])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _quarter(texts: DataFrame, words: int) -> DataFrame:
    """``set_key`` and ``grams``: the n-grams of every row that lie in the first fragment by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngram_set(text.as_py() or "", words) for text in batch.column(0)]
            keys = pa.array([set_key(g) for g in found], pa.binary())
            quarter = [g[g >> np.uint64(62) == 0] for g in found]
            yield pa.RecordBatch.from_arrays([keys, _lists(quarter)], names=["set_key", "grams"])

    return texts.select("text").mapInArrow(tidy(run), "set_key binary, grams array<long>")


def _whole(texts: DataFrame, words: int) -> DataFrame:
    """``n``, ``sketch`` and all ``grams`` of each text, with its ``set_key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngram_set(text.as_py() or "", words) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(g) for g in found], pa.binary()), pa.array([len(g) for g in found], pa.int64()),
                 _lists([sketch(g) for g in found]), _lists(found)], names=["set_key", "n", "sketch", "grams"])

    return texts.select("text").mapInArrow(tidy(run), "set_key binary, n long, sketch array<long>, grams array<long>")


def _unmatched(texts: DataFrame, words: int) -> DataFrame:
    """``number`` of a set and ``n_sole``, the n-grams of the first fragment that no other set holds."""
    each = _quarter(texts, words).select(F.xxhash64("set_key").alias("number"), F.explode("grams").alias("gram"))
    held = each.groupBy("gram").agg(F.min("number").alias("number"), F.max("number").alias("last"))
    return held.filter(F.col("number") == F.col("last")).groupBy("number").agg(F.count("*").alias("n_sole"))


def _ordered(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Sets that can have a link: ``id``, ``set_key``, ``n``, ``sketch``, ``order`` and ``prefix``.

    ``order`` holds the n-grams of two or more sets as ``rarity`` (the logarithm of how
    many hold it) and ``gram``, in global order; ``prefix`` those among the first of the
    set of which a link has to share one.
    """
    sets = written(_whole(texts, words).select(F.monotonically_increasing_id().alias("id"), "*"), "sets")
    each = sets.select("id", F.explode("grams").alias("gram"))
    shared = written(each.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select(
        "gram", F.floor(F.log2(F.col("n") + 0.5)).cast("byte").alias("rarity")), "shared")
    orders = each.join(shared, "gram").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rarity", "gram"))).alias("order"))
    # N-grams of one set come first in the order and match nothing.
    n_first = F.floor(F.col("n") * (100 - percent) / 100).cast("int") + 1 - (F.col("n") - F.size("order")).cast("int")
    ordered = sets.drop("grams").join(orders, "id").withColumn("n_first", n_first).filter("n_first > 0")
    return written(ordered.select("*", F.slice("order.gram", F.lit(1), F.col("n_first")).alias("prefix")).drop("n_first"), "ordered")


def _fragment(place: Column) -> Column:
    """The fragment of the global order: four neighbouring rarities, the hashes of one in order."""
    return F.shiftright(place.rarity.cast("int"), 2)


def _fragments(ordered: DataFrame) -> DataFrame:
    """``id``, ``fragment`` and the set's n-grams in it."""
    names = F.array_distinct(F.transform("order", _fragment))
    parts = F.transform(names, lambda f: F.struct(f.alias("fragment"), F.transform(
        F.filter("order", lambda place: _fragment(place) == f), lambda place: place.gram).alias("grams")))
    return ordered.select("id", F.explode(parts).alias("part")).select("id", "part.*")


def _verified(pairs: DataFrame, ordered: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b, n_a, n_b) that link: overlaps counted per fragment, summed per pair."""
    n_pairs = pairs.count()

    def side(id_of: str, grams: str) -> DataFrame:
        wanted = pairs.select(F.col(id_of).alias("id"), "a", "b", "n_a", "n_b")
        ids = bounded_broadcast(pairs.select(F.col(id_of).alias("id")).distinct(), n_pairs, MOST_BROADCAST_ROWS)
        parts = _fragments(ordered.join(ids, "id", "left_semi"))
        met = parts.join(bounded_broadcast(wanted, n_pairs, MOST_BROADCAST_ROWS), "id")
        return met.select("a", "b", "n_a", "n_b", "fragment", F.col("grams").alias(grams))

    both = side("a", "grams_a").join(side("b", "grams_b").drop("n_a", "n_b"), ["a", "b", "fragment"])
    partial = both.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).cast("long").alias("common"))
    summed = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("common").alias("common"))
    return summed.filter(100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


def _may_link(percent: int) -> Column:
    """Whether sets x and y can reach the similarity by their sizes and sketches."""
    n_x, n_y = F.col("x.n"), F.col("y.n")
    differing = F.aggregate(
        F.zip_with("x.sketch", "y.sketch", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda total, bits: total + bits)
    # At least ``differing`` n-grams are in one set only; the others are in both at best.
    fits = 100 * F.least(n_x, n_y) >= percent * F.greatest(n_x, n_y)
    return F.when(fits, (100 + percent) * (n_x + n_y - differing) >= 2 * percent * (n_x + n_y)).otherwise(False)


def _pairs(met: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of the sets ``x`` and ``y`` that met and may link."""
    x, y = F.col("x.id") < F.col("y.id"), F.least("x.id", "y.id")
    return met.filter(_may_link(percent)).select(
        y.alias("a"), F.greatest("x.id", "y.id").alias("b"),
        F.when(x, F.col("x.n")).otherwise(F.col("y.n")).alias("n_a"), F.when(x, F.col("y.n")).otherwise(F.col("x.n")).alias("n_b")).distinct()


def _roots(ordered: DataFrame, links: DataFrame) -> DataFrame:
    """``ordered`` with ``root``, the component of each set by the links so far."""
    roots = component_roots(links)
    return written(ordered.select("id", "n", "sketch", "prefix").join(roots, F.col("id") == F.col("node"), "left").select(
        "id", "n", "sketch", "prefix", F.coalesce("root", "id").alias("root")), "rooted")


def _one_gram(sets: DataFrame, seed: int) -> DataFrame:
    """The sets with one n-gram of their prefix, the least by a hash: alike sets mostly take the same."""
    least = F.array_min(F.transform("prefix", lambda gram: F.struct(F.xxhash64(gram, F.lit(seed)).alias("h"), gram.alias("gram"))))
    return sets.withColumn("gram", least.gram).withColumn("turn", F.lit(seed)).drop("prefix")


def _pivots(sets: DataFrame, by: list[str]) -> DataFrame:
    """One set per group: the least by a hash of its id, alike in all groups."""
    first = F.min(F.struct(F.xxhash64("id", "turn").alias("h"), "id", "n", "sketch"))
    return sets.groupBy(*by).agg(first.alias("first")).select(*by, "first.id", "first.n", "first.sketch")


def set_components(ordered: DataFrame, percent: int) -> DataFrame:
    """``id`` and ``root`` of every set of ``ordered``: the components of its links."""
    single = _one_gram(ordered.select("id", "n", "sketch", "prefix"), 0)
    for seed in range(1, SINGLE_ROUNDS):
        single = single.union(_one_gram(ordered.select("id", "n", "sketch", "prefix"), seed))
    met = single.alias("x").join(_pivots(single, ["turn", "gram"]).alias("y"), ["turn", "gram"]).filter("x.id != y.id")
    links = written(_verified(written(_pairs(met, percent), "pairs"), ordered, percent), "links")
    for seed in range(SINGLE_ROUNDS, SINGLE_ROUNDS + COMPONENT_ROUNDS):
        sets = _one_gram(_roots(ordered, links), seed)
        pivots = _pivots(sets, ["turn", "gram", "root"])
        met = sets.alias("x").join(pivots.alias("y"), ["turn", "gram"]).filter("x.root != y.root")
        found = written(_verified(written(_pairs(met, percent), "pairs"), ordered, percent), "links")
        if found.isEmpty():
            break
        links = written(links.union(found), "links")
    # All that is still apart: sets of several components at one n-gram.
    rooted = _roots(ordered, links)
    each = rooted.select("id", "root", F.explode("prefix").alias("gram"))
    mixed = each.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("gram")
    apart = written(rooted.select("id", "n", "sketch", "root", F.explode("prefix").alias("gram")).join(mixed, "gram"), "apart")
    met = apart.alias("x").join(apart.alias("y"), "gram").filter("x.root < y.root")
    found = _verified(written(_pairs(met, percent), "pairs"), ordered, percent)
    links = written(links.union(found), "links")
    return _roots(ordered, links).select("id", "root")


def jaccard_components(docs: DataFrame, *, words: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row.

    Two documents link when 100 times the common n-grams of ``words`` words are at least ``percent``
    times all of theirs; ``component_id`` is the smallest ``doc_id`` that links lead to.
    Null and empty texts and texts without words have no n-gram and no link; rows without id
    take part and never name a component that has another. Repeated rows each get their row; equal sets are
    compared once, however many rows hold them. Extra columns are not read. An empty
    table gives no rows.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50, at most 100")
    texts = _texts(docs)
    found = written(_sets(texts, words), "sets-of-rows")
    sets = written(found.filter("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("text_key").alias("text_key"), F.min("n_shingles").alias("n"), F.min("doc_id").alias("least")), "distinct-sets")
    numbered = sets.withColumn("number", F.xxhash64("set_key")).join(_unmatched(texts, words), "number", "left")
    remaining = written(numbered.filter(100 * F.coalesce("n_sole", F.lit(0)) <= (100 - percent) * F.col("n")).select("text_key"), "remaining")
    kept = texts.select("text_key", "text").join(
        bounded_broadcast(remaining, remaining.count(), MOST_BROADCAST_ROWS), "text_key", "left_semi").dropDuplicates(["text_key"])
    ordered = _ordered(kept, words, percent)
    roots = ordered.select("id", "set_key").join(set_components(ordered, percent), "id").join(sets.select("set_key", "least"), "set_key")
    roots = written(roots.select("set_key", "root", "least"), "set-roots")
    reached = roots.groupBy("root").agg(F.min("least").alias("reached"))
    component = sets.select("set_key", "least").join(
        roots.join(reached, "root").select("set_key", "reached"), "set_key", "left").select("set_key", F.coalesce("reached", "least").alias("of_set"))
    return found.join(component, "set_key", "left").select(
        "doc_id", "n_shingles", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("of_set")).alias("component_id"))


def ngram_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


NGRAM_SQL = r"""
WITH RECURSIVE d AS (
       SELECT row_number() OVER () AS r, doc_id,
              regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
       FROM documents),
     sh AS (SELECT DISTINCT r, g FROM (
              SELECT r, unnest(list_transform(range(1, len(w) - least(len(w), 4) + 2), lambda b: array_to_string(w[b:b + least(len(w), 4) - 1], ' '))) AS g
              FROM d WHERE len(w) > 0)),
     n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
     common AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM sh x JOIN sh y ON x.g = y.g AND x.r < y.r GROUP BY x.r, y.r),
     link AS (SELECT a, b FROM common JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
     both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
     reach AS (SELECT r, r AS x FROM d UNION SELECT reach.r, both_ways.b FROM reach JOIN both_ways ON reach.x = both_ways.a)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM d JOIN reach ON reach.r = d.r JOIN d o ON o.r = reach.x LEFT JOIN n ON n.r = d.r
GROUP BY d.r, d.doc_id
"""
