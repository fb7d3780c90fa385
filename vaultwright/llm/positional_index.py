"""Benchmark decontamination by a positional inverted index.

The index is a written table of postings: row, term, place. Each part of it is sorted by
term, so the postings of a term lie together. A phrase is looked up from its rarest
term: the postings of that term, moved back by its offset, are the only places where the
phrase can begin; the postings of the next rarest term thin them out; the remaining
terms decide. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vaultwright.llm.common import ascii_lower, bounded_broadcast, table, text_key, written

# Fixed values of the contract: what separates words, and the length of a window.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
MOST_BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    """The words of a text in order; of a null text none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS, -1), "")


def build_index(docs: DataFrame) -> DataFrame:
    """Postings of every word of ``docs``: ``row``, ``term``, ``place`` (from 0), ``doc_id``, ``text_key``.

    One row without a term stands for each document: its ``place`` is the number of
    words, and it alone carries ``doc_id`` and ``text_key``. Rows are numbered as they are written, so
    repeated and null ids do no harm. Of the input only ``doc_id`` and ``text`` are read.
    """
    tokens = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        text_key(F.col("text")).alias("text_key"), words(F.col("text")).alias("words"),
    ).select("row", "doc_id", "text_key", F.size("words").alias("n"), F.concat(F.array(F.lit(None).cast("string")), "words").alias("words"))
    postings = tokens.select("row", "doc_id", "text_key", "n", F.posexplode("words").alias("at", "term")).select(
        "row", "term",
        F.when(F.col("at") == 0, F.col("n")).otherwise(F.col("at") - 1).alias("place"),
        F.when(F.col("at") == 0, F.col("doc_id")).alias("doc_id"),
        F.when(F.col("at") == 0, F.col("text_key")).alias("text_key"),
    )
    return written(postings.sortWithinPartitions("term", "row", "place"), "postings")


def documents_of(index: DataFrame) -> DataFrame:
    return index.filter(F.col("term").isNull()).select("row", "doc_id", "text_key", F.col("place").cast("long").alias("n_words"))


def postings_of(index: DataFrame, terms: DataFrame) -> DataFrame:
    """The postings of the given distinct terms."""
    terms = terms.select("term").distinct()
    postings = index.filter(F.col("term").isNotNull()).select("row", "term", "place")
    return postings.join(bounded_broadcast(terms, terms.count(), MOST_BROADCAST_ROWS), "term", "left_semi")


def item_words(items: DataFrame) -> DataFrame:
    """``item`` (a number), ``item_id``, ``n_words``, ``offset``, ``term`` of every item word."""
    numbered = items.select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("string").alias("item_id"),
        words(F.col("text")).alias("words"))
    exploded = numbered.select(
        "item", "item_id", F.size("words").alias("n_words"), F.posexplode("words").alias("offset", "term"))
    return written(exploded, "item-words")


def with_frequency(index: DataFrame, terms: DataFrame) -> DataFrame:
    """``terms`` with the number of postings of each term; terms without postings go."""
    found = written(postings_of(index, terms).groupBy("term").agg(F.count("*").alias("frequency")), "frequencies")
    return terms.join(bounded_broadcast(found, found.count(), MOST_BROADCAST_ROWS), "term")


def _windows(parts: DataFrame, window: int) -> DataFrame:
    """Per window its two rarest words; windows with a word that is nowhere are left out."""
    length = F.least(F.col("n_words"), F.lit(window))
    begins = F.sequence(F.greatest(F.lit(0), F.col("offset") - length + 1), F.least(F.col("offset"), F.col("n_words") - length))
    each = parts.select("item", "n_words", length.alias("length"), "offset", "term", "frequency", F.explode(begins).alias("begin"))
    rarest = F.sort_array(F.collect_list(F.struct("frequency", "offset", "term")))
    # At most ``window`` words meet in a window, however long the item.
    found = each.groupBy("item", "begin", "length").agg(rarest.alias("by")).filter(F.size("by") == F.col("length"))
    second = F.when(F.size("by") > 1, F.col("by")[1])
    return found.select(
        "item", "begin", "length", F.col("by")[0].offset.alias("offset_1"), F.col("by")[0].term.alias("term_1"),
        second.offset.alias("offset_2"), second.term.alias("term_2"),
    )


def phrase_matches(index: DataFrame, parts: DataFrame, window: int = WINDOW) -> DataFrame:
    """``row``, ``item``, ``first``, ``last``: runs of document words covered by occurring windows.

    ``parts`` is the result of ``item_words``. A window is ``window`` consecutive words
    of an item, or all words of a shorter one.
    """
    known = written(with_frequency(index, parts), "item-terms")
    looked_up = written(_windows(known, window), "item-windows")
    n_windows = looked_up.count()

    # Where the rarest word of a window stands, the item would begin at ``shift``.
    anchors = looked_up.select("item", "offset_1", F.col("term_1").alias("term")).distinct()
    placed = postings_of(index, anchors).join(bounded_broadcast(anchors, n_windows, MOST_BROADCAST_ROWS), "term").select(
        "row", "item", "offset_1", (F.col("place") - F.col("offset_1")).alias("shift"))
    pairs = looked_up.groupBy("item", "offset_1", "offset_2", "term_2", "length").agg(
        F.min("begin").alias("low"), F.max("begin").alias("high"))
    likely = placed.join(bounded_broadcast(pairs, n_windows, MOST_BROADCAST_ROWS), ["item", "offset_1"])
    seconds = postings_of(index, looked_up.select(F.col("term_2").alias("term")).filter("term IS NOT NULL"))
    both = likely.filter("term_2 IS NOT NULL").withColumn("place", F.col("shift") + F.col("offset_2")).join(
        seconds.withColumnRenamed("term", "term_2"), ["row", "place", "term_2"], "left_semi")
    columns = ["row", "item", "shift", "low", "high", "length"]
    remaining = written(both.select(*columns).union(likely.filter("term_2 IS NULL").select(*columns)).distinct(), "aligned")

    # The other words, only of the rows that are left.
    rows = written(remaining.select("row").distinct(), "aligned-rows")
    n_rows = rows.count()
    offsets = F.explode(F.sequence("low", F.col("high") + F.col("length") - 1))
    wanted = remaining.select("row", "item", "shift", "length", offsets.alias("offset")).distinct()
    wanted = wanted.join(
        bounded_broadcast(known.select("item", "offset", "term"), n_windows, MOST_BROADCAST_ROWS), ["item", "offset"]
    ).withColumn("place", F.col("shift") + F.col("offset"))
    there = postings_of(index, known).join(bounded_broadcast(rows, n_rows, MOST_BROADCAST_ROWS), "row", "left_semi")
    matched = wanted.join(there, ["row", "place", "term"]).select("row", "item", "shift", "length", "offset")
    in_order = Window.partitionBy("row", "item", "shift").orderBy("offset")
    runs = matched.withColumn("run", F.col("offset") - F.row_number().over(in_order)).groupBy(
        "row", "item", "shift", "length", "run").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    return runs.filter(F.col("high") - F.col("low") + 1 >= F.col("length")).select(
        "row", "item", (F.col("shift") + F.col("low")).alias("first"), (F.col("shift") + F.col("high")).alias("last"))


def proximity_matches(index: DataFrame, parts: DataFrame, within: int) -> DataFrame:
    """``row``, ``item``, ``place``: where all words of an item stand within ``within`` places.

    ``place`` is a posting of the item's rarest word; every other distinct word of the
    item has a posting at most ``within`` places from it, in any order.
    """
    known = with_frequency(index, parts.groupBy("item", "term").agg(F.min("offset").alias("offset")))
    n_terms = parts.groupBy("item").agg(F.countDistinct("term").alias("n_terms"))
    ranked = written(known.join(n_terms, "item").withColumn(
        "rank", F.row_number().over(Window.partitionBy("item").orderBy("frequency", "term"))), "near-terms")
    anchors = ranked.filter("rank = 1").select("item", "term", "n_terms")
    anchored = postings_of(index, anchors).join(anchors, "term").select("row", "item", "n_terms", F.col("place").alias("at"))
    others = ranked.filter("rank > 1").select("item", "term")
    # A posting serves the anchors of its own stretch of ``within`` places and the two beside it.
    stretch = anchored.withColumn("near", F.explode(F.array(*[F.floor(F.col("at") / within) + n for n in (-1, 0, 1)])))
    near = postings_of(index, others).withColumn("near", F.floor(F.col("place") / within))
    met = stretch.join(others, "item").join(near, ["row", "near", "term"]).filter(F.abs(F.col("place") - F.col("at")) <= within)
    met = met.groupBy("row", "item", "at", "n_terms").agg(F.countDistinct("term").alias("met"))
    alone = anchored.filter("n_terms = 1").select("row", "item", F.col("at").alias("place"))
    return met.filter(F.col("met") + 1 == F.col("n_terms")).select("row", "item", F.col("at").alias("place")).union(alone)


def contamination(docs: DataFrame, items: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """Per document: its words, those inside occurring item windows, and the items.

    Null and empty texts have no words and are clean. A document without id keeps its
    row, an item without id marks words but is neither counted nor named; repeated rows
    of documents count each, items of one id once. Empty tables give no items or no rows.
    """
    index = build_index(docs)
    parts = item_words(items)
    matches = written(phrase_matches(index, parts, window), "matches")
    covered = matches.select("row", F.explode(F.sequence("first", "last")).alias("place")).distinct()
    hits = covered.groupBy("row").agg(F.count("*").alias("n_hit"))
    names = parts.select("item", "item_id").distinct()
    ids = matches.select("row", "item").distinct().join(names, "item").filter("item_id IS NOT NULL").groupBy("row").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"))
    found = hits.join(ids, "row", "left")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return documents_of(index).join(found, "row", "left").select(
        "doc_id", "n_words", n_hit.cast("long").alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "text_key",
    )


def without_contaminated(docs: DataFrame, items: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns.

    Whether a document is contaminated hangs on its text alone, so rows are found again
    by their text, and those that go are taken out where the others lie.
    """
    found = contamination(docs, items, window=window).filter("contaminated")
    gone = written(found.select("text_key").distinct(), "contaminated")
    # The caller's columns travel as one, so none of their names can clash.
    return docs.select(F.struct("*").alias("doc")).join(
        bounded_broadcast(gone, gone.count(), MOST_BROADCAST_ROWS), text_key(F.col("doc.text")) == F.col("text_key"), "left_anti"
    ).select("doc.*")


def contamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

CONTAMINATION_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
     i AS (SELECT row_number() OVER () AS r, CAST(item_id AS varchar) AS item_id, {_WORDS} AS w FROM benchmark),
     iw AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[b:b + least(len(w), {WINDOW}) - 1], ' ') AS g
            FROM (SELECT r, item_id, w, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS b FROM i WHERE len(w) > 0)),
     sizes AS (SELECT DISTINCT n FROM iw),
     dw AS (SELECT r, n, b, array_to_string(w[b:b + n - 1], ' ') AS g
            FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS b FROM d, sizes WHERE len(w) >= n)),
     m AS (SELECT dw.r, dw.b, dw.n, iw.item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.n = iw.n),
     hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(b, b + n)) AS p FROM m) GROUP BY r),
     ids AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
             FROM (SELECT DISTINCT r, item_id FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)
"""
