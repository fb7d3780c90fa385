"""Personal data in texts, and the terms that give it away.

Four kinds are found by pattern: ``email``, ``ip``, ``card``, ``phone``. Their values
are the protected entities. A further term of a document may disclose an entity though
the entity itself is gone, if the two keep company in the corpus. With n the number of
different texts, so that copies of one text prove nothing, and p(e) = n(e) / n,

    information of an entity      I(e)   = -log2 p(e)
    chance of it beside a term    p(e|t) = w n(e,t) / n(t) + (1 - w) p(e)
    what the term tells of it     M(e,t) = log2 p(e|t) / p(e)
    disclosure                    D(e,t) = M(e,t) / I(e)       (1: the term names the entity)

No pair is too rare to count, but what one or two texts show is drawn towards chance:
1 - w is the chance that they all came about by accident, and a text with d words
between term and entity is no accident with ``near`` / (``near`` + d). From ``sure``
texts on w is 1. A term of a single text leads nowhere else and tells nothing.

A term with D >= ``threshold`` for some entity is reported as kind ``term`` wherever it
stands: also in documents without the entity, which is where it leaks. It is removed if
D >= ``removal`` and else generalised to the class of the word.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwright.llm.common import bounded_broadcast, tidy, written
from vaultwright.llm.spans import SPANS, Span, arrow_spans, counts, digest, of_kind

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "term")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# A number can only begin where its digits begin.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
WORD = re.compile(r"[^\W_]+")

BITMAP_BITS = 1 << 24
MOST_BROADCAST_ROWS = 1_000_000
PAIR_ROWS = 100_000


def luhn(digits: str) -> bool:
    total = 0
    for n, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Every @ with an address around it; an address begins where the one before ended."""
    spans, begin, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > begin and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            spans.append(("email", start, domain.end()))
            begin = domain.end()
        else:
            begin = at + 1
        at = text.find("@", begin)
    return spans


def _at_most_255(part: str) -> bool:
    """Whether digits, with any number of leading zeros, make a number of at most 255."""
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def find_personal(text: str) -> list[Span]:
    """The spans of the four pattern kinds, by kind, then start."""
    spans = _emails(text)
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(_at_most_255(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0]) if m.end() - m.start() >= 13 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return spans


def entity(kind: str, value: str) -> str:
    """One name for the spellings of an entity."""
    return f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else NOT_DIGIT.sub('', value)}"


def _outside(text: str, spans: list[Span]) -> Iterator[re.Match]:
    """The words of a text that touch none of its spans."""
    taken = sorted((s, e) for _, s, e in spans)
    n = 0
    for m in WORD.finditer(text):
        while n < len(taken) and taken[n][1] <= m.start():
            n += 1
        if not any(s < m.end() for s, _ in taken[n : n + len(KINDS)]):
            yield m


def _personal_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans, the entities with the number of words before each, and these words in their order."""
    for batch in batches:
        spans, entities, places, words = [], [], [], []
        for text in batch.column(2):
            text = text.as_py()
            found = find_personal(text)
            outside = list(_outside(text, found)) if found else []
            starts = [m.start() for m in outside]
            spans.append(found)
            entities.append([entity(kind, text[s:e]) for kind, s, e in found])
            places.append([bisect_left(starts, s) for _, s, _ in found])
            words.append([m[0].lower() for m in outside])
        strings = pa.list_(pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), arrow_spans(spans), pa.array(entities, strings),
             pa.array(places, pa.list_(pa.int32())), pa.array(words, strings)],
            names=["doc_id", "text_key", "spans", "entities", "places", "words"],
        )


def _pairs(near: int):
    """Every entity of a text with every word of it, and the chance of an accident by the fewest words between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: tuple[list, list, list] = ([], [], [])
        for batch in batches:
            for entities, places, words in zip(*batch.columns, strict=True):
                entities, words = entities.as_py(), words.as_py()
                terms = {word: n for n, word in enumerate(dict.fromkeys(words))}
                of, at = np.array([terms[word] for word in words], dtype=np.int64), np.arange(len(words))
                stands: dict[str, list[int]] = {}
                for name, place in zip(entities, places.as_py(), strict=True):
                    stands.setdefault(name, []).append(place)
                for name, own in stands.items():
                    own = np.sort(np.array(own, dtype=np.int64))
                    after = np.searchsorted(own, at, side="right")
                    left = np.where(after > 0, at - own[np.maximum(after - 1, 0)], len(words))
                    right = np.where(after < len(own), own[np.minimum(after, len(own) - 1)] - 1 - at, len(words))
                    least = np.full(len(terms), len(words), dtype=np.int64)
                    np.minimum.at(least, of, np.minimum(left, right))
                    rows[0].extend([name] * len(terms))
                    rows[1].extend(terms)
                    rows[2].extend((least / (near + least)).tolist())
                    if len(rows[0]) >= PAIR_ROWS:
                        yield batch_of(rows)
                        rows = ([], [], [])
        if rows[0]:
            yield batch_of(rows)

    def batch_of(rows: tuple[list, list, list]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["entity", "term", "accident"])

    return run


def bit_of(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) % BITMAP_BITS


def bitmap(terms: DataFrame) -> np.ndarray:
    """Which hash buckets hold a term: at most ``BITMAP_BITS`` numbers reach the driver.

    It only spares work: words in a marked bucket are compared with the terms later.
    """
    bits = terms.select((F.crc32(F.col("term").cast("binary")) % BITMAP_BITS).cast("int").alias("bit")).distinct()
    marks = np.zeros(BITMAP_BITS, dtype=bool)
    marks[bits.toPandas()["bit"].to_numpy(np.int64)] = True
    return np.packbits(marks)


def _text_counts(marks: np.ndarray, most: int = 200_000):
    """Different texts per marked word, added up within a task as far as ``most`` words go.

    Each of the ``copies`` of a text counts as its part of one text.
    """

    def batch_of(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.float64())], names=["term", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked, seen = np.unpackbits(marks).tobytes(), Counter()
        for batch in batches:
            for text, copies in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words = {word.lower() for word in set(WORD.findall(text.as_py()))}
                words = [word for word in words if marked[bit_of(word)]]
                if copies == 1:
                    seen.update(words)
                else:
                    seen.update(dict.fromkeys(words, 1 / copies))
                if len(seen) > most:
                    yield batch_of(seen)
                    seen = Counter()
        if seen:
            yield batch_of(seen)

    return run


def _marked_words(marks: np.ndarray):
    """The marked words of each text outside its pattern spans, with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(marks).tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                if any(marked[bit_of(word.lower())] for word in set(WORD.findall(text))):
                    rows += [
                        (key.as_py(), m[0].lower(), m.start(), m.end())
                        for m in _outside(text, find_personal(text)) if marked[bit_of(m[0].lower())]
                    ]
            if rows:
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["text_key", "term", "start", "end"],
                )

    return run


def disclosing_terms(found: DataFrame, texts: DataFrame, *, threshold: float, near: int, sure: int) -> DataFrame:
    """Terms and their highest disclosure, from ``entities``, ``places`` and ``words`` of every document.

    Words are counted only where they may belong to a pair, which leaves the counts whole.
    """
    copies = written(found.groupBy("text_key").agg(F.count("*").alias("copies")), "disclosure-copies")
    n_texts = float(copies.count())
    repeated = copies.filter("copies > 1").withColumnRenamed("text_key", "repeated")
    repeated = bounded_broadcast(repeated, repeated.count(), MOST_BROADCAST_ROWS)
    named = found.filter(F.size("entities") > 0).select("text_key", "entities", "places", "words").dropDuplicates(["text_key"])
    named = written(named.drop("text_key"), "disclosure-named")
    entities = written(named.select(F.explode(F.array_distinct("entities")).alias("of")).groupBy("of").agg(F.count("*").alias("n_entity")), "entities")
    pairs = (
        named.select("entities", "places", "words").mapInArrow(tidy(_pairs(near)), "entity string, term string, accident double")
        .groupBy("entity", "term").agg(F.count("*").alias("n_pair"), F.product("accident").alias("accident"))
        .join(bounded_broadcast(entities, entities.count(), MOST_BROADCAST_ROWS), F.col("entity") == F.col("of"))
        # Of the entities with the same counts, the least accidental tells most.
        .groupBy("term", "n_entity", "n_pair").agg(F.min("accident").alias("accident"))
    )
    pairs = written(pairs, "disclosure-pairs")
    words = texts.join(repeated, F.col("text_key") == F.col("repeated"), "left").select("text", F.coalesce("copies", F.lit(1)).alias("copies"))
    words = words.mapInArrow(tidy(_text_counts(bitmap(pairs))), "term string, n double")
    words = words.groupBy("term").agg(F.round(F.sum("n")).alias("n_term")).filter("n_term > 1")
    chance = F.col("n_entity") / F.lit(n_texts)
    accident = F.when(F.col("n_pair") >= sure, F.lit(0.0)).otherwise(F.col("accident"))
    tells = F.log2((1 - accident) * F.col("n_pair") / (F.col("n_term") * chance) + accident)
    information = -F.log2(chance)
    # Where a term names the entity, the quotient of two logarithms may miss 1 by a hair.
    disclosure = F.when(information > 0, F.round(tells / information, 12)).otherwise(F.lit(0.0))
    return (
        pairs.join(words, "term").withColumn("disclosure", disclosure)
        .filter(F.col("disclosure") >= threshold)
        .groupBy("term").agg(F.max("disclosure").alias("disclosure"))
    )


def word_class(word: Column) -> Column:
    return (
        F.when(word.rlike(r"^\d+$"), "[number]").when(word.rlike(r"\d"), "[code]")
        .when(word.rlike(r"^\p{Lu}"), "[name]").otherwise("[word]")
    )


def personal_spans(docs: DataFrame, *, threshold: float = 0.9, near: int = 16, sure: int = 3) -> DataFrame:
    """``doc_id``, ``text_key``, ``spans`` (by kind, then start) of every row.

    A null text is empty and has no spans. Repeated rows get the same spans each; null
    ids stay. Only ``doc_id`` and ``text`` are read. An empty table gives no rows.
    Spans of terms hang on the text alone, so they travel by its digest, not by row.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).select("doc_id", F.sha2("text", 256).alias("text_key"), "text")
    found = written(texts.mapInArrow(
        tidy(_personal_rows), f"doc_id long, text_key string, spans {SPANS}, entities array<string>, places array<int>, words array<string>"
    ), "personal")
    terms = written(disclosing_terms(found, texts, threshold=threshold, near=near, sure=sure), "disclosing")
    marked = texts.select("text_key", "text").mapInArrow(
        tidy(_marked_words(bitmap(terms))), "text_key string, term string, start long, end long"
    )
    places = (
        marked.join(terms, "term").groupBy("text_key", "start", "end").agg(F.max("disclosure").alias("disclosure"))
        .groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("start", "end", "disclosure"))).alias("places"))
    )
    spans = F.transform("places", lambda p: F.struct(F.lit("term").alias("kind"), p.start.alias("start"), p.end.alias("end")))
    none = F.array().cast(SPANS)
    return found.select("doc_id", "text_key", "spans").join(places, "text_key", "left").select(
        "doc_id", "text_key",
        F.concat("spans", F.coalesce(spans, none)).alias("spans"),
        F.coalesce(F.transform("places", lambda p: p.disclosure), F.array().cast("array<double>")).alias("disclosure"),
    )


def sanitised(
    docs: DataFrame, *, threshold: float = 0.9, removal: float = 1.0, near: int = 16, sure: int = 3
) -> DataFrame:
    """``doc_id`` and ``text`` with personal data named by kind, telling terms generalised or removed."""
    found = personal_spans(docs, threshold=threshold, near=near, sure=sure).select("text_key", "spans", "disclosure")
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    joined = texts.withColumn("text_key", F.sha2("text", 256)).join(found.dropDuplicates(["text_key"]), "text_key")
    terms = F.filter("spans", lambda s: s.kind == "term")
    changes = F.concat(
        F.transform(of_kind(F.col("spans"), *BASE), lambda s: F.struct(
            s.start.alias("start"), s.end.alias("end"), F.concat(F.lit("["), s.kind, F.lit("]")).alias("word"))),
        F.zip_with(terms, "disclosure", lambda s, d: F.struct(
            s.start.alias("start"), s.end.alias("end"),
            F.when(d >= removal, F.lit("")).otherwise(
                word_class(F.substr(F.col("text"), (s.start + 1).cast("int"), (s.end - s.start).cast("int")))
            ).alias("word"))),
    )
    # Where spans of two kinds overlap, the text goes on after the longer of them.
    done = F.aggregate(
        F.sort_array(changes),
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, c: F.struct(
            F.when(c.start >= acc.at, F.concat(
                acc.out, F.substr(F.col("text"), (acc.at + 1).cast("int"), (c.start - acc.at).cast("int")), c.word
            )).otherwise(acc.out).alias("out"),
            F.greatest(acc.at, c.end).alias("at"),
        ),
        lambda acc: F.concat(acc.out, F.substr(F.col("text"), (acc.at + 1).cast("int"))),
    )
    return joined.select("doc_id", done.alias("text"))


def personal_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[n.alias(name) for name, n in counts(spans, BASE).items()],
        F.sha2(digest(of_kind(spans, *BASE)), 256).alias("base_sha256"),
        digest(spans).alias("spans"),
        *[n.alias(name) for name, n in counts(spans, KINDS[4:]).items()],
    )
