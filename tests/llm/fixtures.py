"""Small tables with every odd case, and random texts that share words and passages."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, fp string, term string, spans string"


def documents(spark, rows, partitions=3):
    """``rows`` of (doc_id, text[, lang]); extra columns have names that operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", 0, 7, "x", "y", "z") for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(partitions) if full else spark.createDataFrame([], DOCS)


def words(rng: random.Random, n: int, vocabulary: int = 60) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows() -> list[tuple]:
    """Null and empty texts, a null id, repeated rows, equal texts, one very long text."""
    rng = random.Random(5)
    shared = words(rng, 80)
    rows = [(n, words(rng, rng.randrange(1, 90))) for n in range(12)]
    rows += [(20, None), (21, ""), (22, " \n\t "), (None, "no id here " + shared), (23, shared), (23, shared), (24, shared)]
    rows += [(25, shared + " end"), (26, "x"), (27, "É ß ſ K 日本 😀 \x00 \x85 \xa0 A-Z " + shared), (28, words(rng, 30_000))]
    return rows
