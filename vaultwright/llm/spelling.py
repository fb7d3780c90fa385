"""Spelling variants: words one edit apart, joined by asymmetric q-chunks.

Of two words that differ by one edit the longer, or either of equally long ones, is cut
into two disjoint chunks, its first and its last half; the other gives every positional
gram of the same length. One edit touches one chunk at most, so the other chunk is a gram
of the shorter word, at the same place or one beside it. Words meet on chunk and place;
the edit is then verified on the words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwright.llm.common import ascii_lower, table, written

# Fixed values of the contract: what a word is made of, and which occurrences lose a letter.
RUN = "[A-Za-zÀ-ÿ]+"
DELETION = 199


def _damaged(doc_id: Column, run: Column, divisor: int) -> Column:
    """``run`` without one of its letters where ``divisor`` divides the checksum of id and run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run).cast("long")).cast("int")
    without = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(divisor).cast("long")) == 0, without).otherwise(run)


def occurring_words(docs: DataFrame, *, shortest: int = 6, least: int = 5, deletion: int = DELETION) -> DataFrame:
    """``word`` and ``n``, its occurrences, of all words of ``docs`` with ``shortest`` letters and ``least`` occurrences.

    A null text has no words; a null id takes part in the checksum as an empty one.
    Repeated rows count each. Only ``doc_id`` and ``text`` are read. Words are counted
    within each task before they are shuffled, so a frequent one is no burden.
    """
    runs = F.regexp_extract_all(ascii_lower(F.col("text").cast("string")), F.lit(RUN), F.lit(0))
    long_runs = F.filter(runs, lambda run: F.length(run) >= shortest)
    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(long_runs).alias("run"))
    words = each.select(_damaged(F.col("doc_id"), F.col("run"), deletion).alias("word")).filter(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _chunks(words: DataFrame) -> DataFrame:
    """Both halves of each word, at their places and one place to either side."""
    length = F.length("word")
    q = F.floor(length / 2).cast("int")
    halves = F.array(
        F.struct(F.lit(0).alias("at"), F.substring("word", F.lit(1), q).alias("gram")),
        F.struct((length - q).alias("at"), F.substring("word", length - q + 1, q).alias("gram")),
    )
    cut = words.select("word", "n", length.alias("length"), q.alias("q"), F.explode(halves).alias("half"))
    shifts = F.explode(F.array(*[F.col("half.at") + by for by in (-1, 0, 1)])).alias("at")
    return cut.select(F.col("word").alias("long_word"), F.col("n").alias("long_n"), "length", "q", F.col("half.gram").alias("gram"), shifts)


def _grams(words: DataFrame) -> DataFrame:
    """All positional grams of each word, as long as a half of it or of a word one longer."""
    length = F.length("word")
    sizes = F.array_distinct(F.array(F.floor(length / 2).cast("int"), F.floor((length + 1) / 2).cast("int")))
    sized = words.select("word", "n", length.alias("short_length"), F.explode(sizes).alias("q"))
    places = sized.select("*", F.explode(F.sequence(F.lit(0), F.col("short_length") - F.col("q"))).alias("at"))
    return places.select("word", "n", "short_length", "q", "at", F.substring("word", F.col("at") + 1, F.col("q")).alias("gram"))


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``near`` and ``near_n``: every word next to each of the words one edit away, with that one's ``n``.

    ``words`` has distinct ``word`` of two letters or more, and ``n``. Exactly one code
    point is inserted, deleted or replaced.
    """
    longer = F.col("length") - F.col("short_length")
    met = _chunks(words).join(_grams(words), ["q", "gram", "at"]).filter(
        ((longer == 1) | ((longer == 0) & (F.col("long_word") < F.col("word"))))
        & (F.levenshtein("long_word", "word", 1) == 1)
    )
    # A pair may share both chunks.
    pairs = met.select("long_word", "long_n", "word", "n").distinct()
    ends = F.explode(F.array(
        F.struct(F.col("long_word").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")),
        F.struct(F.col("word").alias("word"), F.col("long_word").alias("near"), F.col("long_n").alias("near_n")),
    ))
    return pairs.select(ends.alias("end")).select("end.*")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of words with a ``form``: each round doubles how far a word has followed its forms.

    A form is more frequent than its word, so there is no ring, and the rounds are the
    logarithm of the longest chain.
    """
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        state = written(state.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if state.filter("moved").isEmpty():
            return state.select("word", "root")
        state = state.select("word", "root")


def spelling_forms(words: DataFrame, *, times: int = 5) -> DataFrame:
    """Each word of ``words`` (``word``, ``n``) with its spelling form.

    ``form`` is the near word of largest ``n`` (of equal ones the first in code-point order) if
    that is at least ``times`` the word's, else null; ``form_n`` its ``n``; ``root`` where
    the forms lead in the end, the word itself without one; ``n_near`` the near words.
    ``words`` may be empty; other columns are left out.
    """
    if times < 2:
        raise ValueError("times must be 2 or more, or forms could lead in a ring")
    words = written(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near")))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.n") >= times * F.col("n")
    formed = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.n")).alias("form_n")), "forms")
    roots = _roots(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(occurring_words(table(spark, sf_dir, "documents")))
