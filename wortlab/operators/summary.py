"""Extractive summaries (inventory M7): the sentences that share most words with the others.

The sentences of a text are the nodes of a graph, the number of distinct words (four letters or more) two of them share is
the weight of their edge, and a damped power iteration ranks them, all in array functions inside the text's row: nothing is
shuffled.  A graph holds at most ``part`` sentences, so the work grows with the text and not with its square.  A longer text
is ranked in parts of consecutive sentences, whose best ones form the text of the next level, until one part is left; no
sentence is left out.  Ties go to the earlier sentence.  A null, empty or blank text has the summary ''; a text of no more
sentences than asked for is its own summary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_boundary
from .enrich import SENTENCE_RE, WORD_RE

DAMPING, ROUNDS, PLACES = 0.85, 20, 9
MIN_LETTERS = 4


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), 0)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def sentences(text: str) -> Column:
    """The sentences of a text column with their places, blank ones left out -> array of (pos, s)."""
    found = F.transform(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(SENTENCE_RE), 0), strip_boundary)
    return F.transform(F.filter(found, lambda s: s != ""), lambda s, i: F.struct(i.alias("pos"), s.alias("s")))


def _scores(words: Column) -> Column:
    """Rank of every sentence from its distinct words."""
    weights = F.transform(words, lambda a, i: F.transform(
        words, lambda b, j: F.when(i == j, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)).cast("double"))))

    def step(links: Column):
        return lambda ranks, _: F.transform(
            links, lambda row: F.lit(1 - DAMPING) + F.lit(DAMPING) * _total(F.zip_with(row, ranks, lambda x, r: x * r)))

    def ranked(w: Column) -> Column:
        shares = _let(F.transform(w, _total), lambda totals: F.transform(
            w, lambda row: F.zip_with(row, totals, lambda x, t: F.when(t > 0, x / t).otherwise(F.lit(0.0)))))
        return _let(shares, lambda links: F.aggregate(
            F.sequence(F.lit(1), F.lit(ROUNDS)), F.transform(links, lambda _: F.lit(1.0)), step(links)))

    return _let(weights, ranked)


def _best(items: Column, k: int) -> Column:
    """The ``k`` best of an array of (pos, s), in the order of the text."""
    words = F.transform(items, lambda x: F.array_distinct(F.filter(
        F.regexp_extract_all(F.lower(x["s"]), F.lit(WORD_RE), 0), lambda w: F.length(w) >= MIN_LETTERS)))
    ranked = _let(_let(words, _scores), lambda scores: F.sort_array(F.zip_with(
        items, scores, lambda x, r: F.struct((-F.round(r, PLACES)).alias("r"), x["pos"].alias("pos"), x["s"].alias("s")))))
    best = F.transform(F.slice(ranked, 1, k), lambda x: F.struct(x["pos"].alias("pos"), x["s"].alias("s")))
    return F.when(F.size(items) <= k, items).otherwise(F.sort_array(best))


def ranked_summary(df: DataFrame, text_col: str = "text", out_col: str = "summary", k: int = 3, part: int = 40) -> DataFrame:
    """M7 every row with the ``k`` sentences that rank first, in the order of the text, joined by one space.  How many
    levels the longest text needs is counted first (one number)."""
    if part < 2 * k:
        raise ValueError("a part holds at least twice the sentences asked for")
    most = df.select(F.max(F.size(sentences(text_col)))).first()[0] or 0
    out = df.withColumn("__s", sentences(text_col))
    while True:
        starts = F.sequence(F.lit(0), F.greatest(F.size("__s") - 1, F.lit(0)), F.lit(part))
        out = out.withColumn("__s", F.flatten(F.transform(starts, lambda i: _let(F.slice(F.col("__s"), i + 1, part), lambda p: _best(p, k)))))
        if most <= part:
            break
        most = -(-most // part) * k
    return out.withColumn(out_col, F.array_join(F.transform("__s", lambda x: x["s"]), " ")).drop("__s")
