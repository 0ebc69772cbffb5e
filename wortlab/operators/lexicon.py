"""Word statistics behind detection and context (inventory L1, L2, M8, M11).

* ``log_odds``: which of two corpora a word belongs to, as a z score of the
  log odds ratio with a prior from both (in place of bare membership);
* ``split_compounds``: the best split of a word into vocabulary words, by
  dynamic programming over log probabilities, once per distinct word;
* ``collocations``: words that stand near a loanword more often than by
  chance (log-likelihood ratio of windowed co-occurrence counts);
* ``name_mentions``: a dictionary of names of several words, matched as token
  n-grams by one join, the longest match first.

All of it is counts with partial aggregation and equi-joins; nothing is
collected and no list of a word's occurrences is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let

NAME_WORD = r"[a-zäöüß]+"
HYPHENATED = r"(?<![\p{L}\p{N}-])\p{L}+(?:-\p{L}+)+(?![\p{L}\p{N}-])"
#: Names of the countries asked for, English and German, with German genitives.
COUNTRY_NAMES = {
    "Australia": ("australia", "australien", "australiens"),
    "Canada": ("canada", "kanada", "kanadas"),
    "China": ("china", "chinas", "volksrepublik china"),
    "France": ("france", "frankreich", "frankreichs"),
    "Germany": ("germany", "deutschland", "deutschlands", "bundesrepublik deutschland"),
    "India": ("india", "indien", "indiens"),
    "Iran": ("iran", "irans", "islamische republik iran"),
    "Israel": ("israel", "israels"),
    "Italy": ("italy", "italien", "italiens"),
    "Japan": ("japan", "japans"),
    "Russia": ("russia", "russland", "russlands", "russische föderation", "russischen föderation"),
    "Saudi Arabia": ("saudi arabia", "saudi arabien", "saudi arabiens"),
    "South Korea": ("south korea", "südkorea", "südkoreas"),
    "Spain": ("spain", "spanien", "spaniens"),
    "Switzerland": ("switzerland", "schweiz"),
    "Turkey": ("turkey", "türkei"),
    "UK": ("uk", "united kingdom", "großbritannien", "großbritanniens", "vereinigtes königreich", "vereinigten königreich", "vereinigten königreichs"),
    "USA": ("usa", "usas", "united states", "united states of america", "vereinigte staaten", "vereinigten staaten", "vereinigte staaten von amerika",
            "vereinigten staaten von amerika"),
}
MAX_NAMES = 10_000
ENGLISH_Z = 1.96  # fixed value: 2.5 % point of the normal distribution


def log_odds(words: DataFrame, group_col: str, source: str, target: str, word_col: str = "word", prior: float = 500.0) -> DataFrame:
    """Per word (word, n_source, n_target, z): z > 0 speaks for the source.

    The prior gives each word ``prior`` occurrences in all, shared out as in
    both corpora together, so rare words stay near 0.  A corpus without a
    word gives no rows (there is nothing to compare)."""
    s, t = F.col("n_source"), F.col("n_target")
    counts = words.where(F.col(group_col).isin(source, target)).groupBy(word_col).agg(
        F.count_if(F.col(group_col) == source).alias("n_source"), F.count_if(F.col(group_col) == target).alias("n_target"))
    totals = words.agg(F.count_if(F.col(group_col) == source).cast("double").alias("_s"), F.count_if(F.col(group_col) == target).cast("double").alias("_t"))
    alpha = F.lit(prior) * (s + t) / (F.col("_s") + F.col("_t"))
    odds = lambda n, total: F.log((n + alpha) / (total + F.lit(prior) - n - alpha))
    z = (odds(s, F.col("_s")) - odds(t, F.col("_t"))) / F.sqrt(1.0 / (s + alpha) + 1.0 / (t + alpha))
    return (counts.crossJoin(F.broadcast(totals)).where("_s > 0 AND _t > 0")  # totals: one row
            .select(word_col, "n_source", "n_target", z.alias("z")))


def hyphen_parts(text_col: str) -> Column:
    """The lower-cased words of a text that are written with hyphens."""
    return F.transform(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(HYPHENATED), 0), lambda w: F.lower(w))


def split_compounds(words: DataFrame, vocabulary: DataFrame, word_col: str = "word", min_part: int = 3, max_part: int = 24, link_cost: float = -4.0) -> DataFrame:
    """Per distinct word (word, parts, score): the split with the greatest sum of the parts' ``logp``.

    Parts have ``min_part`` to ``max_part`` letters; hyphens always split; an
    "s" between parts may belong to none, at ``link_cost``.  ``vocabulary``
    has (word, logp).  A word without a split has itself as its only part and
    a null score.  Ties go to the parts that sort last.  A word of L letters
    meets the vocabulary in at most L * max_part substrings."""
    own = words.select(F.col(word_col).alias("word")).where("word <> ''").distinct()
    pieces = own.select("word", F.posexplode(F.split("word", "-")).alias("k", "piece")).where("piece <> ''")
    n = F.length("piece")
    spans = pieces.where(n >= min_part).select("word", "k", "piece", F.explode(F.sequence(F.lit(0), n - min_part)).alias("a")) \
        .select("word", "k", "piece", "a", F.explode(F.sequence(F.lit(min_part), F.least(F.lit(max_part), n - F.col("a")))).alias("n"))
    spans = spans.withColumn("part", F.substring("piece", F.col("a") + 1, F.col("n")))
    known = spans.join(vocabulary.select(F.col("word").alias("part"), "logp"), "part")
    b = F.col("a") + F.col("n")
    plain = F.struct(b.alias("b"), F.col("a"), F.col("logp"), F.col("part"))
    linked = F.struct((b + 1).alias("b"), F.col("a"), (F.col("logp") + link_cost).alias("logp"), F.col("part"))
    may_link = (F.substring("piece", b + 1, F.lit(1)) == "s") & (b + 1 < n)
    edges = known.select("word", "k", "piece", F.explode(F.when(may_link, F.array(plain, linked)).otherwise(F.array(plain))).alias("e")) \
        .groupBy("word", "k", "piece").agg(F.collect_list("e").alias("edges"))  # at most 2 * letters * max_part of them
    state = "struct<score:double,parts:array<string>>"
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<string>").alias("parts"))).cast(f"array<{state}>")

    def step(best, j):
        ways = F.transform(F.filter("edges", lambda e: (e["b"] == j) & F.get(best, e["a"])["score"].isNotNull()),
                           lambda e: F.struct((F.get(best, e["a"])["score"] + e["logp"]).alias("score"), F.concat(F.get(best, e["a"])["parts"], F.array(e["part"])).alias("parts")))
        return F.concat(best, F.array(F.array_max(ways)).cast(f"array<{state}>"))

    best = edges.select("word", "k", F.element_at(F.aggregate(F.sequence(F.lit(1), n), start, step), -1).alias("best"))
    whole = pieces.join(best, ["word", "k"], "left").select("word", "k", F.coalesce("best.parts", F.array("piece")).alias("parts"), F.col("best.score").alias("score"))
    return whole.groupBy("word").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("k", "parts"))), lambda x: x["parts"])).alias("parts"),
                                     F.when(F.count("score") == F.count(F.lit(1)), F.sum("score")).alias("score"))


def log_probabilities(words: DataFrame, word_col: str = "word", min_count: int = 3) -> DataFrame:
    """(word, logp) of the words seen at least ``min_count`` times."""
    counts = words.groupBy(F.col(word_col).alias("word")).agg(F.count(F.lit(1)).alias("n"))
    total = words.agg(F.count(F.lit(1)).alias("_t"))
    return counts.where(F.col("n") >= min_count).crossJoin(F.broadcast(total)).select("word", F.log(F.col("n") / F.col("_t")).alias("logp"))


def _xlx(x: Column) -> Column:
    return F.when(x > 0, x * F.log(x)).otherwise(0.0)


def collocations(articles: DataFrame, words: Column, lexicon: DataFrame, window: int = 3, min_count: int = 2, k: int = 5) -> DataFrame:
    """Per loanword its ``k`` strongest neighbours: (word, other, n, llr).

    ``words`` is the ordered word list of an article.  Every word meets at
    most 2 * ``window`` neighbours, inside its row; pairs are counted in each
    task before the one shuffle by pair.  Kept are pairs seen ``min_count``
    times and more often than expected; ties by the neighbour."""
    def near(ws):
        last = F.size(ws) - 1
        return F.flatten(F.transform(ws, lambda w, i: F.transform(
            F.filter(F.sequence(F.greatest(i - window, F.lit(0)), F.least(i + window, last)), lambda j: j != i),
            lambda j: F.struct(w.alias("word"), F.get(ws, j).alias("other")))))

    pairs = articles.select(F.explode(let(words, near)).alias("p")).groupBy(F.col("p.word").alias("word"), F.col("p.other").alias("other")) \
        .agg(F.count(F.lit(1)).alias("n")).join(lexicon.select("word"), "word", "left_semi").checkpoint(eager=True)
    rows = pairs.groupBy("word").agg(F.sum("n").alias("_r"))
    cols = pairs.groupBy("other").agg(F.sum("n").alias("_c"))
    total = pairs.agg(F.sum("n").alias("_t"))
    a, r, c, t = (F.col(x).cast("double") for x in ("n", "_r", "_c", "_t"))
    llr = 2.0 * (_xlx(a) + _xlx(r - a) + _xlx(c - a) + _xlx(t - r - c + a) - _xlx(r) - _xlx(t - r) - _xlx(c) - _xlx(t - c) + _xlx(t))
    scored = (pairs.where(F.col("n") >= min_count).join(rows, "word").join(cols, "other").crossJoin(F.broadcast(total))  # total: one row
              .where(a * t > r * c).select("word", "other", "n", F.round(llr, 4).alias("llr")))
    rank = F.row_number().over(Window.partitionBy("word").orderBy(F.col("llr").desc(), "other"))
    return scored.withColumn("_rk", rank).where(F.col("_rk") <= k).drop("_rk")


def name_table(spark, names: dict[str, tuple[str, ...]] = COUNTRY_NAMES) -> DataFrame:
    """(entity, name, n): the dictionary, n being the words of a name."""
    rows = [(e, n, len(n.split(" "))) for e, own in names.items() for n in own]
    if len(rows) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} names")
    return spark.createDataFrame(rows, "entity string, name string, n int")


def name_mentions(df: DataFrame, names: DataFrame, longest: int, id_col: str = "article_id", text_col: str = "text") -> DataFrame:
    """Per row with a mention (ids unique): (id, entities sorted, mentions).  N-grams of up to ``longest`` words meet the
    dictionary in one join; a match inside a longer one is not counted."""
    def grams(ws):
        return F.flatten(F.transform(ws, lambda w, i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(longest), F.size(ws) - i)), lambda n: F.struct(i.alias("a"), n.alias("n"), F.array_join(F.slice(ws, i + 1, n), " ").alias("name")))))

    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(NAME_WORD), 0)
    found = df.select(id_col, F.explode(let(words, grams)).alias("g")).select(id_col, "g.a", "g.name").join(F.broadcast(names), "name")  # checked: MAX_NAMES
    inside = lambda x, y: (y["a"] <= x["a"]) & (y["a"] + y["n"] >= x["a"] + x["n"]) & (y["n"] > x["n"])
    window = Window.partitionBy(id_col).orderBy("a").rangeBetween(-longest, longest)
    own = F.struct("a", "n")
    kept = found.withColumn("_near", F.collect_list(own).over(window)).where(~F.exists("_near", lambda y: inside(own, y)))
    return kept.groupBy(id_col).agg(F.sort_array(F.collect_set("entity")).alias("entities"), F.count(F.lit(1)).alias("mentions"))


def longest_name(names: dict[str, tuple[str, ...]] = COUNTRY_NAMES) -> int:
    return max(len(n.split(" ")) for own in names.values() for n in own)
