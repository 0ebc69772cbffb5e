"""Loanword operators (inventory L1-L7, W3, A22, A23).

The reference tokenises with a German NLP model and asks a language
detector about every token occurrence.  Here detection is a Spark job:

* tokens come from whitespace splitting plus trimming of punctuation edges
  (L1), filtered by the alphabetic pattern and Spark's German stop words;
* a word is English when it is in a vocabulary learned from the English
  documents (L2 ``lexicon``) or when a character n-gram language profile
  scores it highest for English (L2 ``profile``, L3);
* words are scored once per *distinct* word and joined back - the costly
  step never runs per occurrence.

All joins are plain equi-joins: AQE turns them into broadcast joins when
the measured side is small and keeps sort-merge (with skew splitting)
otherwise, so no vocabulary is ever broadcast on faith.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import CANDIDATE_TOKEN, spark_stop_words, word_count


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


@functools.lru_cache(maxsize=None)
def _candidate_sql() -> str:
    stops = ", ".join(_sql_str(w) for w in spark_stop_words("german"))
    return (f"transform(filter(transform(regexp_extract_all(coalesce(__TEXT__, ''), {_sql_str(CANDIDATE_TOKEN)}, 1), "
            f"w -> lower(w)), w -> NOT w IN ({stops})), (w, i) -> named_struct('pos', i, 'word', w))")


def candidate_words(text) -> Column:
    """L1 as an array expression: ordered candidate words of one text.

    A whitespace token counts when, without its non letter/digit edges, it is
    4+ ASCII letters; it is lower-cased; German stop words drop out (the stop
    list is a fixed 231-word set: ``IN`` becomes a hash set).  One regex pass
    over the text finds the tokens.  Elements are structs (pos, word); pos is
    the index among candidates, which keeps the text order.  Written as one
    SQL expression: a single call to build, however long the stop list.
    """
    if not isinstance(text, str):
        return _candidate_col(text)
    return F.expr(_candidate_sql().replace("__TEXT__", f"`{text}`"))


def _candidate_col(text: Column) -> Column:
    stops = list(spark_stop_words("german"))
    words = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CANDIDATE_TOKEN), 1),
                        lambda w: F.lower(w))
    kept = F.filter(words, lambda w: ~w.isin(stops))
    return F.transform(kept, lambda w, i: F.struct(i.alias("pos"), w.alias("word")))


def tokenize_words(df: DataFrame, id_col: str = "article_id", text_col: str = "text") -> DataFrame:
    """L1 ``tokenize_words``: one row per candidate word -> (id, pos, word)."""
    return (df.select(id_col, F.explode(candidate_words(text_col)).alias("t"))
              .select(id_col, F.col("t.pos").alias("pos"), F.col("t.word").alias("word")))


def build_lexicon(tokens: DataFrame, min_count: int = 2, word_col: str = "word") -> DataFrame:
    """L2(a) vocabulary: words seen at least ``min_count`` times in the
    source-language corpus.  A hash aggregate with map-side partial counts,
    so a very frequent word costs one row per map task in the shuffle."""
    return (tokens.groupBy(word_col).agg(F.count(F.lit(1)).alias("n"))
                  .where(F.col("n") >= min_count).select(word_col))


def detect_loanwords(tokens: DataFrame, lexicon: DataFrame, word_col: str = "word") -> DataFrame:
    """L2 keep the tokens whose word is in the English vocabulary (J7, a
    semi join: the token side is never duplicated)."""
    return tokens.join(lexicon, word_col, "left_semi")


def _run_starts(words: str) -> Column:
    """The places where a run of equal words begins in an array of (word, pos) sorted by both."""
    w = F.col(words)
    starts = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: (i == 0) | (F.get(w, i)["word"] != F.get(w, i - 1)["word"]))
    return F.when(F.size(w) > 0, starts)


def _runs(words: str, starts: str, with_places: bool) -> Column:
    """One entry (word, n, first[, ps]) per run of equal words."""
    w, size = F.col(words), F.size(words)

    def entry(start: Column, end: Column) -> Column:
        n = end - start
        places = [F.transform(F.slice(w, start + 1, n), lambda x: x["pos"]).alias("ps")] if with_places else []
        return F.struct(F.get(w, start)["word"].alias("word"), n.alias("n"), F.get(w, start)["pos"].alias("first"), *places)

    return F.zip_with(starts, F.concat(F.slice(starts, 2, size), F.array(size)), entry)


def loanword_table(articles: DataFrame, lexicon: DataFrame, id_col: str = "article_id",
                   text_col: str = "text", with_lists: bool = False, top_n: int = 3) -> DataFrame:
    """L4-L6 (and H14's loanword part): per article word count, loanword
    count, density (rounded to 4, 0 for an empty text) and optionally the
    ordered loanword list (repeats kept), its distinct sorted set and the
    top ``top_n`` words (ties by first occurrence).

    One scan of the text.  The candidate words of an article are folded to
    one entry per distinct word inside its row (sorted, run by run), so the
    first exchange is the one by word, where the entries meet the vocabulary
    in a left join; only loanwords (and one row per article, the word it
    begins with) go on to the exchange by id, which the fold per article and
    a later join on the id (the labels) share.  Articles without any
    candidate keep a row with a join key of their own, so they are spread and
    their count is 0, not missing.  Every other column of ``articles`` is
    carried through unchanged.
    """
    keep = [c for c in articles.columns if c not in (text_col, id_col)]
    # word count and candidate array are computed once per article; the text
    # itself never reaches a shuffle
    sorted_words = F.sort_array(F.transform(candidate_words(text_col), lambda c: F.struct(c["word"], c["pos"])))
    per_doc = articles.select(id_col, *keep, word_count(text_col).alias("word_count"), sorted_words.alias("_words"))
    per_doc = per_doc.withColumn("_starts", _run_starts("_words"))
    folded = (per_doc.select(id_col, *keep, "word_count", F.explode_outer(_runs("_words", "_starts", with_lists)).alias("t"))
              .select(id_col, *keep, "word_count", "t.*"))
    keys = [id_col, *keep, "word_count"]
    lex = lexicon.select(F.col("word").alias("_w"), F.lit(True).alias("_en"))
    key = F.coalesce("word", F.concat(F.lit("\u0000"), F.col(id_col).cast("string")))
    found = (folded.withColumn("_key", key).join(lex, F.col("_key") == F.col("_w"), "left")
             .where(F.col("_en") | F.col("word").isNull() | (F.col("first") == 0))
             .drop("_key", "_w").repartition(id_col))
    # per-article columns are part of the key (functionally dependent on the
    # id): plain hash aggregation, no sort-based fallback for string buffers
    if not with_lists:
        out = found.groupBy(*keys).agg(F.coalesce(F.sum(F.when(F.col("_en"), F.col("n"))), F.lit(0)).cast("bigint").alias("loanword_count"))
    else:
        # the per-word rows of an article are few, sorting them is cheap
        entry = F.when(F.col("_en"), F.struct(F.col("n"), F.col("first"), F.col("word").alias("w"), F.col("ps")))
        out = found.groupBy(*keys).agg(F.collect_list(entry).alias("_e"))
        occ = F.flatten(F.transform(F.col("_e"),
                                    lambda e: F.transform(e["ps"], lambda p: F.struct(p.alias("p"), e["w"].alias("w")))))
        ranked = F.sort_array(F.transform(F.col("_e"), lambda e: F.struct((-e["n"]).alias("n"), e["first"].alias("first"), e["w"].alias("w"))))
        out = out.select(id_col, *keep, "word_count",
                         F.transform(F.sort_array(occ), lambda x: x["w"]).alias("loanwords"),
                         F.sort_array(F.transform(F.col("_e"), lambda e: e["w"])).alias("all_loanwords"),
                         F.transform(F.slice(ranked, 1, top_n), lambda e: e["w"]).alias("top_loanwords"))
        out = out.withColumn("loanword_count", F.size("loanwords"))
    return out.withColumn("loanword_density",
                          F.round(F.coalesce(F.try_divide(F.col("loanword_count"), F.col("word_count")),
                                             F.lit(0.0)).cast("double"), 4))


def top_words_per_article(tokens: DataFrame, id_col: str = "article_id", word_col: str = "word",
                          pos_col: str = "pos", k: int = 3) -> DataFrame:
    """The k most frequent words of each article, ties by first
    occurrence -> (id, rank, word, n).

    ``row_number() <= k`` lets Spark add a partial WindowGroupLimit before the
    shuffle, so each map task ships at most k rows per article."""
    per = tokens.groupBy(id_col, word_col).agg(F.count(F.lit(1)).alias("n"), F.min(pos_col).alias("first"))
    w = Window.partitionBy(id_col).orderBy(F.col("n").desc(), F.col("first").asc())
    return (per.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
               .select(id_col, "rank", word_col, "n"))


def word_frequency(df: DataFrame, list_col: str = "loanwords", word_col: str = "word") -> DataFrame:
    """A22 global frequency of the words of a list column (flatten + count);
    partial aggregation makes a hot word cost one row per map task."""
    return (df.select(F.explode(list_col).alias(word_col))
              .groupBy(word_col).agg(F.count(F.lit(1)).alias("frequency")))


def char_frequency(df: DataFrame, text_col: str, char_col: str = "ch") -> DataFrame:
    """A23 frequency of single characters of a text column (the published
    'top loanwords' file is this, computed on list text)."""
    chars = F.filter(F.split(F.col(text_col), ""), lambda x: x != "")
    return (df.select(F.explode(chars).alias(char_col))
              .groupBy(char_col).agg(F.count(F.lit(1)).alias("frequency")))


def refine_loanwords(df: DataFrame, list_col: str = "loanwords", excluded_col: str = "excluded_loanwords",
                     out_col: str = "refined_loanwords") -> DataFrame:
    """L7 refined = loanwords minus excluded, order and repeats kept."""
    from ..functions.text import array_difference_keep
    return df.withColumn(out_col, array_difference_keep(list_col, excluded_col))
