"""Language profiles (inventory L2(b), L3): the per-word language test of
the reference re-aimed as Spark aggregations over the labelled corpus.

* word profile: a word belongs to the language in whose documents it has
  the highest relative frequency (count / all candidate words of that
  language); ties go to the alphabetically first language;
* character n-gram profile: add-one smoothed log probabilities of the
  1..3-grams of ``_word_`` per language; a word is scored by the sum over
  its n-grams and assigned the best language.  Candidate words are ASCII
  letters only, so a profile holds at most 27 + 27^2 + 27^3 grams per
  language; no hint forces a broadcast, adaptive execution measures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NGRAM_SIZES = (1, 2, 3)


def word_language(tokens: DataFrame, word_col: str = "word", lang_col: str = "lang") -> DataFrame:
    """-> (word, lang) best language by relative frequency.  Hash
    aggregations only; the language totals are one row per language."""
    per = tokens.groupBy(word_col, lang_col).agg(F.count(F.lit(1)).alias("_n"))
    tot = per.groupBy(lang_col).agg(F.sum("_n").alias("_tot"))     # from the same per-word shuffle
    rel = per.join(tot, lang_col).select(word_col, lang_col, (F.col("_n") / F.col("_tot")).alias("_rel"))
    # max_by over (rel, -lang order) - ties resolved to the smallest language code
    best = rel.groupBy(word_col).agg(F.max_by(F.col(lang_col), F.struct(F.col("_rel"),
                                                                        _desc_key(F.col(lang_col)))).alias(lang_col))
    return best


def _desc_key(s: Column) -> Column:
    """A key that orders strings descending (so max picks the smallest)."""
    return F.transform(F.split(s, ""), lambda ch: -F.ascii(ch))


def word_grams(word: Column) -> Column:
    """1..3-grams of '_' + word + '_' as an array (with repeats)."""
    padded = F.concat(F.lit("_"), word, F.lit("_"))
    def grams_of(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(padded) - n + 1), lambda i: F.substring(padded, i, n))
    arrays = [grams_of(n) for n in NGRAM_SIZES]
    return F.flatten(F.array(*arrays))


def word_counts(tokens: DataFrame, word_col: str = "word", lang_col: str = "lang", out: str = "n") -> DataFrame:
    """(lang, word, n): occurrences per word and language (partial counts
    before the shuffle, so a hot word costs one row per map task)."""
    return tokens.groupBy(lang_col, word_col).agg(F.count(F.lit(1)).alias(out))


def train_ngram_profile(tokens: DataFrame, word_col: str = "word", lang_col: str = "lang",
                        weight_col: str | None = None) -> DataFrame:
    """L3 -> (lang, gram, logp) plus, per language, the log probability of
    an unseen gram (gram = null).  Add-one smoothing over the vocabulary V
    of all grams seen in any language.

    Every occurrence of a word has the same grams, so grams are counted per
    distinct (lang, word) weighted by its occurrences (``weight_col`` when
    ``tokens`` are such counts already).  The gram counts are read three
    times (totals, V, probabilities); they are bounded (see module doc) and
    written once to the checkpoint folder, so the text pass runs once."""
    if weight_col is None:
        tokens, weight_col = word_counts(tokens, word_col, lang_col, "_n"), "_n"
    grams = tokens.select(lang_col, weight_col, F.explode(word_grams(F.col(word_col))).alias("gram"))
    counts = grams.groupBy(lang_col, "gram").agg(F.sum(weight_col).alias("_c")).checkpoint(eager=True)
    tot = counts.groupBy(lang_col).agg(F.sum("_c").alias("_tot"))
    v = counts.select("gram").distinct().agg(F.count(F.lit(1)).alias("_v"))
    base = tot.crossJoin(F.broadcast(v))                       # one row per language x one row
    seen = (counts.join(base, lang_col)
                  .select(lang_col, "gram", F.log((F.col("_c") + 1) / (F.col("_tot") + F.col("_v"))).alias("logp")))
    unseen = base.select(lang_col, F.lit(None).cast("string").alias("gram"),
                         F.log(F.lit(1.0) / (F.col("_tot") + F.col("_v"))).alias("logp"))
    return seen.unionByName(unseen)


def classify_words(words: DataFrame, profile: DataFrame, word_col: str = "word", lang_col: str = "lang") -> DataFrame:
    """Score distinct words against the n-gram profile -> (word, lang, score).
    Adaptive execution broadcasts the profile if it measured small; each word's grams
    are crossed with the few languages, unseen grams get the language's
    floor probability."""
    langs = profile.where(F.col("gram").isNull()).select(lang_col, F.col("logp").alias("_floor"))
    wg = words.select(word_col).distinct().select(word_col, F.explode(word_grams(F.col(word_col))).alias("gram"))
    seen = profile.where(F.col("gram").isNotNull())
    scored = (wg.crossJoin(F.broadcast(langs))
                .join(seen, [lang_col, "gram"], "left")
                .groupBy(word_col, lang_col).agg(F.sum(F.coalesce(F.col("logp"), F.col("_floor"))).alias("score")))
    best = scored.groupBy(word_col).agg(F.max_by(F.struct(lang_col, "score"),
                                                 F.struct(F.col("score"), _desc_key(F.col(lang_col)))).alias("b"))
    return best.select(word_col, F.col(f"b.{lang_col}").alias(lang_col), F.col("b.score").alias("score"))
