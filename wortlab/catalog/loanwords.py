"""Registered loanword queries (L1-L7, W3, U5) and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import langprofile as LP
from ..operators import loanwords as L
from ..plans.articles import TARGET_LANG, english_lexicon, loanword_articles
from ..sources.tables import documents_base, load
from . import finish, query
from ..operators.enrich import BOILERPLATE
from .sqlparts import ARTICLE_CTES, CAND_IDX, NGRAM_PROFILE, WORD_LANG, _q, grams_sql, r, with_articles


def _w(extra: str, body: str) -> str:
    return f"WITH {ARTICLE_CTES},\n{extra}\n{body}"


def _target(spark, sf_dir):
    return documents_base(spark, sf_dir).where(F.col("lang") == TARGET_LANG).select("article_id", "text")


@query("tokenize_words", _w(CAND_IDX, "SELECT article_id, pos, word FROM candi WHERE lang = 'de'"))
def tokenize_words(spark, sf_dir):
    """L1 candidate words of the German articles -> (article_id, pos, word)."""
    return L.tokenize_words(_target(spark, sf_dir))


@query("detect_loanwords", _w(CAND_IDX, "SELECT article_id, pos, word FROM candi SEMI JOIN lex USING (word) WHERE lang = 'de'"))
def detect_loanwords(spark, sf_dir):
    """L2(a) loanword tokens: candidate words in the English vocabulary."""
    return L.detect_loanwords(L.tokenize_words(_target(spark, sf_dir)), english_lexicon(spark, sf_dir))


def _all_tokens(spark, sf_dir):
    docs = documents_base(spark, sf_dir).select("article_id", "lang", "text")
    return L.tokenize_words(docs.select("article_id", "text", "lang"), "article_id", "text")


@query("detect_loanwords_profile", _w(f"{CAND_IDX},\n{WORD_LANG}", """
SELECT article_id, pos, word FROM candi JOIN wlang USING (word) WHERE candi.lang = 'de' AND wlang.lang = 'en'"""))
def detect_loanwords_profile(spark, sf_dir):
    """L2(b) loanword tokens: words whose relative frequency is highest in
    the English documents."""
    docs = documents_base(spark, sf_dir).select("article_id", "lang", "text")
    toks = docs.select("article_id", "lang", F.explode(L.candidate_words("text")).alias("t")) \
               .select("article_id", "lang", F.col("t.pos").alias("pos"), F.col("t.word").alias("word"))
    best = LP.word_language(toks.select("word", "lang"))
    en_words = best.where(F.col("lang") == "en").select("word")
    return toks.where(F.col("lang") == TARGET_LANG).join(en_words, "word", "left_semi").select("article_id", "pos", "word")


def _all_cands(spark, sf_dir):
    docs = documents_base(spark, sf_dir).select("article_id", "lang", "text")
    return docs.select("lang", F.explode(L.candidate_words("text")).alias("t")).select("lang", F.col("t.word").alias("word"))


@query("train_language_profile", _w(NGRAM_PROFILE, f"SELECT lang, gram, {r('logp', 'logp')} FROM profile"))
def train_language_profile(spark, sf_dir):
    """L3 character 1-3-gram language profile (add-one smoothed logs)."""
    return finish(LP.train_ngram_profile(_all_cands(spark, sf_dir)))


@query("detect_language_ngram", _w(NGRAM_PROFILE + """,
words AS (SELECT DISTINCT word FROM cand WHERE lang = 'de'),
wg AS (SELECT word, unnest(""" + grams_sql("word") + """) AS gram FROM words),
fl AS (SELECT lang, logp AS floor_p FROM profile WHERE gram IS NULL),
sc AS (SELECT wg.word, fl.lang, sum(coalesce(p.logp, fl.floor_p)) AS score
       FROM wg CROSS JOIN fl LEFT JOIN profile p ON p.lang = fl.lang AND p.gram = wg.gram GROUP BY 1, 2)""", f"""
SELECT word, lang, {r('score', 'score', 6)} FROM (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY score DESC, lang ASC) AS rk FROM sc) WHERE rk = 1"""))
def detect_language_ngram(spark, sf_dir):
    """L3 applied: best language of each distinct German candidate word."""
    # one text pass: distinct (lang, word) counts, written once, feed both the
    # profile and the German word list
    wl = LP.word_counts(_all_cands(spark, sf_dir)).checkpoint(eager=True)
    prof = LP.train_ngram_profile(wl, weight_col="n")
    words = wl.where(F.col("lang") == TARGET_LANG).select("word")
    out = LP.classify_words(words, prof)
    return out.select("word", "lang", F.round("score", 6).alias("score"))


@query("loanword_count_density", with_articles(f"""
SELECT article_id, word_count, loanword_count, {r('loanword_density', 'loanword_density')} FROM articles"""))
def loanword_count_density(spark, sf_dir):
    """L4 per article: words, loanwords, density (0 when no loanword)."""
    a = loanword_articles(spark, sf_dir)
    return finish(a.select("article_id", "word_count", "loanword_count", "loanword_density"))


_LISTS = """lists AS (SELECT article_id, list(word ORDER BY pos) AS lw FROM loantok GROUP BY article_id),
topw AS (SELECT article_id, string_agg(word, ' ' ORDER BY rk) AS top3 FROM (
  SELECT article_id, word, row_number() OVER (PARTITION BY article_id ORDER BY count(*) DESC, min(pos)) AS rk
  FROM loantok GROUP BY article_id, word) WHERE rk <= 3 GROUP BY article_id)"""


@query("article_top_loanwords", _w(_LISTS, """
SELECT article_id, coalesce(top3, '') AS top_loanwords FROM articles LEFT JOIN topw USING (article_id)"""))
def article_top_loanwords(spark, sf_dir):
    """L5 the 3 most frequent loanwords of each article (ties: first seen)."""
    a = loanword_articles(spark, sf_dir, with_lists=True)
    return a.select("article_id", F.array_join("top_loanwords", " ").alias("top_loanwords"))


@query("article_distinct_loanwords", _w(_LISTS, """
SELECT article_id, coalesce(array_to_string(list_sort(list_distinct(lw)), ' '), '') AS all_loanwords
FROM articles LEFT JOIN lists USING (article_id)"""))
def article_distinct_loanwords(spark, sf_dir):
    """L6 distinct loanwords of each article, sorted."""
    a = loanword_articles(spark, sf_dir, with_lists=True)
    return a.select("article_id", F.array_join("all_loanwords", " ").alias("all_loanwords"))


@query("top_words_per_article", _w(CAND_IDX, """
SELECT article_id, CAST(rk AS INTEGER) AS rank, word, n FROM (
  SELECT article_id, word, count(*) AS n,
         row_number() OVER (PARTITION BY article_id ORDER BY count(*) DESC, min(pos)) AS rk
  FROM candi WHERE lang = 'de' GROUP BY article_id, word) WHERE rk <= 3"""))
def top_words_per_article(spark, sf_dir):
    """W3 the 3 most frequent candidate words per article (window with a
    partial per-partition limit before the shuffle)."""
    return L.top_words_per_article(L.tokenize_words(_target(spark, sf_dir)))


# Remove the words that are boilerplate in this corpus.  Rule back end
# of the unwanted-word detector: a fixed list plus words found in more than
# half of the articles (document frequency).
_DF_SQL = """dfreq AS (SELECT word FROM loantok GROUP BY word
  HAVING count(DISTINCT article_id) > 0.5 * (SELECT count(*) FROM articles))"""


@query("refine_loanwords", _w(_LISTS + ",\n" + _DF_SQL + f""",
excl AS (SELECT article_id, list(word ORDER BY pos) AS ex FROM loantok
         WHERE word IN (SELECT word FROM dfreq) OR word IN ({', '.join(_q(w) for w in BOILERPLATE)})
         GROUP BY article_id)""", """
SELECT article_id, coalesce(array_to_string(list_filter(lw, lambda w: NOT list_contains(coalesce(ex, []), w)), ' '), '') AS refined_loanwords
FROM articles LEFT JOIN lists USING (article_id) LEFT JOIN excl USING (article_id)"""))
def refine_loanwords(spark, sf_dir):
    """L7 / U5 refined = loanwords minus the unwanted ones (order and
    repeats kept)."""
    from ..operators.enrich import unwanted_loanwords
    a = loanword_articles(spark, sf_dir, with_lists=True)
    a = unwanted_loanwords(a, "loanwords", "excluded_loanwords")
    return (L.refine_loanwords(a).select("article_id", F.array_join("refined_loanwords", " ").alias("refined_loanwords")))


@query("array_difference_keep", _w(_LISTS + """,
first AS (SELECT article_id, lw[1] AS w1 FROM lists)""", """
SELECT article_id, coalesce(array_to_string(list_filter(lw, lambda w: w <> w1), ' '), '') AS rest
FROM articles LEFT JOIN lists USING (article_id) LEFT JOIN first USING (article_id)"""))
def array_difference_keep(spark, sf_dir):
    """U5 list minus a list with order and repeats kept (here: every
    article's loanwords without its first loanword)."""
    a = loanword_articles(spark, sf_dir, with_lists=True)
    rest = X.array_difference_keep("loanwords", F.slice("loanwords", 1, 1))
    return a.select("article_id", F.array_join(rest, " ").alias("rest"))


@query("lexicon_semi_join", _w("words AS (SELECT DISTINCT word FROM cand WHERE lang = 'de')",
                               "SELECT word FROM words SEMI JOIN lex USING (word)"))
def lexicon_semi_join(spark, sf_dir):
    """J7 distinct German candidate words that are in the English
    vocabulary (semi join: AQE broadcasts the vocabulary if it measured
    small, else a sort-merge semi join)."""
    words = L.tokenize_words(_target(spark, sf_dir)).select("word").distinct()
    return words.join(english_lexicon(spark, sf_dir), "word", "left_semi")
