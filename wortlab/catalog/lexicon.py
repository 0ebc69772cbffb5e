"""Queries of the word statistics: log odds, compounds, collocations, country names."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lexicon as LX
from ..operators import loanwords as L
from ..plans.articles import SOURCE_LANG, TARGET_LANG, english_lexicon
from ..sources.tables import documents_base, spread
from . import query
from .sqlparts import CAND, CAND_IDX, DOC, LEX, WTOK, _q, r


def _docs(spark, sf_dir):
    return spread(documents_base(spark, sf_dir), "article_id")


def _words(spark, sf_dir):
    docs = _docs(spark, sf_dir).where(F.col("lang").isin(SOURCE_LANG, TARGET_LANG))
    return docs.select("lang", F.explode(L.candidate_words("text")).alias("t")).select("lang", F.col("t.word").alias("word"))


_ODDS_SQL = """cnt AS (SELECT word, count(*) FILTER (lang = 'en') AS n_source, count(*) FILTER (lang = 'de') AS n_target FROM cand WHERE lang IN ('en', 'de') GROUP BY word),
tot AS (SELECT CAST(sum(n_source) AS DOUBLE) AS s, CAST(sum(n_target) AS DOUBLE) AS t FROM cnt),
al AS (SELECT *, 500.0 * (n_source + n_target) / (s + t) AS a FROM cnt, tot WHERE s > 0 AND t > 0),
odds AS (SELECT word, n_source, n_target, (ln((n_source + a) / (s + 500.0 - n_source - a)) - ln((n_target + a) / (t + 500.0 - n_target - a)))
                / sqrt(1.0 / (n_source + a) + 1.0 / (n_target + a)) AS z FROM al)"""


@query("loanword_log_odds", f"WITH {DOC},\n{WTOK},\n{CAND},\n{_ODDS_SQL}\nSELECT word, n_source, n_target, {r('z', 'z', 6)}, z >= {LX.ENGLISH_Z} AS english FROM odds")
def loanword_log_odds(spark, sf_dir):
    """L2 how much a word belongs to the English rather than the German documents (z score of the log odds ratio)."""
    odds = LX.log_odds(_words(spark, sf_dir), "lang", SOURCE_LANG, TARGET_LANG)
    return odds.select("word", "n_source", "n_target", F.round("z", 6).alias("z"), (F.col("z") >= LX.ENGLISH_Z).alias("english"))


@query("compound_parts")
def compound_parts(spark, sf_dir):
    """L1 the German documents' words, hyphenated ones too, split into vocabulary words; tests hold the splits against brute force."""
    words = _words(spark, sf_dir).checkpoint(eager=True)
    german = _docs(spark, sf_dir).where(F.col("lang") == TARGET_LANG).select(F.explode(LX.hyphen_parts("text")).alias("word"))
    all_words = words.where(F.col("lang") == TARGET_LANG).select("word").unionByName(german)
    parts = LX.split_compounds(all_words, LX.log_probabilities(words), min_part=4)
    return parts.select("word", F.array_join("parts", "+").alias("parts"), F.round("score", 6).alias("score"))


@query("loanword_collocations", f"""WITH {DOC},
{WTOK},
{CAND},
{LEX},
{CAND_IDX},
de AS (SELECT article_id, pos, word FROM candi WHERE lang = 'de'),
pr AS (SELECT x.word, y.word AS other, count(*) AS n FROM de x JOIN lex USING (word) JOIN de y ON x.article_id = y.article_id AND y.pos BETWEEN x.pos - 3 AND x.pos + 3 AND y.pos <> x.pos GROUP BY ALL),
m AS (SELECT word, other, n, CAST(n AS DOUBLE) AS a, CAST(sum(n) OVER (PARTITION BY word) AS DOUBLE) AS r, CAST(sum(n) OVER (PARTITION BY other) AS DOUBLE) AS c,
             CAST(sum(n) OVER () AS DOUBLE) AS t FROM pr),
sc AS (SELECT word, other, n, round(2.0 * ({" ".join(f"{s} CASE WHEN {x} > 0 THEN ({x}) * ln({x}) ELSE 0.0 END" for s, x in
                                      (("", "a"), ("+", "(r - a)"), ("+", "(c - a)"), ("+", "(t - r - c + a)"), ("-", "r"), ("-", "(t - r)"), ("-", "c"), ("-", "(t - c)"), ("+", "t")))}), 4) AS llr
       FROM m WHERE n >= 2 AND a * t > r * c)
SELECT word, other, n, llr FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY llr DESC, other) AS rk FROM sc) WHERE rk <= 5""")
def loanword_collocations(spark, sf_dir):
    """M8 the context of loanwords: their strongest neighbours by log-likelihood ratio."""
    german = _docs(spark, sf_dir).where(F.col("lang") == TARGET_LANG).select("text")
    words = F.transform(L.candidate_words("text"), lambda c: c["word"])
    return LX.collocations(german, words, english_lexicon(spark, sf_dir))


_NAMES_SQL = ", ".join(f"({_q(e)}, {_q(n)}, {len(n.split(' '))})" for e, own in LX.COUNTRY_NAMES.items() for n in own)


@query("country_mentions", f"""WITH names(entity, name, n) AS (VALUES {_NAMES_SQL}),
named AS (SELECT doc_id AS article_id, CASE WHEN doc_id % 7 = 0 THEN 'Die Vereinigten Staaten von Amerika, Russlands und ' ELSE '' END || coalesce(text, '')
          || CASE WHEN doc_id % 5 = 0 THEN ' in Saudi-Arabien, den USA' ELSE '' END AS text FROM documents WHERE lang = 'de'),
w AS (SELECT article_id, regexp_extract_all(lower(text), {_q(LX.NAME_WORD)}) AS ws FROM named),
g AS (SELECT article_id, i AS a, array_to_string(ws[i + 1:i + k], ' ') AS name FROM w, unnest(range(0, len(ws))) AS u(i), unnest(range(1, {LX.longest_name()} + 1)) AS v(k) WHERE i + k <= len(ws)),
hit AS (SELECT article_id, a, n, entity FROM g JOIN names USING (name))
SELECT article_id, array_to_string(list_sort(list(DISTINCT entity)), '|') AS entities, count(*) AS mentions FROM hit x
WHERE NOT EXISTS (SELECT 1 FROM hit y WHERE y.article_id = x.article_id AND y.a <= x.a AND y.a + y.n >= x.a + x.n AND y.n > x.n) GROUP BY article_id""")
def country_mentions(spark, sf_dir):
    """M11 the countries named in each German article, English and German names (some are put into the texts, which name none)."""
    text = F.concat(F.when(F.col("article_id") % 7 == 0, "Die Vereinigten Staaten von Amerika, Russlands und ").otherwise(""), F.coalesce("text", F.lit("")),
                    F.when(F.col("article_id") % 5 == 0, " in Saudi-Arabien, den USA").otherwise(""))
    german = _docs(spark, sf_dir).where(F.col("lang") == TARGET_LANG).select("article_id", text.alias("text"))
    found = LX.name_mentions(german, LX.name_table(spark), LX.longest_name())
    return found.select("article_id", F.array_join("entities", "|").alias("entities"), "mentions")
