"""Queries of the learned topic and sentiment back ends.  Every fourth run
of twenty ids is held out (sources go round in twenties); the others are learned from."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrich as M
from ..operators import learned as LB
from ..sources.tables import documents_base, label_columns, spread
from . import query
from .sqlparts import DOC, _q

HELD_OUT = "CAST(floor(article_id / 20) AS BIGINT) % 4 = 2"


def _rows(spark, sf_dir):
    return spread(documents_base(spark, sf_dir), "article_id")


def _bayes_sql(label: str) -> str:
    return f"""WITH {DOC},
tok AS (SELECT article_id, {label} AS label, {HELD_OUT} AS held_out, unnest(regexp_extract_all(lower(coalesce(text, '')), {_q(LB.WORD_RE)})) AS word FROM doc),
cls AS (SELECT {label} AS label, ln(count(*) / (SELECT count(*) FROM doc WHERE NOT {HELD_OUT} AND {label} IS NOT NULL)) AS prior
        FROM doc WHERE NOT {HELD_OUT} AND {label} IS NOT NULL GROUP BY 1),
vocab AS (SELECT DISTINCT word FROM tok WHERE NOT held_out AND label IS NOT NULL),
tot AS (SELECT label, count(word) + (SELECT count(*) FROM vocab) AS total FROM cls LEFT JOIN tok USING (label) WHERE NOT coalesce(held_out, false) GROUP BY label),
wc AS (SELECT label, word, count(*) AS c FROM tok WHERE NOT held_out AND label IS NOT NULL GROUP BY ALL),
own AS (SELECT article_id, word, count(*) AS n FROM tok SEMI JOIN vocab USING (word) GROUP BY ALL),
len AS (SELECT article_id, sum(n) AS n FROM own GROUP BY article_id),
seen AS (SELECT article_id, label, sum(n * ln(c + 1.0)) AS s FROM own JOIN wc USING (word) GROUP BY ALL),
score AS (SELECT d.article_id, label, prior + coalesce(s, 0) - coalesce(len.n, 0) * ln(total) AS score
          FROM doc d CROSS JOIN cls JOIN tot USING (label) LEFT JOIN len USING (article_id) LEFT JOIN seen USING (article_id, label)),
best AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY round(score, 6) DESC, label) AS rk FROM score)
SELECT article_id, {HELD_OUT} AS held_out, label AS found, round(score, 4) AS score FROM best WHERE rk = 1"""


def _bayes(spark, sf_dir, label):
    docs = _rows(spark, sf_dir)
    model = LB.fit_naive_bayes(docs.where(f"NOT ({HELD_OUT})"), label)
    found = LB.naive_bayes(docs, model, out_col="found")
    return found.select("article_id", F.expr(HELD_OUT).alias("held_out"), "found", F.round("score", 4).alias("score"))


@query("topic_bayes", _bayes_sql("topic"))
def topic_bayes(spark, sf_dir):
    """M6 the topic by naive Bayes, learned from the articles' topics."""
    return _bayes(spark, sf_dir, "topic")


@query("language_bayes", _bayes_sql("lang"))
def language_bayes(spark, sf_dir):
    """M6's model on labels that the words do tell: the language."""
    return _bayes(spark, sf_dir, "lang")


@query("sentiment_learned")
def sentiment_learned(spark, sf_dir):
    """M2 / M4 the label by logistic regression, learned from the labelled articles (fitting is not SQL; tests hold it out)."""
    docs = label_columns(_rows(spark, sf_dir), spark, sf_dir)
    model = LB.fit_sentiment(docs.where(f"NOT ({HELD_OUT})"), "sentiment")
    M.register_column_backend("learned", {"sentiment": lambda df, text, out: LB.learned_sentiment(df, model, text, out)})
    found = M.sentiment(docs.select("article_id", "text", F.col("sentiment").alias("given")), backend="learned")
    return found.select("article_id", F.expr(HELD_OUT).alias("held_out"), "given", "sentiment")
