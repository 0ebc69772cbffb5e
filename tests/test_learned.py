"""The learned topic and sentiment back ends."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from paths import SF01
from wortlab.operators import enrich as M
from wortlab.operators import learned as LB

TRAIN = [("wirtschaft", "markt firma markt deal"), ("wirtschaft", "umsatz markt"), ("sport", "spiel tor tor"), ("sport", "Tor! Spiel, markt"), (None, "gar nichts"), ("sport", None)]


def brute(train, text):
    words = lambda t: re.findall(LB.WORD_RE, (t or "").lower())
    known = [(y, words(t)) for y, t in train if y is not None]
    counts = {y: Counter(w for z, ws in known if z == y for w in ws) for y, _ in known}
    vocab = {w for c in counts.values() for w in c}
    score = {y: math.log(sum(z == y for z, _ in known) / len(known)) + sum(math.log((c[w] + 1) / (c.total() + len(vocab))) for w in words(text) if w in vocab)
             for y, c in counts.items()}
    best = min(score, key=lambda y: (-score[y], y))
    return best, score[best]


def test_naive_bayes_is_the_textbook_s(spark):
    model = LB.fit_naive_bayes(spark.createDataFrame(TRAIN, "label string, text string").repartition(3), "label")
    texts = ["markt tor", "TOR tor spiel", "unbekannt", "", None, "umsatz " * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "article_id long, text string")
    got = {r.article_id: (r.topic, r.score) for r in LB.naive_bayes(df, model).collect()}
    assert got == {i: (y, pytest.approx(s)) for i, t in enumerate(texts) for y, s in [brute(TRAIN, t)]}


def test_naive_bayes_without_rows_or_with_too_many_classes(spark):
    none = spark.createDataFrame([], "label string, text string")
    df = spark.createDataFrame([(1, "a")], "article_id long, text string")
    assert [tuple(r) for r in LB.naive_bayes(df, LB.fit_naive_bayes(none, "label")).collect()] == [(1, None, None)]
    with pytest.raises(ValueError):
        LB.fit_naive_bayes(spark.createDataFrame(TRAIN, "label string, text string"), "label", max_classes=1)


def sent(node):
    """Rows that the exchanges of a plan that has run wrote, each exchange once."""
    name = node.getClass().getSimpleName()
    if name == "ReusedExchangeExec":
        return 0
    below = [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else [node.plan()] if name.endswith("QueryStageExec") else [node.children().apply(i) for i in range(node.children().size())]
    own = node.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0
    return own + sum(map(sent, below))


def test_naive_bayes_sends_words_by_block_not_by_article(spark):
    """Of 300 articles of the same 60 words no exchange carries a row per article and word, nor one per article and partition."""
    vocab, articles, blocks = [f"wort{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)], 300, int(spark.conf.get("spark.sql.shuffle.partitions"))
    model = LB.fit_naive_bayes(spark.createDataFrame([("a", " ".join(vocab[:40])), ("b", " ".join(vocab[20:]))], "label string, text string"), "label")
    found = LB.naive_bayes(spark.createDataFrame([(i, " ".join(vocab)) for i in range(articles)], "article_id long, text string").repartition(4), model)
    assert len(found.collect()) == articles
    assert articles < sent(found._jdf.queryExecution().executedPlan()) <= 4 * articles + 3 * blocks * len(vocab)


def test_naive_bayes_of_repeated_null_and_text_ids(spark):
    model = LB.fit_naive_bayes(spark.createDataFrame(TRAIN, "label string, text string"), "label")
    df = spark.createDataFrame([("x", "markt"), ("x", "tor firma"), (None, "markt markt"), ("y", "markt")], "k string, text string")
    got = sorted(((r.k or "", r.topic, r.score) for r in LB.naive_bayes(df, model, id_col="k").collect()))
    want = sorted((k, *brute(TRAIN, t)) for k, t in [("x", "markt tor firma"), ("x", "markt tor firma"), ("", ""), ("y", "markt")])
    assert got == [(k, y, pytest.approx(s)) for k, y, s in want]


def test_learned_sentiment_beats_the_majority_on_held_out_rows(spark):
    rows = E.queries()["sentiment_learned"](spark, SF01).where("held_out AND given IS NOT NULL").select("given", "sentiment").collect()
    right = sum(r.given == r.sentiment for r in rows) / len(rows)
    assert right > Counter(r.given for r in rows).most_common(1)[0][1] / len(rows) + 0.02


def test_learned_sentiment_of_null_empty_and_clashing_columns(spark):
    train = spark.createDataFrame([("positive", "gut gut"), ("positive", "gut schön"), ("positive", "schön"), ("negative", "schlecht"), ("negative", "schlecht, mies"), (None, "egal")], "label string, text string")
    model = LB.fit_sentiment(train, "label", reg=0.001)
    M.register_column_backend("small", {"sentiment": lambda df, text, out: LB.learned_sentiment(df, model, text, out)})
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "schlecht schlecht", "x"), (4, "gut", "x")], "id long, text string, sentiment string")
    got = M.sentiment(df.withColumn("_tf", F.lit(1)).withColumnRenamed("sentiment", "given"), backend="small")
    assert got.columns == ["id", "text", "given", "_tf", "sentiment"]
    assert {r.id: r.sentiment for r in got.collect()} == {1: "positive", 2: "positive", 3: "negative", 4: "positive"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert M.sentiment(df.drop("sentiment").limit(0), backend="small").count() == 0
    with pytest.raises(ValueError):
        M.register_column_backend(M.RULES, {})
