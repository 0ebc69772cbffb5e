from pyspark.sql import functions as F

from wortlab.functions import text as X
from wortlab.operators import loanwords as L


def one(spark, expr, ddl="s string", row=("",)):
    return spark.createDataFrame([row], ddl).select(expr.alias("v")).first()["v"]


def test_word_count(spark):
    df = spark.createDataFrame([("",), (" a  b ",), ("a\n\tb",), (None,)], "s string")
    assert [r.v for r in df.select(X.word_count("s").alias("v")).collect()] == [0, 2, 2, 0]


def test_split_csv_list(spark):
    assert one(spark, X.split_csv_list("s"), row=(" footer, ,ticker ,",)) == ["footer", "ticker"]


def test_parse_lists(spark):
    assert one(spark, X.parse_list("s"), row=("['team', 'deal']",)) == ["team", "deal"]
    assert one(spark, X.parse_list("s"), row=("[]",)) == []
    assert one(spark, X.parse_list("s"), row=('["a", "b"]',)) == ["a", "b"]


def test_array_difference_keeps_order_and_repeats(spark):
    df = spark.createDataFrame([(["a", "b", "a", "c"], ["b"])], "a array<string>, b array<string>")
    assert df.select(X.array_difference_keep("a", "b").alias("v")).first().v == ["a", "a", "c"]


def test_candidate_words(spark):
    df = spark.createDataFrame([(1, "Das Team, im Start-up: foo_bar Meeting! abc1")], "article_id long, text string")
    got = [r.word for r in L.tokenize_words(df).orderBy("pos").collect()]
    assert got == ["team", "meeting"]


def test_top_words_ties_by_first_occurrence(spark):
    toks = spark.createDataFrame([(1, i, w) for i, w in enumerate("b a b a c d".split())],
                                 "article_id long, pos int, word string")
    got = [r.word for r in L.top_words_per_article(toks).orderBy("rank").collect()]
    assert got == ["b", "a", "c"]


def test_density_zero_cases(spark):
    arts = spark.createDataFrame([(1, "eins zwei drei vier fünf"), (2, "")], "article_id long, text string")
    lex = spark.createDataFrame([("meeting",)], "word string")
    rows = {r.article_id: r for r in L.loanword_table(arts, lex, with_lists=True).collect()}
    assert rows[1].loanword_density == 0.0 and rows[2].loanword_density == 0.0
    assert rows[1].word_count == 5 and rows[2].word_count == 0
    assert rows[1].loanwords == [] and rows[1].top_loanwords == []


def test_loanword_lists(spark):
    arts = spark.createDataFrame([(1, "Das Team hat ein Meeting, das Team mag Meeting und Team!")],
                                 "article_id long, text string")
    lex = spark.createDataFrame([("team",), ("meeting",)], "word string")
    r = L.loanword_table(arts, lex, with_lists=True).first()
    assert r.loanwords == ["team", "meeting", "team", "meeting", "team"]
    assert r.all_loanwords == ["meeting", "team"]
    assert r.top_loanwords == ["team", "meeting"]
    assert r.loanword_count == 5 and r.loanword_density == round(5 / 11, 4)


def test_stop_word_only_article_counts_zero(spark):
    arts = spark.createDataFrame([(1, "aber alle doch"), (2, "team meeting")], "article_id long, text string")
    lex = spark.createDataFrame([("team",)], "word string")
    rows = {r.article_id: r for r in L.loanword_table(arts, lex).collect()}
    assert rows[1].loanword_count == 0 and rows[1].word_count == 3
    assert rows[2].loanword_count == 1 and rows[2].loanword_density == 0.5


def test_ngram_profile_weighted_by_word_counts_equals_per_occurrence(spark):
    from wortlab.operators import langprofile as LP
    toks = spark.createDataFrame([("en", "team"), ("en", "team"), ("en", "meeting"), ("de", "haus"),
                                  ("de", "team"), ("de", "haus"), ("de", "haus")], "lang string, word string")
    direct = {(r.lang, r.gram): round(r.logp, 12) for r in LP.train_ngram_profile(toks).collect()}
    counted = LP.word_counts(toks)
    weighted = {(r.lang, r.gram): round(r.logp, 12)
                for r in LP.train_ngram_profile(counted, weight_col="n").collect()}
    assert direct == weighted
    # brute force: add-one smoothing over the grams of '_word_' (1- to 3-grams)
    grams_en = [w[i:i + n] for w in ["_team_", "_team_", "_meeting_"] for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    grams_de = [w[i:i + n] for w in ["_haus_"] * 3 + ["_team_"] for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    import math
    v = len(set(grams_en) | set(grams_de))
    assert direct[("en", "ea")] == round(math.log((grams_en.count("ea") + 1) / (len(grams_en) + v)), 12)
    assert direct[("de", None)] == round(math.log(1 / (len(grams_de) + v)), 12)
