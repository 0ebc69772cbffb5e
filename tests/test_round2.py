"""Row ids with payload, prompts per task, batch-independent cleaning, cluster folders, plan shapes."""

import pytest
from pyspark.sql import functions as F

from wortlab.operators import enrich as M
from wortlab.operators import loanwords as L
from wortlab.operators import order_stats as OS
from wortlab.plans import enrich as PE
from wortlab.session import ensure_checkpoint_dir, scratch_path


def test_row_ids_are_dense_with_payload_columns(spark, tmp_path):
    n = 2_000_000
    df = spark.range(0, n, 1, 16).select((F.xxhash64("id") % 1_000_003).alias("k"), "id", F.concat(F.lit("payload "), F.col("id")).alias("p"))
    path = str(tmp_path / "ids")
    OS.row_ids(df, ["k", "id"], "rid", partitions=16).write.parquet(path)
    back = spark.read.parquet(path)
    r = back.agg(F.count("*").alias("n"), F.countDistinct("rid").alias("d"), F.min("rid").alias("a"), F.max("rid").alias("b")).first()
    assert (r.n, r.d, r.a, r.b) == (n, n, 0, n - 1) and set(back.columns) == {"k", "id", "p", "rid"}


def test_approximate_quantiles(spark):
    df = spark.range(10_001).select(F.col("id").cast("double").alias("v"))
    r = OS.exact_quantiles(df, "v", {"m": 0.5, "q": 0.75}, accuracy=1000).first()
    assert abs(r.m - 5000) <= 20 and abs(r.q - 7500) <= 20


def test_every_task_gets_its_own_prompt_and_messages(spark):
    class Echo:  # defined locally: shipped to the workers by value
        def answer(self, task, rows):
            return [f"{task}|{m[0]['role']}|{m[-1]['content']}" for m in rows["messages"]]

    M.register_backend("echo_prompts", Echo)
    df = spark.createDataFrame([(1, "Ein Text.", ["team", "deal"])], "article_id long, text string, loanwords array<string>")
    tasks = {t: t for t in M.PROMPT_PARTS}
    assert len(tasks) == 7
    row = M.infer(df, tasks, "echo_prompts", list_col="loanwords", prompts=M.build_prompts(), system=M.SYSTEM).first()
    want = df.select(*[c.alias(t) for t, c in M.build_prompts().items()]).first()
    for t in tasks:
        assert row[t] == f"{t}|system|{want[t]}" and want[t].endswith("Ein Text.")
    assert len({want[t] for t in tasks}) == 7 and "team, deal" in want["unwanted_loanwords"]
    enriched = PE.enrich_articles(df, "echo_prompts", retries=1, delay=0).first()
    assert enriched.summary == f"summary|system|{want['summary']}" and enriched.tone_raw == f"tone|system|{want['tone']}"


def test_registered_again_and_wrong_number_of_answers(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, text string")

    def backend(answers):
        class Fixed:
            def answer(self, task, rows):
                return answers[:len(rows)] if len(rows) > 1 else ["one"]
        return Fixed

    for answers, want in ((["x", "y"], {"x", "y"}), (["z", "z"], {"z"}), (["short"], {"one"})):
        M.register_backend("changing", backend(answers))
        got = M.infer(df.coalesce(1), {"ans": "tone"}, backend="changing", retries=1, delay=0).collect()
        assert {r.ans for r in got} == want


def test_rules_run_without_python(spark):
    df = spark.createDataFrame([(1, "Ein Text!", ["team"])], "article_id long, text string, loanwords array<string>")
    plan = PE.enrich_articles(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_cleaning_does_not_depend_on_the_batch_size(spark):
    lists = [["team", "deal", "team"], ["team", "deal"], ["team"], ["team", "login", "sale"], ["deal"], []]
    df = spark.createDataFrame(list(enumerate(lists)), "article_id long, loanwords array<string>")
    results = []
    for limits in ((None,), (2, 2, 2), (1, 4, None)):
        path = scratch_path(spark, f"test-clean-{len(limits)}-{limits[0]}")
        for limit in limits:
            back = PE.clean_loanwords(spark, df, path, limit=limit)
        results.append({r.article_id: (r.excluded_loanwords, r.refined_loanwords) for r in back.collect()})
    assert results[0] == results[1] == results[2]
    assert results[0][0] == (["team", "team"], ["deal"]) and results[0][3][0] == ["team", "login"]


def test_required_columns_are_checked(spark):
    with pytest.raises(ValueError, match="loanwords"):
        PE.enrich_articles(spark.createDataFrame([(1, "x")], "article_id long, text string"))


def test_whole_text_is_scored_by_default(spark):
    df = spark.createDataFrame([(1, "x " * 400 + "Krise")], "id long, text string")
    assert M.sentiment(df).first().sentiment == "negative"
    assert M.sentiment(df, max_chars=M.SENTIMENT_CHARS).first().sentiment == "neutral"
    assert df.select(M.sentiment_rowwise("text").alias("s")).first().s == "negative"


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_articles_without_candidates_and_hot_words(spark):
    texts = [(1, "Team Team Meeting haben"), (2, ""), (3, None), (4, "der die das"), (5, "Team")]
    df = spark.createDataFrame(texts, "article_id long, text string")
    lex = spark.createDataFrame([("team",), ("meeting",)], "word string")
    got = {r.article_id: r for r in L.loanword_table(df, lex, with_lists=True).collect()}
    assert got[1].loanwords == ["team", "team", "meeting"] and got[1].top_loanwords == ["team", "meeting"]
    assert all(got[i].loanwords == [] and got[i].loanword_count == 0 for i in (2, 3, 4))
    counts = {r.article_id: (r.word_count, r.loanword_count, r.loanword_density) for r in L.loanword_table(df, lex).collect()}
    assert counts == {1: (4, 3, 0.75), 2: (0, 0, 0.0), 3: (0, 0, 0.0), 4: (3, 0, 0.0), 5: (1, 1, 1.0)}
