import pytest
from pyspark.sql import functions as F

from wortlab.operators import enrich as M
from wortlab.operators import incremental as I


def test_skip_done_ids_null_safe(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (3,)], "id long")
    done = spark.createDataFrame([(2,), (2,)], "id long")
    got = sorted((r.id for r in I.skip_done_ids(df, done, "id").collect()), key=lambda x: (x is None, x))
    assert got == [1, 3, None]
    done_null = spark.createDataFrame([(None,)], "id long")
    got = sorted(r.id for r in I.skip_done_ids(df, done_null, "id").collect())
    assert got == [1, 2, 3]


def test_skip_done_urls_keeps_input_duplicates(spark):
    urls = spark.createDataFrame([("a",), ("a",), ("b",)], "url string")
    done = spark.createDataFrame([("b",), ("b",)], "url string")
    assert [r.url for r in I.skip_done_urls(urls, done).collect()] == ["a", "a"]


def test_anti_plus_semi_is_input(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    done = spark.range(0, 100, 3).withColumnRenamed("id", "k")
    assert I.skip_done_ids(df, done, "k").count() + df.join(done, "k", "left_semi").count() == 100


def test_merge_progress_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id long, a string")
    b = spark.createDataFrame([(2, "y")], "id long, b string")
    rows = {r.id: r for r in I.merge_progress(a, b).collect()}
    assert rows[1].b is None and rows[2].a is None


class Flaky:
    def __init__(self, fails):
        self.fails = fails
        self.calls = 0

    def answer(self, task, rows):
        self.calls += 1
        if self.calls <= self.fails:
            raise RuntimeError("down")
        return ["ok"] * len(rows)


def test_retries_then_answer():
    be = Flaky(2)
    assert M.call_with_retries(lambda: be.answer("t", [1]), retries=3, delay=0) == ["ok"]
    be = Flaky(10)
    with pytest.raises(RuntimeError):
        M.call_with_retries(lambda: be.answer("t", [1]), retries=3, delay=0)


def test_infer_error_sentinel_and_batch_unknown(spark):
    class Broken:  # defined locally: shipped to the workers by value
        def answer(self, task, rows):
            raise RuntimeError("boom")
    M.register_backend("broken", Broken)
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, text string")
    out = M.infer(df, {"ans": "tone"}, backend="broken", retries=2, delay=0).collect()
    assert [r.ans for r in out] == ["error", "error"]
    s = M.sentiment(df, backend="broken").collect()
    assert [r.sentiment for r in s] == ["unknown", "unknown"]


def test_rule_sentiment_and_null_text(spark):
    df = spark.createDataFrame([(1, "Ein guter Erfolg, good!"), (2, None), (3, "Krise und Verlust")],
                               "id long, text string")
    got = {r.id: r.sentiment for r in M.sentiment(df).collect()}
    assert got == {1: "positive", 2: "neutral", 3: "negative"}


def test_country_json(spark):
    df = spark.createDataFrame([('{"countries":["USA"],"reason":"x"}',), ("sorry",)], "raw string")
    rows = df.select(M.country_struct("raw").alias("c")).collect()
    assert rows[0].c.countries == ["USA"] and rows[0].c.reason == "x"
    assert rows[1].c is None or (rows[1].c.countries is None and rows[1].c.reason is None)


def test_validated_domain(spark):
    df = spark.createDataFrame([(" Formal\n",), ("casual",)], "raw string")
    assert [r.v for r in df.select(M.validated("raw", M.TONES).alias("v")).collect()] == ["formal", None]
