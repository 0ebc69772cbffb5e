import math

import pytest
from pyspark.sql import functions as F

from wortlab.operators import order_stats as OS
from wortlab.operators import profile as PR
from wortlab.operators import stats as S
from wortlab.sources.tables import load

from paths import SF01

# published yearly means (golden values, rounded to 8 places)
BY_YEAR = [(2011, 0.22361796), (2012, 0.21685000), (2013, 0.21334856), (2014, 0.19663074), (2015, 0.16852842),
           (2016, 0.10544733), (2017, 0.12010974), (2018, 0.11910375), (2019, 0.12461850), (2020, 0.10988259),
           (2021, 0.11878036), (2022, 0.11718568), (2023, 0.11610172), (2024, 0.10699961), (2025, 0.10880118)]


def test_trend_golden(spark):
    yearly = spark.createDataFrame(BY_YEAR, "year int, m double")
    fit = S.linear_fit(yearly.where(F.col("year").between(2016, 2023)), "year", "m").first()
    assert fit.slope == pytest.approx(0.000526837, abs=1e-8)
    assert fit.intercept == pytest.approx(-0.947543676, abs=2e-5)
    fc = {r.year: r.forecast for r in S.linear_forecast(
        S.linear_fit(yearly.where(F.col("year").between(2016, 2023)), "year", "m"), 2016, 2028).collect()}
    assert len(fc) == 12 and fc[2027] == pytest.approx(0.12035499, abs=1e-6)
    g = S.growth_factor(yearly, "year", "m", 2016, 2023).first()[0]
    assert g == pytest.approx(1.101040, abs=1e-6)


def test_single_row_group_ci_is_null(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.1), (2, 0.3)], "k int, v double")
    rows = {r.k: r for r in S.mean_ci(df, "k", "v").collect()}
    assert rows[1].std is None and rows[1].sem is None and rows[1].ci95_low is None
    assert rows[2]["count"] == 2 and rows[2].ci95_high > rows[2].mean


def test_histogram_events_matches_pandas(spark):
    h = S.equal_width_histogram(load(spark, SF01, "events"), "value", 10).orderBy("bin").collect()
    assert [r["count"] for r in h] == [6263, 2365, 868, 319, 118, 43, 17, 6, 0, 1]


def test_edge_histogram_bounds(spark):
    df = spark.createDataFrame([(v,) for v in [-0.06, -0.05, 0.06, 1.05, 1.06]], "v double")
    edges = [-0.05 + i * (1.1 / 10) for i in range(10)] + [1.05]
    h = {r.bin: r["count"] for r in S.edge_histogram(df, "v", edges).collect()}
    assert h[1] == 2 and h[10] == 1 and sum(h.values()) == 3 and len(h) == 10


def test_mode_ties_to_smallest(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "b", "a", None]], "s string")
    assert [r.s for r in PR.fill_mode(df, ["s"]).collect()][-1] == "a"


def test_quartiles_numpy_rule(spark):
    df = spark.createDataFrame([(v,) for v in [0.1, 0.2, 0.33, 0.5, 0.7, 0.9, None]], "v double")
    q = PR.quartiles_iqr(df, "v").first()
    assert q.q1 == pytest.approx(0.2325) and q.q3 == pytest.approx(0.65)


def test_iqr_filter_is_strict(spark):
    # q1 = 1.75, q3 = 3.25, fences = -0.5 and 5.5
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, 4.0, 5.5, -0.5]], "v double")
    lim = PR.quartiles_iqr(df, "v").first()
    kept = sorted(r.v for r in PR.filter_iqr(df, "v").collect())
    assert all(lim.lower < v < lim.upper for v in kept)
    assert lim.upper not in kept and lim.lower not in kept


def test_iqr_all_recomputes_limits(spark):
    rows = [(float(i), float(i % 7)) for i in range(40)] + [(1000.0, 1000.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    out = PR.filter_iqr_all(df, ["a", "b"])
    assert out.where("a = 1000").count() == 0 and out.count() == 40


def test_row_ids_dense(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k"))
    ids = OS.row_ids(df, ["k"], "rid", partitions=7).orderBy("k").collect()
    assert [r.rid for r in ids] == list(range(5000)) and [r.k for r in ids] == list(range(5000))


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    vals = [float((i * 37) % 101) / 3 for i in range(777)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    q = OS.exact_quantiles(df, "v", {"a": 0.1, "b": 0.5, "c": 0.99}).first()
    assert q.a == pytest.approx(np.percentile(vals, 10)) and q.b == pytest.approx(np.median(vals))
    assert q.c == pytest.approx(np.percentile(vals, 99))


def test_null_percentage_and_sparse(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, 1.0, "y"), (4, float("nan"), "z")],
                               "a int, b double, c string")
    pct = {r.column: r.null_pct for r in PR.null_percentage(df).collect()}
    assert pct == {"a": 0.0, "b": 75.0, "c": 25.0}
    assert PR.drop_sparse_columns(df, 50).columns == ["c", "a"]


def test_corr_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.5, 0.0)], "x double, y double, z double")
    m = {(r.col_a, r.col_b): r.r for r in PR.corr_lower_triangle(df).collect()}
    assert set(m) == {("y", "x"), ("z", "x"), ("z", "y")}
    assert m[("z", "x")] == pytest.approx(-1.0)
