"""Exact quantiles: sketch brackets, counts and folds against numpy."""

import numpy as np
import pytest

from wortlab.functions.text import bin_label, round_n
from wortlab.operators.order_stats import exact_quantiles
from wortlab.operators.profile import quartiles_iqr

PROBS = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.753, "e": 1.0}


def columns():
    r = np.random.default_rng(5)
    yield "normal", r.normal(size=20_000)
    yield "constant", np.full(5000, 3.5)
    yield "two values", np.repeat([1.0, 2.0], [2500, 2501])
    yield "hot value at a quartile", np.concatenate((np.full(7000, 5.0), r.normal(5, 2, 14_000)))
    yield "few", np.array([0.1, 0.2, 0.33, 0.5, 0.7, 0.9])
    yield "one", np.array([-7.0])
    yield "long tail", np.exp(r.normal(0, 4, 20_000))
    yield "steps", r.integers(0, 40, 20_000).astype(float)
    yield "infinities", np.concatenate((np.full(40, -np.inf), r.normal(size=3000), np.full(30, np.inf)))


@pytest.mark.parametrize("fold,width", [(50_000, 0.002), (40, 0.01), (3, 0.0)])
def test_quantiles_are_numpy_s(spark, fold, width):
    for name, values in columns():
        if fold == 3 and name in ("normal", "long tail", "infinities"):
            continue
        probs = {k: p for k, p in PROBS.items() if np.isfinite(values).all() or k in "bc"}
        df = spark.createDataFrame([(float(x),) for x in values] + [(None,), (float("nan"),)], "v double").repartition(5)
        got = exact_quantiles(df, "v", probs, fold_values=fold, rank_width=width).first().asDict()
        want = {k: float(np.quantile(values, p)) for k, p in probs.items()}
        assert got == pytest.approx(want, rel=1e-12, abs=1e-12), (name, fold)


def test_no_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert exact_quantiles(df, "v", PROBS).first().asDict() == dict.fromkeys(PROBS)
    assert quartiles_iqr(df.limit(0), "v").first()["iqr"] is None


def test_the_column_is_not_sorted_or_written(spark, monkeypatch):
    from pyspark.sql import DataFrame

    for way in ("checkpoint", "repartitionByRange", "sort", "orderBy"):
        monkeypatch.setattr(DataFrame, way, None)
    assert exact_quantiles(spark.range(1000), "id", {"m": 0.5}).first()["m"] == 499.5


def test_ties_round_up(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (-0.125,), (2.5,)], "v double")
    assert [r[0] for r in df.select(round_n("v", 2)).collect()] == [0.13, 0.38, -0.12, 2.5]
    assert [r[0] for r in df.select(bin_label("v", "v", 2)).collect()] == ["0.13 - 0.13", "0.38 - 0.38", "-0.12 - -0.12", "2.50 - 2.50"]
