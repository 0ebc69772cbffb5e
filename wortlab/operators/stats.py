"""Group statistics, histograms and the trend line (inventory A1-A8,
A17-A25, F9, P2, U3, J4, J5).

All aggregates here are decomposable (count / sum / avg / stddev / regr_*),
so Spark runs them as partial + final hash aggregation: a key holding a
third of the rows costs one partial row per map task, never one task with
a third of the data.  One-row results (min/max, fit coefficients) are
attached to rows by a broadcast of that single row.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bin_label

Z95 = 1.96  # fixed value: normal quantile used for the 95 % band


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def group_mean(df: DataFrame, keys, value: str, out: str | None = None) -> DataFrame:
    """A1-A4 mean of ``value`` per group, sorted by the keys.  Rows with a
    null key are dropped first (pandas groupby semantics)."""
    ks = _keys(keys)
    cond = F.lit(True)
    for k in ks:
        cond = cond & F.col(k).isNotNull()
    return (df.where(cond).groupBy(*ks).agg(F.avg(value).alias(out or value)).orderBy(*ks))


def mean_ci(df: DataFrame, key: str, value: str, z: float = Z95) -> DataFrame:
    """A5 per group: mean, count (non-null), sample std, sem = std/sqrt(n),
    CI = mean -/+ z*sem.  A group of one row gets null std / sem / bounds."""
    g = (df.where(F.col(key).isNotNull()).groupBy(key)
           .agg(F.avg(value).alias("mean"), F.count(value).alias("count"),
                F.stddev_samp(value).alias("std")))
    sem = F.try_divide(F.col("std"), F.sqrt(F.col("count")))
    return (g.withColumn("sem", sem)
             .withColumn("ci95_low", F.col("mean") - z * F.col("sem"))
             .withColumn("ci95_high", F.col("mean") + z * F.col("sem"))
             .orderBy(key))


def named_group_stats(df: DataFrame, keys, spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """A25 named aggregation: ``{"out": ("mean", "col"), ...}``."""
    fns = {"mean": F.avg, "avg": F.avg, "count": F.count, "std": F.stddev_samp, "sum": F.sum,
           "min": F.min, "max": F.max, "median": F.median}
    ks = _keys(keys)
    cond = F.lit(True)
    for k in ks:
        cond = cond & F.col(k).isNotNull()
    return (df.where(cond).groupBy(*ks)
              .agg(*[fns[fn](c).alias(name) for name, (fn, c) in spec.items()]).orderBy(*ks))


def group_value(df: DataFrame, key: str, value: str, at) -> Column:
    """F9 value of one group as an aggregate expression (no collect)."""
    return F.max(F.when(F.col(key) == F.lit(at), F.col(value)))


def growth_factor(means: DataFrame, key: str, value: str, start, end, out: str = "growth_factor") -> DataFrame:
    """A19 value(end) / value(start) over a table of group means -> one row."""
    return means.agg(F.try_divide(group_value(means, key, value, end),
                                  group_value(means, key, value, start)).alias(out))


def pivot_mean(df: DataFrame, row_key: str, col_key: str, value: str, values: Iterable[str]) -> DataFrame:
    """A20 rows x columns of mean values; missing pair = null.  The column
    values are given, so Spark needs no extra job to find them and the
    schema is fixed."""
    vals = sorted(values)
    return (df.where(F.col(row_key).isNotNull()).groupBy(row_key)
              .pivot(col_key, vals).agg(F.avg(value)).orderBy(row_key))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A21 distinct values (null is a value)."""
    return df.select(col).distinct()


def shape(df: DataFrame, label: str = "rows") -> DataFrame:
    """A24 row and column count in one small frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(label).alias("step"), "n_rows", F.lit(len(df.columns)).alias("n_cols"))


# ---------------------------------------------------------------- histograms

def linspace_edges(lo: Column, hi: Column, n: int) -> list[Column]:
    """X16 numpy.linspace(lo, hi, n + 1): i * step + lo, last edge = hi."""
    step = (hi - lo) / F.lit(float(n))
    return [lo + F.lit(float(i)) * step for i in range(n)] + [hi]


def bin_index(v: Column, inner_edges: Column) -> Column:
    """J4 right-closed bin number 1..n of v given the n-1 inner edges:
    1 + #(edges < v).  A range lookup as one array expression - no join."""
    return F.lit(1) + F.size(F.filter(inner_edges, lambda e: e < v))


def equal_width_histogram(df: DataFrame, value: str, n: int = 10, label_places: int = 4,
                          derived_input: bool = True) -> DataFrame:
    """A6 / A7 ``pd.cut(col, bins=n)`` + ``value_counts().sort_index()``.

    Edges span [min, max] (numpy linspace arithmetic); the lowest edge is
    moved down by 0.1 % of the range; a constant column is widened by
    0.1 % of its value (0.001 when it is 0) each way.  Every bin is
    reported, empty bins with count 0 -> (bin, lo, hi, label, count).

    The edges need min / max before any row can be binned, so the input is
    read twice.  For a ``derived_input`` (e.g. the article table, a whole
    text pass) it is first folded to (value, count) - lossless, partially
    aggregated, so a hot value costs one row per map task - and that fold
    is checkpointed to the shared folder, so the input is computed once and
    both reads are of the small fold.  A plain column scan is cheaper to
    read twice.
    """
    v = F.col(value)
    if derived_input:
        df = (df.select(value).where(v.isNotNull() & ~F.isnan(v))
                .groupBy(value).agg(F.count(F.lit(1)).alias("_w"))
                .checkpoint(eager=True))      # one job: the input is computed once, as it is written
    stats = df.agg(F.min(v).alias("_mn"), F.max(v).alias("_mx"))
    mn, mx = F.col("_mn"), F.col("_mx")
    same = mn == mx
    widen = F.when(mn == 0, F.lit(0.001)).otherwise(F.abs(mn) * 0.001)
    lo = F.when(same, mn - widen).otherwise(mn)
    hi = F.when(same, mx + widen).otherwise(mx)
    edges = linspace_edges(lo, hi, n)
    adj = F.when(same, F.lit(0.0)).otherwise((mx - mn) * 0.001)
    edges[0] = edges[0] - adj
    stats = stats.select(F.array(*edges).alias("_edges"))  # one row
    return _histogram(df, value, stats, n, label_places, include_lowest=False, weight="_w" if derived_input else None)


def edge_histogram(df: DataFrame, value: str, edges: list[float], label_places: int = 2) -> DataFrame:
    """A8 ``pd.cut(col, bins=edges, labels=..., include_lowest=True)``:
    values outside [e0, en] are dropped, empty bins kept."""
    spark = df.sparkSession
    stats = spark.range(1).select(F.array(*[F.lit(float(e)) for e in edges]).alias("_edges"))
    return _histogram(df, value, stats, len(edges) - 1, label_places, include_lowest=True)


def _histogram(df, value, stats, n, label_places, include_lowest, weight=None):
    v = F.col(value)
    e = F.col("_edges")
    inner = F.slice(e, 2, n - 1)
    lo_ok = (v >= e[0]) if include_lowest else (v > e[0])
    cnt = F.count(F.lit(1)) if weight is None else F.sum(weight)
    # the statistics row is a single row: broadcasting it is bounded
    counted = (df.select(value, *([weight] if weight else [])).where(v.isNotNull() & ~F.isnan(v))
                 .crossJoin(F.broadcast(stats))
                 .where(lo_ok & (v <= e[n]))
                 .groupBy(bin_index(v, inner).alias("bin")).agg(cnt.alias("count")))
    bins = (stats.select(F.posexplode(F.arrays_zip(F.slice(e, 1, n).alias("lo"),
                                                  F.slice(e, 2, n).alias("hi"))).alias("i", "b"))
                 .select((F.col("i") + 1).alias("bin"), F.col("b.lo").alias("lo"), F.col("b.hi").alias("hi")))
    return (bins.join(counted, "bin", "left")
                .select("bin", "lo", "hi", bin_label("lo", "hi", label_places).alias("label"),
                        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))
                .orderBy("bin"))


# ---------------------------------------------------------------- trend line

def linear_fit(points: DataFrame, x: str, y: str) -> DataFrame:
    """A17 ordinary least squares of y on x (one feature) -> slope, intercept."""
    return points.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                      F.regr_intercept(F.col(y), F.col(x)).alias("intercept"))


def linear_forecast(fit: DataFrame, start: int, stop: int, x: str = "year", out: str = "forecast") -> DataFrame:
    """A18 / S13 evaluate the line for x in [start, stop) (numpy range)."""
    spark = fit.sparkSession
    years = spark.range(start, stop).select(F.col("id").cast("int").alias(x))
    return (years.crossJoin(F.broadcast(fit))  # one-row fit
                 .select(x, (F.col("slope") * F.col(x) + F.col("intercept")).alias(out)).orderBy(x))


def ci_band_outline(ci: DataFrame, key: str, low: str = "ci95_low", high: str = "ci95_high") -> DataFrame:
    """U3 closed outline of a confidence band: upper bounds by ascending key,
    then lower bounds by descending key -> (part, key, bound), ordered.
    The path order is (part, +key / -key): a sort, no global window."""
    up = ci.select(F.lit(0).alias("part"), F.col(key), F.col(high).alias("bound"))
    dn = ci.select(F.lit(1).alias("part"), F.col(key), F.col(low).alias("bound"))
    ordk = F.when(F.col("part") == 0, F.col(key)).otherwise(-F.col(key))
    return up.unionByName(dn).orderBy("part", ordk)
