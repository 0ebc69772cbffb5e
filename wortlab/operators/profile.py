"""Profiling and cleaning (inventory P3-P5, A9-A16, F7, F8).

Whole-table statistics are single aggregation passes (partial + final);
their one-row results are broadcast back to the rows.  Quantiles are exact
and distributed (``order_stats``); the mode is a distributed count with a
bounded top-1 per column, never a value map in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, DoubleType, NumericType, StringType

from .order_stats import exact_quantiles

IQR_K = 1.5          # fixed value: Tukey fence factor
SUSPECT_K = 3.0      # fixed value: 'suspected' outliers in the box plot


def columns_by_kind(df: DataFrame) -> tuple[list[str], list[str]]:
    """P3 numeric and categorical column names (schema only, no job)."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    cat = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return num, cat


def is_missing(df: DataFrame, c: str) -> Column:
    """P5 null test of a cell; NaN counts as missing for floating columns."""
    dt = df.schema[c].dataType
    if isinstance(dt, (DoubleType, FloatType)):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def null_flags(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or df.columns
    return df.select(*[is_missing(df, c).alias(c) for c in cols])


def _unpivot(one_row: DataFrame, cols: list[str], name: str, value: str) -> DataFrame:
    return one_row.unpivot([], cols, name, value)


def null_counts(df: DataFrame) -> DataFrame:
    """A9 nulls per column -> (column, nulls), one aggregation pass."""
    row = df.agg(*[F.sum(is_missing(df, c).cast("long")).alias(c) for c in df.columns])
    return _unpivot(row, df.columns, "column", "nulls")


def null_percentage(df: DataFrame) -> DataFrame:
    """A10 round(nulls / rows, 3) * 100 per column, descending."""
    row = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.sum(is_missing(df, c).cast("long")).alias(c) for c in df.columns])
    pct = row.select(*[(F.round(F.try_divide(F.col(c), F.col("__rows")), 3) * 100).alias(c) for c in df.columns])
    return _unpivot(pct, df.columns, "column", "null_pct").orderBy(F.col("null_pct").desc(), "column")


def drop_sparse_columns(df: DataFrame, threshold: float) -> DataFrame:
    """P4 keep the columns whose null percentage is strictly below the
    threshold, ordered by descending null percentage.  The percentages are
    one value per column (a bounded collect), then a plain select."""
    pct = {r["column"]: r["null_pct"] for r in null_percentage(df).collect()}
    keep = sorted([c for c in df.columns if pct[c] is not None and pct[c] < threshold],
                  key=lambda c: (-pct[c], df.columns.index(c)))
    return df.select(*keep)


def fill_mean(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A11 numeric nulls -> column mean (one aggregate row, broadcast)."""
    num, _ = columns_by_kind(df)
    cols = cols or num
    means = df.agg(*[F.avg(c).alias(f"__m_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(means))
    return out.select(*[F.coalesce(F.col(c), F.col(f"__m_{c}").cast(df.schema[c].dataType)).alias(c)
                        if c in cols else F.col(c) for c in df.columns])


def column_modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Most frequent non-null value per column, ties to the smallest ->
    (column, mode).  Distributed: counts per (column, value) with partial
    aggregation, then a top-1 per column (partial window limit)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                         for c in cols])).alias("cv")).select("cv.column", "cv.value")
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value").asc())
    return (counts.withColumn("_rk", F.row_number().over(w)).where("_rk = 1")
                  .select("column", F.col("value").alias("mode")))


def fill_mode(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A12 string nulls -> most frequent value (ties: smallest); an all-null
    column stays null."""
    _, cat = columns_by_kind(df)
    cols = cols or cat
    modes = column_modes(df, cols)
    wide = modes.groupBy().pivot("column", cols).agg(F.first("mode"))   # one row
    wide = wide.select(*[F.col(c).alias(f"__mode_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(wide))
    return out.select(*[F.coalesce(F.col(c), F.col(f"__mode_{c}")).alias(c) if c in cols else F.col(c)
                        for c in df.columns])


def quartiles_iqr(df: DataFrame, col: str, k: float = IQR_K) -> DataFrame:
    """A13 Q1, Q3 (linear interpolation), IQR and both fences -> one row."""
    q = exact_quantiles(df, col, {"q1": 0.25, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    return q.select("q1", "q3", iqr.alias("iqr"), (F.col("q1") - k * iqr).alias("lower"),
                    (F.col("q3") + k * iqr).alias("upper"))


def box_stats(df: DataFrame, col: str, k: float = IQR_K, suspect_k: float = SUSPECT_K) -> DataFrame:
    """A14 the table behind a box plot: min, Q1, median, Q3, max, whisker
    ends (extreme values inside the fences), outlier and suspected counts."""
    q = exact_quantiles(df, col, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    q = q.select("q1", "median", "q3", (F.col("q1") - k * iqr).alias("lower"), (F.col("q3") + k * iqr).alias("upper"),
                 (F.col("q1") - suspect_k * iqr).alias("s_lower"), (F.col("q3") + suspect_k * iqr).alias("s_upper"))
    v = F.col(col)
    joined = df.select(col).where(v.isNotNull()).crossJoin(F.broadcast(q))   # one-row statistics
    inside = (v >= F.col("lower")) & (v <= F.col("upper"))
    return joined.groupBy("q1", "median", "q3", "lower", "upper").agg(
        F.min(v).alias("min"), F.max(v).alias("max"),
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("n_outliers"),
        F.count(F.when((v < F.col("s_lower")) | (v > F.col("s_upper")), 1)).alias("n_suspected"))


def outlier_rows(df: DataFrame, col: str, k: float = IQR_K) -> DataFrame:
    """A14 the points drawn outside the whiskers."""
    q = quartiles_iqr(df, col, k)
    v = F.col(col)
    return (df.crossJoin(F.broadcast(q.select("lower", "upper")))
              .where((v < F.col("lower")) | (v > F.col("upper"))).drop("lower", "upper"))


def filter_iqr(df: DataFrame, col: str, k: float = IQR_K) -> DataFrame:
    """F7 keep rows strictly inside (Q1 - k IQR, Q3 + k IQR); the quartiles
    come from the non-null values, rows with a null drop out."""
    q = quartiles_iqr(df, col, k)
    v = F.col(col)
    return (df.crossJoin(F.broadcast(q.select("lower", "upper")))
              .where((v > F.col("lower")) & (v < F.col("upper"))).drop("lower", "upper"))


def filter_iqr_all(df: DataFrame, cols: list[str] | None = None, k: float = IQR_K,
                   checkpoint_every: int = 1) -> DataFrame:
    """F8 F7 applied to each column in turn; each column's limits are
    computed on the rows the previous columns kept (order matters).
    Each column's result is materialised with a reliable checkpoint (shared
    checkpoint folder) before the next column's quartiles are computed, so
    no step recomputes the earlier ones and the plan stays flat."""
    num, _ = columns_by_kind(df)
    out = df
    for i, c in enumerate(cols or num):
        out = filter_iqr(out, c, k)
        if checkpoint_every and (i + 1) % checkpoint_every == 0:
            out = out.checkpoint(eager=True)
    return out


def corr_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A15 Pearson r for every ordered pair of numeric columns (pairwise
    complete rows) -> (col_a, col_b, r); one aggregation pass."""
    num, _ = columns_by_kind(df)
    cols = cols or num
    pairs = [(a, b) for a in cols for b in cols]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    long = row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                                   F.lit(ia).alias("ia"), F.lit(ib).alias("ib"),
                                                   F.col(f"{i}").alias("r"))
                                          for i, (a, b) in enumerate(pairs)
                                          for ia, ib in [(cols.index(a), cols.index(b))]])).alias("p"))
    return long.select("p.col_a", "p.col_b", "p.ia", "p.ib", "p.r")


def corr_lower_triangle(df: DataFrame, cols: list[str] | None = None, min_abs_r: float | None = None) -> DataFrame:
    """A16 the strictly lower triangle of A15 (optional |r| threshold)."""
    m = corr_matrix(df, cols).where(F.col("ia") > F.col("ib"))
    if min_abs_r is not None:
        m = m.where(F.abs("r") >= min_abs_r)
    return m
