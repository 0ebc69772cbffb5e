"""C6 chart exports: every chart table of the analytics notebook from one
article table.  The article table (the expensive loanword stage) is
computed once and checkpointed to the shared folder; each chart is a small
aggregate written as one CSV with header."""

from __future__ import annotations

import functools
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import loanwords as L
from ..operators import stats as S
from ..sources.files import write_chart_csv
from .articles import loanword_articles

SENTIMENTS = ("negative", "neutral", "positive")
A8_EDGES = [-0.05 + i * (1.1 / 10) for i in range(10)] + [1.05]


def chart_tables(articles: DataFrame) -> dict[str, DataFrame]:
    """The chart tables of one (already materialised) article table."""
    yearly = S.group_mean(articles, "year", "loanword_density")
    ci = S.mean_ci(articles, "year", "loanword_density")
    fit = S.linear_fit(yearly.where(F.col("year").between(2016, 2023)), "year", "loanword_density")
    fc = S.linear_forecast(fit, 2016, 2028, x="year", out="Forecast Loanword Density")
    actual = yearly.where(F.col("year").between(2016, 2023)).withColumnRenamed("loanword_density",
                                                                               "Actual Loanword Density")
    return {
        "loanword_density_by_year": yearly,
        "loanword_density_confidence": ci.withColumnsRenamed({"year": "Year", "mean": "Avg Loanword Density",
                                                              "count": "Article Count", "ci95_low": "CI Lower",
                                                              "ci95_high": "CI Upper"}),
        "loanword_density_histogram": S.equal_width_histogram(articles, "loanword_density", 10, derived_input=False)
                                       .select(F.col("label").alias("density_bin"), F.col("count").alias("article_count")),
        "loanword_density_histogram_20": S.equal_width_histogram(articles, "loanword_density", 20, derived_input=False)
                                          .select(F.col("label").alias("density_bin"), F.col("count").alias("article_count")),
        "loanword_density_histogram_bins10": S.edge_histogram(articles, "loanword_density", A8_EDGES)
                                              .select(F.col("label").alias("Loanword Density Range"),
                                                      F.col("count").alias("Article Count")),
        "loanword_density_by_sentiment": S.group_mean(articles, "sentiment", "loanword_density"),
        "loanword_density_by_topic": S.group_mean(articles, "topic", "loanword_density"),
        "sentiment_pivot": S.pivot_mean(articles, "year", "sentiment", "loanword_density", SENTIMENTS),
        "top_loanwords": L.word_frequency(articles, "loanwords", "loanword")
                          .orderBy(F.col("frequency").desc(), "loanword").limit(20),
        "forecast": fc.withColumnRenamed("year", "Year").join(actual.withColumnRenamed("year", "Year"), "Year", "left"),
    }


def chart_exports(spark: SparkSession, sf_dir: str, out_dir: str) -> DataFrame:
    """Write every chart; returns (chart, row) read back from the files, a row
    as its fields in order, numbers rounded to six places."""
    articles = loanword_articles(spark, sf_dir, with_lists=True).checkpoint(eager=True)
    written = []
    for name, df in chart_tables(articles).items():
        path = os.path.join(out_dir, name)
        write_chart_csv(df, path)
        back = spark.read.option("header", "true").schema(df.schema).csv(path)
        cells = [F.coalesce(F.when(F.col(f"`{c}`").isNotNull(), F.format_string("%.6f", F.col(f"`{c}`"))) if t in ("double", "float") else F.col(f"`{c}`").cast("string"), F.lit(""))
                 for c, t in back.dtypes]
        written.append(back.select(F.lit(name).alias("chart"), F.concat_ws("|", *cells).alias("row")))
    return functools.reduce(DataFrame.unionByName, written)
