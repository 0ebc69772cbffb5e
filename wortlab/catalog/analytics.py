"""Chart tables over the loanword article table (A1-A8, A17-A25, J1, T1-T5,
F6, F9, P1, P2, U3, S13) plus the same operators at volume on the
TPC-H-ish tables and ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import loanwords as L
from ..operators import stats as S
from ..plans.articles import loanword_articles
from ..sources.tables import load
from . import finish, query
from .sqlparts import r, with_articles

SENTIMENTS = ("negative", "neutral", "positive")
FIT_YEARS = (2016, 2023)          # fixed values: trend window of the chart notebook
FORECAST_YEARS = (2016, 2028)     # numpy range: 2016..2027
A8_EDGES = [-0.05 + i * (1.1 / 10) for i in range(10)] + [1.05]   # numpy.linspace(-0.05, 1.05, 11)


def _ci_sql(src: str, key: str, v: str) -> str:
    sem = f"stddev_samp({v}) / sqrt(count({v}))"
    return f"""SELECT {key}, {r(f'avg({v})', 'mean')}, count({v}) AS count, {r(f'stddev_samp({v})', 'std')},
       {r(sem, 'sem')}, {r(f'avg({v}) - 1.96 * {sem}', 'ci95_low')}, {r(f'avg({v}) + 1.96 * {sem}', 'ci95_high')}
FROM {src} WHERE {key} IS NOT NULL GROUP BY {key} ORDER BY {key}"""


@query("mean_ci_by_year", with_articles(_ci_sql("articles", "year", "loanword_density")))
def mean_ci_by_year(spark, sf_dir):
    """A5 flagship: yearly mean loanword density with a 95 % band."""
    return finish(S.mean_ci(loanword_articles(spark, sf_dir), "year", "loanword_density"))


@query("mean_ci_orders_by_year",
       _ci_sql("(SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice FROM orders)", "year", "o_totalprice"))
def mean_ci_orders_by_year(spark, sf_dir):
    """A5 at volume: order value by order year."""
    o = load(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), "o_totalprice")
    return finish(S.mean_ci(o, "year", "o_totalprice"))


def _mean_sql(keys: str) -> str:
    cond = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return with_articles(f"SELECT {keys}, {r('avg(loanword_density)', 'loanword_density')} FROM articles "
                         f"WHERE {cond} GROUP BY {keys} ORDER BY {keys}")


@query("mean_by_year", _mean_sql("year"))
def mean_by_year(spark, sf_dir):
    """A1 mean density per year (also T2: sorted by the key)."""
    return finish(S.group_mean(loanword_articles(spark, sf_dir), "year", "loanword_density"))


@query("mean_by_topic", _mean_sql("topic"))
def mean_by_topic(spark, sf_dir):
    """A2 mean density per topic."""
    return finish(S.group_mean(loanword_articles(spark, sf_dir), "topic", "loanword_density"))


@query("mean_by_sentiment", _mean_sql("sentiment"))
def mean_by_sentiment(spark, sf_dir):
    """A3 mean density per sentiment (unlabelled articles drop out)."""
    return finish(S.group_mean(loanword_articles(spark, sf_dir), "sentiment", "loanword_density"))


@query("mean_by_year_sentiment", _mean_sql("year, sentiment"))
def mean_by_year_sentiment(spark, sf_dir):
    """A4 mean per (year, sentiment)."""
    return finish(S.group_mean(loanword_articles(spark, sf_dir), ["year", "sentiment"], "loanword_density"))


@query("named_group_stats", f"""
SELECT l_returnflag, {r('avg(l_extendedprice)', 'mean')}, count(l_extendedprice) AS count,
       {r('stddev_samp(l_extendedprice)', 'std')}, {r('max(l_quantity)', 'max_qty')}
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY 1""")
def named_group_stats(spark, sf_dir):
    """A25 named aggregation at volume (lineitem by return flag)."""
    li = load(spark, sf_dir, "lineitem")
    return finish(S.named_group_stats(li, "l_returnflag", {
        "mean": ("mean", "l_extendedprice"), "count": ("count", "l_extendedprice"),
        "std": ("std", "l_extendedprice"), "max_qty": ("max", "l_quantity")}))


@query("derive_columns", f"""
SELECT l_returnflag, l_linestatus, {r('avg(l_quantity)', 'mean')}, count(l_quantity) AS count,
       {r('stddev_samp(l_quantity)', 'std')}, {r('stddev_samp(l_quantity) / sqrt(count(l_quantity))', 'sem')},
       {r('avg(l_quantity) - 1.96 * stddev_samp(l_quantity) / sqrt(count(l_quantity))', 'ci95_low')},
       {r('avg(l_quantity) + 1.96 * stddev_samp(l_quantity) / sqrt(count(l_quantity))', 'ci95_high')}
FROM lineitem GROUP BY 1, 2""")
def derive_columns(spark, sf_dir):
    """P2 derived columns (sem, CI bounds) over a two-key aggregate."""
    li = load(spark, sf_dir, "lineitem")
    g = (li.groupBy("l_returnflag", "l_linestatus")
           .agg(F.avg("l_quantity").alias("mean"), F.count("l_quantity").alias("count"),
                F.stddev_samp("l_quantity").alias("std")))
    sem = F.col("std") / F.sqrt(F.col("count"))
    return finish(g.withColumns({"sem": sem, "ci95_low": F.col("mean") - S.Z95 * sem,
                                 "ci95_high": F.col("mean") + S.Z95 * sem}))


# ------------------------------------------------------------------ histograms

def _label_sql(places: int, lo: str = "lo", hi: str = "hi") -> str:
    """X17 with the rounding rule of X14."""
    rounded = [f"floor({e} * {10 ** places}.0 + 0.5) / {10 ** places}.0" for e in (lo, hi)]
    return f"printf('%.{places}f - %.{places}f', {rounded[0]}, {rounded[1]})"


def _hist_sql(src: str, v: str, n: int, places: int = 6) -> str:
    return f"""st AS (SELECT min({v}) AS mn, max({v}) AS mx FROM {src}),
ex AS (SELECT CASE WHEN mn = mx THEN mn - (CASE WHEN mn = 0 THEN 0.001 ELSE abs(mn) * 0.001 END) ELSE mn END AS lo,
              CASE WHEN mn = mx THEN mx + (CASE WHEN mn = 0 THEN 0.001 ELSE abs(mn) * 0.001 END) ELSE mx END AS hi,
              CASE WHEN mn = mx THEN 0.0 ELSE (mx - mn) * 0.001 END AS adj FROM st),
eg AS (SELECT list_transform(range(0, {n} + 1), lambda i: CASE WHEN i = {n} THEN hi
              WHEN i = 0 THEN lo + CAST(i AS DOUBLE) * ((hi - lo) / {float(n)}) - adj
              ELSE lo + CAST(i AS DOUBLE) * ((hi - lo) / {float(n)}) END) AS e FROM ex),
cnt AS (SELECT 1 + len(list_filter(e[2:{n}], lambda x: x < {v})) AS bin, count(*) AS c
        FROM {src}, eg WHERE {v} > e[1] AND {v} <= e[{n} + 1] GROUP BY 1),
bins AS (SELECT CAST(b AS INTEGER) AS bin, e[b] AS lo, e[b + 1] AS hi FROM eg, range(1, {n} + 1) t(b))
SELECT bins.bin, {r('lo', 'lo')}, {r('hi', 'hi')}, {_label_sql(places)} AS label,
       CAST(coalesce(c, 0) AS BIGINT) AS count
FROM bins LEFT JOIN cnt USING (bin) ORDER BY bin"""


@query("histogram_10", with_articles(", " + _hist_sql("articles", "loanword_density", 10)).replace(")\n, st AS", "),\nst AS"))
def histogram_10(spark, sf_dir):
    """10 equal-width bins of the density, empty bins kept."""
    return finish(S.equal_width_histogram(loanword_articles(spark, sf_dir), "loanword_density", 10, 6))


@query("histogram_20", with_articles(", " + _hist_sql("articles", "loanword_density", 20)).replace(")\n, st AS", "),\nst AS"))
def histogram_20(spark, sf_dir):
    """A7 the same with 20 bins (the notebook computed them but wrote 10)."""
    return finish(S.equal_width_histogram(loanword_articles(spark, sf_dir), "loanword_density", 20, 6))


@query("histogram_events", "WITH " + _hist_sql("events", "value", 10))
def histogram_events(spark, sf_dir):
    """A6 at volume on a long-tailed column (has an empty bin)."""
    return finish(S.equal_width_histogram(load(spark, sf_dir, "events"), "value", 10, 6,
                                           derived_input=False))


def _edge_hist_sql() -> str:
    edges = ", ".join(repr(float(e)) for e in A8_EDGES)
    n = len(A8_EDGES) - 1
    return with_articles(f""", eg AS (SELECT [{edges}] AS e),
cnt AS (SELECT 1 + len(list_filter(e[2:{n}], lambda x: x < loanword_density)) AS bin, count(*) AS c
        FROM articles, eg WHERE loanword_density >= e[1] AND loanword_density <= e[{n} + 1] GROUP BY 1),
bins AS (SELECT CAST(b AS INTEGER) AS bin, e[b] AS lo, e[b + 1] AS hi FROM eg, range(1, {n} + 1) t(b))
SELECT bins.bin, {r('lo', 'lo')}, {r('hi', 'hi')}, {_label_sql(2)} AS label,
       CAST(coalesce(c, 0) AS BIGINT) AS count
FROM bins LEFT JOIN cnt USING (bin) ORDER BY bin""").replace(")\n, eg AS", "),\neg AS")


@query("histogram_edges", _edge_hist_sql())
def histogram_edges(spark, sf_dir):
    """A8 bins from given edges, lowest edge included, outside dropped."""
    return finish(S.edge_histogram(loanword_articles(spark, sf_dir), "loanword_density", A8_EDGES, 2))


# ------------------------------------------------------------------ trend line

_YEARLY = "yearly AS (SELECT year, avg(loanword_density) AS m FROM articles WHERE year IS NOT NULL GROUP BY year)"
_FIT = f"fit AS (SELECT regr_slope(m, year) AS slope, regr_intercept(m, year) AS intercept FROM yearly WHERE year BETWEEN {FIT_YEARS[0]} AND {FIT_YEARS[1]})"


def _fit(spark, sf_dir):
    # the yearly means (one row per year) feed both the fit and the actuals:
    # written once to the checkpoint folder, so the text pass runs once
    yearly = S.group_mean(loanword_articles(spark, sf_dir), "year", "loanword_density", "m").checkpoint(eager=True)
    inwin = yearly.where(F.col("year").between(*FIT_YEARS))          # F6
    return yearly, S.linear_fit(inwin, "year", "m")


@query("linear_fit", with_articles(f", {_YEARLY}, {_FIT} SELECT {r('slope', 'slope')}, {r('intercept', 'intercept', 6)} FROM fit").replace(")\n, yearly", "),\nyearly"))
def linear_fit(spark, sf_dir):
    """A17 least squares line over the yearly means of 2016-2023."""
    _, fit = _fit(spark, sf_dir)
    return fit.select(F.round("slope", 9).alias("slope"), F.round("intercept", 6).alias("intercept"))


@query("linear_forecast", with_articles(f""", {_YEARLY}, {_FIT}
SELECT CAST(y AS INTEGER) AS "Year", {r('slope * y + intercept', '"Forecast Loanword Density"', 6)},
       {r('yearly.m', '"Actual Loanword Density"', 6)}
FROM range({FORECAST_YEARS[0]}, {FORECAST_YEARS[1]}) t(y) CROSS JOIN fit
LEFT JOIN (SELECT * FROM yearly WHERE year BETWEEN {FIT_YEARS[0]} AND {FIT_YEARS[1]}) yearly ON yearly.year = t.y
ORDER BY 1""").replace(")\n, yearly", "),\nyearly"))
def linear_forecast(spark, sf_dir):
    """A18 + S13 + J1 + P1: forecast 2016..2027 left joined with the actual
    means of the fitted window (future years get null), chart names."""
    yearly, fit = _fit(spark, sf_dir)
    fc = S.linear_forecast(fit, *FORECAST_YEARS, x="year", out="forecast")
    actual = yearly.where(F.col("year").between(*FIT_YEARS))
    out = fc.join(actual, "year", "left").orderBy("year")       # J1 left equi join
    return out.select(F.col("year").alias("Year"),
                      F.round("forecast", 6).alias("Forecast Loanword Density"),
                      F.round("m", 6).alias("Actual Loanword Density"))


@query("growth_factor", with_articles(f""", {_YEARLY}
SELECT {r("max(CASE WHEN year = 2023 THEN m END) / max(CASE WHEN year = 2016 THEN m END)", 'growth_factor')} FROM yearly""")
       .replace(")\n, yearly", "),\nyearly"))
def growth_factor(spark, sf_dir):
    """A19 mean of 2023 / mean of 2016 (F9 lookups as conditional aggregates)."""
    yearly = S.group_mean(loanword_articles(spark, sf_dir), "year", "loanword_density", "m")
    return finish(S.growth_factor(yearly, "year", "m", 2016, 2023))


@query("lookup_group", with_articles(f""", {_YEARLY}
SELECT {r("max(CASE WHEN year = 2016 THEN m END)", 'value_2016')} FROM yearly""").replace(")\n, yearly", "),\nyearly"))
def lookup_group(spark, sf_dir):
    """F9 the value of one group, without collecting."""
    yearly = S.group_mean(loanword_articles(spark, sf_dir), "year", "loanword_density", "m")
    return finish(yearly.agg(S.group_value(yearly, "year", "m", 2016).alias("value_2016")))


@query("pivot_sentiment", with_articles(f"""
SELECT year, {', '.join(r(f"avg(CASE WHEN sentiment = '{s}' THEN loanword_density END)", s) for s in SENTIMENTS)}
FROM articles WHERE year IS NOT NULL GROUP BY year ORDER BY year"""))
def pivot_sentiment(spark, sf_dir):
    """A20 year x sentiment mean density; missing pair = null."""
    return finish(S.pivot_mean(loanword_articles(spark, sf_dir), "year", "sentiment", "loanword_density", SENTIMENTS))


@query("distinct_values", with_articles("SELECT DISTINCT sentiment FROM articles"))
def distinct_values(spark, sf_dir):
    """A21 distinct sentiments (null included)."""
    return S.distinct_values(loanword_articles(spark, sf_dir), "sentiment")


@query("shape", with_articles("SELECT 'articles' AS step, count(*) AS n_rows, 9 AS n_cols FROM articles"))
def shape(spark, sf_dir):
    """A24 rows and columns of the article table."""
    return S.shape(loanword_articles(spark, sf_dir), "articles")


@query("filter_year_range", with_articles(f"""
SELECT article_id, year, {r('loanword_density', 'loanword_density')} FROM articles WHERE year BETWEEN 2016 AND 2023"""))
def filter_year_range(spark, sf_dir):
    """F6 2016 <= year <= 2023."""
    a = loanword_articles(spark, sf_dir)
    return finish(a.where(F.col("year").between(2016, 2023)).select("article_id", "year", "loanword_density"))


@query("rename_columns", with_articles(f"""
SELECT year AS "Year", {r('avg(loanword_density)', '"Avg Loanword Density"')}, count(loanword_density) AS "Article Count",
       {r('avg(loanword_density) - 1.96 * stddev_samp(loanword_density) / sqrt(count(loanword_density))', '"CI Lower"')},
       {r('avg(loanword_density) + 1.96 * stddev_samp(loanword_density) / sqrt(count(loanword_density))', '"CI Upper"')}
FROM articles WHERE year IS NOT NULL GROUP BY year"""))
def rename_columns(spark, sf_dir):
    """P1 chart template names on the CI table."""
    ci = S.mean_ci(loanword_articles(spark, sf_dir), "year", "loanword_density")
    return finish(ci.select("year", "mean", "count", "ci95_low", "ci95_high")
                    .withColumnsRenamed({"year": "Year", "mean": "Avg Loanword Density", "count": "Article Count",
                                         "ci95_low": "CI Lower", "ci95_high": "CI Upper"}))


@query("ci_band_outline", with_articles(f""", ci AS ({_ci_sql('articles', 'year', 'loanword_density')})
SELECT 0 AS part, year, ci95_high AS bound FROM ci UNION ALL SELECT 1 AS part, year, ci95_low AS bound FROM ci""")
       .replace(")\n, ci AS", "),\nci AS"))
def ci_band_outline(spark, sf_dir):
    """U3 outline of the band: upper bounds ascending, lower descending."""
    # one row per year, read by both halves of the outline: checkpointed once
    ci = S.mean_ci(loanword_articles(spark, sf_dir), "year", "loanword_density").checkpoint(eager=True)
    return finish(S.ci_band_outline(finish(ci), "year"))


# ------------------------------------------------------------------ words

_LISTS = "lists AS (SELECT article_id, list(word ORDER BY pos) AS lw FROM loantok GROUP BY article_id)"


@query("word_frequency", with_articles("SELECT word, count(*) AS frequency FROM loantok GROUP BY word"))
def word_frequency(spark, sf_dir):
    """A22 global frequency of all loanwords: candidate words are counted
    before the vocabulary join (as in ``top_k_words``)."""
    return _loanword_counts(spark, sf_dir)


def _loanword_counts(spark, sf_dir):
    from ..plans.articles import TARGET_LANG, english_lexicon
    from ..sources.tables import documents_base
    arts = documents_base(spark, sf_dir).where(F.col("lang") == TARGET_LANG).select("article_id", "text")
    counts = L.tokenize_words(arts).groupBy("word").agg(F.count(F.lit(1)).alias("frequency"))
    return L.detect_loanwords(counts, english_lexicon(spark, sf_dir))


@query("top_k_words", with_articles("""
SELECT word, count(*) AS frequency FROM loantok GROUP BY word ORDER BY frequency DESC, word LIMIT 20"""))
def top_k_words(spark, sf_dir):
    """T1 the 20 most frequent loanwords (ties by the word).

    A word's frequency over all loanword lists is its number of loanword
    tokens, so no per-article list is built: candidate tokens are counted
    per word first (partial counts: only distinct words per map task are
    shuffled, a hot word is one row per task), then the vocabulary semi join
    keeps the loanwords, on data already partitioned by the word."""
    wf = _loanword_counts(spark, sf_dir)
    return wf.orderBy(F.col("frequency").desc(), "word").limit(20)


@query("sort_by_value", with_articles("""
SELECT * FROM (SELECT word, count(*) AS frequency FROM loantok GROUP BY word ORDER BY frequency DESC, word LIMIT 20)
ORDER BY frequency, word"""))
def sort_by_value(spark, sf_dir):
    """T3 the top words in chart order (ascending frequency)."""
    return top_k_words(spark, sf_dir).orderBy("frequency", "word")


@query("char_frequency", with_articles(f""", {_LISTS},
txt AS (SELECT '[' || coalesce((SELECT string_agg('''' || w || '''', ', ') FROM unnest(lw) t(w)), '') || ']' AS s
        FROM articles LEFT JOIN lists USING (article_id))
SELECT ch, count(*) AS frequency FROM (SELECT unnest(string_split(s, '')) AS ch FROM txt) GROUP BY ch""")
       .replace(")\n, lists", "),\nlists"))
def char_frequency(spark, sf_dir):
    """A23 character frequency of the list text (what the published
    'top loanwords' file actually counts)."""
    a = loanword_articles(spark, sf_dir, with_lists=True)
    txt = F.concat(F.lit("["), F.array_join(F.transform("loanwords", lambda w: F.concat(F.lit("'"), w, F.lit("'"))), ", "),
                   F.lit("]"))
    return L.char_frequency(a.select(txt.alias("s")), "s")


@query("head", with_articles(f"""
SELECT article_id, year, sentiment, {r('loanword_density', 'loanword_density')} FROM articles ORDER BY article_id LIMIT 5"""))
def head(spark, sf_dir):
    """T5 first 5 rows by id."""
    a = loanword_articles(spark, sf_dir)
    return finish(a.select("article_id", "year", "sentiment", "loanword_density").orderBy("article_id").limit(5))


# ------------------------------------------------------------------ joins, sorts, exports

@query("join_forecast_actuals", with_articles(f""", {_YEARLY}, {_FIT}
SELECT CAST(y AS INTEGER) AS year, {r('intercept + slope * y', 'forecast')}, {r('yearly.m', 'actual')}
FROM range({FORECAST_YEARS[0]}, {FORECAST_YEARS[1]}) t(y) CROSS JOIN fit
LEFT JOIN (SELECT * FROM yearly WHERE year BETWEEN {FIT_YEARS[0]} AND {FIT_YEARS[1]}) yearly ON yearly.year = t.y""")
       .replace(")\n, yearly", "),\nyearly"))
def join_forecast_actuals(spark, sf_dir):
    """J1 left equi join of the 12 forecast years with the actual means:
    years without an actual (outside the fitted window) stay, with null."""
    yearly, fit = _fit(spark, sf_dir)
    fc = S.linear_forecast(fit, *FORECAST_YEARS, x="year", out="forecast")
    j = fc.join(yearly.where(F.col("year").between(*FIT_YEARS)), "year", "left")
    return finish(j.select("year", "forecast", F.col("m").alias("actual")))


@query("bin_lookup", """WITH eg AS (SELECT [0.0, 50.0, 100.0, 200.0, 400.0, 500.0] AS e)
SELECT event_id, CASE WHEN value > e[1] AND value <= e[6] THEN 1 + len(list_filter(e[2:5], lambda x: x < value)) END AS bin
FROM events, eg""")
def bin_lookup(spark, sf_dir):
    """J4 range lookup: right-closed bin of each value from an edge array
    (one array expression per row, no range join)."""
    ev = load(spark, sf_dir, "events")
    e = [0.0, 50.0, 100.0, 200.0, 400.0, 500.0]
    v = F.col("value")
    inner = F.array(*[F.lit(x) for x in e[1:-1]])
    return ev.select("event_id", F.when((v > e[0]) & (v <= e[-1]), S.bin_index(v, inner)).alias("bin"))


@query("dense_bins", "WITH " + _hist_sql("events", "value", 10).replace(f"{_label_sql(6)} AS label,", "")
       .replace(f"{r('lo', 'lo')}, {r('hi', 'hi')}, ", ""))
def dense_bins(spark, sf_dir):
    """J5 bin table left join counts: empty bins appear with count 0."""
    h = S.equal_width_histogram(load(spark, sf_dir, "events"), "value", 10, derived_input=False)
    return h.select("bin", "count")


@query("sort_by_key", f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {r('avg(o_totalprice)', 'o_totalprice')}
FROM orders GROUP BY 1 ORDER BY 1""")
def sort_by_key(spark, sf_dir):
    """T2 group result in key order."""
    o = load(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), "o_totalprice")
    return finish(S.group_mean(o, "year", "o_totalprice"))


@query("sort_bins", "WITH " + _hist_sql("events", "value", 20))
def sort_bins(spark, sf_dir):
    """T4 bins in bin order (not label order), 20 bins."""
    return finish(S.equal_width_histogram(load(spark, sf_dir, "events"), "value", 20, 6,
                                           derived_input=False))


@query("broadcast_scalar", f"""WITH st AS (SELECT avg(l_extendedprice) AS m FROM lineitem)
SELECT l_orderkey, l_linenumber, {r('l_extendedprice - m', 'centered')} FROM lineitem, st""")
def broadcast_scalar(spark, sf_dir):
    """J8 a table-wide scalar applied to every row (one-row broadcast)."""
    li = load(spark, sf_dir, "lineitem")
    st = li.agg(F.avg("l_extendedprice").alias("m"))
    return finish(li.crossJoin(F.broadcast(st))
                    .select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") - F.col("m")).alias("centered")))


def _cell(expr: str) -> str:
    return f"coalesce(printf('%.6f', CAST({expr} AS DOUBLE)), '')"


def _chart(name: str, cells: list[str], source: str) -> str:
    return f"SELECT '{name}' AS chart, {' || chr(124) || '.join(cells)} AS row FROM {source}"


_SEM = "stddev_samp(loanword_density) / sqrt(count(loanword_density))"
_MEAN = _cell("avg(loanword_density)")
_HIST = "(SELECT label, count AS n FROM (WITH {}))"
_CHARTS = [
    _chart("loanword_density_by_year", ["year", _cell("m")], "yearly"),
    "SELECT 'loanword_density_confidence' AS chart, year || '|' || " + " || '|' || ".join([
        _MEAN, "count(loanword_density)", _cell("stddev_samp(loanword_density)"), _cell(_SEM), _cell(f"avg(loanword_density) - 1.96 * {_SEM}"),
        _cell(f"avg(loanword_density) + 1.96 * {_SEM}")]) + " AS row FROM articles WHERE year IS NOT NULL GROUP BY year",
    _chart("loanword_density_histogram", ["label", "n"], _HIST.format(_hist_sql("articles", "loanword_density", 10, 4))),
    _chart("loanword_density_histogram_20", ["label", "n"], _HIST.format(_hist_sql("articles", "loanword_density", 20, 4))),
    _chart("loanword_density_histogram_bins10", ["label", "count"], f"({_edge_hist_sql()})"),
    *[f"SELECT 'loanword_density_by_{k}' AS chart, {k} || '|' || {_MEAN} AS row FROM articles WHERE {k} IS NOT NULL GROUP BY {k}" for k in ("sentiment", "topic")],
    "SELECT 'sentiment_pivot' AS chart, year || '|' || " + " || '|' || ".join(
        _cell(f"avg(loanword_density) FILTER (WHERE sentiment = '{k}')") for k in ("negative", "neutral", "positive"))
    + " AS row FROM articles WHERE year IS NOT NULL GROUP BY year",
    _chart("top_loanwords", ["word", "n"], "(SELECT word, count(*) AS n FROM loantok GROUP BY word ORDER BY n DESC, word LIMIT 20)"),
    _chart("forecast", ["y", _cell("intercept + slope * y"), _cell("m")],
           f"range({FORECAST_YEARS[0]}, {FORECAST_YEARS[1]}) t(y) CROSS JOIN fit LEFT JOIN (SELECT * FROM yearly WHERE year BETWEEN {FIT_YEARS[0]} AND {FIT_YEARS[1]}) a ON a.year = t.y"),
]


@query("chart_exports", with_articles(f""", {_YEARLY}, {_FIT}
""" + "\nUNION ALL ".join(_CHARTS)).replace(")\n, yearly", "),\nyearly"))
def chart_exports(spark, sf_dir):
    """C6 every chart CSV of the notebook from one checkpointed article
    table -> (chart, row), all rows of all files read back."""
    from ..plans.crawl import fresh_dir
    from ..plans.exports import chart_exports as run
    from ..session import ensure_checkpoint_dir
    return run(spark, sf_dir, fresh_dir(ensure_checkpoint_dir(spark), "charts"))
