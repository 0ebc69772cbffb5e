"""Registered profiling / cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as PR
from ..plans.cleaning import clean_profile
from ..sources.tables import documents_with_labels, load
from . import finish, query
from .sqlparts import r

_PROFILE_COLS = ["article_id", "year", "topic", "lang", "text", "quality", "toxic", "sentiment"]
_PROFILE_SQL = """prof AS (
  SELECT d.doc_id AS article_id, CAST(2011 + d.doc_id % 15 AS INTEGER) AS year, d.source AS topic, d.lang, d.text,
         l.quality, l.toxic,
         CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive'
              WHEN l.toxic IS NOT NULL THEN 'neutral' END AS sentiment
  FROM documents d LEFT JOIN labels l USING (doc_id))"""
_LI_SQL = """li AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount, l_tax
  FROM lineitem)"""
_LI_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _profile(spark, sf_dir):
    return documents_with_labels(spark, sf_dir).select(*_PROFILE_COLS)


def _lineitem(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                     F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"), "l_tax")


def _unpivot_sql(expr_by_col: dict[str, str], name: str, value: str, src: str) -> str:
    parts = [f"SELECT '{c}' AS \"{name}\", {e} AS {value} FROM {src}" for c, e in expr_by_col.items()]
    return "\nUNION ALL ".join(parts)


_NULLS = {c: f"(SELECT CAST(count(*) - count({c}) AS BIGINT) FROM prof)" for c in _PROFILE_COLS}


@query("null_counts", f"WITH {_PROFILE_SQL} " + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM prof" for c in _PROFILE_COLS))
def null_counts(spark, sf_dir):
    """A9 nulls per column of the article profile table."""
    return PR.null_counts(_profile(spark, sf_dir))


_PCT_SQL = f"WITH {_PROFILE_SQL}, pct AS (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round((count(*) - count({c})) / count(*), 3) * 100 AS null_pct FROM prof"
    for c in _PROFILE_COLS) + ")"


@query("null_percentage", _PCT_SQL + f" SELECT \"column\", {r('null_pct', 'null_pct')} FROM pct")
def null_percentage(spark, sf_dir):
    """A10 null percentage per column, descending."""
    return finish(PR.null_percentage(_profile(spark, sf_dir)))


@query("drop_sparse_columns", f"WITH {_PROFILE_SQL}, m AS (SELECT * EXCLUDE (quality, toxic, sentiment) FROM prof) SELECT article_id, year, topic, lang, text FROM m")
def drop_sparse_columns(spark, sf_dir):
    """P4 the table without the columns that have 50 % nulls or more (the labels cover less than half of the rows)."""
    return PR.drop_sparse_columns(_profile(spark, sf_dir), 50)


@query("null_flags", f"WITH {_PROFILE_SQL} SELECT " + ", ".join(f"{c} IS NULL AS {c}" for c in _PROFILE_COLS) + " FROM prof")
def null_flags(spark, sf_dir):
    """P5 null test of every cell."""
    return PR.null_flags(_profile(spark, sf_dir))


@query("fill_mean", f"""WITH {_LI_SQL}
SELECT l_orderkey, l_linenumber, {r('coalesce(l_discount, (SELECT avg(l_discount) FROM li))', 'l_discount')} FROM li""")
def fill_mean(spark, sf_dir):
    """A11 numeric nulls -> column mean."""
    li = _lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_discount")
    return finish(PR.fill_mean(li, ["l_discount"]))


@query("fill_mode", f"""WITH {_PROFILE_SQL},
m AS (SELECT sentiment FROM prof WHERE sentiment IS NOT NULL GROUP BY sentiment ORDER BY count(*) DESC, sentiment LIMIT 1)
SELECT article_id, coalesce(prof.sentiment, (SELECT sentiment FROM m)) AS sentiment FROM prof""")
def fill_mode(spark, sf_dir):
    """A12 string nulls -> most frequent value (ties: smallest)."""
    return PR.fill_mode(_profile(spark, sf_dir).select("article_id", "sentiment"), ["sentiment"])


_Q_SQL = """q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)"""


@query("quartiles_iqr", f"""WITH {_Q_SQL}
SELECT {r('q1', 'q1')}, {r('q3', 'q3')}, {r('q3 - q1', 'iqr')}, {r('q1 - 1.5 * (q3 - q1)', 'lower')}, {r('q3 + 1.5 * (q3 - q1)', 'upper')} FROM q""")
def quartiles_iqr(spark, sf_dir):
    """A13 exact quartiles (linear interpolation), IQR, fences."""
    return finish(PR.quartiles_iqr(load(spark, sf_dir, "lineitem"), "l_extendedprice"))


@query("box_stats", f"""WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                       quantile_cont(value, 0.75) AS q3 FROM events),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper,
             q1 - 3.0 * (q3 - q1) AS s_lower, q3 + 3.0 * (q3 - q1) AS s_upper FROM q)
SELECT {r('q1', 'q1')}, {r('median', 'median')}, {r('q3', 'q3')}, {r('lower', 'lower')}, {r('upper', 'upper')},
       {r('min(value)', 'min')}, {r('max(value)', 'max')},
       {r('min(CASE WHEN value >= lower AND value <= upper THEN value END)', 'whisker_low')},
       {r('max(CASE WHEN value >= lower AND value <= upper THEN value END)', 'whisker_high')},
       count(CASE WHEN NOT (value >= lower AND value <= upper) THEN 1 END) AS n_outliers,
       count(CASE WHEN value < s_lower OR value > s_upper THEN 1 END) AS n_suspected
FROM events, f WHERE value IS NOT NULL GROUP BY q1, median, q3, lower, upper""")
def box_stats(spark, sf_dir):
    """A14 box plot table of a long-tailed column."""
    return finish(PR.box_stats(load(spark, sf_dir, "events"), "value"))


@query("outlier_rows", """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value FROM events, q WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def outlier_rows(spark, sf_dir):
    """A14 the rows drawn as outlier points."""
    return PR.outlier_rows(load(spark, sf_dir, "events").select("event_id", "value"), "value")


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql(lower_only: bool) -> str:
    rows = []
    for ia, a in enumerate(_CORR_COLS):
        for ib, b in enumerate(_CORR_COLS):
            if lower_only and not ia > ib:
                continue
            rows.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(f'corr({a}, {b})', 'r')} FROM li")
    return f"WITH {_LI_SQL} " + "\nUNION ALL ".join(rows)


@query("corr_matrix", _corr_sql(False))
def corr_matrix(spark, sf_dir):
    """A15 Pearson r for each pair of numeric columns."""
    return finish(PR.corr_matrix(_lineitem(spark, sf_dir), _CORR_COLS).select("col_a", "col_b", "r"))


@query("corr_lower_triangle", _corr_sql(True))
def corr_lower_triangle(spark, sf_dir):
    """A16 lower triangle of the correlation matrix."""
    return finish(PR.corr_lower_triangle(_lineitem(spark, sf_dir), _CORR_COLS).select("col_a", "col_b", "r"))


@query("filter_iqr", f"""WITH {_Q_SQL}
SELECT l_orderkey, l_linenumber FROM lineitem, q
WHERE l_extendedprice > q1 - 1.5 * (q3 - q1) AND l_extendedprice < q3 + 1.5 * (q3 - q1)""")
def filter_iqr(spark, sf_dir):
    """F7 rows strictly inside the IQR fences of one column."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return PR.filter_iqr(li, "l_extendedprice").select("l_orderkey", "l_linenumber")


def _iqr_chain_sql(src: str, cols: list[str], out: str) -> str:
    parts, prev = [], src
    for i, c in enumerate(cols):
        parts.append(f"""s{i} AS (SELECT {prev}.* FROM {prev}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {prev}) q
  WHERE {c} > q1 - 1.5 * (q3 - q1) AND {c} < q3 + 1.5 * (q3 - q1))""")
        prev = f"s{i}"
    return ",\n".join(parts) + f",\n{out} AS (SELECT * FROM {prev})"


_F8_COLS = ["l_quantity", "l_extendedprice", "l_tax"]


@query("filter_iqr_all", f"""WITH {_LI_SQL},
{_iqr_chain_sql('li', _F8_COLS, 'kept')}
SELECT l_orderkey, l_linenumber FROM kept""")
def filter_iqr_all(spark, sf_dir):
    """F8 IQR filter over several columns in turn (limits recomputed)."""
    li = _lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", *_F8_COLS)
    return PR.filter_iqr_all(li, _F8_COLS).select("l_orderkey", "l_linenumber")


_C7_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("clean_profile", f"""WITH {_LI_SQL},
filled AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
                  coalesce(l_discount, (SELECT avg(l_discount) FROM li)) AS l_discount, l_tax FROM li),
{_iqr_chain_sql('filled', _C7_COLS, 'kept')}
SELECT l_orderkey, l_linenumber, {r('l_quantity', 'l_quantity')}, {r('l_extendedprice', 'l_extendedprice')},
       {r('l_discount', 'l_discount')}, {r('l_tax', 'l_tax')} FROM kept""")
def clean_profile_q(spark, sf_dir):
    """C7 profile and clean: drop sparse columns (50 %), fill means and
    modes, IQR filter the value columns in turn."""
    return finish(clean_profile(_lineitem(spark, sf_dir), threshold=50.0, iqr_cols=_C7_COLS))
