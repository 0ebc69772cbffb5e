"""Registered scalar-function queries (X1-X24) over ``documents`` and
``events``: one column expression each, checked against DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.stats import linspace_edges
from ..sources.tables import load
from . import finish, query
from .sqlparts import r, words_sql

_STRIP_SQL = "regexp_replace({e}, '^[\\s\\x{{85}}\\p{{Z}}]+|[\\s\\x{{85}}\\p{{Z}}]+$', '', 'g')"


def _doc(name, doc, spark_expr, sql_expr, table="documents", key="doc_id"):
    @query(name, f"SELECT {key}, {sql_expr} AS {name} FROM {table}")
    def fn(spark, sf_dir):
        return finish(load(spark, sf_dir, table).select(key, spark_expr().alias(name)))
    fn.__doc__ = doc
    fn.__name__ = name
    return fn


_doc("word_count", "X1 whitespace token count", lambda: X.word_count("text"), f"CAST({words_sql('text')} AS INTEGER)")
_doc("lower_trim", "X2 strip + lower", lambda: X.lower_trim(F.concat(F.lit("  "), F.upper("source"), F.lit("\n"))),
     "lower(" + _STRIP_SQL.format(e="'  ' || upper(source) || chr(10)") + ")")
_doc("capitalize", "X3 first letter upper, rest lower", lambda: F.sha2(X.capitalize("text"), 256),
     "sha256(upper(left(text, 1)) || lower(substring(text, 2)))")
_doc("prefix_chars", "X4 first 516 characters", lambda: X.prefix_chars("text", 516), "left(text, 516)")
_doc("split_csv_list", "X5 split on ',', trim, drop empty",
     lambda: F.array_join(X.split_csv_list(F.concat(F.lit(" "), F.col("source"), F.lit(", ,"), F.col("lang"), F.lit(" ,"))), "|"),
     "source || '|' || lang")
_doc("join_list", "X6 ', '.join(list)", lambda: X.join_list(F.array("lang", "source")), "lang || ', ' || source")
_doc("alpha_word_match", "X7 how many tokens are 4+ ASCII letters",
     lambda: F.size(F.filter(X.whitespace_tokens("text"), X.alpha_word_match)),
     "CAST(len(list_filter(regexp_split_to_array(text, '[\\t\\n\\x0B\\f\\r\\x1C-\\x1F\\x85\\p{Z}]+'), lambda x: regexp_matches(x, '^[A-Za-z]{4,}$'))) AS INTEGER)")
_doc("parse_py_list", "X8 Python list text -> array",
     lambda: F.array_join(X.parse_list(F.concat(F.lit("['"), F.col("lang"), F.lit("', '"), F.col("source"), F.lit("']"))), "|"),
     "lang || '|' || source")
_doc("parse_json_list", "X9 JSON list text -> array",
     lambda: F.array_join(X.parse_list(F.concat(F.lit('["'), F.col("lang"), F.lit('","'), F.col("source"), F.lit('"]'))), "|"),
     "lang || '|' || source")
_doc("to_json_list", "X10 list -> JSON text", lambda: X.to_json_list(F.array("lang", "source")),
     "'[\"' || lang || '\",\"' || source || '\"]'")
_doc("json_field", "X11 top-level JSON key", lambda: X.json_field("props", "k"), "json_extract_string(props, '$.k')",
     table="events", key="event_id")
_doc("date_part_text", "X12 text before 'T'", lambda: X.date_part_text(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")),
     "strftime(ts, '%Y-%m-%d')", table="events", key="event_id")
_doc("safe_ratio", "X13 a / b, 0 when b is 0", lambda: X.safe_ratio(F.col("value"), (F.col("user_id") % 3).cast("double")),
     r("CASE WHEN user_id % 3 = 0 THEN 0.0 ELSE value / (user_id % 3) END", "x").rsplit(" AS ", 1)[0],
     table="events", key="event_id")
# a third of the values are ties at the 5th place (odd multiples of 1 / 32)
_TIES = "CASE WHEN event_id % 3 = 0 THEN (event_id % 997 - 400) / 32.0 ELSE value / 7 END"
_doc("round_n", "X14 round half up to 4 places", lambda: X.round_n(F.expr(_TIES.replace("32.0", "32.0D")), 4), f"floor(({_TIES}) * 10000.0 + 0.5) / 10000.0",
     table="events", key="event_id")
_doc("sqrt", "X15 square root", lambda: F.sqrt("value"), r("sqrt(value)", "x").rsplit(" AS ", 1)[0],
     table="events", key="event_id")
_doc("format_bin", "X17 bin label text", lambda: X.bin_label(F.col("event_id") / 8.0, F.col("value") * 2, 2),
     "printf('%.2f - %.2f', floor(event_id / 8.0 * 100.0 + 0.5) / 100.0, floor(value * 2 * 100.0 + 0.5) / 100.0)", table="events", key="event_id")


@query("fill_empty_text", """SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), '') AS fill_empty_text
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def fill_empty_text(spark, sf_dir):
    """X18 null -> '' as text (unlabelled documents have no quality)."""
    d = load(spark, sf_dir, "documents").select("doc_id").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    return d.select("doc_id", X.fill_empty_text("quality").alias("fill_empty_text"))


_doc("cast_int", "X19 int() that gives null", lambda: X.cast_int(F.split_part(F.col("source"), F.lit("c"), F.lit(2))),
     "TRY_CAST(split_part(source, 'c', 2) AS INTEGER)")
_doc("contains_any", "X20 any literal occurs", lambda: X.contains_any("text", ["!", "?", "ß"]),
     "contains(text, '!') OR contains(text, '?') OR contains(text, 'ß')")
_doc("array_distinct_sorted", "X21 list(set(a)) in fixed order",
     lambda: F.array_join(X.array_distinct_sorted(F.array("source", "lang", "source")), "|"),
     "array_to_string(list_sort(list_distinct([source, lang, source])), '|')")
_doc("array_length", "X22 len(list)", lambda: X.array_length(X.whitespace_tokens("text")),
     "CAST(len(list_filter(regexp_split_to_array(text, '[\\t\\n\\x0B\\f\\r\\x1C-\\x1F\\x85\\p{Z}]+'), lambda x: x <> '')) AS INTEGER)")
_doc("strip_boundary", "X24 strip() of tabs, newlines and spaces",
     lambda: X.strip_boundary(F.concat(F.lit("\t "), F.col("source"), F.lit(" \n"))),
     _STRIP_SQL.format(e="chr(9) || ' ' || source || ' ' || chr(10)"))


@query("flatten_lists", "SELECT v, count(*) AS n FROM (SELECT unnest([lang, source]) AS v FROM documents) GROUP BY v")
def flatten_lists(spark, sf_dir):
    """X23 flatten list columns (explode) and count the items."""
    d = load(spark, sf_dir, "documents")
    return d.select(F.explode(F.array("lang", "source")).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))


@query("linspace", f"""WITH st AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
SELECT CAST(i AS INTEGER) AS i, {r("CASE WHEN i = 10 THEN hi ELSE lo + CAST(i AS DOUBLE) * ((hi - lo) / 10.0) END", "edge")}
FROM st, range(0, 11) t(i)""")
def linspace(spark, sf_dir):
    """X16 n + 1 equally spaced edges between min and max (numpy rule)."""
    ev = load(spark, sf_dir, "events")
    st = ev.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    edges = st.select(F.posexplode(F.array(*linspace_edges(F.col("lo"), F.col("hi"), 10))).alias("i", "edge"))
    return finish(edges)
