"""File sources and sinks (inventory S1-S5, S11).

Parquet is the format between steps; CSV and text only at the edges.  Paths
are folders (Spark writes part files); on a cluster they live on shared
storage - see ``session.scratch_path``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.text import parse_list

# CSV with header, '"' quotes and inner quotes doubled, as pandas writes it
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# own CSVs keep one record per line, so that Spark reads a file in splits: in
# text cells a line feed is "\\n", a carriage return "\\r", a backslash "\\-",
# an empty text "\\e" (an empty cell is null)
ESCAPES = (("\\", "\\-"), ("\n", "\\n"), ("\r", "\\r"))
EMPTY = "\\e"


def _escaped(c: Column) -> Column:
    for char, code in ESCAPES:
        c = F.replace(c, F.lit(char), F.lit(code))
    return F.when(c == "", EMPTY).otherwise(c)


def _unescaped(c: Column) -> Column:
    # every backslash of an escaped text is followed by the letter of its code
    empty = c == EMPTY
    for char, code in reversed(ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(char))
    return F.when(empty, "").otherwise(c)


def _flat(schema: StructType | str) -> tuple[StructType, StructType]:
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return st, StructType([StructField(f.name, StringType(), True) if isinstance(f.dataType, ArrayType) else f for f in st.fields])


def _cells(df: DataFrame, st: StructType, text) -> DataFrame:
    """The columns of a CSV under the schema: ``text`` of every text cell, list text decoded."""
    def cell(f: StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, ArrayType):
            return parse_list(text(c)).alias(f.name)
        return (text(c) if isinstance(f.dataType, StringType) else c).alias(f.name)
    return df.select(*map(cell, st.fields))


def read_articles_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """S1 read an own CSV (``write_articles_csv``) under an explicit schema (no inference pass).  One record is one line:
    a large file is read by many tasks.  Array columns are stored as list text and decoded with ``from_json``."""
    st, flat = _flat(schema)
    return _cells(spark.read.options(**CSV_OPTIONS).schema(flat).csv(path), st, _unescaped)


def read_foreign_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """S1 read a CSV written elsewhere, whose quoted cells may hold line ends: no place in such a file is known to begin
    a record, so one task reads each file.  Take a large one to Parquet once with ``foreign_csv_to_parquet``."""
    st, flat = _flat(schema)
    return _cells(spark.read.options(**CSV_OPTIONS, multiLine="true").schema(flat).csv(path), st, lambda c: c)


def foreign_csv_to_parquet(spark: SparkSession, path: str, schema: StructType | str, out: str) -> DataFrame:
    """S1 the one step that pays for line ends in cells: a foreign CSV as a Parquet table."""
    read_foreign_csv(spark, path, schema).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def _listed(df: DataFrame, text) -> DataFrame:
    def cell(f: StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, ArrayType):
            return text(F.to_json(c)).alias(f.name)
        return (text(c) if isinstance(f.dataType, StringType) else c).alias(f.name)
    return df.select(*map(cell, df.schema.fields))


def write_articles_csv(df: DataFrame, path: str) -> None:
    """Own CSV of a large table, one record per line, one file per task."""
    _listed(df, _escaped).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_chart_csv(df: DataFrame, path: str, single_file: bool = True) -> None:
    """S2 write a chart-ready result with a header, cells as they are (for
    other programs).  ``single_file`` folds to one part file - only for small
    aggregated results."""
    out = _listed(df, lambda c: c)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def append_results(df: DataFrame, path: str) -> None:
    """S3 append rows to a result table (Parquet; the job's output commit
    makes each append all-or-nothing)."""
    df.write.mode("append").parquet(path)


def read_results(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """S4 one URL per line, trimmed, blank lines dropped -> (url)."""
    v = F.regexp_replace(F.col("value"), r"^\s+|\s+$", "")
    return spark.read.text(path).select(v.alias("url")).where(F.col("url") != "")


def write_url_list(df: DataFrame, path: str, url_col: str = "url") -> None:
    """S5 append URLs to a text folder, one per line."""
    df.select(F.col(url_col).alias("value")).write.mode("append").text(path)


def load_progress(spark: SparkSession, path: str, list_cols=("excluded_loanwords", "refined_loanwords")) -> DataFrame:
    """S11 read an own progress CSV, every column as text, the list columns (JSON / list text) decoded."""
    df = spark.read.options(**CSV_OPTIONS).csv(path)
    return df.select(*[(parse_list(_unescaped(F.col(f"`{c}`"))) if c in list_cols else _unescaped(F.col(f"`{c}`"))).alias(c)
                       for c in df.columns])


def require_columns(df: DataFrame, columns) -> DataFrame:
    """S10 stop early (before any job) when required columns are missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required column(s): {', '.join(missing)}")
    return df
