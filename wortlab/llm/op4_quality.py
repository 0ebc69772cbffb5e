"""Operator 4: quality rules from a threshold table, compiled into one Spark projection.

``THRESHOLDS`` is the table: one row per rule with the metric, the comparison that rejects, and the bound.
``rule_columns`` compiles it into column expressions; ``quality_rules`` adds one boolean per rule and the verdict.  No user
function runs: counts come from built-in string and array functions over the whole text, row by row, without a shuffle.

Defined results.  A null or empty text, or one without a word, has no words, no lines and no stop words: all counts are 0,
``base_failed`` is true and ``kept`` false.  Ratios with an empty denominator are 0.  Repeated rows give repeated results;
an empty table gives none.  Only the id and text columns are read, so other columns cannot clash.
Three-word windows are compared by the 64-bit XXH64 of their words with separators (two different windows of one text
meet by chance with probability n^2 / 2^65).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

NAME = "op4_quality_rules"

#: rule, metric, comparison that rejects, bound.
THRESHOLDS = (
    ("short_words", "mean_word_chars", "<", 2.0),
    ("long_words", "mean_word_chars", ">", 14.0),
    ("symbols", "symbol_ratio", ">", 0.1),
    ("repeated_lines", "dup_line_ratio", ">", 0.5),
    ("no_stop_words", "stop_word_ratio", "<", 0.01),
)
#: Frequent function words of English, German, French and Spanish (fixed values).
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "on", "with", "as", "be", "at", "by", "this",
              "der", "die", "das", "und", "ist", "von", "zu", "mit", "den", "im", "auf", "für", "nicht", "ein", "eine",
              "le", "la", "les", "des", "et", "est", "un", "une", "du", "dans", "que", "pour", "qui", "sur", "avec",
              "el", "los", "las", "del", "y", "es", "en", "por", "con", "para", "se", "una", "de")
BASE_WORDS, BASE_REPEAT_PERCENT = 50, 50
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_window_words(words: Column) -> Column:
    """Words inside a three-word window that the text has at least twice, the first one included."""
    return _let(words, _repeated_window_words)


def _repeated_window_words(words: Column) -> Column:
    last = F.size(words) - 2
    hashes = F.transform(F.sequence(F.lit(0), last - 1),
                         lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def places(s):  # s: windows by hash and place; neighbours with equal hashes are the repeated ones
        n = F.size(s)
        pairs = F.filter(F.arrays_zip(F.slice(s, 1, n - 1).alias("a"), F.slice(s, 2, n - 1).alias("b")),
                         lambda x: x["a"]["h"] == x["b"]["h"])
        return F.sort_array(F.array_distinct(F.flatten(F.transform(pairs, lambda x: F.array(x["a"]["p"], x["b"]["p"])))))

    def cover(p):  # p: sorted places, two at least; each covers three words or up to the next place
        n = F.size(p)
        steps = F.zip_with(F.slice(p, 1, n - 1), F.slice(p, 2, n - 1), lambda a, b: F.least(b - a, F.lit(3)))
        return F.aggregate(steps, F.lit(3), lambda x, y: x + y)

    def repeats(h):  # most texts have no repeated window: equal sizes say so without a sort
        windows = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(_let(windows, places), cover))

    return F.when(last > 1, _let(hashes, repeats)).otherwise(0)


def metric_columns(text: str) -> dict[str, Column]:
    """Counts of one text, as columns over ``text``, ``_words`` and ``_lines``."""
    t, words = F.col(text), F.col("_words")
    lines = F.col("_lines")
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.regexp_replace(t, SPACE, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeated_window_words(words).cast("long"),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long"),
    }


RATIOS = {"mean_word_chars": ("word_chars", "n_words"), "symbol_ratio": ("n_symbols", "word_chars"),
          "dup_line_ratio": ("n_dup_lines", "n_lines"), "stop_word_ratio": ("n_stop_words", "n_words")}


def rule_columns(thresholds=THRESHOLDS) -> dict[str, Column]:
    """One boolean per row of the threshold table: true where the rule rejects."""
    out = {}
    for rule, metric, op, bound in thresholds:
        if metric in RATIOS:
            a, b = RATIOS[metric]
            value = F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
        else:
            value = F.col(metric)
        out[rule] = {"<": value < bound, "<=": value <= bound, ">": value > bound, ">=": value >= bound}[op]
    return out


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", thresholds=THRESHOLDS,
                  min_words: int = BASE_WORDS, max_repeat_percent: int = BASE_REPEAT_PERCENT) -> DataFrame:
    """Per row of ``docs``: the counts, one boolean per rule (``fails_<rule>``), ``base_failed`` and ``kept``."""
    return _judged(docs, id_col, text_col, thresholds, min_words, max_repeat_percent).drop("_at")


def _judged(docs: DataFrame, id_col: str, text_col: str, thresholds=THRESHOLDS, min_words: int = BASE_WORDS,
            max_repeat_percent: int = BASE_REPEAT_PERCENT) -> DataFrame:
    """``quality_rules`` with a column ``_at``: a filter that names it is not moved below the counts, so each is made once."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    d = d.select("doc_id", "_text", F.array_remove(F.split("_text", SPACE), "").alias("_words"),
                 F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    d = d.select("doc_id", F.monotonically_increasing_id().alias("_at"), *[c.alias(n) for n, c in metric_columns("_text").items()])
    rules = rule_columns(thresholds)
    d = d.withColumns({f"fails_{n}": c for n, c in rules.items()} | {
        "base_failed": (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))})
    return d.withColumn("kept", ~reduce(lambda a, b: a | b, [F.col(f"fails_{n}") for n in rules], F.col("base_failed")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``: a projection and a filter, no join."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    judged = _judged(docs.select(row, F.col("text").alias("text")), "row", "text")
    return judged.where(F.col("kept") & (F.col("_at") >= 0)).select("doc_id.*")


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k FROM w, unnest(range(1, len(ws) - 1)) AS u(i) WHERE len(ws) > 2),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM g) WHERE c > 1),
rep AS (SELECT r, count(*) AS n_repeat_words FROM (SELECT DISTINCT r, i + o AS p FROM hit, (VALUES (0), (1), (2)) AS v(o)) GROUP BY r),
m AS (SELECT w.r, doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols, len(ls) AS n_lines,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS n_stop
      FROM w LEFT JOIN rep USING (r)),
b AS (SELECT *, (n_words < {BASE_WORDS} OR 100 * n_repeat_words > {BASE_REPEAT_PERCENT} * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR (CASE WHEN n_words > 0 THEN CAST(word_chars AS DOUBLE) / n_words ELSE 0 END) < 2.0
            OR (CASE WHEN n_words > 0 THEN CAST(word_chars AS DOUBLE) / n_words ELSE 0 END) > 14.0
            OR (CASE WHEN word_chars > 0 THEN CAST(n_symbols AS DOUBLE) / word_chars ELSE 0 END) > 0.1
            OR (CASE WHEN n_lines > 0 THEN CAST(n_dup_lines AS DOUBLE) / n_lines ELSE 0 END) > 0.5
            OR (CASE WHEN n_words > 0 THEN CAST(n_stop AS DOUBLE) / n_words ELSE 0 END) < 0.01) AS kept
FROM b"""
