"""Plan checks: pushdown, pruning, no row-at-a-time Python, bounded top-k."""

import __spark_entry__ as E

from paths import SF001


import contextlib
import io


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_flagship_pushes_language_filter_and_has_no_python(spark):
    p = plan(E.queries()["mean_ci_by_year"](spark, SF001))
    assert "EqualTo(lang,de)" in p and "EqualTo(lang,en)" in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_top_words_is_a_bounded_topk(spark):
    p = plan(E.queries()["top_k_words"](spark, SF001))
    assert "TakeOrderedAndProject" in p


def test_projection_is_pruned(spark):
    p = plan(E.queries()["mean_ci_orders_by_year"](spark, SF001))
    schema = [l for l in p.splitlines() if "ReadSchema" in l][0]
    assert "o_totalprice" in schema and "o_orderdate" in schema and schema.count(":") == 3


def test_row_ids_use_no_single_partition_window_over_rows(spark):
    # the range-partitioned rows are numbered and written once; what is left
    # is a window over one row per partition (their counts)
    p = plan(E.queries()["add_row_id"](spark, SF001))
    windows = [line for line in p.splitlines() if line.startswith("Arguments:") and "windowspecdefinition" in line]
    assert len(windows) == 1 and "_pid" in windows[0] and "article_id" not in windows[0]
    assert "Scan ExistingRDD" in p and "parquet" not in p


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[0] == "year"


def test_derived_tables_read_twice_are_computed_once(spark):
    """Queries that read a derived table twice (min/max then counts, fit then
    actuals, CI up then down, the n-gram counts) compute it once: the small
    fold is checkpointed while the query is built, so the final plan does
    not scan the documents again (at most one text pass, en + de)."""
    for name in ("histogram_10", "linear_forecast", "ci_band_outline", "train_language_profile",
                 "detect_language_ngram"):
        p = plan(E.queries()[name](spark, SF001))
        assert p.count("documents.parquet") == 0, name
    p = plan(E.queries()["unwanted_loanwords"](spark, SF001))
    assert p.count("documents.parquet") == 0


def test_flagship_exchanges(spark):
    """Ahead of the fold per year: the vocabulary by word, the entries by word, the found words by id, the labels by
    id; the words of an article are folded in its row, and the labels join on the exchange that is there."""
    p = plan(E.queries()["mean_ci_by_year"](spark, SF001))
    exchanges = [line for line in p.splitlines() if line.startswith("Arguments: hashpartitioning")]
    assert len(exchanges) == 5, exchanges
    assert sum("article_id" in e or "doc_id" in e for e in exchanges) == 2
