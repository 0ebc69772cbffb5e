"""Article tables: the analytics input with loanword statistics (H14's
loanword stage over the ``documents`` stand-in)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import loanwords as L
from ..sources.tables import documents_with_labels, documents_base, label_columns

SOURCE_LANG = "en"   # vocabulary corpus
TARGET_LANG = "de"   # articles measured for English loanwords


def english_lexicon(spark: SparkSession, sf_dir: str, min_count: int = 2) -> DataFrame:
    """L2(a) vocabulary from the English documents (filter pushed to the scan)."""
    docs = documents_base(spark, sf_dir).where(F.col("lang") == SOURCE_LANG)
    return L.build_lexicon(L.tokenize_words(docs.select("article_id", "text")), min_count)


def loanword_articles(spark: SparkSession, sf_dir: str, with_lists: bool = False,
                      lexicon: DataFrame | None = None) -> DataFrame:
    """Article table: article_id, year, sentiment, topic, quality, toxic,
    word_count, loanword_count, loanword_density (+ lists when asked)."""
    lex = lexicon if lexicon is not None else english_lexicon(spark, sf_dir)
    arts = (documents_base(spark, sf_dir).where(F.col("lang") == TARGET_LANG)
            .select("article_id", "year", "topic", "text"))
    table = L.loanword_table(arts, lex, with_lists=with_lists)
    # labels join after the fold: only ids and small columns are shuffled
    return label_columns(table, spark, sf_dir)
