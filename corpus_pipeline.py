"""The corpus pipeline: quality rules, near duplicates, repeated passages, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of
``documents``.  ``run`` writes each stage's result in the shared checkpoint folder and reads it for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wortlab.llm.common import documents, written
from wortlab.llm.op4_quality import keep_good
from wortlab.llm.op5_packing import pieces
from wortlab.llm.op7_decontam import drop_contaminated
from wortlab.llm.op8_simhash import keep_one
from wortlab.llm.op10_substring import drop_repeats
from wortlab.session import ensure_ready


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the quality rules reject go."""
    ensure_ready(spark)
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each group of near-duplicates one row stays, of the smallest doc_id (null last)."""
    ensure_ready(spark)
    return keep_one(docs, repeats=False)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: passages repeated anywhere are cut out of their documents."""
    ensure_ready(spark)
    return drop_repeats(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents with a benchmark passage go."""
    return drop_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one row per piece of a document in a packed sequence."""
    ensure_ready(spark)
    return pieces(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("packing", packing),
]
#: The last stage tokenizes and fingerprints use XXH64, which SQL cannot express; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
