"""C1 resumable crawl-and-parse job.

input URLs -> minus URLs already in the result table (J2) -> join to the
crawl table (pages) on url -> parse (H13) -> append (S3).  A re-run after a
failure continues where the committed appends stopped; ``resume=False``
reprocesses everything.  Each append is one Spark job whose output commit
is atomic, and lost executors only rerun their tasks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import skip_done_urls
from ..sources.files import append_results
from .pages import parse_pages


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def crawl_resume(spark: SparkSession, urls: DataFrame, pages: DataFrame, out_path: str,
                 resume: bool = True) -> DataFrame:
    """Process the not-yet-done URLs and append them; returns the summary
    (appended rows) of this run."""
    todo = urls.select("url")
    if resume and _exists(spark, out_path):
        todo = skip_done_urls(todo, spark.read.parquet(out_path).select("url"))
    todo = todo.distinct()
    work = pages.join(todo, "url", "left_semi")
    parsed = parse_pages(work).withColumn("processed", F.lit(True))
    append_results(parsed, out_path)
    return spark.read.parquet(out_path).agg(F.count(F.lit(1)).alias("total_rows"))


def fresh_dir(base: str, name: str) -> str:
    import uuid
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
