"""Incremental jobs (inventory R1, R2) on Structured Streaming.

The reference resumes by re-reading its output and skipping done keys.  The
streaming form keeps that bookkeeping in the checkpoint: a file source
remembers which files it has read, the sink commits each micro-batch once,
and ``trigger(availableNow=True)`` processes what is there and stops - a
restarted job continues where the checkpoint ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import enrich as M


def incremental_enrich(spark: SparkSession, in_dir: str, schema: StructType | str, out_dir: str, checkpoint: str,
                       key: str = "url", event_time: str | None = None, watermark: str = "7 days",
                       backend: str = "rules") -> None:
    """R1 new article files are picked up, deduplicated on ``key``,
    enriched (sentiment) once and appended.  Without an event-time column
    the seen-key state grows with the data; with one, the state is bounded
    by the watermark (``dropDuplicatesWithinWatermark``)."""
    src = spark.readStream.schema(schema).parquet(in_dir)
    if event_time:
        src = src.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark([key])
    else:
        src = src.dropDuplicates([key])
    enriched = M.sentiment(src, "text", "sentiment", backend).drop("text")
    q = (enriched.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint)
                 .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


PUBLISHED = "_published"


def _files(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _versions(spark: SparkSession, out_dir: str) -> list[str]:
    """Names of the published versions, oldest first."""
    fs, at = _files(spark, f"{out_dir}/{PUBLISHED}")
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def publish_version(df: DataFrame, out_dir: str, keep: int = 2) -> None:
    """Replace a small table without a moment at which it is missing or half written.

    The rows go into a version folder of their own; an empty marker file named after it, made only when that job has
    committed, publishes it.  A crash before the marker leaves the last version in force (its folder without a marker is
    never read).  The last ``keep`` versions stay for readers under way, older published ones are removed.  One writer at
    a time, as a streaming query is."""
    spark = df.sparkSession
    names = _versions(spark, out_dir)
    name = f"{int(names[-1].split('-')[0]) + 1 if names else 0:012d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{out_dir}/{name}")
    fs, marker = _files(spark, f"{out_dir}/{PUBLISHED}/{name}")
    fs.create(marker, False).close()
    for old in names[:max(0, len(names) + 1 - keep)]:
        for path in (f"{out_dir}/{PUBLISHED}/{old}", f"{out_dir}/{old}"):
            fs, at = _files(spark, path)
            fs.delete(at, True)


def read_published(spark: SparkSession, out_dir: str) -> DataFrame:
    """The version of the newest marker."""
    names = _versions(spark, out_dir)
    if not names:
        raise ValueError(f"nothing published in {out_dir}")
    return spark.read.parquet(f"{out_dir}/{names[-1]}")


def incremental_year_stats(spark: SparkSession, in_dir: str, schema: StructType | str, out_dir: str, checkpoint: str,
                           key: str = "year", value: str = "loanword_density") -> None:
    """R2 yearly mean / count / std kept up to date: a streaming aggregate
    (state = one row per year) in complete mode, each micro-batch result
    published as a new version (``read_published``)."""
    src = spark.readStream.schema(schema).parquet(in_dir)
    agg = (src.where(F.col(key).isNotNull()).groupBy(key)
              .agg(F.avg(value).alias("mean"), F.count(value).alias("count"), F.stddev_samp(value).alias("std")))

    def publish(batch: DataFrame, epoch: int) -> None:
        publish_version(batch, out_dir)

    q = (agg.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
            .foreachBatch(publish).trigger(availableNow=True).start())
    q.awaitTermination()
