"""Resume and merge operators (inventory J2, J3, U1, U4, T6).

Skipping finished work is a left anti join against the done keys: the input
side keeps its duplicates, the done side is reduced to distinct keys first
(partial aggregation), and AQE broadcasts it only when it measured small.
Done keys that are kept for the next resume go into a table bucketed by the
key (``DoneKeys``): the anti join reads it in place, however large it grew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def distinct_keys(done: DataFrame, key: str) -> DataFrame:
    """U4 the set of processed keys."""
    return done.select(key).distinct()


def skip_done_urls(urls: DataFrame, done: DataFrame, key: str = "url") -> DataFrame:
    """J2 input rows whose URL is not in the results (input duplicates kept;
    a key done twice does not duplicate anything)."""
    return urls.join(distinct_keys(done, key), key, "left_anti")


def skip_done_ids(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """J3 rows whose id is not processed yet.  Null-safe: a null id is kept
    unless null itself is among the done ids (``NOT IN`` would drop it).  An
    equality join, which a bucketed done side meets in place; whether null is
    done is one row, joined to the rows with a null id alone."""
    rest = df.join(distinct_keys(done, key), key, "left_anti").select(*df.columns)
    null_done = done.where(F.col(key).isNull()).select(F.lit(True).alias("__null_done")).limit(1)
    return rest.join(F.broadcast(null_done), F.col(key).isNull() & F.col("__null_done"), "left_anti")   # at most one row


class DoneKeys:
    """U4 the processed keys as a Parquet table at ``path``, bucketed by the key.

    Every ``append`` is one job that adds a file per bucket and task, so keep appends coarse; a key appended twice is
    harmless.  ``buckets`` is fixed by the first append and must be given again by later sessions; below
    ``spark.sql.shuffle.partitions`` (its default) Spark may shuffle both sides after all.  The catalog entry is made
    anew where the session's catalog does not know the table.  Null keys are kept, and count in ``skip_done_ids``."""

    def __init__(self, spark: SparkSession, table: str, path: str, key: str, key_type: str = "string", buckets: int | None = None):
        self.spark, self.table, self.path, self.key, self.key_type = spark, table, path, key, key_type
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{table}` (`{key}` {key_type}) USING parquet "
                  f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def append(self, rows: DataFrame) -> None:
        """Keys of the rows, folded to distinct ones; partitioned as the buckets are, each bucket is one task's file."""
        keys = rows.select(F.col(self.key).cast(self.key_type)).repartition(self.buckets, self.key).distinct()
        (keys.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key).option("path", self.path)
             .mode("append").saveAsTable(self.table))

    def read(self) -> DataFrame:
        return self.spark.table(self.table)


def limit_work(df: DataFrame, key: str, limit: int | None) -> DataFrame:
    """T6 the first ``limit`` rows by key; 0 or None means no limit.
    ``orderBy + limit`` plans a top-k: every task keeps only ``limit`` rows."""
    if not limit:
        return df
    return df.orderBy(key).limit(limit)


def merge_progress(old: DataFrame, new: DataFrame) -> DataFrame:
    """U1 union by column name; columns missing on one side are null."""
    return old.unionByName(new, allowMissingColumns=True)
