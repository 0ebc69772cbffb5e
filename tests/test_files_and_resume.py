"""CSVs read in splits, done keys kept in buckets, versions of a published table."""

import contextlib
import io
import os
import uuid

import pytest
from pyspark.sql import functions as F

from wortlab.operators import incremental as I
from wortlab.sources import files as FS
from wortlab.streaming import incremental as R

TEXTS = ["", "eins\nzwei", "a\r\nb", "C:\\neu \\- \\\\", 'sagt "ja", geht', " Rand ", "\\", "\\e", "\\-e", None, "ä,ö;ü\t\u2028"]


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def rows_of(spark):
    rows = [(i, t, [t, "x"] if t is not None else None) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "id long, text string, words array<string>")


def test_own_csv_round_trip(spark, tmp_path):
    df = rows_of(spark)
    FS.write_articles_csv(df, str(tmp_path / "own"))
    back = FS.read_articles_csv(spark, str(tmp_path / "own"), df.schema)
    assert sorted(back.collect(), key=lambda r: r.id) == sorted(df.collect(), key=lambda r: r.id)
    FS.write_articles_csv(df.limit(0), str(tmp_path / "none"))
    assert FS.read_articles_csv(spark, str(tmp_path / "none"), df.schema).count() == 0


def test_one_own_csv_file_is_read_by_several_tasks(spark, tmp_path):
    df = spark.range(20000).select("id", F.concat(F.lit("eins\nzwei \\n "), F.col("id").cast("string")).alias("text"))
    FS.write_articles_csv(df.coalesce(1), str(tmp_path / "big"))
    assert len([f for f in os.listdir(tmp_path / "big") if f.endswith(".csv")]) == 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        back = FS.read_articles_csv(spark, str(tmp_path / "big"), df.schema)
        assert back.rdd.getNumPartitions() > 4
        assert back.exceptAll(df).count() == 0 and back.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_foreign_csv_keeps_line_ends(spark, tmp_path):
    import pandas as pd

    os.makedirs(tmp_path / "foreign")
    pd.DataFrame({"id": [1, 2], "text": ['a\nb "c"', "d\\n"]}).to_csv(tmp_path / "foreign" / "x.csv", index=False)
    got = FS.foreign_csv_to_parquet(spark, str(tmp_path / "foreign"), "id long, text string", str(tmp_path / "table"))
    assert sorted(map(tuple, got.collect())) == [(1, 'a\nb "c"'), (2, "d\\n")]


def test_done_keys_have_no_exchange(spark, tmp_path):
    name = "done_" + uuid.uuid4().hex[:8]
    keys = I.DoneKeys(spark, name, str(tmp_path / "done"), "id", "bigint")
    assert I.skip_done_ids(spark.range(3), keys.read(), "id").count() == 3
    keys.append(spark.range(0, 50))
    keys.append(spark.range(40, 60))
    df = spark.range(200).select((F.col("id") % 100).alias("id"), F.lit("x").alias("v"))
    left = I.skip_done_ids(df, keys.read(), "id")
    assert sorted(r.id for r in left.collect()) == sorted(list(range(60, 100)) * 2)
    assert plan(I.skip_done_ids(df, keys.read(), "id")).count("Arguments: hashpartitioning") == 1          # the rows to do; none of the done side
    assert plan(I.distinct_keys(keys.read(), "id")).count("Arguments: hashpartitioning") == 0
    # a later session knows the folder, not the catalog entry
    spark.sql(f"DROP TABLE {name}")
    again = I.DoneKeys(spark, name, str(tmp_path / "done"), "id", "bigint")
    again.append(spark.range(60, 70))
    left = I.skip_done_ids(df, again.read(), "id")
    assert sorted(r.id for r in left.collect()) == sorted(list(range(70, 100)) * 2)
    assert plan(I.skip_done_ids(df, again.read(), "id")).count("Arguments: hashpartitioning") == 1
    spark.sql(f"DROP TABLE {name}")


def test_null_ids(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "id long, v string")
    done = spark.createDataFrame([(1,), (1,)], "id long")
    assert sorted(r.v for r in I.skip_done_ids(df, done, "id").collect()) == ["b", "c", "d"]
    done = done.union(spark.createDataFrame([(None,), (None,)], "id long"))
    got = I.skip_done_ids(df.select("v", "id"), done, "id")
    assert [r.v for r in got.collect()] == ["b"] and got.columns == ["v", "id"]


def test_versions(spark, tmp_path):
    out = str(tmp_path / "stats")
    with pytest.raises(ValueError):
        R.read_published(spark, out)
    R.publish_version(spark.range(1), out)
    under_way = R.read_published(spark, out)
    spark.range(7).write.parquet(f"{out}/000000000009-crashed")          # a job that died before its marker
    assert R.read_published(spark, out).count() == 1
    R.publish_version(spark.range(2), out)
    assert under_way.count() == 1 and R.read_published(spark, out).count() == 2
    R.publish_version(spark.range(3), out)
    assert R.read_published(spark, out).count() == 3 and len(R._versions(spark, out)) == 2
