"""Operator 10: removal of repeated passages (windows of 35 words that start anywhere else in the corpus).

Method.  The named method - broadcast a suffix automaton for each shard of the corpus and stream every document through all
of them - costs shards x corpus, and one automaton state takes some hundred bytes and microseconds (figures in the
README), so it is kept for a bounded reference only: ``remove_reference_passages`` cuts what a given, size-checked reference
holds (matching statistics from broadcast automata).  Passages repeated inside the corpus are found by hashing, in jobs
that each grow with the input:

0. ``_copies``: rows repeated under one id are counted by a hash of (id, text) and one of them goes on; if there are
   others, all their windows are repeated.
1. ``window_runs``: every window's anchor is its 8-word gram with the least hash (the leftmost of equals); consecutive windows
   around one anchor make a run (about one per 14 words).  Equal windows have equal anchors at equal distances, so a
   window is repeated only if its anchor is, and no two windows of one run are equal.
2. Runs are counted by anchor (partial aggregation: a hot anchor is one row per task).  An anchor seen once drops out.
   An anchor whose runs are all the same words is settled: all its windows are repeated.
3. The windows of the other runs (edges of passages) are counted by their hash, and the repeated ones go back to their
   documents.
4. Each document is joined with its places once and cut.

No step holds a group of documents together, and joins whose one side has hot keys read written tables on both sides, so
that adaptive execution can split them.  Hashes have 64 bits: two different windows meet by chance with probability n^2/2^65.

Defined results.  Null text has no words and stays null if nothing is removed; a text under 35 words keeps all.  Rows are
told apart by (id, text), so repeated rows are copies of each other and lose their passages; a null id is allowed.  Words
are compared as bytes.  What is kept of a changed text is its words joined by one space; an unchanged text is returned as it
was.  Only id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, blocks, covered, documents, grams, mix, sliding_argmin, written

NAME = "op10_substring_dedup"
MIN_WORDS, GRAM = 35, 8
MAX_KEYS = 1 << 20  # of rows with copies that are broadcast (8 MB); above, they are joined by a shuffle
U64 = np.uint64


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("_key"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"))


def _copies(keyed: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """(the keys of rows that occur more than once, or None; one row of each key).  A row repeated very often is one row per task before
    it is shuffled, and its copies never meet in a list."""
    copied = written(keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("_key"), "op10-copies")
    n = copied.count()
    if not n:
        return None, keyed
    own = F.broadcast(copied) if n <= MAX_KEYS else copied
    one = keyed.join(own, "_key", "left_semi").groupBy("_key").agg(F.any_value("text").alias("text"))
    return copied, keyed.join(own, "_key", "left_anti").select("_key", "text").unionByName(one)


def _runs(words: Words, min_words: int):
    """Runs of windows of the block: first window (a word number), windows, anchor; then the window hashes and word documents."""
    h, k = words.hashes(), min(GRAM, min_words)
    window, gram, doc = grams(h, min_words, 0x51ED27), grams(h, k, 0x2545F4), words.doc()
    place = sliding_argmin(gram, min_words - k + 1)
    valid = doc[:len(window)] == doc[len(doc) - len(window):]  # the window ends in the document where it starts
    begins, stops = valid.copy(), valid.copy()
    change = place[1:] != place[:-1]
    begins[1:] &= ~valid[:-1] | change
    stops[:-1] &= ~valid[1:] | change
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(stops) + 1 - first, gram[place[first]], window, doc


def window_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows (anchor, content, key, start, n): the runs of each document; ``content`` hashes all words of the run."""
    def make(batches):
        for rows, data, off in blocks(batches, "text"):
            words = Words(data, off)
            first, n, anchor, window, doc = _runs(words, min_words)
            if not len(first):
                continue
            at = np.flatnonzero(covered(len(window), first, n))
            run = np.repeat(np.arange(len(first)), n)
            content = np.add.reduceat(mix(window[at] + (at - first[run]).astype(U64) * U64(0x9E3779B97F4A7C15)),
                                      np.cumsum(n) - n)
            key = rows.column(rows.schema.get_field_index("_key")).to_numpy(zero_copy_only=False)
            yield pa.record_batch({"anchor": anchor.view(np.int64), "content": content.view(np.int64),
                                   "key": key[doc[first]].astype(np.int64),
                                   "start": (first - words.first[doc[first]]).astype(np.int32), "n": n.astype(np.int32)})

    return docs.select("_key", "text").mapInArrow(make, "anchor long, content long, key long, start int, n int")


def _edge_windows(docs: DataFrame, min_words: int) -> DataFrame:
    """Rows (key, hash[], start[]): the windows of the unsettled runs, from rows (key, text, runs)."""
    def make(batches):
        for rows, data, off in blocks(batches, "text"):
            words = Words(data, off)
            window = grams(words.hashes(), min_words, 0x51ED27)
            out = {"key": [], "hash": [], "start": []}
            for d, (key, runs) in enumerate(zip(rows["key"].to_pylist(), rows["runs"])):
                v = runs.values
                start, n = v.field("start").to_numpy(), v.field("n").to_numpy()
                places = np.repeat(start - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                out["key"].append(key)
                out["start"].append(places.astype(np.int32))
                out["hash"].append(window[words.first[d] + places].view(np.int64))
            yield pa.record_batch([pa.array(out["key"], pa.int64()), pa.array(out["hash"], pa.list_(pa.int64())),
                                   pa.array(out["start"], pa.list_(pa.int32()))], names=list(out))

    return docs.mapInArrow(make, "key long, hash array<long>, start array<int>")


def repeated_places(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows (key, places): per document with repeated windows, an array of (start, n): n consecutive repeated windows."""
    anchors = written(
        window_runs(docs, min_words).groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("c"), F.min("content").alias("a"), F.max("content").alias("b"))
        .where("c > 1").select("anchor", (F.col("a") == F.col("b")).alias("settled")), "op10-anchors")
    runs = written(window_runs(docs, min_words).drop("content").join(anchors, "anchor").drop("anchor")
                   .groupBy("key").agg(F.collect_list(F.struct("start", "n", "settled")).alias("runs")), "op10-runs")
    open_runs = (runs.select("key", F.filter("runs", lambda r: ~r["settled"]).alias("runs")).where(F.size("runs") > 0))
    edges = written(_edge_windows(docs.select(F.col("_key").alias("key"), "text").join(open_runs, "key"), min_words), "op10-edges")
    windows = edges.select("key", F.explode(F.arrays_zip("hash", "start")).alias("w")).select("key", "w.hash", "w.start")
    again = written(windows.groupBy("hash").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("hash"), "op10-windows")
    hits = (windows.join(again, "hash").groupBy("key")
            .agg(F.collect_list(F.struct("start", F.lit(1).alias("n"))).alias("places")))
    settled = runs.select("key", F.transform(F.filter("runs", lambda r: r["settled"]),
                                             lambda r: F.struct(r["start"], r["n"])).alias("places")).where(F.size("places") > 0)
    return (settled.unionByName(hits).groupBy("key").agg(F.flatten(F.collect_list("places")).alias("places")))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per row: doc_id, text (what is kept), n_words, n_removed, spans (removed word ranges, start inclusive, end exclusive)."""
    keyed = _keyed(docs, id_col, text_col)
    copied, single = _copies(keyed)
    places = repeated_places(single, min_words)
    if copied is not None:  # every window of a row with copies is repeated
        all_words = F.array(F.struct(F.lit(0).alias("start"), F.lit(1 << 30).alias("n")))
        places = places.join(copied, places["key"] == copied["_key"], "left_anti").unionByName(copied.select(F.col("_key").alias("key"), all_words.alias("places")))
    return _cut(keyed.join(places, F.col("_key") == F.col("key"), "left").drop("_key", "key"), min_words)


def _cut(rows: DataFrame, min_words: int) -> DataFrame:
    """Removes the windows listed in ``places`` (array of (start, n)) from ``text``."""
    def make(batches):
        for batch in (b.slice(a, 500) for b in batches for a in range(0, b.num_rows, 500)):
            out = {"doc_id": [], "text": [], "n_words": [], "n_removed": [], "spans": []}
            for doc, text, places in zip(batch["doc_id"], batch["text"], batch["places"]):
                text, spans, removed = text.as_py(), [], 0
                words = (text or "").encode().split()
                if places.is_valid and len(places) and len(words) >= min_words:
                    v = places.values
                    gone = covered(len(words), v.field("start").to_numpy(), v.field("n").to_numpy() + (min_words - 1))
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                    spans = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]
                    removed = int(gone.sum())
                    text = b" ".join([words[i] for i in np.flatnonzero(~gone)]).decode()
                for k, x in zip(out, (doc.as_py(), text, len(words), removed, spans)):
                    out[k].append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], batch["doc_id"].type), pa.array(out["text"], pa.string()), pa.array(out["n_words"], pa.int64()),
                 pa.array(out["n_removed"], pa.int64()),
                 pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], names=list(out))

    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    return rows.select("doc_id", "text", "places").mapInArrow(make, T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("spans", T.ArrayType(span))]))


class SuffixAutomaton:
    """Suffix automaton over word sequences; sequences are told apart by a separator that no word equals."""

    def __init__(self):
        self.next, self.link, self.length, self.last = [{}], [-1], [0], 0

    def add(self, words) -> None:
        for w in [*words, None]:
            at, new = self.last, len(self.next)
            self.next.append({})
            self.length.append(self.length[at] + 1)
            self.link.append(0)
            while at >= 0 and w not in self.next[at]:
                self.next[at][w] = new
                at = self.link[at]
            if at >= 0:
                old = self.next[at][w]
                if self.length[old] == self.length[at] + 1:
                    self.link[new] = old
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[old]))
                    self.length.append(self.length[at] + 1)
                    self.link.append(self.link[old])
                    while at >= 0 and self.next[at].get(w) == old:
                        self.next[at][w] = copy
                        at = self.link[at]
                    self.link[old] = self.link[new] = copy
            self.last = new if w is not None else 0

    def matching(self, words) -> list[int]:
        """For each word, the length of the longest run ending there that the reference holds."""
        out, at, n = [], 0, 0
        for w in words:
            while at and w not in self.next[at]:
                at = self.link[at]
                n = self.length[at]
            if w in self.next[at]:
                at, n = self.next[at][w], n + 1
            else:
                at, n = 0, 0
            out.append(n)
        return out


REFERENCE_BYTES, SHARD_WORDS = 64 << 20, 200_000


def remove_reference_passages(docs: DataFrame, reference: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                              min_words: int = MIN_WORDS, max_reference_bytes: int = REFERENCE_BYTES) -> DataFrame:
    """Cuts every span of at least ``min_words`` words of ``docs`` that a text of ``reference`` holds word for word.

    The reference must be bounded: above ``max_reference_bytes`` of text this raises ValueError.  It is cut into shards of
    whole texts, one broadcast automaton each; documents are streamed for matching statistics, and the union over the shards goes.
    Same columns and defined results as ``substring_dedup``.
    """
    size = reference.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > max_reference_bytes:
        raise ValueError(f"the reference has {size} bytes of text; the bound is {max_reference_bytes}")
    shards, count = [SuffixAutomaton()], 0
    for row in reference.select("text").where(F.col("text").isNotNull()).distinct().toLocalIterator():
        words = row.text.encode().split()
        if count and count + len(words) > SHARD_WORDS:
            shards.append(SuffixAutomaton())
            count = 0
        shards[-1].add(words)
        count += len(words)
    sent = docs.sparkSession.sparkContext.broadcast(shards)

    @F.udf("array<struct<start:int,n:int>>")
    def find(text):
        words = (text or "").encode().split()
        return [(i - min_words + 1, 1) for a in sent.value for i, n in enumerate(a.matching(words)) if n >= min_words]

    return _cut(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("places", find("text")), min_words)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(documents(spark, sf_dir))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.array_join(words, " "), 256).alias("kept_sha256"))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with repeated passages cut from ``text``, in the columns of ``docs`` (``n_chars`` follows the text)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    cut = substring_dedup(docs.select(row.alias("row"), F.col("text").alias("text")), id_col="row")
    cut = cut.select("doc_id.*", "text")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*[f"`{c}`" for c in docs.columns])


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (SELECT r, i, array_to_string(ws[i:i + {MIN_WORDS - 1}], ' ') AS k FROM d, unnest(range(1, len(ws) - {MIN_WORDS - 2})) AS u(i) WHERE len(ws) >= {MIN_WORDS}),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS c FROM g) WHERE c > 1),
w AS (SELECT r, doc_id, ws, p, EXISTS (SELECT 1 FROM hit WHERE hit.r = x.r AND hit.i BETWEEN p - {MIN_WORDS - 1} AND p) AS gone
      FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM d) x)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(sum(gone::INT), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(ws[p], ' ' ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM (SELECT r, doc_id, ws, p, gone FROM w UNION ALL SELECT r, doc_id, ws, NULL, NULL FROM d WHERE len(ws) = 0)
GROUP BY r, doc_id, ws"""
