"""Operator 8: SimHash near-duplicates through an inverted index over byte positions.

1. Fingerprints: a numpy map over the texts (no shuffle).  Equal fingerprints are one entry from here on, so a group of
   copies of any size is one row.
2. Index: fingerprints at most d = 2 bits apart share at least 8 - d = 6 of the eight positional bytes, so of the four
   byte pairs (0,1) (2,3) (4,5) (6,7) two are equal.  The postings of single bytes are therefore kept intersected: one
   posting per union of two byte pairs (six per fingerprint, 32-bit keys), which loses no pair and keeps chance meetings rare.
3. Count filter: for each pair within a posting the shared positional bytes are tallied; pairs with 6 or more are kept and
   verified by their bit distance.
4. A posting with more than ``MAX_POSTING`` members is not paired.  Its members agree on four bytes, so two of them are at
   most 2 bits apart exactly if some value is at most one bit, among the other 32, from both: each member is listed under these 33
   values, and under each value (at most 33 members) linked to the smallest.  The components are the same, without pairs.
5. Components: alternating large and small stars over the links until nothing changes, each round a written table.

Defined results.  Null or wordless texts have fingerprint zero and are linked like any other.  Rows repeated under one
doc_id are separate rows with the same result.  A null doc_id has a fingerprint and links, but names a component only where
no member has an id (then component_id is null).  Only id and text are read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, blocks, documents, written

NAME = "op8_simhash_neardup"
SQL = None  # XXH64 is not a DuckDB function; tests hold it against brute force
SHINGLE, MAX_BITS, MAX_POSTING, SEED = 3, 2, 64, 42
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = 1 << 15


def _fingerprints(words: Words, size: int) -> np.ndarray:
    """SimHash of each document of a block: bit is 1 if set in over half of the hashes of its shingles."""
    length = words.end - words.start
    place = np.cumsum(length + 1) - length - 1
    text = np.full(int((length + 1).sum()), 0x20, np.uint8)
    is_word = np.ones(len(text), bool)
    is_word[place + length] = False
    text[is_word] = words.data[words.inside]
    text = text.tobytes()
    n = np.diff(words.first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), count)
    first = words.first[doc] + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    last = np.minimum(first + size, words.first[doc + 1]) - 1
    bits = np.zeros((len(n), 64), np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, len(first), _STEP):  # bounded even for one very long text
        f, la, d = first[a:a + _STEP], last[a:a + _STEP], doc[a:a + _STEP]
        h = np.fromiter([digest(text[i:j], SEED) for i, j in zip(place[f].tolist(), (place[la] + length[la]).tolist())], np.uint64, len(f))
        own, begin = np.unique(d, return_index=True)
        bits[own] += np.add.reduceat(np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), begin, axis=0, dtype=np.int32)
    return np.packbits(2 * bits > count[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, fp): the SimHash of each text as a signed 64-bit integer."""
    def make(batches):
        for rows, data, off in blocks(batches, "text"):
            fp = _fingerprints(Words(_LOWER[data], off), shingle)
            yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(make, T.StructType([T.StructField("doc_id", d.schema["doc_id"].dataType), T.StructField("fp", T.LongType())]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


#: Masks of the six unions of two byte pairs.
POSTINGS = [_signed(sum(0xFFFF << (16 * p) for p in pair)) for pair in itertools.combinations(range(4), 2)]


def shared_bytes(a: Column, b: Column) -> Column:
    """How many of the eight positional bytes two fingerprints share."""
    x = a.bitwiseXOR(b)
    return sum((x.bitwiseAND(F.lit(_signed(0xFF << (8 * i)))) == 0).cast("int") for i in range(8))


def links(nodes: DataFrame, max_bits: int = MAX_BITS, max_posting: int = MAX_POSTING) -> DataFrame:
    """Verified links (a < b) between different fingerprints ``fp``; large postings give a spanning set of theirs."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the byte pairs of the index guarantee a common posting up to 2 bits")
    index = nodes.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes"))
                                                   for i, m in enumerate(POSTINGS)])).alias("k")).select("fp", "k.part", "k.bytes")
    sizes = written(index.groupBy("part", "bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "op8-postings")
    listed = index.join(sizes, ["part", "bytes"])
    small = listed.where(F.col("n") <= max_posting).groupBy("part", "bytes").agg(F.sort_array(F.collect_list("fp")).alias("m"))
    pairs = (small.select("m", F.posexplode("m").alias("i", "a")).select("a", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("b")))
    near = [F.lit(0)] + [F.lit(_signed(1 << i)) for i in range(64)]
    free = [F.array(*[b for i, b in enumerate(near) if i == 0 or not m >> (i - 1) & 1]) for m in POSTINGS]
    large = listed.where(F.col("n") > max_posting)
    around = large.select("fp", "part", F.explode(F.element_at(F.array(*free), F.col("part") + 1)).alias("bit")) \
        .select("fp", "part", F.col("fp").bitwiseXOR(F.col("bit")).alias("value"))
    stars = (around.groupBy("part", "value").agg(F.collect_list("fp").alias("m")).where(F.size("m") > 1)  # at most 33 members
             .select(F.array_min("m").alias("a"), F.explode("m").alias("b")).where("a < b"))
    found = pairs.unionByName(stars).where(shared_bytes(F.col("a"), F.col("b")) >= 8 - max_bits)
    return found.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root): the smallest node reachable, for every node that has a link (alternating stars)."""
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "op8-links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "op8-least")
        large = written(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "op8-large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "op8-least")
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                                F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        edges = written(small.where("u != v").distinct(), "op8-links")
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state


def simhash_neardup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hexadecimal digits), component_id (smallest doc_id reachable over links)."""
    marked = written(fingerprints(docs, id_col, text_col, shingle), "op8-fingerprints")
    nodes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "op8-nodes")
    roots = components(links(nodes.select("fp"), max_bits))
    rooted = written(nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "op8-rooted")
    names = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "op8-names")
    named = written(rooted.join(names, "root").select("fp", "component_id"), "op8-components")
    return marked.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_neardup(documents(spark, sf_dir))


def keep_one(docs: DataFrame, repeats: bool = True) -> DataFrame:
    """Of each component the least row, by doc_id (null last) and then by its place; with ``repeats`` also the component's
    other rows under that doc_id, if it has one."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = written(docs.select(row, F.monotonically_increasing_id().alias("key")), "op8-rows")  # two jobs read the keys
    name = F.struct(F.col("row.doc_id").isNull().alias("unnamed"), F.col("row.doc_id").alias("id"), "key").alias("name")
    groups = simhash_neardup(rows.select(name, F.col("row.text").alias("text")), id_col="name")
    first = F.col("doc_id.key") == F.col("component_id.key")
    if repeats:
        first |= F.coalesce(F.col("doc_id.id") == F.col("component_id.id"), F.lit(False))
    return rows.join(groups.where(first).select("doc_id.key"), "key", "left_semi").select("row.*")
