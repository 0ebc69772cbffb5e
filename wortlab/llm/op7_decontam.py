"""Operator 7: benchmark decontamination with suffix arrays over shards of the training text.

A shard is a block of whole documents (some MB of text) inside a task.  Its suffix array holds the places where the next
words all occur in the benchmark - no other suffix can match a test suffix - sorted by their first ten words.  Every test
suffix (each window of ten consecutive words of an item; the whole item if it has fewer) is binary-searched in the array;
consecutive hits on one diagonal are joined into the longest verbatim matches with their locations.  Documents never move:
the job is one scan and one map, hot passages included.

The benchmark is broadcast.  Its text is measured first and above ``max_benchmark_bytes`` the call raises ValueError.
Words are compared by 64-bit hashes.

Defined results.  Null or empty text has no words and no hits.  An item without a word has no window; rows with a null
item_id mark words but are not counted or listed; rows repeated under one item_id are one item with the windows of all its
rows.  An empty benchmark leaves every document clean.  Rows repeated in the documents are judged one by one.  Only the id
and text columns are read.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, blocks, covered, documents

NAME = "op7_decontaminate"
WINDOW, BENCHMARK_BYTES, SHARD_BYTES = 10, 128 << 20, 2 << 20
_BITS, _PER = 21, 3  # three word numbers in one integer

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _words(data: np.ndarray, off: np.ndarray) -> Words:
    return Words(_LOWER[data], off, _SEPARATOR)


def _packed(ids: np.ndarray, at: np.ndarray, run: np.ndarray, window: int, pad: int = 0) -> np.ndarray:
    """Rows of integers that sort as the first ``window`` word numbers from each place, ``pad`` after ``run`` words."""
    keys = np.zeros((-(-window // _PER), len(at)), np.int64)
    for j in range(keys.shape[0] * _PER):
        inside = (j < run) & (j < window)
        word = np.where(inside, ids[np.minimum(at + j, len(ids) - 1)], pad if j < window else 0)
        keys[j // _PER] = (keys[j // _PER] << _BITS) | word
    return keys


def _bound(array: np.ndarray, keys: np.ndarray, right: bool) -> np.ndarray:
    """For each key the first row of the sorted ``array`` not below it (right: above it), by binary search of all keys at once."""
    lo, hi = np.zeros(keys.shape[1], np.int64), np.full(keys.shape[1], array.shape[1], np.int64)
    while (go := lo < hi).any():
        mid = (lo + hi) // 2
        row = array[:, np.minimum(mid, array.shape[1] - 1)]
        below, open_ = np.zeros(len(mid), bool), np.ones(len(mid), bool)
        for a, b in zip(row, keys):
            below |= open_ & (a < b)
            open_ &= a == b
        if right:
            below |= open_
        lo = np.where(go & below, mid + 1, lo)
        hi = np.where(go & ~below, mid, hi)
    return lo


class TestSuffixes:
    """The test suffixes of the benchmark: vocabulary, sorted search keys, and the items and places of each suffix."""

    def __init__(self, rows: list[tuple[object, str | None]], window: int):
        self.window = window
        texts = [(t or "").encode() for _, t in rows]
        off = np.cumsum([0, *map(len, texts)])
        words = _words(np.frombuffer(b"".join(texts), np.uint8), off)
        self.vocabulary, ids = np.unique(words.hashes(), return_inverse=True)
        if len(self.vocabulary) >= 1 << _BITS:
            raise ValueError("the benchmark has too many different words")
        ids = ids + 1
        self.items = [r[0] for r in rows]
        found: dict[bytes, list[tuple[int, int]]] = {}
        for i in range(len(rows)):
            own = ids[words.first[i]:words.first[i + 1]]
            for j in range(max(len(own) - window, 0) + 1 if len(own) else 0):
                found.setdefault(own[j:j + window].tobytes(), []).append((i, j))
        keys = [np.frombuffer(k, ids.dtype) for k in found]
        self.length = np.array([len(k) for k in keys], np.int64)
        self.places = list(found.values())
        flat = np.concatenate(keys) if keys else np.zeros(1, np.int64)
        at = np.cumsum(self.length) - self.length
        self.low = _packed(flat, at, self.length, window)
        self.high = _packed(flat, at, self.length, window, (1 << _BITS) - 1)
        self.shortest = int(self.length.min()) if keys else 0
        self.filter = np.zeros(1 << 16, bool)
        self.filter[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        ids = np.zeros(len(hashes), np.int64)
        at = np.flatnonzero(self.filter[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        if len(at):
            k = np.minimum(np.searchsorted(self.vocabulary, hashes[at]), len(self.vocabulary) - 1)
            ids[at] = np.where(self.vocabulary[k] == hashes[at], k + 1, 0)
        return ids

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(place, suffix) of every occurrence of a test suffix in the shard."""
        none = np.zeros(0, np.int64)
        if not words.n or not self.shortest:
            return none, none
        ids = self.word_ids(words.hashes())
        stop = np.append(np.flatnonzero(ids == 0), words.n)
        here = np.arange(words.n)
        run = stop[np.searchsorted(stop, here)] - here
        run = np.minimum(run, np.repeat(words.first[1:], np.diff(words.first)) - here)
        at = np.flatnonzero(run >= self.shortest)
        if not len(at):
            return none, none
        keys = _packed(ids, at, run[at], self.window)
        order = np.lexsort(keys[::-1])
        array, places = keys[:, order], at[order]
        lo, hi = _bound(array, self.low, False), _bound(array, self.high, True)
        n = hi - lo
        suffix = np.repeat(np.arange(len(n)), n)
        return places[np.arange(int(n.sum())) + np.repeat(lo - np.cumsum(n) + n, n)], suffix

    def longest(self, hits: list[tuple[int, int]]) -> list[dict]:
        """Longest matches of one document from its (place, suffix) hits: hits on one diagonal of one item, joined."""
        lines: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for place, suffix in hits:
            for row, j in self.places[suffix]:
                lines.setdefault((row, place - j), []).append((place, int(self.length[suffix])))
        out = []
        for (row, diagonal), found in lines.items():
            start = end = None
            for place, length in sorted(found):
                if start is not None and place <= end - length + 1:
                    end = place + length
                    continue
                if start is not None:
                    out.append((row, start - diagonal, start, end - start))
                start, end = place, place + length
            out.append((row, start - diagonal, start, end - start))
        return [{"item_id": self.items[r], "item_start": a, "start": b, "length": n} for r, a, b, n in sorted(out, key=lambda x: (x[2], x[0], x[1]))]


def verbatim_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                     window: int = WINDOW, max_benchmark_bytes: int = BENCHMARK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, items (distinct, sorted as strings), matches (the longest verbatim
    matches: item_id, item_start, start, length in words), contaminated."""
    bench = benchmark.select(F.col(item_col).alias("item"), F.col("text"))
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > max_benchmark_bytes:
        raise ValueError(f"the benchmark has {size} bytes of text; the bound is {max_benchmark_bytes}")
    suffixes = TestSuffixes([(r.item, r.text) for r in bench.collect()], window)  # bounded above
    sent = docs.sparkSession.sparkContext.broadcast(suffixes)
    item_type, id_field = bench.schema["item"].dataType, T.StructField("doc_id", docs.select(F.col(id_col).alias("d")).schema["d"].dataType)
    schema = T.StructType([id_field, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                           T.StructField("items", T.ArrayType(item_type)),
                           T.StructField("matches", T.ArrayType(T.StructType([
                               T.StructField("item_id", item_type), T.StructField("item_start", T.IntegerType()),
                               T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())]))),
                           T.StructField("contaminated", T.BooleanType())])

    def make(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        suffixes, kinds = sent.value, to_arrow_schema(schema)
        for rows, data, off in blocks(batches, "text", SHARD_BYTES):
            words = _words(data, off)
            place, suffix = suffixes.search(words)
            n = np.diff(words.first)
            hit = covered(words.n, place, suffixes.length[suffix]) if len(place) else np.zeros(words.n, bool)
            sums = np.concatenate(([0], np.cumsum(hit)))
            n_hit = sums[words.first[1:]] - sums[words.first[:-1]]
            items, matches = [[]] * len(n), [[]] * len(n)
            doc = np.searchsorted(words.first, place, "right") - 1
            order = np.argsort(doc, kind="stable")
            doc, place, suffix = doc[order], place[order], suffix[order]
            found, begin = np.unique(doc, return_index=True)
            for d, a, b in zip(found.tolist(), begin.tolist(), [*begin[1:].tolist(), len(doc)]):
                own = suffixes.longest([*zip((place[a:b] - words.first[d]).tolist(), suffix[a:b].tolist())])
                matches[d] = own
                items[d] = sorted({m["item_id"] for m in own if m["item_id"] is not None}, key=str)
            yield pa.RecordBatch.from_arrays([
                rows["doc_id"], pa.array(n, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, kinds.field("items").type),
                pa.array(matches, kinds.field("matches").type), pa.array(n_hit > 0, pa.bool_())], names=schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(make, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = verbatim_matches(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.transform("items", lambda x: x.cast("string")), ","), 256).alias("items_sha256"),
                        "contaminated")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, with the columns of ``docs``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = verbatim_matches(docs.select(row.alias("row"), F.col("text").alias("text")), benchmark, id_col="row")
    return found.where("NOT contaminated").select("doc_id.*")


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SQL = f"""
WITH b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(ws), {WINDOW}) AS n, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS k
        FROM b, unnest(range(1, greatest(len(ws) - {WINDOW - 1}, 1) + 1)) AS u(i) WHERE len(ws) > 0),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
g AS (SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS k FROM d, (SELECT DISTINCT n FROM win) l, unnest(range(1, len(ws) - n + 2)) AS u(i)
      WHERE len(ws) >= n),
hit AS (SELECT g.r, g.i, g.n, win.item_id FROM g JOIN win USING (n, k)),
p AS (SELECT r, count(DISTINCT i + o) AS n_hit FROM (SELECT DISTINCT r, i, n FROM hit), unnest(range(0, n)) AS u(o) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN it USING (r)"""
