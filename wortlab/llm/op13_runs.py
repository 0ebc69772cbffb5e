"""Operator 13: periodic runs of words by an enhanced suffix array (suffix array, its inverse, LCP intervals; no tree nodes).

A block of whole documents is one array of word numbers; the number of a document is part of its words, so no suffix of one
document matches another's.  Prefix doubling sorts the suffixes: level k ranks the first 2^k words, and only places whose
rank is still shared go on.  The levels are kept: they answer how far two places agree, to the right (LCP) and to the left.

For each LCP interval of depth d, all children but the largest are listed; for each of their suffixes i it is tested whether
i + d, or i - d, lies in the interval (by its place in the inverse array) but in another child: then d words are repeated at
once and the next word differs, a branching tandem repeat.  Each is rotated to the left as far as words d apart agree, which
gives the run of period d that ends there; of runs over the same words the smallest period stays.  Work is n log n.

Memory is some 100 bytes a word of the block, a block being 1 MB of text or one document.  No data are shuffled.

Defined results.  A null or empty text has no words and no run; its collapsed text is empty.  Rows repeated under one id are rows
of their own; null ids are allowed.  An empty table gives no row.  Words are compared whole, not by hashes.  Only id and text
are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import distinct
from .common import Words, blocks, covered, documents

NAME = "op13_periodic_runs"
SQL = None  # suffix arrays are not SQL; tests hold it against brute force
MIN_WORDS, MIN_EXPONENT = 6, 4


class SuffixArray:
    """Of one array of symbols in documents; ``first[d]`` is where document d begins."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray):
        n = self.n = len(symbols)
        self.first = first
        size = np.diff(first)
        doc = np.repeat(np.arange(len(size)), size)
        self.begin, stop = np.repeat(first[:-1], size), np.repeat(first[1:], size)
        key = doc * (int(symbols.max()) + 1 if n else 1) + symbols
        rank, active = self._ranked(key, np.zeros(n, np.int64), np.arange(n))
        self.levels = [rank]
        step = 1
        while len(active):
            ahead = active + step
            second = np.where(ahead < stop[active], rank[np.minimum(ahead, n - 1)] + 1, 0)
            new = rank.copy()
            new[active], left = self._ranked(second, rank[active], active)
            rank, active, step = new, left, step * 2
            self.levels.append(rank)
        self.inverse = rank.astype(np.int64)
        self.order = np.empty(n, np.int64)
        self.order[self.inverse] = np.arange(n)
        self.lcp = self._lcp()

    @staticmethod
    def _ranked(key: np.ndarray, group: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of places by (group, key), a group's rank being its first place in the order; the places that share theirs."""
        n = len(places)
        if not n:
            return np.zeros(0, np.int32), places
        order = np.lexsort((key, group)) if group.any() else np.argsort(key, kind="stable")
        g, k = group[order], key[order]
        fresh = np.ones(n, bool)
        fresh[1:] = g[1:] != g[:-1]
        new = fresh.copy()
        new[1:] |= k[1:] != k[:-1]
        at = np.arange(n)
        group_start = np.maximum.accumulate(np.where(fresh, at, 0))
        own_start = np.maximum.accumulate(np.where(new, at, 0))
        out = np.empty(n, np.int32)
        out[order] = g + own_start - group_start
        alone = new & np.append(new[1:], True)
        return out, np.sort(places[order[~alone]])

    def _same(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        rank = self.levels[level]
        inside = (a >= 0) & (np.maximum(a, b) < self.n)
        return inside & (rank[np.where(inside, a, 0)] == rank[np.where(inside, b, 0)])

    def _lcp(self) -> np.ndarray:
        """For each place k > 0 of the order, the words that its suffix shares with the one before."""
        lcp = np.zeros(self.n + 1, np.int64)
        if self.n < 2:
            return lcp
        k = 1 + np.flatnonzero(self.levels[0][self.order[1:]] == self.levels[0][self.order[:-1]])
        a, b = self.order[k - 1], self.order[k]
        length = np.zeros(len(k), np.int64)
        for level in range(len(self.levels) - 2, -1, -1):
            length += self._same(level, a + length, b + length).astype(np.int64) << level
        lcp[k] = length
        return lcp

    def intervals(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(depth, lo, hi, child lo, child hi) of every child but the largest, of the LCP intervals with ``least`` suffixes."""
        k = np.flatnonzero(self.lcp > 0)
        depth = self.lcp[k]
        if not len(k):
            return (k,) * 5
        left, right = self._smaller(k, depth), self._smaller(k, depth, -1)
        lo, hi = left, right - 1
        big = hi - lo + 1 >= least
        k, depth, lo, hi = k[big], depth[big], lo[big], hi[big]
        order = np.lexsort((k, hi, lo))
        k, depth, lo, hi = k[order], depth[order], lo[order], hi[order]
        new = np.ones(len(k), bool)
        new[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
        head = np.flatnonzero(new)
        if not len(head):
            return (k,) * 5
        # children: the one before each boundary, and the last one of each interval
        child_lo = np.where(new, lo, np.append(0, k[:-1]))
        tail = np.append(head[1:], len(k)) - 1
        number = np.cumsum(new) - 1
        all_lo, all_hi = np.concatenate((child_lo, k[tail])), np.concatenate((k - 1, hi[tail]))
        own = np.concatenate((number, number[tail]))
        size = all_hi - all_lo
        order = np.lexsort((-size, own))
        keep = order[np.append(False, own[order][1:] == own[order][:-1])]
        of = head[own[keep]]
        return depth[of], lo[of], hi[of], all_lo[keep], all_hi[keep]

    def _smaller(self, k: np.ndarray, depth: np.ndarray, way: int = 1) -> np.ndarray:
        """The nearest place before each k (way -1: after) with a smaller LCP, by following the answers of others."""
        lcp = self.lcp
        answer = np.arange(len(lcp)) - way
        open_ = np.arange(len(k))
        while len(open_):
            at = k[open_]
            open_ = open_[lcp[answer[at]] >= depth[open_]]
            at = k[open_]
            answer[at] = answer[answer[at]]
        return answer[k]

    def tandem_repeats(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, words) of the branching tandem repeats in LCP intervals with at least ``least`` suffixes."""
        depth, lo, hi, child_lo, child_hi = self.intervals(least)
        size = child_hi - child_lo + 1
        of = np.repeat(np.arange(len(size)), size)
        stop = np.cumsum(size)
        place = self.order[np.arange(len(of)) + np.repeat(child_lo - stop + size, size)] if len(of) else of
        found = []
        for way in (1, -1):
            other = place + way * depth[of]
            inside = (other >= 0) & (other < self.n)
            at = self.inverse[np.where(inside, other, 0)]
            ok = inside & (at >= lo[of]) & (at <= hi[of]) & ((at < child_lo[of]) | (at > child_hi[of]))
            found.append(np.stack((np.minimum(place, other)[ok], depth[of][ok])))
        both = np.unique(np.concatenate(found, axis=1), axis=1)
        return both[0], both[1]

    def runs(self, min_words: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, period) of the runs with at least ``min_words`` words and ``min_exponent`` (2 or more) periods, by start and period."""
        place, period = self.tandem_repeats(max(min_exponent, 2))
        start = place.copy()
        for level in range(len(self.levels) - 2, -1, -1):  # rotate to the left
            back = start - (1 << level)
            ok = self._same(level, back, back + period) & (back >= self.begin[place])
            start = np.where(ok, back, start)
        end = place + 2 * period
        long = end - start >= np.maximum(min_words, min_exponent * period)
        start, end, period = start[long], end[long], period[long]
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        new = np.ones(len(start), bool)
        new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        start, end, period = start[new], end[new], period[new]
        order = np.lexsort((period, start))
        return start[order], end[order], period[order]


def joined(words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets by document) of the kept words joined by one space."""
    at = np.flatnonzero(keep)
    size = words.end[at] - words.start[at] + 1
    doc = np.searchsorted(words.first, at, "right") - 1
    stop = np.cumsum(size)
    take = np.arange(int(size.sum())) + np.repeat(words.start[at] - stop + size, size)
    out = np.append(words.data, np.uint8(0x20))[take]
    out[stop - 1] = 0x20
    last = np.append(doc[1:] != doc[:-1], True) if len(at) else np.zeros(0, bool)
    out = np.delete(out, stop[last] - 1)
    by_doc = np.bincount(doc, size, len(words.first) - 1).astype(np.int64)
    by_doc -= by_doc > 0
    return out, np.concatenate(([0], np.cumsum(by_doc)))


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per row: doc_id, n_words, runs (start, length, period in words; by start, then period), text (without the repeated words of
    runs: the first period of each stays unless another run drops it), words joined by one space."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType([d.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(run)),
                           T.StructField("text", T.StringType())])

    def make(batches):
        for rows, data, off in blocks(batches, "text"):
            words = Words(data, off)
            _, number = distinct(data, words.start, words.end)
            start, end, period = SuffixArray(number, words.first).runs(min_words, min_exponent)
            begin = words.first[np.searchsorted(words.first, start, "right") - 1]
            text, at = joined(words, ~covered(words.n, start + period, end - start - period))
            structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start - begin, end - start, period)], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(start, words.first), pa.int32()), structs)
            strings = pa.LargeStringArray.from_buffers(len(rows), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(text))
            yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(np.diff(words.first), pa.int64()), lists, strings.cast(pa.string())], names=schema.names)

    return d.mapInArrow(make, schema)


def _let(value, body):
    """``body`` of a value that is computed once: a column named in a lambda is computed again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, text) in which a tenth of the documents (by crc32 of the id) repeat themselves from some word on."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def places(words):
        n = F.size(words)
        a = g % n
        return F.struct(words.alias("words"), a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p"))

    def again(s):
        picked = F.transform(F.sequence(F.lit(0), F.size(s["words"]) - 1),
                             lambda i: F.get(s["words"], F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]).cast("int")))
        return F.array_join(picked, " ")

    words = F.filter(F.split(text_col, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.when(h % 10 == 0, _let(words, lambda w: F.when(F.size(w) > 0, _let(places(w), again)))).otherwise(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse(planted(documents(spark, sf_dir)))
    # the greatest exact length / period; runs come by start, then period, so only a greater one takes the place
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                                 r["period"].cast("string"), F.lit("\n"))), "")
    return (found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"),
                         F.sha2("text", 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                    F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"))
