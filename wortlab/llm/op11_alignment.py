"""Operator 11: token statistics across two tokenizers, with counts in dense vectors under minimal perfect hashes.

A text is encoded by a byte-level tokenizer (A) and a piece tokenizer (B) and aligned by bytes: the byte offsets where tokens of
both end cut it into groups, and every two token occurrences whose bytes overlap are a link.  Between two neighbouring ends of
any token lies exactly one link, so a text has as many links as different ends.

1. *First pass.*  Each task aligns its texts and counts links by pair of ids; its sums are written.
2. *Hash.*  The distinct pairs are dealt into sub-shards by (31 a + b) mod the number of sub-shards; a task builds the minimal perfect hash
   of its sub-shard (``perfect_hash.py``) and keeps the pairs in the order of the hash.
3. *Counts.*  Each task over the written sums fills a dense vector indexed by the hash; chunks of ``CHUNK`` counts are summed in a tree
   of two levels, ``FAN`` partial sums for each chunk at most at the second.
4. *Second pass.*  Texts are aligned again and the counts of their links are looked up; a pair whose kept key differs has no
   count (it occurs only in texts without tokens).

Both tokenizers cut at an isolated space or line end (between two characters that are not white space): no token of A or B crosses
it.  Texts are cut into units there; a unit is aligned once for each task, while a cache of ``CACHE_BYTES`` holds it.

Sizes.  At most ``max_pairs`` pairs (4 million: 64 MB of keys and counts and 2 MB of hash) are broadcast or held by the driver at a time.  If there
are more, steps 3 and 4 run once for each bundle of sub-shards that fits, on any number of pairs; the result is the same.  The
greatest count of each B id is a vector over B's vocabulary.

Defined results.  A text that is null, empty, or whose tokens of A or B do not join to the bytes of a space and the text has no
tokens: zeros and no groups; its links are not counted.  Strings of special tokens are ordinary text.  Rows repeated under one id
are rows of their own, each counted; null ids are allowed.  An empty table gives no row.  Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import distinct, gather
from .byte_level import WHITE, byte_level
from .common import blocks, documents, written
from .perfect_hash import PerfectHash

NAME = "op11_token_alignment"
SQL = None  # tokenizers are not SQL; tests hold it against brute force
TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
MAX_PAIRS, SUBS, CHUNK, FAN = 1 << 22, 32, 1 << 16, 32
CACHE_BYTES, TEXT_BLOCK, ROWS = 48 << 20, 1 << 20, 1 << 16
_SPACE = "▁"


class Aligner:
    """Units of texts and the alignment of units, for one pair of tokenizer files."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = byte_level(path_a, special_as_text=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        plain = [not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i)) for i in range(n)]
        if any(p and ("\n" in piece or _SPACE in piece.lstrip(_SPACE)) for p, piece in zip(plain, pieces)):
            raise ValueError(f"{path_b} has pieces over a space or line end: texts cannot be cut there")
        content = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.b_blob, self.b_length = np.frombuffer(b"".join(content), np.uint8), np.array([len(c) for c in content], np.int64)
        self.b_space = self.b.piece_to_id(_SPACE)
        self.size_b = n
        size = max(n, len(self.a.token_bytes))
        self.width = np.array([len(str(i)) for i in range(size)], np.int64)
        self.digits = np.zeros((size, int(self.width.max()) + 1), np.uint8)
        for i in range(size):
            self.digits[i, :self.width[i]] = np.frombuffer(str(i).encode(), np.uint8)

    def units(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes with a space before each text that is not empty, where units begin, the first unit of each text)."""
        full = np.flatnonzero(np.diff(off))
        data = np.insert(data, off[full], 0x20)
        off = off + np.concatenate(([0], np.cumsum(np.diff(off) > 0)))
        kind = self.a.classes(data)[0]
        cut = np.zeros(len(data), bool)
        if len(data):
            blank = (data == 0x20) | (data == 0x0A)
            cut[1:-1] = blank[1:-1] & (kind[:-2] != WHITE) & (kind[2:] != WHITE)
            cut[off[full]] = True  # the space before a text is white: the place after it is no cut
            cut[off[full + 1] - 1] = False  # the last byte of a text
        begin = np.flatnonzero(cut)
        return data, begin, np.searchsorted(begin, off)

    def align(self, units: list[bytes], with_text: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Per unit (tokens of A, tokens of B, groups, links, whether both join to its bytes), the pairs of ids of all links (A's id in the
        high 32 bits) in order, and the groups as text, ``;`` after each."""
        raw = np.frombuffer(b"".join(units), np.uint8)
        size = np.array([len(u) for u in units], np.int64)
        a, n_a = self.a.encode(raw, np.concatenate(([0], np.cumsum(size))))
        # the library puts a space before each text
        found = self.b.encode([u.decode() if u[:1] != b" " else u[1:].decode() for u in units], num_threads=1)
        for u, ids in zip(units, found):
            if u[:1] != b" ":
                if ids[:1] != [self.b_space]:
                    raise ValueError("the piece tokenizer joined the space before a text to a line end")
                del ids[0]
        n_b = np.array([len(x) for x in found], np.int64)
        b = np.array(list(chain.from_iterable(found)), np.int64)
        unit_b = np.repeat(np.arange(len(units)), n_b)
        total = np.bincount(unit_b, self.b_length[b], len(units)).astype(np.int64)
        ok = total == size
        own = gather(self.b_blob, self.b_length, b[ok[unit_b]])[0]
        want = raw[np.repeat(ok, size)]
        wrong = np.flatnonzero(own != want)
        ok[np.flatnonzero(ok)[np.searchsorted(np.cumsum(size[ok]), wrong, "right")]] = False
        keep_a, keep_b = np.repeat(ok, n_a), np.repeat(ok, n_b)
        a, b = a[keep_a].astype(np.int64), b[keep_b]
        end_a, end_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b_length[b])
        at_end = np.zeros((2, int(end_a[-1]) + 1 if len(a) else 1), bool)  # bytes before which a token of A, of B ends
        at_end[0, end_a], at_end[1, end_b] = True, True
        ends = np.flatnonzero(at_end[0] | at_end[1])
        before = np.cumsum(at_end, axis=1, dtype=np.int32) - at_end  # tokens that end before
        pairs = (a[before[0, ends]] << 32) | b[before[1, ends]]
        both = at_end[0] & at_end[1]
        owner = np.repeat(np.flatnonzero(ok), size[ok])  # the unit of each byte
        stats = np.stack([np.where(ok, n_a, 0), np.where(ok, n_b, 0), np.bincount(owner[np.flatnonzero(both) - 1], minlength=len(units)),
                          np.bincount(owner[ends - 1], minlength=len(units)), ok]).T.astype(np.int64)
        if not with_text:
            return stats, pairs, []
        group = np.cumsum(both, dtype=np.int32) - both  # groups that end before
        group_a, group_b = group[end_a], group[end_b]
        shared = np.flatnonzero(both)
        at_a = np.arange(len(a)) + np.concatenate(([0], before[1, shared] + 1))[group_a]  # tokens of B in earlier groups
        at_b = np.arange(len(b)) + before[0, shared][group_b] + 1  # tokens of A up to this group's end
        ids, mark, unit = (np.zeros(len(a) + len(b), np.int64) for _ in range(3))
        for at, own, end, last in ((at_a, a, end_a, ord("|")), (at_b, b, end_b, ord(";"))):
            ids[at], unit[at], mark[at] = own, owner[end - 1], np.where(both[end], last, ord(","))
        rows, width = self.digits[ids], self.width[ids]
        rows[np.arange(len(ids)), width] = mark
        text = rows[np.arange(rows.shape[1]) <= width[:, None]].tobytes()
        length = np.bincount(unit, width + 1, len(units)).astype(np.int64)
        edge = np.cumsum(length)
        return stats, pairs, [text[i:j] for i, j in zip((edge - length).tolist(), edge.tolist())]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of this Python worker for two tokenizer files (tables of a fixed size)."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


class _Units:
    """The aligned units of a task: numbers by content, statistics, pairs, and one more row of figures for each by ``score``."""

    def __init__(self, own: Aligner, score: Callable[[np.ndarray], np.ndarray] | None = None):
        self.own, self.score = own, score
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.stats, self.links, self.text, self.size = np.zeros((0, 7), np.int64), [], [], 0
        self.seen = np.zeros(0, np.int64)

    def read(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(unit numbers of the block, the first of each text, whether each text has tokens)."""
        data, begin, first = self.own.units(data, off)
        end = np.append(begin[1:], len(data))
        places, which = distinct(data, begin, end)
        raw = data.tobytes()
        content = [raw[i:j] for i, j in zip(begin[places].tolist(), end[places].tolist())]
        numbers = np.array([self.number.get(c, -1) for c in content], np.int64)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            fresh = [content[i] for i in new.tolist()]
            stats, pairs, text = self.own.align(fresh, self.score is not None)
            base = len(self.stats)
            numbers[new] = base + np.arange(len(new))
            self.number.update(zip(fresh, numbers[new].tolist()))
            more = np.zeros((len(new), 2), np.int64)
            if self.score is not None and len(pairs):
                unit = np.repeat(np.arange(len(new)), stats[:, 3])
                for k, row in enumerate(self.score(pairs)):
                    more[:, k] = _sums(unit, row, len(new))
            self.stats = np.concatenate((self.stats, np.hstack((stats, more))))
            self.seen = np.concatenate((self.seen, np.zeros(len(new), np.int64)))
            if self.score is None:
                self.links.append(pairs)
            else:
                self.text += text
            self.size += sum(map(len, fresh)) + sum(map(len, text)) + 200 * len(new)
        numbers = numbers[which]
        bad = np.concatenate(([0], np.cumsum(self.stats[numbers, 4] == 0)))
        return numbers, first, (bad[first[1:]] == bad[first[:-1]]) & (np.diff(first) > 0)


def _sums(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact integer sums of ``values`` by ``group`` (ascending)."""
    total = np.concatenate(([0], np.cumsum(values)))
    edge = np.searchsorted(group, np.arange(n + 1))
    return total[edge[1:]] - total[edge[:-1]]


def count_pairs(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """Rows (pair, n): the links of each pair of ids, summed by task (a pair may have several rows)."""
    def make(batches):
        units = _Units(aligner(path_a, path_b))

        def sums():
            pairs = np.concatenate(units.links) if units.links else np.zeros(0, np.int64)
            times = np.repeat(units.seen, units.stats[:, 3])
            keys, place = np.unique(pairs[times > 0], return_inverse=True)
            order = np.argsort(place, kind="stable")
            n = _sums(place[order], times[times > 0][order], len(keys))
            units.clear()
            for i in range(0, len(keys), ROWS):
                yield pa.record_batch({"pair": pa.array(keys[i:i + ROWS]), "n": pa.array(n[i:i + ROWS])})

        for _, data, off in blocks(batches, "text", TEXT_BLOCK):
            numbers, first, has = units.read(data, off)
            units.seen += np.bincount(numbers[np.repeat(has, np.diff(first))], minlength=len(units.seen))
            if units.size > cache_bytes:
                yield from sums()
        yield from sums()

    return docs.select(F.col(text_col).alias("text")).mapInArrow(make, "pair long, n long")


class PairTable:
    """Keys in the order of the perfect hashes of some sub-shards, and their counts."""

    def __init__(self, subs: int, rows: list):
        self.subs = subs
        self.hashes, self.base, keys, at = {}, {}, [], 0
        for r in sorted(rows, key=lambda r: r["sub"]):
            own = np.frombuffer(r["keys"], "<i8")
            self.hashes[r["sub"]], self.base[r["sub"]] = PerfectHash.from_bytes(r["hash"]), at
            keys.append(own)
            at += len(own)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.counts = np.zeros(len(self.keys), np.int64)

    def index(self, pairs: np.ndarray) -> np.ndarray:
        """The place of each pair; -1 for those of other sub-shards and those without a link in any text with tokens."""
        out = np.full(len(pairs), -1, np.int64)
        sub = ((pairs >> 32) * 31 + (pairs & 0xFFFFFFFF)) % self.subs
        order = np.argsort(sub, kind="stable")
        edge = np.searchsorted(sub[order], np.arange(self.subs + 1))
        for s, own in self.hashes.items():
            at = order[edge[s]:edge[s + 1]]
            if len(at):
                place = own.index(pairs[at].view(np.uint64))
                place[place >= 0] += self.base[s]
                out[at] = np.where((place >= 0) & (self.keys[place] == pairs[at]), place, -1)
        return out


def _build_hashes(keys: DataFrame, subs: int) -> DataFrame:
    """Rows (sub, n, hash, keys): the perfect hash of each sub-shard and its keys in that order."""
    def make(table):
        own = table["pair"].to_numpy()
        found = PerfectHash.build(own.view(np.uint64))
        ordered = np.empty(len(own), np.int64)
        ordered[found.index(own.view(np.uint64))] = own
        return pa.table({"sub": pa.array([table["sub"][0].as_py()], pa.int32()), "n": pa.array([len(own)], pa.int64()),
                         "hash": pa.array([found.to_bytes()], pa.binary()), "keys": pa.array([ordered.astype("<i8").tobytes()], pa.binary())})

    sub = ((F.shiftright("pair", 32) * 31 + F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))) % subs).cast("int")
    return keys.select("pair", sub.alias("sub")).groupBy("sub").applyInArrow(make, "sub int, n long, hash binary, keys binary")


def _summed(vectors: DataFrame, *by: str) -> DataFrame:
    """Rows (chunk, part, counts): the sums of the vectors with equal ``by``; each task holds one vector for each of its groups."""
    def make(batches):
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for chunk, part, raw in zip(batch["chunk"].to_pylist(), batch["part"].to_pylist(), batch["counts"]):
                own = np.frombuffer(raw.as_buffer(), "<i8")
                key = (chunk, part if "part" in by else 0)
                held[key] = held[key] + own if key in held else own.copy()
        for (chunk, part), own in held.items():
            yield pa.record_batch({"chunk": pa.array([chunk], pa.int32()), "part": pa.array([part], pa.int32()), "counts": pa.array([own.tobytes()], pa.binary())})

    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return vectors.repartition(n, *by).mapInArrow(make, vectors.schema)


def _fill(table: PairTable, sums: DataFrame) -> None:
    """Counts of the table's pairs: dense vectors of the tasks over ``sums``, summed in a tree."""
    spark = sums.sparkSession
    sent = spark.sparkContext.broadcast(table)

    def make(batches):
        own = sent.value
        dense = np.zeros(-(-len(own.keys) // CHUNK) * CHUNK, np.int64)
        for batch in batches:
            at = own.index(batch["pair"].to_numpy())
            np.add.at(dense, at[at >= 0], batch["n"].to_numpy()[at >= 0])
        part = TaskContext.get().partitionId() % FAN
        for chunk, vector in enumerate(dense.reshape(-1, CHUNK)):
            if vector.any():
                yield pa.record_batch({"chunk": pa.array([chunk], pa.int32()), "part": pa.array([part], pa.int32()), "counts": pa.array([vector.tobytes()], pa.binary())})

    vectors = sums.mapInArrow(make, "chunk int, part int, counts binary")
    for r in _summed(_summed(vectors, "chunk", "part"), "chunk").toLocalIterator():  # as many counts as the table has keys
        own = np.frombuffer(r["counts"], "<i8")[:len(table.keys) - r["chunk"] * CHUNK]
        table.counts[r["chunk"] * CHUNK:r["chunk"] * CHUNK + len(own)] = own
    sent.destroy()


def _look_up(rows: DataFrame, path_a: str, path_b: str, table: PairTable, best: np.ndarray, cache_bytes: int) -> DataFrame:
    """The columns n_best and count_sum of ``rows`` grow by the links of the table's pairs; the others are set."""
    sent = rows.sparkSession.sparkContext.broadcast((table, best))

    def make(batches):
        own, best = sent.value

        def score(pairs):
            at = own.index(pairs)
            count = np.where(at >= 0, own.counts[at] if len(own.counts) else 0, 0)
            return (at >= 0) & (count == best[pairs & 0xFFFFFFFF]), count

        units = _Units(aligner(path_a, path_b), score)
        for rows_, data, off in blocks(batches, "text", TEXT_BLOCK):
            if units.size > cache_bytes:
                units.clear()
            numbers, first, has = units.read(data, off)
            total = np.concatenate((np.zeros((1, 7), np.int64), np.cumsum(units.stats[numbers], axis=0)))
            sums = (total[first[1:]] - total[first[:-1]]) * has[:, None]
            text = units.text
            groups = [b"".join([text[u] for u in numbers[i:j].tolist()])[:-1].decode() if ok else ""
                      for i, j, ok in zip(first[:-1].tolist(), first[1:].tolist(), has.tolist())]
            out = [rows_["doc_id"], rows_["text"], *[pa.array(sums[:, k]) for k in range(4)],
                   pa.array(sums[:, 5] + rows_["n_best"].to_numpy()), pa.array(sums[:, 6] + rows_["count_sum"].to_numpy()), pa.array(groups, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=names)

    names = ["doc_id", "text", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    schema = T.StructType([rows.schema["doc_id"], T.StructField("text", T.StringType()), *[T.StructField(n, T.LongType()) for n in names[2:8]], T.StructField("groups", T.StringType())])
    return rows.select("doc_id", "text", "n_best", "count_sum").mapInArrow(make, schema)


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", max_pairs: int = MAX_PAIRS,
              subs: int = SUBS, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """Per row: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose count is the greatest of their B id), count_sum (of
    all links), groups (``a1,a2|b1;a3|b2,b3``: ids of A and B, empty without tokens)."""
    sums = written(count_pairs(docs, path_a, path_b, text_col, cache_bytes), "op11-sums")
    keys = written(sums.select("pair").distinct(), "op11-pairs")
    subs *= -(-max(keys.count(), 1) // max_pairs)
    hashes = written(_build_hashes(keys, subs), "op11-hashes")
    bundles, room = [[]], max_pairs
    for r in sorted(hashes.select("sub", "n").collect()):  # one row for each sub-shard
        if bundles[-1] and r["n"] > room:
            bundles.append([])
            room = max_pairs
        bundles[-1].append(r["sub"])
        room -= r["n"]

    best = np.zeros(aligner(path_a, path_b).size_b, np.int64)

    def counted(bundle: list[int], first: bool) -> PairTable:
        table = PairTable(subs, hashes.where(F.col("sub").isin(bundle)).collect() if bundle else [])
        if len(table.keys):
            _fill(table, sums)
            if first:
                np.maximum.at(best, table.keys & 0xFFFFFFFF, table.counts)
        return table

    tables = [counted(bundles[0], True)] if len(bundles) == 1 else [counted(b, True) and None for b in bundles]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    for k, bundle in enumerate(bundles):
        table = tables[k] or counted(bundle, False)
        rows = _look_up(rows, path_a, path_b, table, best, cache_bytes)
        if k + 1 < len(bundles):
            rows = written(rows.select("doc_id", "text", "n_best", "count_sum"), "op11-pass")
    return rows.drop("text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = alignment(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER_A), public_tokenizers.path(TOKENIZER_B))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                        F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"))
