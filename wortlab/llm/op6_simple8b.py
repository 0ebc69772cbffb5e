"""Operator 6: token ids of whole texts in files of 64-bit words (Simple-8b).

The documents are range-partitioned by id (text under the same id breaks ties), sorted, tokenized and written by the task that
holds them, in ascending order: partition p writes ``part-<p>-<k>.s8b``, a new file after ``FILE_IDS`` ids.  Files in the
order of the numbers p and k are ids in order.  A manifest has one row per file; a file's first position is the running total over the manifest.

File (little-endian): magic, documents, ids, blocks, table size; the table of ids by falling frequency in the file (ids are
coded by their rank, so frequent ones are small); per document its id, validity and id count; per block of ``BLOCK`` ids the
offset of its first word; the words.  A word has a 4-bit selector and 60 data bits: selector s packs ``COUNTS[s]`` values of
``BITS[s]`` bits; selector 0 is the escape: the next word is one value in all 64 bits.  A block begins at a word, so blocks
decode alone and all words of one selector decode in one numpy step.

Defined results.  A null or empty text has only the end id.  Null ids come first; rows under one id are ordered by their text
(null first).  An empty table writes no file and gives no row.  Only id and text are read.
"""

from __future__ import annotations

import io
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, scratch_folder, written
from .shared_files import opened, whole_file
from .tokens import encoder

NAME = "op6_token_files"
SQL = None  # a tokenizer is not SQL; tests hold it against the library and exact round trips
TOKENIZER, KIND, END_ID = "byte_bpe_50k.json", "spaced", 2
BLOCK, FILE_IDS = 4096, 4_000_000
#: Values per word and their bits, by selector; 0 is the escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
MAGIC = b"S8BIDS01"
U64 = np.uint64
_POWERS = np.left_shift(U64(1), np.arange(64, dtype=U64))
_WIDTH = np.searchsorted(_POWERS, np.arange(1 << 16, dtype=U64), "right").astype(np.uint8)  # bits of small values


def _selectors(values: np.ndarray) -> np.ndarray:
    """For every place the selector that packs most of the values from there on (values are zero after the end)."""
    n = len(values)
    width = np.zeros(n + 64, np.uint8)
    width[:n] = _WIDTH[values.view(np.int64)] if not n or values.max() < len(_WIDTH) else np.searchsorted(_POWERS, values, "right")
    best = np.where(width[:n] <= 60, len(COUNTS) - 1, 0).astype(np.uint8)
    span, least = 1, width  # least[i]: bits that the next ``span`` values need
    for s in range(len(COUNTS) - 2, 0, -1):
        while span < COUNTS[s]:
            step = min(span, int(COUNTS[s]) - span)
            least = np.maximum(least[:-step], least[step:])
            span += step
        np.copyto(best, np.uint8(s), where=least[:n] <= int(BITS[s]))
    return best


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of unsigned 64-bit values, and the word at which each block of ``BLOCK`` values begins."""
    values = values.astype(U64)
    words, offsets, at_word = [], [], 0
    for a in range(0, len(values), BLOCK * 64):
        part = values[a:a + BLOCK * 64]
        best, begins = [], []
        for b in range(0, len(part), BLOCK):  # the greedy walk: one step per word
            own = _selectors(part[b:b + BLOCK])
            step, i, n = COUNTS[own].astype(np.uint8).tobytes(), 0, len(own)
            walk = []
            while i < n:
                walk.append(i)
                i += step[i]
            walk = np.array(walk)
            best.append(own[walk])
            begins.append(walk + b)
        sizes = [int((1 + (s == 0)).sum()) for s in best]
        offsets += (at_word + np.cumsum(sizes) - sizes).tolist()
        select, begin = np.concatenate(best), np.concatenate(begins)
        place = np.cumsum(1 + (select == 0)) - (1 + (select == 0))
        out = np.zeros(int(sum(sizes)), U64)
        padded = np.zeros((len(best), BLOCK + 64), U64)  # zeros after each block's values
        for k in range(len(best)):
            own = part[k * BLOCK:(k + 1) * BLOCK]
            padded[k, :len(own)] = own
        flat, at = padded.ravel(), begin + begin // BLOCK * 64
        for s in range(1, len(COUNTS)):
            of = np.flatnonzero(select == s)
            if len(of):
                v = flat[at[of][:, None] + np.arange(COUNTS[s])]
                v <<= (np.arange(COUNTS[s]) * BITS[s]).astype(U64)
                out[place[of]] = np.bitwise_or.reduce(v, axis=1) | U64(s << 60)
        of = np.flatnonzero(select == 0)
        out[place[of] + 1] = part[begin[of]]
        words.append(out)
        at_word += len(out)
    return np.concatenate(words) if words else np.zeros(0, U64), np.array(offsets, U64)


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of ``encode``: all words of one selector at once."""
    out = np.zeros(n, U64)
    if not n:
        return out
    select = (words >> U64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    if (select == 0).any():  # the words after escapes are data; an escape is never itself escaped data
        i, zero = -1, np.flatnonzero(select == 0)
        for z in zero.tolist():
            if z != i:
                i = z + 1
                raw[i] = True
    head = np.flatnonzero(~raw)
    block = np.searchsorted(offsets, head, "right") - 1
    count = COUNTS[select[head]]
    before = np.cumsum(count) - count
    first = np.searchsorted(head, offsets)
    start = block * BLOCK + before - before[first][block]
    stop = np.minimum((block + 1) * BLOCK, n)
    for s in range(1, len(COUNTS)):
        of = np.flatnonzero(select[head] == s)
        if len(of):
            v = (words[head[of]][:, None] >> (np.arange(COUNTS[s]) * BITS[s]).astype(U64)) & U64((1 << int(BITS[s])) - 1)
            to = start[of][:, None] + np.arange(COUNTS[s])
            inside = to < stop[of][:, None]
            out[to[inside]] = v[inside]
    of = np.flatnonzero(select[head] == 0)
    out[start[of]] = words[head[of] + 1]
    return out


def file_bytes(doc_ids: list, counts: list[int], ids: np.ndarray) -> bytes:
    """One file of documents (ids or None) with their numbers of token ids, and the token ids of all of them."""
    if len(ids) and int(ids.max()) < 1 << 22:
        often = np.bincount(ids)
        found, place = np.flatnonzero(often), ids
        order = np.argsort(-often[found], kind="stable")
        rank = np.zeros(len(often), np.int64)
        rank[found[order]] = np.arange(len(order))
    else:
        found, place, often = np.unique(ids, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        rank = np.zeros(len(order), np.int64)
        rank[order] = np.arange(len(order))
    words, offsets = encode(rank[place])
    return b"".join([MAGIC, np.array([len(doc_ids), len(ids), len(offsets), len(found)], "<u8").tobytes(), found[order].astype("<u8").tobytes(),
                     np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is not None for d in doc_ids], "u1").tobytes(),
                     np.array(counts, "<u8").tobytes(), offsets.astype("<u8").tobytes(), words.astype("<u8").tobytes()])


def read_file(raw: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(document ids, numbers of token ids, token ids) of one file."""
    if raw[:8] != MAGIC:
        raise ValueError("not a token file")
    stream = io.BytesIO(raw)
    stream.seek(8)
    take = lambda n, kind: np.frombuffer(stream.read(n * np.dtype(kind).itemsize), kind)
    docs, n, blocks, size = take(4, "<u8").tolist()
    table, ids, valid, counts, offsets = take(size, "<u8"), take(docs, "<i8"), take(docs, "u1"), take(docs, "<u8"), take(blocks, "<u8")
    rank = decode(np.frombuffer(stream.read(), "<u8"), offsets.astype(np.int64), n)
    return [i if v else None for i, v in zip(ids.tolist(), valid.tolist())], counts.astype(np.int64), table[rank.astype(np.int64)]


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, kind: str, end_id: int = END_ID, id_col: str = "doc_id",
                      text_col: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the files and returns the manifest (path, part, k, n_docs, n_ids; in the order of part and k), itself a written table."""
    def make(batches):
        part, k, manifest = TaskContext.get().partitionId(), 0, []
        names, counts, parts, size = [], [], [], 0

        def close():
            nonlocal k, names, counts, parts, size
            path = f"{folder}/part-{part:06d}-{k:04d}.s8b"
            with whole_file(path) as out:
                out.write(file_bytes(names, counts, np.frombuffer(b"".join(parts), "<u4")))
            manifest.append((path, part, k, len(names), size))
            k, names, counts, parts, size = k + 1, [], [], [], 0

        end, coder = np.array([end_id], "<u4").tobytes(), encoder(tokenizer, kind)
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                rows = batch.slice(a, 200)
                found = coder.encode([t or "" for t in rows["text"].to_pylist()])
                for d, ids in zip(rows["doc_id"].to_pylist(), found):
                    names.append(d)
                    parts += [ids, end]
                    counts.append(len(ids) // 4 + 1)
                    size += counts[-1]
                    if size >= file_ids:
                        close()
        if names:
            close()
        yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*manifest) if manifest else ((),) * 5, (pa.string(), *[pa.int64()] * 4))],
                              names=["path", "part", "k", "n_docs", "n_ids"])

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = d.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return written(ordered.mapInArrow(make, "path string, part long, k long, n_docs long, n_ids long"), "op6-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) read back from the files of a manifest."""
    def make(batches):
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist()):
                with opened(path) as f:
                    names, counts, ids = read_file(f.read())
                raw, stop = ids.astype("<u4").tobytes(), np.cumsum(counts)
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((stop - counts).tolist(), stop.tolist())]
                yield pa.record_batch([pa.array(names, pa.int64()), pa.array(stop - counts + base, pa.int64()), pa.array(counts, pa.int64()),
                                       pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # one row per file (millions of ids each): a running total over the manifest, in one small task
    base = manifest.withColumn("base", F.sum("n_ids").over(Window.orderBy("part", "k")) - F.col("n_ids"))
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return base.repartition(n, "path").mapInArrow(make, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, sf_dir)
    folder = scratch_folder(spark, "op6")
    return read_token_files(write_token_files(docs, folder, public_tokenizers.path(TOKENIZER), KIND))
