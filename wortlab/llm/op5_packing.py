"""Operator 5: packing documents into sequences by order-preserving dynamic programming.

Each task reads its documents in order as one stream of token ids (a document's ids, then the end id) and cuts the stream
into sequences of at most ``SEQUENCE`` ids.  A cut may lie at a document's end (free), at a sentence's end (``SENTENCE_COST``),
or, where no sentence ends for ``GAP`` ids and in the last sequence of the task, inside a sentence (``INSIDE_COST``).  A
sequence of l ids costs SEQUENCE - l of padding, or nothing if l is a power of two.  With g(i) = f(i) + place(i),

    f(j) = cost(j) + min( SEQUENCE - place(j) + min g(i),  min f(i) over i with place(j) - place(i) a power of two )

where the first minimum runs over the cuts i at most SEQUENCE before j: a sliding window held in a monotone queue.  The
stream is cut in chunks of ``CHUNK`` ids; the last sequence of a chunk is left open and begins the next one, so memory is
bounded by the chunk and one document.  No data are shuffled, and every sequence lies in one task; a sequence id is the
task's partition number times 2^33 plus a counter.

Defined results.  A null or empty text is a document of the end id alone.  Rows repeated under one id are documents of their own;
null ids are allowed.  An empty table gives no piece.  Only id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, released
from .tokens import encoder

NAME = "op5_pack_sequences"
SQL = None  # a tokenizer is not SQL; tests check every piece against the library
TOKENIZER, KIND, END_ID = "word_bpe_49k.json", "bare", 2
SEQUENCE, CHUNK, GAP = 4096, 1 << 20, 256
SENTENCE_COST, INSIDE_COST = 16, 64


def sentence_ends(tokenizer) -> np.ndarray:
    """Ids of the tokens that are punctuation ending a sentence at a word's end."""
    return np.array(sorted(i for t, i in tokenizer.get_vocab().items() if t.endswith("</w>") and set(t[:-4]) & set(".!?")
                           and not any(c.isalnum() for c in t[:-4])), np.int64)


def choose_cuts(place: np.ndarray, cost: np.ndarray, size: int, least_power: np.ndarray) -> np.ndarray:
    """Places of the best cuts, from the allowed ones (ascending, the first is 0; the last is always cut).  Power-of-two
    sequences of at least ``least_power[j]`` ids may end at j."""
    n = len(place)
    exact: dict[int, list[int]] = {}
    power = 1
    while power <= size:
        j = np.flatnonzero((place >= power) & (least_power <= power))
        i = np.searchsorted(place, place[j] - power)
        hit = place[i] == place[j] - power
        for a, b in zip(j[hit].tolist(), i[hit].tolist()):
            exact.setdefault(a, []).append(b)
        power *= 2
    at, extra = place.tolist(), cost.tolist()
    best, before = [0] * n, [0] * n
    queue, key, head = [0], [0], 0  # cuts in the window with rising g
    for j in range(1, n):
        here = at[j]
        low = here - size
        while at[queue[head]] < low:
            head += 1
        i = queue[head]
        value = key[head] + size - here
        if j in exact:
            for k in exact[j]:
                if best[k] < value:
                    value, i = best[k], k
        value += extra[j]
        best[j], before[j] = value, i
        g = value + here
        while len(key) > head and key[-1] >= g:
            key.pop()
            queue.pop()
        key.append(g)
        queue.append(j)
    cuts, j = [], n - 1
    while j:
        cuts.append(at[j])
        j = before[j]
    return np.array([0, *reversed(cuts)], np.int64)


class _Stream:
    """The open documents of a task: ids, and where each document's part begins."""

    def __init__(self, ends: np.ndarray, size: int, sequence: int):
        self.is_end = np.zeros(int(ends.max()) + 1 if len(ends) else 1, bool)
        self.is_end[ends] = True
        self.size, self.sequence = size, sequence
        self.docs: list[list] = []  # doc_id, ids from ``skip`` on, skip, number of ids of the whole document
        self.total = 0

    def add(self, doc, ids: np.ndarray) -> None:
        self.docs.append([doc, ids, 0, len(ids)])
        self.total += len(ids)

    def cut(self, last: bool):
        """Pieces of all closed sequences; without ``last`` the final sequence stays open."""
        ids = np.concatenate([d[1] for d in self.docs])
        length = np.array([len(d[1]) for d in self.docs])
        stop = np.cumsum(length)
        cost = np.full(len(ids) + 1, -1, np.int64)
        small = np.minimum(ids, len(self.is_end) - 1)
        cost[1:][self.is_end[small] & (small == ids)] = SENTENCE_COST
        cost[stop] = 0
        cost[0] = 0
        known = np.flatnonzero(cost >= 0)
        gap = min(GAP, max(self.size // 4, 1))
        wide = np.flatnonzero(np.diff(known) > gap)
        for a, b in zip(known[wide].tolist(), known[wide + 1].tolist()):
            cost[a + gap:b:gap] = INSIDE_COST
        if last:
            tail = cost[max(len(ids) - self.size, 1):-1]
            tail[tail < 0] = INSIDE_COST
        place = np.flatnonzero(cost >= 0)
        powers = np.full(len(place), GAP)
        if last:
            powers[place > len(ids) - self.size] = 1
        cuts = choose_cuts(place, cost[place], self.size, powers)
        if not last:
            cuts = cuts[:-1]
        if len(cuts) < 2:
            return None
        end = int(cuts[-1])
        edges = np.unique(np.concatenate((cuts, stop[stop < end])))
        begin, close = edges[:-1], edges[1:]
        doc = np.searchsorted(stop, begin, "right")
        sequence = np.searchsorted(cuts, begin, "right") - 1
        raw = ids.astype("<u4").tobytes()
        names = [d[0] for d in self.docs]
        skip, whole = np.array([d[2] for d in self.docs]), np.array([d[3] for d in self.docs])
        out = ([names[d] for d in doc.tolist()], begin - (stop - length)[doc] + skip[doc], close - begin, whole[doc], self.sequence + sequence,
               begin - cuts[sequence], [raw[4 * a:4 * b] for a, b in zip(begin.tolist(), close.tolist())])
        self.sequence += len(cuts) - 1
        keep = int(np.searchsorted(stop, end, "right"))
        gone = end - int((stop - length)[keep]) if keep < len(self.docs) else 0
        self.docs = self.docs[keep:]
        if self.docs and gone:
            first = self.docs[0]
            self.docs[0] = [first[0], first[1][gone:], first[2] + gone, first[3]]
        self.total = len(ids) - end
        return out


def pack(docs: DataFrame, tokenizer: str, kind: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
         size: int = SEQUENCE) -> DataFrame:
    """Rows, one per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit)."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc_id", d.schema["doc_id"].dataType), *[T.StructField(n, T.LongType()) for n in (
        "start", "length", "doc_tokens", "sequence_id", "offset")], T.StructField("ids", T.BinaryType())])

    def make(batches):
        coder = encoder(tokenizer, kind)
        stream = _Stream(sentence_ends(coder.tokenizer), size, TaskContext.get().partitionId() << 33)
        id_type = None

        def rows(out):
            return pa.RecordBatch.from_arrays([pa.array(out[0], id_type), *[pa.array(c, pa.int64()) for c in out[1:6]], pa.array(out[6], pa.binary())],
                                              names=schema.names)

        for batch in released(batches):
            id_type = batch["doc_id"].type
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                for doc, raw in zip(part["doc_id"].to_pylist(), coder.encode([t or "" for t in part["text"].to_pylist()])):
                    stream.add(doc, np.append(np.frombuffer(raw, "<u4"), np.uint32(end_id)).astype(np.int64))
                if stream.total >= CHUNK and (out := stream.cut(False)):
                    yield rows(out)
        if stream.docs and (out := stream.cut(True)):
            yield rows(out)

    return d.mapInArrow(make, schema)


def pieces(docs: DataFrame) -> DataFrame:
    """The pieces of ``docs`` with the production parameters and the digest of their ids."""
    import public_tokenizers

    found = pack(docs, public_tokenizers.path(TOKENIZER), KIND)
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(documents(spark, sf_dir))
