"""Operator 12: byte-pair encoding and decoding as streams of bounded memory.

Encoding is a transducer over one stream of documents.  It reads bytes in chunks, keeps an unfinished tail, and emits the tokens
that no further byte can change.  Two rules say when that is.  A pre-token is final when three runs of one character class and
the longest special token have been read after its start (the pre-tokenizer looks no further).  Inside a pre-token that is longer
than the buffer, a token is final when ``MergeList.lookahead`` further bytes of the pre-token are known: that bound follows from
the merge list (``bpe.py``; 320 bytes for the production file).  So the state is the tail: at most ``CHUNK`` bytes and a few runs,
however long a document, a word or a run of blanks is.

Decoding is a transducer from ids to bytes to text: token bytes from a table, and a state machine of UTF-8 that carries an
unfinished character (at most 3 bytes) from one chunk to the next and writes U+FFFD for each part that cannot be continued.

A task feeds all its documents through one encoder and one decoder; no data are shuffled, and a task that is run again gives the
same rows.  A row holds the ids and the text of its document, so a row is as large as the document.

Defined results.  A null or empty text has no ids and decodes to the empty text.  Rows repeated under one id are rows of their own;
null ids are allowed.  An empty table gives no row.  Strings of special tokens are their special ids, as in the library's plain
call, and decode to their strings.  Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byte_level import ByteLevel, byte_level
from .common import documents

NAME = "op12_bpe_transducer"
SQL = None  # byte-pair merging is not SQL; tests hold it against the library
TOKENIZER = "byte_bpe_50k.json"
CHUNK = 2 << 20


def _unfinished(data: np.ndarray) -> int:
    """Bytes at the end that begin a character without ending it."""
    for n, byte in enumerate(data[:-4:-1].tolist(), 1):
        if byte >= 0xC0:
            return n if n < 2 + (byte >= 0xE0) + (byte >= 0xF0) else 0
        if byte < 0x80:
            break
    return 0


class Encoder:
    """``feed`` takes the next bytes of the stream and where documents end in them; it returns the ids that are final by now and, for
    each of these ends, how many of them lie before it."""

    def __init__(self, coder: ByteLevel):
        self.coder = coder
        self.keep = coder.merges.lookahead + coder.margin
        self.tail = np.zeros(0, np.uint8)
        self.inside = 0  # class of the pre-token that the tail continues; 0: it begins one

    def feed(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        coder, held = self.coder, len(self.tail)
        buf = np.concatenate((self.tail, data)) if held else data
        off = np.concatenate(([0], ends + held)).astype(np.int64)
        closed = int(off[-1])
        whole = len(buf) if closed == len(buf) else len(buf) - _unfinished(buf)
        buf, rest = buf[:whole], buf[whole:]
        if not len(buf):
            self.tail = rest.copy()
            return np.zeros(0, np.int32), np.zeros(len(ends), np.int64)
        spans = coder.special_spans(buf, off if closed == len(buf) else np.append(off, len(buf)))
        edges = np.unique(np.concatenate((off, [x for s in spans for x in s[:2]])).astype(np.int64))
        edges = edges[edges < len(buf)]
        begin, runs, kind = coder.starts(buf, edges, self.inside)
        begin = coder.outside(begin, spans)
        stop = len(buf) if closed == len(buf) else self._stable(begin, runs, closed, spans, len(buf))
        done = begin[begin < stop]
        ids, size = coder.tokens(buf, done, np.append(done[1:], stop), [s for s in spans if s[0] < stop]) if len(done) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        total = np.concatenate(([0], np.cumsum(size)))
        cuts = total[np.searchsorted(done, off[1:])]
        parts = [ids]
        if stop:
            self.inside = 0
        while stop < len(buf) and int(runs[-1]) < len(buf) - 2 * self.keep and stop >= max(closed, int(begin[-1])):  # one long pre-token, still open
            window = buf[stop:stop + coder.merges.lookahead + (1 << 14)] if len(buf) - stop > (1 << 14) + self.keep else buf[stop:]
            end = len(buf) - stop - len(window)
            more, used = coder.merges.stable(window, self.keep if not end else coder.merges.lookahead)
            if not used:
                break
            parts.append(more)
            stop += used
            self.inside = int(kind[-1])
        self.tail = np.concatenate((buf[stop:], rest))
        return np.concatenate(parts), cuts

    def _stable(self, begin: np.ndarray, runs: np.ndarray, closed: int, spans: list, n: int) -> int:
        """Where the first pre-token begins that more bytes may change."""
        last = int(begin[-1])
        if int(runs[-1]) < n - 2 * self.keep:  # its last run is long: what comes before it is final
            return max(last, closed)
        hold = int(runs[-3]) if len(runs) > 2 else 0
        hold = min(hold, n - self.coder.margin)
        at = int(begin[max(int(np.searchsorted(begin, hold, "right")) - 1, 0)])
        return max(at, closed)


#: The state machine of UTF-8: (state, byte) to the next state; state 0 is between characters, 1 to 3 wait for as many bytes of
#: any value 80-BF, 4 to 7 for a first one in a narrower range.
_NARROW = {0xE0: (4, 0xA0, 0xBF), 0xED: (5, 0x80, 0x9F), 0xF0: (6, 0x90, 0xBF), 0xF4: (7, 0x80, 0x8F)}
_REJECT = 8
_NEXT = np.full((9, 256), _REJECT, np.uint8)
_NEXT[0, :0x80] = 0
_NEXT[0, 0xC2:0xE0] = 1
_NEXT[0, 0xE0:0xF0] = 2
_NEXT[0, 0xF0:0xF5] = 3
for _lead, (_state, _low, _high) in _NARROW.items():
    _NEXT[0, _lead] = _state
    _NEXT[_state, _low:_high + 1] = 1 if _state < 6 else 2
for _state in (1, 2, 3):
    _NEXT[_state, 0x80:0xC0] = _state - 1
_NEXT = _NEXT.tolist()


class Decoder:
    """Bytes to text; an unfinished character is kept for the next chunk."""

    def __init__(self):
        self.state, self.pending = 0, b""

    def feed(self, data: bytes) -> str:
        data = self.pending + data
        try:  # all whole characters
            text, self.pending, self.state = data.decode(), b"", 0
            return text
        except UnicodeDecodeError as e:
            good = e.start
        out, at, state, since = [data[:good].decode()], good, 0, good
        n = len(data)
        while at < n:
            state = _NEXT[state][data[at]]
            if state == _REJECT:
                out.append("�")
                at = max(at, since + 1)  # a byte that cannot go on is tried again as a beginning
                state, since = 0, at
                continue
            at += 1
            if state == 0:
                out.append(data[since:at].decode())
                since = at
        self.pending, self.state = data[since:], state
        return "".join(out)

    def end(self) -> str:
        """The end of a text: an unfinished character is one U+FFFD."""
        out = "�" if self.pending else ""
        self.state, self.pending = 0, b""
        return out


def stream(coder: ByteLevel, batches: Iterator[pa.RecordBatch], chunk: int = CHUNK) -> Iterator[tuple[object, list[np.ndarray], str]]:
    """(doc_id, parts of its ids, decoded text) of every row, from batches with doc_id and text."""
    encoder, decoder = Encoder(coder), Decoder()
    waiting: list[object] = []
    ids_of: list[np.ndarray] = []
    text_of: list[str] = []

    def take(ids: np.ndarray) -> None:
        if len(ids):
            ids_of.append(ids)
            text_of.append(decoder.feed(coder.text_bytes(ids).tobytes()))

    def pushed(parts: list[bytes], ends: list[int], size: int):
        nonlocal waiting
        ids, cuts = encoder.feed(np.frombuffer(b"".join(parts), np.uint8), np.array(ends, np.int64))
        at = 0
        for doc, cut in zip(waiting[:len(ends)], cuts.tolist()):
            take(ids[at:cut])
            at = cut
            yield doc, ids_of[:], "".join(text_of) + decoder.end()
            ids_of.clear()
            text_of.clear()
        take(ids[at:])
        waiting = waiting[len(ends):]

    parts, ends, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.large_binary())):
            raw = text.as_py() or b""
            waiting.append(doc)
            at = 0
            while size + len(raw) - at > chunk:
                parts.append(raw[at:at + chunk - size])
                at += chunk - size
                yield from pushed(parts, ends, chunk)
                parts, ends, size = [], [], 0
            parts.append(raw[at:])
            size += len(raw) - at
            ends.append(size)
    yield from pushed(parts, ends, size)


def transduce(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Per row: doc_id, ids (array of int), text (the ids decoded)."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def make(batches):
        coder, kind = byte_level(tokenizer), None
        rows, size = [], 0

        def batch_of(rows):
            counts = [sum(map(len, ids)) for _, ids, _ in rows]
            flat = [p for _, ids, _ in rows for p in ids]
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32), pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), lists, pa.array([r[2] for r in rows], pa.string())], names=["doc_id", "ids", "text"])

        def typed(batches):
            nonlocal kind
            for batch in batches:
                kind = batch["doc_id"].type
                yield batch

        for row in stream(coder, typed(batches), chunk):
            rows.append(row)
            size += len(row[2]) + 1
            if size >= chunk:
                yield batch_of(rows)
                rows, size = [], 0
        if rows:
            yield batch_of(rows)

    return d.mapInArrow(make, T.StructType([d.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("text", T.StringType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = transduce(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
