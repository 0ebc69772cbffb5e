"""Byte-level BPE of blocks of texts in numpy: pre-tokens from character classes, merged through a cache.

The pre-tokens are those of ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``: runs of one class (letter,
number, other, white space), where the last blank of white space joins the run after it and an apostrophe alone takes its
ending.  The class of a character is asked from the library's own pre-tokenizer when it is first seen, so that Unicode
versions agree.  What is kept from block to block is these classes (one byte for each code point) and the cache of ``bpe.Merged``, both of
fixed size.
"""

from __future__ import annotations

import json
import os
import re
from unicodedata import is_normalized

import numpy as np

from .bpe import Merged, MergeList, gather

LETTER, NUMBER, OTHER, WHITE = 1, 2, 3, 4
_ONE = np.zeros(256, bool)
_ONE[list(b"stmd")] = True
_TWO = np.zeros(1 << 16, bool)
_TWO[[a << 8 | b for a, b in (b"re", b"ve", b"ll")]] = True
_CODERS: dict[tuple[str, bool], ByteLevel] = {}


class ByteLevel:
    """``special_as_text``: strings of special tokens in a text are ordinary text; else each is its id, as in the library's plain call."""

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._check(path, spec)
        self.merges = MergeList(path)
        self.merged = Merged(self.merges)
        self.special: dict[bytes, int] = {}
        for t in spec["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"] or not t["special"]:
                raise ValueError(f"{path}: added token {t['content']!r} is not plain")
            self.special[t["content"].encode()] = t["id"]
        size = max([self.merges.size, *(i + 1 for i in self.special.values())])
        self.token_bytes = self.merges.token_bytes + [b""] * (size - self.merges.size)
        for content, i in self.special.items():
            self.token_bytes[i] = content
        self.blob = np.frombuffer(b"".join(self.token_bytes), np.uint8)
        self.lengths = np.array([len(b) for b in self.token_bytes], np.int64)
        #: further bytes without which the end of a pre-token, or a special token, may still change
        self.margin = 4 + (0 if special_as_text else max(map(len, self.special), default=0))
        self.find = None
        if self.special and not special_as_text:
            self.find = re.compile(b"|".join(re.escape(c) for c in sorted(self.special, key=len, reverse=True)))
        self.library = Tokenizer.from_file(path)
        self._pieces = self.library.pre_tokenizer.pre_tokenize_str
        self._class = np.zeros(0x110000, np.uint8)
        self._ask(np.arange(128))

    @staticmethod
    def _check(path: str, spec: dict) -> None:
        pre = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space"):
            raise ValueError(f"{path} is not a plain byte-level tokenizer")

    def _ask(self, points: np.ndarray) -> None:
        for p in points.tolist():
            c = chr(p)
            self._class[p] = next((k for k, other in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(self._pieces(other + c)) == 1), WHITE)

    def classes(self, data: np.ndarray, inside: int = 0) -> tuple[np.ndarray, np.ndarray | None]:
        """(class of each byte's character, places where characters begin, or None for ASCII).  Bytes of a character that began
        before the data have the class ``inside``."""
        high = np.flatnonzero(data & 0x80)
        if not len(high):
            return self._class[data], None
        out = self._class[data & 0x7F]
        lead = high[data[high] >= 0xC0]
        b = data[lead].astype(np.int64)
        n = 1 + (b >= 0xE0) + (b >= 0xF0)
        point = b & np.array([0, 0x1F, 0x0F, 0x07])[n]
        for k in (1, 2, 3):
            more = np.flatnonzero(n >= k)
            point[more] = point[more] << 6 | (data[lead[more] + k] & 0x3F)
        kind = self._class[point]
        if (unknown := kind == 0).any():
            self._ask(np.unique(point[unknown]))
            kind = self._class[point]
        out[high[:np.searchsorted(high, lead[0])] if len(lead) else high] = inside
        for k in range(4):
            here = np.flatnonzero(n >= k)
            out[lead[here] + k] = kind[here]
        return out, np.flatnonzero((data & 0xC0) != 0x80)

    def starts(self, data: np.ndarray, edges: np.ndarray, inside: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where pre-tokens begin, where runs of one class begin, class of each byte); texts begin at ``edges``."""
        kind, chars = self.classes(data, inside)
        edge = np.zeros(len(data) + 3, bool)
        edge[edges] = True
        run = np.zeros(len(data) + 3, bool)
        run[0] = True
        run[1:len(data)] = kind[1:] != kind[:-1]
        run |= edge
        run[len(data):] = False
        begin = run.copy()
        self._split(begin, run, edge, data, kind, chars)
        mark = np.flatnonzero(data == 0x27)
        if len(mark):
            mark = mark[begin[mark] & run[mark + 1] & ~edge[mark + 1]]
            mark = mark[mark + 1 < len(data)]
            mark = mark[kind[mark + 1] == LETTER]
            a = data[mark + 1].astype(np.int64)
            second = np.minimum(mark + 2, len(data) - 1)
            two = (mark + 2 < len(data)) & ~edge[mark + 2] & ~run[mark + 2] & _TWO[a << 8 | data[second]]
            one = _ONE[a]
            for at, n in ((mark[one], 2), (mark[two & ~one], 3)):
                begin[at + 1] = False
                rest = (at + n)[at + n < len(data)]
                begin[rest[~run[rest]]] = True
        return np.flatnonzero(begin[:len(data)]), np.flatnonzero(run[:len(data)]), kind

    @staticmethod
    def _split(begin: np.ndarray, run: np.ndarray, edge: np.ndarray, data: np.ndarray, kind: np.ndarray, chars: np.ndarray | None) -> None:
        """The last blank of white space goes to the run after it."""
        after = np.flatnonzero(run[:len(data)] & ~edge[:len(data)])
        after = after[after > 0]
        after = after[(kind[after - 1] == WHITE) & (kind[after] != WHITE)]
        blank = after - 1 if chars is None else chars[np.searchsorted(chars, after) - 1]
        begin[blank] = True
        begin[after[data[blank] == 0x20]] = False

    def special_spans(self, data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, id) of the special tokens in the texts between consecutive offsets."""
        raw = data.tobytes() if self.find is not None else b""
        if self.find is None or self.find.search(raw) is None:
            return []
        return [(m.start() + a, m.end() + a, self.special[m.group()]) for a, b in zip(off[:-1].tolist(), off[1:].tolist()) for m in self.find.finditer(raw[a:b])]

    @staticmethod
    def outside(begin: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
        """The places that do not lie inside a special token."""
        if not spans:
            return begin
        inside = [np.arange(np.searchsorted(begin, a, "right"), np.searchsorted(begin, b)) for a, b, _ in spans]
        return np.delete(begin, np.concatenate(inside))

    def tokens(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each pre-token); pre-tokens that are special spans have their id."""
        if not spans:
            return self.merged.encode(data, begin, end)
        special = np.searchsorted(begin, np.array([s[0] for s in spans]))
        plain = np.delete(np.arange(len(begin)), special)
        ids, counts = self.merged.encode(data, begin[plain], end[plain])
        number = np.empty(len(begin), np.int64)
        number[plain], number[special] = np.arange(len(plain)), len(plain) + np.arange(len(special))
        ids = np.append(ids, np.array([s[2] for s in spans], np.int32))
        return gather(ids, np.append(counts, np.ones(len(special), np.int64)), number)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts between consecutive offsets, the number of ids of each text)."""
        spans = self.special_spans(data, off)
        edges = np.unique(np.concatenate((off[:-1], [x for s in spans for x in s[:2]])).astype(np.int64))
        edges = edges[edges < len(data)]
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(off) - 1, np.int64)
        begin = self.outside(self.starts(data, edges)[0], spans)
        ids, size = self.tokens(data, begin, np.append(begin[1:], len(data)), spans)
        total = np.concatenate(([0], np.cumsum(size)))
        return ids, np.diff(total[np.searchsorted(begin, off)])

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, the number of ids of each)."""
        raw = [t.encode() for t in texts]
        return self.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))

    def text_bytes(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, one after another."""
        return gather(self.blob, self.lengths, ids)[0]


class WordLevel(ByteLevel):
    """Tokenizers that lower-case, drop white space, and take each number character and each run of letters or others as a word whose
    last byte is marked.  Texts in which lower case or composition is not that of single characters, and those with a special
    token, go through the library."""

    def __init__(self, path: str, special_as_text: bool = False):
        super().__init__(path, special_as_text)
        self.library.encode_special_tokens = special_as_text

    @staticmethod
    def _check(path: str, spec: dict) -> None:
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if (steps != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in pre] != ["Split", "ByteLevel"] or pre[1]["use_regex"] or pre[1]["add_prefix_space"]
                or pre[0]["pattern"] != {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"} or not pre[0]["invert"] or pre[0]["behavior"] != "Removed"):
            raise ValueError(f"{path} is not a tokenizer of lower-case words")

    def _ask(self, points: np.ndarray) -> None:
        for p in points.tolist():
            c = chr(p)
            self._class[p] = (LETTER if len(self._pieces("a" + c)) == 1 and len(self._pieces(c)) == 1 else OTHER if len(self._pieces("!" + c)) == 1 and len(self._pieces(c)) == 1
                              else NUMBER if len(self._pieces(c)) == 1 else WHITE)

    @staticmethod
    def _split(begin: np.ndarray, run: np.ndarray, edge: np.ndarray, data: np.ndarray, kind: np.ndarray, chars: np.ndarray | None) -> None:
        """Each number character is a word."""
        number = np.flatnonzero(kind == NUMBER) if chars is None else chars[kind[chars] == NUMBER]
        begin[number] = True

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, the number of ids of each)."""
        low, other = [], {}
        for k, text in enumerate(texts):
            own = text.lower()
            if (own.isascii() or "\u03c2" not in own and is_normalized("NFC", text)) and (self.find is None or self.find.search(text.encode()) is None):
                low.append(own.encode())
            else:
                low.append(b"")
                other[k] = np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)
        data, off = np.frombuffer(b"".join(low), np.uint8), np.cumsum([0, *map(len, low)])
        ids, counts = np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        if len(data):
            begin, _, kind = self.starts(data, off[:-1][np.diff(off) > 0])
            end = np.append(begin[1:], len(data))
            word = kind[begin] != WHITE
            ids, size = self.merged.encode(data, begin[word], end[word])
            total = np.concatenate(([0], np.cumsum(size)))
            counts = np.diff(total[np.searchsorted(begin[word], off)])
        if other:
            edge = np.cumsum(counts)
            parts = [other[k] if k in other else ids[edge[k] - counts[k]:edge[k]] for k in range(len(texts))]
            ids, counts = np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        return ids, counts


def byte_level(path: str, special_as_text: bool = False) -> ByteLevel:
    """The coder of this Python worker for a tokenizer file (tables of a fixed size)."""
    if (path, special_as_text) not in _CODERS:
        _CODERS[path, special_as_text] = ByteLevel(path, special_as_text)
    return _CODERS[path, special_as_text]
