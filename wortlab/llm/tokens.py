"""Token ids of whole texts by kind of tokenizer, as ``byte_level.py`` computes them; they are the ids of the library's plain call."""

from __future__ import annotations

import numpy as np

from .byte_level import ByteLevel, WordLevel


class Encoder:
    """``kind``: "spaced" (byte-level, white space belongs to tokens) or "bare" (the tokenizer drops it).  ``special_as_text``: the
    strings of special tokens in a text are ordinary text; else each is its special id, as the library does by itself."""

    def __init__(self, path: str, kind: str, special_as_text: bool = True):
        self.coder = {"spaced": ByteLevel, "bare": WordLevel}[kind](path, special_as_text)
        self.tokenizer = self.coder.library

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        ids, counts = self.coder.encode_texts(texts)
        raw, stop = ids.astype("<u4").tobytes(), np.cumsum(counts)
        return [raw[4 * a:4 * b] for a, b in zip((stop - counts).tolist(), stop.tolist())]


_CACHED: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    """The encoder of this Python worker for a tokenizer file (tables and a cache of a fixed size)."""
    if (path, kind) not in _CACHED:
        _CACHED[path, kind] = Encoder(path, kind, special_as_text=False)
    return _CACHED[path, kind]
