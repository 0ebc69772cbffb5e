"""Byte-pair merging of many short byte strings at once, from the merge list of a tokenizer file.

All strings are held as one array of symbols.  In a round each string merges its best pair (lowest rank) wherever it occurs, left
to right, as the merge list demands; strings without a pair of the list leave the array.  Pairs are looked up by a hash
table.  Very long strings are merged one by one over a heap, since they would need a round for every rank they use.

``MergeList.lookahead`` is the number of further bytes after which a token boundary cannot change any more.  Let two
continuations of a text differ from some place p on.  A merge (a, c) with c beginning at p can happen for one of them only, and
moves p back by the length of a; the next such merge has a higher rank, and its right part begins with the token a.  The
longest chain of such merges, by bytes, is found from the list in the order of ranks: a boundary further than that from the end of
what was read is final.  It holds for lists in which the parts of a merge come before it and every token has one merge.
"""

from __future__ import annotations

import heapq
import json

import numpy as np

#: How byte-level tokenizers write a byte: printable Latin-1 characters stand for themselves, the others follow from 256 on.
_SELF = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARS = [chr(b) if b in _SELF else chr(256 + sum(x not in _SELF for x in range(b))) for b in range(256)]
BYTE_OF = {c: b for b, c in enumerate(BYTE_CHARS)}
LONG_BYTES, WINDOW_BYTES = 400, 1 << 14
NEVER = np.iinfo(np.int32).max
SLOT_BITS = 18
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class MergeList:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        if model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout") or model.get("continuing_subword_prefix"):
            raise ValueError(f"{path} is not a plain list of merges")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[m[k]] for m in merges], np.int64) for k in (0, 1))
        made = np.array([vocab["".join(m)] for m in merges], np.int64)
        self.byte_ids = np.array([vocab[c] for c in BYTE_CHARS], np.int32)
        self.last_ids = np.array([vocab[c + self.suffix] for c in BYTE_CHARS], np.int32) if self.suffix else self.byte_ids
        self.size = max(vocab.values()) + 1
        keys = self._key(left, right)
        self.made, self.merges = made.astype(np.int32), (left, right, made)
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []  # keys, ranks; a key whose slot is taken is in a later table
        rest = np.arange(len(keys))
        while len(rest):
            slots, ranks = np.full(1 << SLOT_BITS, _EMPTY), np.zeros(1 << SLOT_BITS, np.int32)
            slot, first = np.unique(self._slot(keys[rest], len(self.tables)), return_index=True)
            slots[slot], ranks[slot] = keys[rest[first]], rest[first]
            rest = np.delete(rest, first)
            self.tables.append((slots, ranks))
        byte = np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)
        self.byte_ranks = self._ranks(*byte)
        self.pairs = {k: (r, m) for r, (k, m) in enumerate(zip(keys.tolist(), made.tolist()))}
        self.token_bytes: list[bytes] = [b""] * self.size
        for token, i in vocab.items():
            text = token[:-len(self.suffix)] if self.suffix and token.endswith(self.suffix) else token
            self.token_bytes[i] = bytes(map(BYTE_OF.get, text)) if all(c in BYTE_OF for c in text) else token.encode()
        self.lengths = np.array([len(b) for b in self.token_bytes], np.int64)
        self.lookahead = self._lookahead()

    @staticmethod
    def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)

    def _lookahead(self) -> int:
        """Bytes after which a boundary is final: the longest chain of merges that a change to the right can set off."""
        left, right, made = (x.tolist() for x in self.merges)
        first: dict[int, int] = {}
        reach: dict[int, int] = {}
        known = {*self.byte_ids.tolist(), *self.last_ids.tolist()}
        longest = 0
        for a, c, new in zip(left, right, made):
            if a not in known or c not in known or new in known:
                raise ValueError("a merge comes before its parts, or a token has two merges")
            before, spine = 0, c
            while spine is not None:
                before = max(before, reach.get(spine, 0))
                spine = first.get(spine)
            chain = before + int(self.lengths[a])
            reach[a] = max(reach.get(a, 0), chain)
            longest = max(longest, chain)
            known.add(new)
            first[new] = a
        return longest

    @staticmethod
    def _slot(keys: np.ndarray, table: int) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(15))) * _FACTORS[table % len(_FACTORS)] + np.uint64(table // len(_FACTORS))) >> np.uint64(64 - SLOT_BITS)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``NEVER`` for a pair that is not in the list."""
        keys = self._key(a, b)
        out = np.full(len(keys), NEVER, np.int32)
        open_ = None
        for table, (slots, ranks) in enumerate(self.tables):
            slot = self._slot(keys, table).view(np.int64)
            there = slots[slot]
            found = np.flatnonzero(there == keys)
            out[found if open_ is None else open_[found]] = ranks[slot[found]]
            on = np.flatnonzero((there != keys) & (there != _EMPTY))
            if not len(on):
                break
            open_, keys = on if open_ is None else open_[on], keys[on]
        return out

    def encode_many(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all strings data[start:end] one after another, number of tokens of each); strings are not empty."""
        length = end - start
        counts = np.zeros(len(start), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []  # strings, their symbols
        for i in np.flatnonzero(length > LONG_BYTES).tolist():
            ids = self.encode_long(data[start[i]:end[i]])
            counts[i] = len(ids)
            done.append((np.full(len(ids), i), ids))
        names = np.flatnonzero(length <= LONG_BYTES)
        size = length[names]
        stop = np.cumsum(size)
        at = np.arange(int(size.sum())) + np.repeat(start[names] - stop + size, size)
        raw = data[at]
        sym, rank = self.byte_ids[raw], np.full(len(raw), NEVER, np.int32)
        if len(names):
            rank[:-1] = self.byte_ranks[(raw[:-1].astype(np.int32) << 8) | raw[1:]]
            if self.suffix:
                sym[stop - 1] = self.last_ids[raw[stop - 1]]
                two = stop[size > 1] - 2
                rank[two] = self._ranks(sym[two], sym[two + 1])
            rank[stop - 1] = NEVER  # the last symbol of a string has no pair
        while len(sym):
            first = np.cumsum(size) - size
            least = np.minimum.reduceat(rank, first)
            over = least == NEVER
            hit = rank == np.repeat(np.where(over, -1, least), size)
            here = np.flatnonzero(hit)
            if (np.diff(here) == 1).any():  # a a a: pairs that overlap, every second one from the left merges
                new = np.append(True, np.diff(here) > 1)
                begin = np.maximum.accumulate(np.where(new, np.arange(len(here)), 0))
                here = here[(np.arange(len(here)) - begin) % 2 == 0]
            sym[here] = self.made[rank[here]]
            keep = np.ones(len(sym), bool)
            keep[here + 1] = False
            place = np.cumsum(keep)[here] - 1  # of the merged symbols among those kept
            size = np.add.reduceat(keep, first, dtype=np.int64)
            sym, rank = sym[keep], rank[keep]
            if len(place):
                last = np.zeros(len(sym), bool)
                last[np.cumsum(size) - 1] = True
                again = np.concatenate((place, place[place > 0] - 1))
                none = last[again]
                rank[again[none]] = NEVER
                again = again[~none]
                rank[again] = self._ranks(sym[again], sym[again + 1])
            if over.sum() * 4 >= len(over):
                out = np.repeat(over, size)
                counts[names[over]] = size[over]
                done.append((np.repeat(names[over], size[over]), sym[out]))
                keep = ~out
                sym, rank = sym[keep], rank[keep]
                names, size = names[~over], size[~over]
        if not done:
            return np.zeros(0, np.int32), counts
        where = np.concatenate([w for w, _ in done])
        return np.concatenate([s for _, s in done])[np.argsort(where, kind="stable")], counts

    def encode_long(self, data: np.ndarray) -> np.ndarray:
        """Token ids of one string, in windows: the tokens of a window up to ``lookahead`` before its end are final."""
        parts, at = [], 0
        while len(data) - at > WINDOW_BYTES + self.lookahead:
            ids, used = self.stable(data[at:at + WINDOW_BYTES + self.lookahead], self.lookahead)
            parts.append(ids)
            at += used
        return np.concatenate((*parts, self._merge(data[at:], True)))

    def stable(self, data: np.ndarray, keep: int) -> tuple[np.ndarray, int]:
        """(tokens that end at least ``keep`` bytes before the end of the beginning of a string, the bytes they cover)."""
        ids = self._merge(data, False)
        stop = np.cumsum(self.lengths[ids])
        n = int(np.searchsorted(stop, len(data) - keep, "right"))
        return ids[:n], int(stop[n - 1]) if n else 0

    def _merge(self, data: np.ndarray, whole: bool) -> np.ndarray:
        """Merges one string over a heap of its pairs; ``whole``: its last byte ends a word."""
        sym: list[int | None] = self.byte_ids[data].tolist()
        if sym and whole:
            sym[-1] = int(self.last_ids[data[-1]])
        n, pairs = len(sym), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(pairs[k][0], i, k) for i, k in enumerate((a << 32) | b for a, b in zip(sym, sym[1:])) if k in pairs]
        heapq.heapify(heap)
        while heap:
            _, i, k = heapq.heappop(heap)
            j = after[i] if sym[i] is not None else n
            if j >= n or (sym[i] << 32) | sym[j] != k:
                continue
            sym[i], sym[j] = pairs[k][1], None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (key := (sym[a] << 32) | sym[b]) in pairs:
                    heapq.heappush(heap, (pairs[key][0], a, key))
        return np.array([s for s in sym if s is not None], np.int32)


def _keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first 8 bytes, next 8 bytes, length, a hash of these) of strings."""
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    view = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    length = end - start
    low = view[start] & _MASK[np.minimum(length, 8)]
    high = np.zeros(len(start), np.uint64)
    more = np.flatnonzero(length > 8)
    high[more] = view[start[more] + 8] & _MASK[np.minimum(length[more] - 8, 8)]
    key = (low ^ (low >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + (high ^ (high >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return low, high, length, (key ^ (key >> np.uint64(32))) + length.astype(np.uint64) * np.uint64(0x165667B19E3779F9)


class Merged:
    """Merges strings through a cache of fixed size: each string of up to 16 bytes has one slot, by its hash; a new one takes it."""

    def __init__(self, merges: MergeList, slot_bits: int = 19, room: int = 1 << 22):
        self.merges, self.shift = merges, np.uint64(64 - slot_bits)
        self.low, self.high = np.zeros((2, 1 << slot_bits), np.uint64)
        self.length, self.count, self.first = np.zeros((3, 1 << slot_bits), np.int32)
        self.ids, self.used = np.zeros(room, np.int32), 0

    def encode(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all strings one after another, number of tokens of each)."""
        low, high, length, key = _keys(data, start, end)
        slot = ((key * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)
        hit = (self.low[slot] == low) & (self.length[slot] == length) & (self.high[slot] == high)
        hit &= length <= 16
        miss = np.flatnonzero(~hit)
        first, count = self.first[slot], self.count[slot]
        if len(miss):
            places, number = distinct(data, start[miss], end[miss])
            places = miss[places]
            ids, size = self.merges.encode_many(data, start[places], end[places])
            base, store = self.used, self.ids
            if base + len(ids) > len(store):  # full: this block reads from a copy, and the cache begins anew
                store = np.concatenate((store[:base], ids))
                self.length[:] = 0
                self.used = 0
            else:
                store[base:base + len(ids)] = ids
                self.used += len(ids)
            at = base + np.cumsum(size) - size
            first[miss], count[miss] = at[number], size[number]
            if store is self.ids:
                short = length[places] <= 16
                own, at, size = places[short], at[short], size[short]
                to = slot[own]
                self.low[to], self.high[to], self.length[to], self.first[to], self.count[to] = low[own], high[own], length[own], at, size
                # of several new strings with one slot numpy writes one, the same in all five
        else:
            store = self.ids
        stop = np.cumsum(count, dtype=np.int64)
        total = int(stop[-1]) if len(stop) else 0
        return store[np.arange(total) + np.repeat(first - stop + count, count)], count.astype(np.int64)


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place in ``start`` for each distinct string data[start:end], the number of each string's own distinct one).

    Strings of up to 16 bytes are compared whole, as two integers and a length, after sorting by a hash of these; longer
    ones go through a dictionary.  No two different strings are taken for one.
    """
    low, high, length, key = _keys(data, start, end)
    number = np.zeros(len(start), np.int64)
    short = np.flatnonzero(length <= 16)
    order = short[np.argsort(key[short])]
    new = np.ones(len(order), bool)
    a, b = order[1:], order[:-1]
    new[1:] = (low[a] != low[b]) | (high[a] != high[b]) | (length[a] != length[b])  # equal keys of different strings only split a group
    number[order] = np.cumsum(new) - 1
    places = order[new]
    rest = np.flatnonzero(length > 16)
    if len(rest):
        raw, seen, more = data.tobytes(), {}, []
        for i, s, e in zip(rest.tolist(), start[rest].tolist(), end[rest].tolist()):
            k = seen.setdefault(raw[s:e], len(seen))
            if k == len(more):
                more.append(i)
            number[i] = len(places) + k
        places = np.concatenate((places, np.array(more, np.int64)))
    return places, number


_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def gather(values: np.ndarray, counts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``values`` (the k-th has ``counts[k]``) in the order of ``which``: (values, sizes)."""
    first = np.cumsum(counts) - counts
    size = counts[which]
    stop = np.cumsum(size)
    return values[np.arange(int(size.sum())) + np.repeat(first[which] - stop + size, size)], size
