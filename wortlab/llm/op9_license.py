"""Operator 9: license texts by winnowed fingerprints, an inverted index of templates, and banded alignment.

Texts and templates become lower-case words of ASCII letters, digits and bytes of other characters.  Hashes of their
``GRAM``-word runs are winnowed (the leftmost least of every ``WINDOW``), so that a shared run of GRAM + WINDOW - 1 words has a common
fingerprint.  The templates' fingerprints are an inverted index (hash to template and place); a document's fingerprints
found there vote for a template and a diagonal, and votes of one template near one diagonal are one candidate; those outside
the stretch it is aligned with are a candidate again.  Each
candidate is aligned with its stretch of the document within ``BAND`` words of the diagonal.  Similarity is the matched words
over the template's words and the other words of the stretch; coverage is the matched share of the template's words.  Candidates
of similarity ``LEAST_COVERAGE`` at least are reported with their span, unless a word that names a sibling license (``MARKS``)
is more or less in it, or a number of the template is missing; of overlapping spans, of any license, the one with the most
matched less missing and other words stays.

Templates are broadcast.  Their text is measured first, and above ``max_template_bytes`` the call raises ValueError.  Documents
never move: one scan and one map, whatever repeats.

Defined results.  A null or empty text, or one without a license, gives no row.  A template without a word is never found;
templates of fewer than GRAM words have one fingerprint, of all their words.  Repeated rows are reported each.  Only id and text are read.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, blocks, documents, grams, mix, sliding_argmin

NAME = "op9_license_scan"
SQL = None  # alignment is not SQL; tests hold it against brute force over every template and place
GRAM, WINDOW, BAND, LEAST_COVERAGE, TEMPLATE_BYTES = 3, 3, 8, 0.9, 16 << 20

_COMMONS = (("", "", ""), ("-SA", "-ShareAlike", "Share Alike"), ("-NC", "-NonCommercial", "Noncommercial"), ("-ND", "-NoDerivatives", "No Derivative Works"),
            ("-NC-SA", "-NonCommercial-ShareAlike", "Noncommercial Share Alike"), ("-NC-ND", "-NonCommercial-NoDerivatives", "Noncommercial No Derivative Works"))
_VERSIONS = (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic"), ("1.0", "Generic"))
#: License, and its names as they follow "licensed under".
_NAMES = (
    ("MIT", "the MIT License"), ("MIT", "the terms of the MIT License"), ("MIT-0", "the MIT No Attribution License"), ("ISC", "the ISC License"),
    ("Apache-2.0", "the Apache License, Version 2.0"), ("Apache-2.0", "the Apache License 2.0"), ("Apache-1.1", "the Apache License, Version 1.1"),
    *((f"{short}-{v}", name) for short, words, versions in (
        ("GPL", "General", ("1.0", "2.0", "3.0")), ("AGPL", "Affero General", ("1.0", "3.0")),
        ("LGPL", "Lesser General", ("2.1", "3.0")), ("LGPL", "Library General", ("2.0",)))
      for v in versions for name in (f"the GNU {words} Public License, version {v.removesuffix('.0')}", f"the GNU {words} Public License v{v}",
                                     f"the GNU {words} Public License v{v.removesuffix('.0')}")),
    ("BSD-2-Clause", "the BSD 2-Clause License"), ("BSD-3-Clause", "the BSD 3-Clause License"), ("BSD-4-Clause", "the BSD 4-Clause License"),
    ("BSD-2-Clause", "the Simplified BSD License"), ("BSD-3-Clause", "the New BSD License"),
    ("MPL-2.0", "the Mozilla Public License, version 2.0"), ("MPL-1.1", "the Mozilla Public License, version 1.1"),
    ("EPL-2.0", "the Eclipse Public License, version 2.0"), ("EPL-1.0", "the Eclipse Public License, version 1.0"),
    ("BSL-1.0", "the Boost Software License, version 1.0"), ("CC0-1.0", "CC0 1.0"), ("CC0-1.0", "CC0 1.0 Universal"),
    *((f"CC-BY{code}-{v}", name) for code, long, _ in _COMMONS for v, _ in _VERSIONS
      for name in (f"CC BY{code} {v}", f"Creative Commons Attribution{long} {v}")),
)
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so")
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.")
_ADVERTISING = ("All advertising materials mentioning features or use of this software must display the following acknowledgement: "
                "This product includes software developed by the copyright holder.")
_ENDORSE = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
            "software without specific prior written permission.")
_ENDORSE_1 = "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission."


def _gnu(name: str, version: str, last: str) -> str:
    return (f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} Public License as published "
            f"by the Free Software Foundation, either version {version}{last}, or (at your option) any later version.")


#: License notices as they are commonly written, with those of their siblings.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", _MIT + ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("MIT-0", _MIT + "."),
    ("ISC", _ISC + ", provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", _ISC + "."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
                   "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
                   "KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    *((f"{short}-{v}", _gnu(name, n, last)) for short, name, v, n, last in (
        ("GPL", "General", "3.0", "3", " of the License"), ("GPL", "General", "2.0", "2", " of the License"), ("GPL", "General", "1.0", "1", ""),
        ("AGPL", "Affero General", "3.0", "3", " of the License"), ("AGPL", "Affero General", "1.0", "1", " of the License"),
        ("LGPL", "Lesser General", "3.0", "3", " of the License"), ("LGPL", "Lesser General", "2.1", "2.1", " of the License"),
        ("LGPL", "Library General", "2.0", "2", " of the License"))),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", f"{_BSD} {_ENDORSE}"),
    ("BSD-3-Clause", f"{_BSD} {_ENDORSE_1}"),
    ("BSD-4-Clause", f"{_BSD} {_ADVERTISING} {_ENDORSE}"),
    ("BSD-4-Clause", f"{_BSD} {_ADVERTISING} {_ENDORSE_1}"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "This work is licensed under a Creative Commons Zero 1.0 Universal License."),
    *((f"CC-BY{code}-{v}", f"This work is licensed under a Creative Commons Attribution{name} {v} {where} License.") for code, long, old in _COMMONS
      for v, where in _VERSIONS for name in dict.fromkeys((long, f" {old}".rstrip()))),
    *((license, f"{lead} {name}.") for license, name in _NAMES for lead in ("Released under", "Licensed under", "This work is licensed under")),
)
#: Words that tell a license from its siblings: a match has the same ones as its template, and the template's numbers.
MARKS = ("affero", "lesser", "noncommercial", "commercial", "sharealike", "alike", "noderivatives", "noderivs", "derivatives", "derivative", "derivs", "nc", "sa", "nd")
NUMBERS = tuple(p + str(n) for p in ("", "v") for n in range(100))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def fingerprints(words: Words, hashes: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the winnowed fingerprints of each document of the block; short ones have one."""
    values, doc = grams(hashes, gram, 0x7F4A7), words.doc()
    inside = doc[:len(values)] == doc[gram - 1:] if len(values) else np.zeros(0, bool)
    place = sliding_argmin(values, window)
    whole = doc[:len(place)] == doc[gram + window - 2:] if len(place) else np.zeros(0, bool)
    chosen = [np.unique(place[whole])]
    size = np.diff(words.first)
    few = np.flatnonzero((size >= gram) & (size < gram + window - 1))
    for d in few.tolist():
        a, b = words.first[d], words.first[d + 1] - gram + 1
        chosen.append(np.array([a + int(values[a:b].argmin())]))
    at = np.concatenate(chosen).astype(np.int64)
    out, own = [at], [values[at[inside[at]]] if len(at) else np.zeros(0, np.uint64)]
    for d in np.flatnonzero((size > 0) & (size < gram)).tolist():  # all words, told apart by their number
        a, b = words.first[d], words.first[d + 1]
        out.append(np.array([a]))
        own.append(mix(hashes[a:b].sum(keepdims=True) + np.uint64(b - a)))
    return np.concatenate(out), np.concatenate(own)


def align(template: list, text: list, offset: int, band: int, cost: float = 0) -> tuple[int, int, int]:
    """(matched words, start, end) of the template in the text, where template word i meets text words within ``band``
    of i + offset: the most matched words less ``cost`` for each other text word between them; of the best the shortest stretch."""
    width = 2 * band + 1
    none = (0, 0, 0)
    best, top = [none] * (width + 1), (0, 0, 0, 0)  # (value, first word, matches): the later first word is the shorter stretch
    for i, w in enumerate(template):
        now = []
        for k in range(width):  # text word j = i + offset - band + k
            j = i + offset - band + k
            cell = best[k + 1] if k + 1 < width else none   # same text word, previous template word
            left = now[k - 1] if k else none
            if left[2]:
                cell = max(cell, (left[0] - cost, left[1], left[2]))
            if 0 <= j < len(text) and text[j] == w:
                v, a, m = best[k]  # previous text word, previous template word
                here = (v + 1, a, m + 1) if m and v > 0 else (1, j, 1)
                cell = max(cell, here)
                top = max(top, (here[0], here[1] - j, -j, here[2]))
            now.append(cell)
        best = [*now, none]
    _, length, last, m = top
    return m, length - last, -last + 1 if m else 0


class TemplateIndex:
    """Words of the templates, and the inverted index of their fingerprints."""

    def __init__(self, templates):
        self.names = [n for n, _ in templates]
        texts = [(t or "").encode() for _, t in templates]
        off = np.cumsum([0, *map(len, texts)])
        words = Words(_LOWER[np.frombuffer(b"".join(texts), np.uint8)], off, _SEPARATOR)
        hashes = words.hashes()
        signs = " ".join([*MARKS, *NUMBERS]).encode()
        signs = Words(np.frombuffer(signs, np.uint8), np.array([0, len(signs)])).hashes().tolist()
        self.marks, self.numbers = set(signs[:len(MARKS)]), set(signs[len(MARKS):])
        self.words = [hashes[a:b].tolist() for a, b in zip(words.first[:-1], words.first[1:])]
        at, value = fingerprints(words, hashes)
        doc = words.doc()
        # every gram of a template is indexed: the text's winnowed ones then always meet it
        grams_, all_at = grams(hashes, GRAM, 0x7F4A7), np.arange(max(words.n - GRAM + 1, 0))
        fit = doc[:len(grams_)] == doc[GRAM - 1:] if len(grams_) else np.zeros(0, bool)
        short = np.isin(doc[at], np.flatnonzero(np.diff(words.first) < GRAM)) if len(at) else np.zeros(0, bool)
        at, value = np.concatenate((all_at[fit], at[short])), np.concatenate((grams_[fit], value[short]))
        order = np.argsort(value, kind="stable")
        self.hash, self.template, self.place = value[order], doc[at][order], (at - words.first[doc[at]])[order]

    def same_license(self, template: list, stretch: list) -> bool:
        """Whether the stretch has the template's marks, and its numbers in order."""
        if [w for w in template if w in self.marks] != [w for w in stretch if w in self.marks]:
            return False
        found = iter(stretch)
        return all(w in found for w in template if w in self.numbers)

    def votes(self, at: np.ndarray, value: np.ndarray):
        """(text word, template, template word) of every fingerprint of a text found in the index."""
        a, b = np.searchsorted(self.hash, value), np.searchsorted(self.hash, value, "right")
        n = b - a
        i = np.arange(int(n.sum())) + np.repeat(a - np.cumsum(n) + n, n)
        return np.repeat(at, n), self.template[i], self.place[i]


def scan_text(index: TemplateIndex, hashes: list, votes: list[tuple[int, int, int]], band: int, least: float) -> list[dict]:
    """Matches in one text from its (text word, template, template word) votes."""
    lines: dict[int, set[tuple[int, int]]] = {}
    for place, template, j in votes:
        lines.setdefault(template, set()).add((place - j, place))
    found = []
    for template, own in lines.items():
        words, text, k, own = index.words[template], hashes, 0, sorted(own)
        while k < len(own):  # a candidate for each group of near diagonals, its band around their middle
            o, place = own[k]
            if text[place] is None:  # inside a stretch aligned before
                k += 1
                continue
            stop = bisect_left(own, (o + band,))
            group = [d for d, place in own[k:stop] if text[place] is not None]
            middle = (group[0] + group[-1]) // 2
            near = set(text[max(middle - band, 0):max(middle + band + len(words), 0)])
            if sum(w in near for w in words) < least * len(words):
                k = stop
                continue
            m, a, b = align(words, text, middle, band, least)
            if not m or m / (len(words) + b - a - m) < least:
                k = stop
                continue
            if index.same_license(words, hashes[a:b]):
                found.append((m, m / len(words), a, b, index.names[template], 3 * m - len(words) - (b - a)))
            text = text.copy() if text is hashes else text
            text[a:b] = [None] * (b - a)  # the group's other votes are aligned again, outside this stretch
    kept, taken = [], np.zeros(len(hashes), bool)
    for s in sorted(found, key=lambda s: (-s[5], s[3] - s[2], s[2], s[4])):
        if not taken[s[2]:s[3]].any():
            taken[s[2]:s[3]] = True
            kept.append(s)
    out = []
    for name in sorted({k[4] for k in kept}):
        own = sorted((k for k in kept if k[4] == name), key=lambda k: k[2])
        out.append({"license": name, "coverage": max(k[1] for k in own), "matched": sum(k[0] for k in own),
                    "spans": [{"start": k[2], "end": k[3], "coverage": k[1]} for k in own]})
    return out


def license_scan(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text", band: int = BAND,
                 least_coverage: float = LEAST_COVERAGE, max_template_bytes: int = TEMPLATE_BYTES) -> DataFrame:
    """One row per document and license found: doc_id, license, coverage (best), matched (words), spans (start, end in
    words of the text, coverage)."""
    size = sum(len((t or "").encode()) for _, t in templates)
    if size > max_template_bytes:
        raise ValueError(f"the templates have {size} bytes; the bound is {max_template_bytes}")
    sent = docs.sparkSession.sparkContext.broadcast(TemplateIndex(templates))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("coverage", T.DoubleType())])
    schema = T.StructType([T.StructField("doc_id", d.schema["doc_id"].dataType), T.StructField("license", T.StringType()), T.StructField("coverage", T.DoubleType()),
                           T.StructField("matched", T.LongType()), T.StructField("spans", T.ArrayType(span))])

    def make(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        index, kinds = sent.value, to_arrow_schema(schema)
        for rows, data, off in blocks(batches, "text"):
            words = Words(_LOWER[data], off, _SEPARATOR)
            if not words.n:
                continue
            hashes = words.hashes()
            place, template, j = index.votes(*fingerprints(words, hashes))
            doc = np.searchsorted(words.first, place, "right") - 1
            order = np.argsort(doc, kind="stable")
            doc, place, template, j = doc[order], place[order], template[order], j[order]
            owners, begin = np.unique(doc, return_index=True)
            out = []
            for d, a, b in zip(owners.tolist(), begin.tolist(), [*begin[1:].tolist(), len(doc)]):
                first = int(words.first[d])
                own = hashes[first:words.first[d + 1]].tolist()
                for found in scan_text(index, own, [*zip((place[a:b] - first).tolist(), template[a:b].tolist(), j[a:b].tolist())], band, least_coverage):
                    out.append({"doc_id": rows["doc_id"][d].as_py(), **found})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([pa.field("doc_id", rows["doc_id"].type), *[kinds.field(n) for n in schema.names[1:]]]))

    return d.mapInArrow(make, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))
