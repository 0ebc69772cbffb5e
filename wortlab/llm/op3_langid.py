"""Operator 3: language of every word by a linear-chain conditional random field, and of every document by its words.

A word is a run of letters (ASCII letters in any case, and all bytes of other characters).  Its emission score for a label is
the sum of learned weights of its features: prefixes and suffixes of two and three bytes (affixes), all byte trigrams, and for
each label whether the word is in that label's lexicon.  Labels of neighbouring words are tied by learned transitions.
Forward-backward over the whole text gives each word's label probabilities; their mean over the text names the document's
language, and is the score.

Fitting.  Per language up to ``SAMPLE_ROWS`` labelled training documents (ids with the least hash; of a repeated one the least text) give up to
``SEGMENTS`` stretches of ``LENGTH`` words each, from places spread over the whole text.  Every language is learned.  Above
``FULL_LABELS`` of them the rows of each and the buckets go down in proportion (``LEAST_ROWS`` and ``LEAST_BUCKETS`` at least), chains go
up, and fitting and prediction take smaller slices, so that memory stays near what it is at ``FULL_LABELS``.  Code-switched chains are put together from stretches
of different languages, so that transitions are learned; weights come from full-batch AdaGrad on the conditional
log-likelihood.  The model (some MB; ``sizes``) is broadcast.  Prediction reads nothing but the text.

Forward-backward is exact and does not walk a long text word by word: texts are cut in stretches of ``STEP`` words, whose
transfer matrices are made side by side, chained, and then used to fill in all stretches side by side.

Defined results.  A text that is null or has no letter is ``und`` with score 0.  A null doc_id is not held out and never trained on.
With no labelled row every text is ``und`` with score 0.  Ties go to the first label in sorted order.  Repeated rows
get the same result.  Only id, text and lang are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLOCK_BYTES, U64, Words, blocks, documents, mix, written

NAME = "op3_language_crf"
SQL = None  # a trained model; tests check held-out accuracy and forward-backward against brute force
SAMPLE_ROWS, SEGMENTS, LENGTH, FULL_LABELS = 400, 3, 48, 64
BUCKETS, STEP, CHAINS, ROUNDS, SEED = 1 << 17, 64, 1500, 40, 11
LEXICON_COUNT, LEXICON_SHARE = 4, 0.6
LEAST_ROWS, LEAST_BUCKETS, CHAINS_EACH = 25, 1 << 12, 12
UNKNOWN = "und"


def sizes(labels: int) -> tuple[int, int]:
    """(buckets, words of a stretch of forward-backward) for this many labels: what is held goes with buckets x labels and
    with labels^2 for each stretch."""
    buckets = BUCKETS
    while buckets > LEAST_BUCKETS and buckets * labels > BUCKETS * FULL_LABELS:
        buckets //= 2
    return buckets, STEP * max(1, -(-labels * labels // FULL_LABELS ** 2))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_OTHER = np.ones(256, bool)
_OTHER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def words_of(data: np.ndarray, off: np.ndarray) -> Words:
    return Words(_LOWER[data], off, _OTHER)


def features(words: Words, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every affix and trigram feature."""
    data, n = words.data.astype(np.int64), words.n
    length = words.end - words.start
    place = np.flatnonzero(words.inside)
    word = np.cumsum(words.begins)[place] - 1
    tri = place + 2 < words.end[word]
    at = place[tri]
    found = [(word[tri], (data[at] << 16) | (data[at + 1] << 8) | data[at + 2])]
    for k in (2, 3):
        w = np.flatnonzero(length >= k)
        for salt, begin in ((2 * k, words.start[w]), (2 * k + 1, words.end[w] - k)):
            code = data[begin] << 8 | data[begin + 1]
            found.append((w, (code << 8 | data[begin + 2] if k == 3 else code) | salt << 24))
    code = np.concatenate([f[1] for f in found]).astype(U64)
    return np.concatenate([f[0] for f in found]) if n else np.zeros(0, np.int64), (mix(code) & U64(buckets - 1)).astype(np.int64)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray      # bucket x label
    lexicon: np.ndarray      # sorted word hashes
    member: np.ndarray       # word x label: in that label's lexicon
    lexical: np.ndarray      # label of the lexicon x label
    start: np.ndarray
    move: np.ndarray         # label x next label

    def in_lexicon(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(hashes), len(self.labels)))
        if len(self.lexicon):
            i = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
            hit = self.lexicon[i] == hashes
            out[hit] = self.member[i[hit]]
        return out

    def emissions(self, words: Words) -> np.ndarray:
        word, bucket = features(words, len(self.weights))
        out = self.in_lexicon(words.hashes()) @ self.lexical
        for label in range(len(self.labels)):
            out[:, label] += np.bincount(word, self.weights[:, label][bucket], words.n)
        return out


def posteriors(scores: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray, step: int = STEP) -> np.ndarray:
    """Label probabilities of each word by forward-backward; chain d has the words first[d] to first[d + 1]."""
    n, labels = scores.shape
    if not n:
        return scores
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    m, s = np.exp(move - move.max()), np.exp(start - start.max())
    size = np.diff(first)
    parts = -(-size // step)
    chain = np.repeat(np.arange(len(size)), parts)
    order = np.arange(len(chain)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = first[chain] + order * step
    length = np.minimum(first[chain + 1] - begin, step)
    head = order == 0
    # transfer matrix of every stretch: label before it (one for all, at a chain's head) to label at its end
    v = np.broadcast_to(np.eye(labels), (len(chain), labels, labels)).copy()
    for t in range(int(length.max())):
        live = length > t
        x = v[live] @ m
        if t == 0:
            x[head[live]] = s
        x *= e[begin[live] + t][:, None, :]
        v[live] = x / x.max(axis=(1, 2), keepdims=True)
    before, after = np.ones((len(chain), labels)) / labels, np.ones((len(chain), labels))
    for k in range(1, int(parts.max())):  # chained: all chains side by side
        i = np.flatnonzero(order == k)
        x = np.einsum("nl,nlm->nm", before[i - 1], v[i - 1])
        before[i] = x / x.sum(axis=1, keepdims=True)
    for k in range(int(parts.max()) - 2, -1, -1):
        i = np.flatnonzero((order == k) & (k + 1 < parts[chain]))
        x = np.einsum("nlm,nm->nl", v[i + 1], after[i + 1])
        after[i] = x / x.max(axis=1, keepdims=True)
    alpha = np.empty_like(e)
    now = before
    for t in range(int(length.max())):
        live = np.flatnonzero(length > t)
        x = now[live] @ m
        if t == 0:
            x[head[live]] = s
        x *= e[begin[live] + t]
        now = now.copy() if t == 0 else now
        now[live] = x / x.sum(axis=1, keepdims=True)
        alpha[begin[live] + t] = now[live]
    beta = after.copy()
    for t in range(int(length.max()) - 1, -1, -1):
        live = np.flatnonzero(length > t)
        at = begin[live] + t
        alpha[at] *= beta[live]
        x = (beta[live] * e[at]) @ m.T
        beta[live] = x / x.max(axis=1, keepdims=True)
    return alpha / alpha.sum(axis=1, keepdims=True)


def _expected(scores: np.ndarray, start: np.ndarray, move: np.ndarray):
    """For equal-length chains (chain x word x label): log normaliser, node and summed pair marginals."""
    n, length, labels = scores.shape
    top = scores.max(axis=2, keepdims=True)
    e, m = np.exp(scores - top), np.exp(move)
    alpha, scale = np.empty_like(e), np.empty((n, length))
    for t in range(length):
        x = (np.exp(start) if t == 0 else alpha[:, t - 1] @ m) * e[:, t]
        scale[:, t] = x.sum(axis=1)
        alpha[:, t] = x / scale[:, t, None]
    beta = np.ones((n, labels))
    node, pair = np.empty_like(e), np.zeros((labels, labels))
    for t in range(length - 1, -1, -1):
        node[:, t] = alpha[:, t] * beta
        if t:
            x = beta * e[:, t] / scale[:, t, None]
            pair += m * (alpha[:, t - 1].T @ x)
            beta = x @ m.T
    return (np.log(scale).sum() + top.sum()), node, pair


def fit(stretches: list[tuple[str, str]], seed: int = SEED, chains: int = CHAINS, rounds: int = ROUNDS) -> Model | None:
    """The model of labelled stretches of text (lang, text); None without any."""
    texts = [t.encode() for _, t in stretches]
    words = words_of(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    labels = sorted({lang for lang, _ in stretches})
    if not labels or not words.n:
        return None
    number = {lang: k for k, lang in enumerate(labels)}
    label = np.array([number[lang] for lang, _ in stretches])
    buckets, _ = sizes(len(labels))
    chains = max(chains, CHAINS_EACH * len(labels))
    hashes, of = words.hashes(), label[words.doc()]
    found, place = np.unique(hashes, return_inverse=True)
    cells, count = np.unique(place * len(labels) + of, return_counts=True)  # (word, label) pairs that occur
    of_cell = cells // len(labels)
    member = (count >= LEXICON_COUNT) & (count >= LEXICON_SHARE * np.bincount(of_cell, count, len(found))[of_cell])
    known = np.unique(of_cell[member])
    lexicon = np.zeros((len(known), len(labels)))
    lexicon[np.searchsorted(known, of_cell[member]), cells[member] % len(labels)] = 1
    model = Model(labels, np.zeros((buckets, len(labels))), found[known], lexicon, np.zeros((len(labels),) * 2),
                  np.zeros(len(labels)), np.zeros((len(labels),) * 2))
    # chains of LENGTH words from one to three stretches, of any languages
    rng = np.random.default_rng(seed)
    by_label = np.argsort(label, kind="stable")
    by_label = by_label[np.diff(words.first)[by_label] > 0]
    usable = np.split(by_label, np.searchsorted(label[by_label], np.arange(1, len(labels))))
    languages = [k for k in range(len(labels)) if len(usable[k])]
    rows = []
    for _ in range(chains):
        edges = np.sort(rng.choice(np.arange(1, LENGTH), rng.integers(0, 3), replace=False))
        row = []
        for size in np.diff(np.concatenate(([0], edges, [LENGTH]))):
            d = rng.choice(usable[rng.choice(languages)])
            a, b = words.first[d], words.first[d + 1]
            i = rng.integers(a, max(a + 1, b - size + 1))
            row.append(a + (i - a + np.arange(size)) % (b - a))
        rows.append(np.concatenate(row))
    chain = np.array(rows)
    truth = of[chain]
    word, bucket = features(words, buckets)
    used, compact = np.unique(bucket, return_inverse=True)
    begin = np.searchsorted(np.sort(word, kind="stable"), np.arange(words.n + 1))
    compact = compact[np.argsort(word, kind="stable")]
    weight = np.zeros((len(used), len(labels)))
    params = [weight, model.lexical, model.start, model.move]
    squares = [np.full_like(p, 1e-6) for p in params]
    pairs = np.zeros_like(model.move)
    np.add.at(pairs, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1)
    slices = []  # of chains: what is held of each goes with the labels
    for a in range(0, len(chain), max(1, CHAINS * FULL_LABELS // len(labels))):
        own = slice(a, a + max(1, CHAINS * FULL_LABELS // len(labels)))
        flat = chain[own].ravel()
        size = np.diff(begin)[flat]
        cell = np.repeat(np.arange(len(flat)), size)
        slices.append((truth[own], flat, cell, compact[np.arange(int(size.sum())) + np.repeat(begin[flat] - np.cumsum(size) + size, size)]))
    for _ in range(rounds):
        grads = [np.zeros_like(p) for p in params]
        grads[3] += pairs
        for own, flat, cell, feature in slices:
            lex = model.in_lexicon(hashes[flat])
            scores = lex @ model.lexical
            for k in range(len(labels)):
                scores[:, k] += np.bincount(cell, weight[:, k][feature], len(flat))
            _, node, pair = _expected(scores.reshape(*own.shape, -1), model.start, model.move)
            off = -node
            np.put_along_axis(off, own[..., None], 1 + np.take_along_axis(off, own[..., None], axis=2), axis=2)
            grads[2] += off[:, 0].sum(axis=0)
            off = off.reshape(len(flat), -1)
            for k in range(len(labels)):
                grads[0][:, k] += np.bincount(feature, off[:, k][cell], len(used))
            grads[1] += lex.T @ off
            grads[3] -= pair
        for p, g, q in zip(params, grads, squares):
            g = g / len(chain) - 1e-4 * p
            q += g * g
            p += 0.3 * g / np.sqrt(q)
    model.weights[used] = weight
    return model


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def training_stretches(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows (lang, text): bounded stretches of the sampled training documents."""
    labelled = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    top = (labelled.groupBy(F.col(lang_col).alias("lang")).agg(F.approx_count_distinct(id_col).alias("n")))
    top = written(top, "op3-languages")
    rows = min(rows, max(LEAST_ROWS, rows * FULL_LABELS // max(top.count(), 1)))
    ids = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).join(F.broadcast(top), "lang")
    # about four times the ids wanted are left of each language, however many it has, before they are ranked
    near = ids.withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1 << 30))).where(F.col("h") / (1 << 30) < 4.0 * rows / F.col("n")).distinct()
    order = Window.partitionBy("lang").orderBy("h", "id")
    chosen = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= rows).select("id", "lang")
    bounded = F.broadcast(chosen)  # rows for each language
    texts = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).join(bounded, ["id", "lang"])
    texts = texts.groupBy("id", "lang").agg(F.min("text").alias("text"))  # one row of each, however many it has

    def make(batches):
        for part, data, off in blocks(batches, "text"):
            words, langs, out = words_of(data, off), part["lang"].to_pylist(), ([], [])
            for d, lang in enumerate(langs):
                a, b = int(words.first[d]), int(words.first[d + 1])
                for k in range(min(SEGMENTS, -(-(b - a) // LENGTH))):
                    i = a + k * max((b - a - LENGTH) // max(SEGMENTS - 1, 1), LENGTH)
                    j = min(i + LENGTH, b)
                    if i < j:
                        out[0].append(lang)
                        out[1].append(" ".join(words.data[words.start[w]:min(words.end[w], words.start[w] + 200)].tobytes().decode(errors="ignore") for w in range(i, j)))
            yield pa.record_batch([pa.array(c, pa.string()) for c in out], names=["lang", "text"])

    return texts.mapInArrow(make, "lang string, text string")


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, n_words, shares (mean probability of each label)."""
    sample = training_stretches(docs, id_col, text_col, lang_col).collect()  # bounded by SAMPLE_ROWS, SEGMENTS, LENGTH and the languages
    model = fit(sorted((r.lang, r.text) for r in sample))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc_id", d.schema["doc_id"].dataType), T.StructField("held_out", T.BooleanType()),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("n_words", T.LongType()),
                           T.StructField("shares", T.ArrayType(T.DoubleType()))])

    def make(batches):
        model = sent.value
        labels = len(model.labels) if model is not None else 1
        step = sizes(labels)[1]
        for rows, data, off in blocks(batches, "text", min(BLOCK_BYTES, BLOCK_BYTES * FULL_LABELS // labels)):
            words = words_of(data, off)
            n = np.diff(words.first)
            ascii_letter = np.concatenate(([0], np.cumsum(_LOWER[data] - 97 < 26)))
            plain = ascii_letter[off[1:]] > ascii_letter[off[:-1]]
            texts = rows["text"]
            lettered = np.array([bool(p) or bool(k) and any(c.isalpha() for c in texts[i].as_py()) for i, (p, k) in enumerate(zip(plain, n))], bool)
            pred, score, shares = [UNKNOWN] * len(n), np.zeros(len(n)), [None] * len(n)
            if model is not None and words.n:
                p = posteriors(model.emissions(words), words.first, model.start, model.move, step)
                sums = np.zeros((words.n + 1, p.shape[1]))
                np.cumsum(p, axis=0, out=sums[1:])
                mean = (sums[words.first[1:]] - sums[words.first[:-1]]) / np.maximum(n, 1)[:, None]
                best = mean.argmax(axis=1)
                for i in np.flatnonzero(lettered):
                    pred[i], score[i], shares[i] = model.labels[best[i]], min(1.0, float(mean[i, best[i]])), mean[i]
            yield pa.RecordBatch.from_arrays([rows["doc_id"], rows["held_out"], pa.array(pred, pa.string()), pa.array(score), pa.array(n, pa.int64()),
                                              pa.array(shares, pa.list_(pa.float64()))], names=schema.names)

    return d.mapInArrow(make, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")
