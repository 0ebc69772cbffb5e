"""Token alignment, streaming byte-pair encoding, and periodic runs."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import aligned, runs, words

from wortlab.llm import bpe, op11_alignment, op12_transducer, op13_runs
from wortlab.llm.byte_level import byte_level
from wortlab.llm.perfect_hash import PerfectHash

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
PARTS = [" ", "  ", "\n", "\n\n", "\t", "\xa0", "　", "\x85", "'", "'s", "'re", "'T", "the", "ing", "é", "日本", "🎉", "▁", "<s>", "<0x0A>", "<|endoftext|>", "<|end", "1", "²", "...",
         "\x00", "\x1c", "́", "Straße", "xq", " a", " of", "r", "e"]


def mixed(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 30))) for _ in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# perfect hash


def test_perfect_hash_is_minimal_and_survives_its_bytes():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 64, 20_000, dtype=np.uint64))
    own = PerfectHash.build(keys)
    assert sorted(own.index(keys).tolist()) == list(range(len(keys)))
    again = PerfectHash.from_bytes(own.to_bytes())
    assert (again.index(keys) == own.index(keys)).all() and again.n == len(keys)
    assert len(own.to_bytes()) * 8 < 8 * len(keys)
    assert PerfectHash.build(keys[:0]).index(keys[:3]).tolist() == [-1] * 3
    with pytest.raises(ValueError):
        PerfectHash.build(np.zeros(2, np.uint64))


# merging


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_merging_many_strings_gives_the_model_s_ids(path):
    from tokenizers import Tokenizer

    merges, model, r = bpe.MergeList(path), Tokenizer.from_file(path).model, random.Random(2)
    units = [t.strip() for t in mixed(2000, 5)] + ["a" * k for k in range(1, 900, 13)] + ["".join(r.choice("aAbé日🎉=-_") for _ in range(n)) for n in range(1, 700, 9)]
    raw = [u.encode() for u in units if u]
    stop = np.cumsum([0, *map(len, raw)])
    ids, counts = merges.encode_many(np.frombuffer(b"".join(raw), np.uint8), stop[:-1], stop[1:])
    edge = np.cumsum(counts)
    want = [[t.id for t in model.tokenize("".join(bpe.BYTE_CHARS[b] for b in u))] for u in raw]
    assert [ids[b - n:b].tolist() for b, n in zip(edge, counts)] == want


def test_a_cache_with_few_slots_gives_the_same(monkeypatch):
    merges = bpe.MergeList(BYTE)
    cache = bpe.Merged(merges, slot_bits=4, room=200)
    for k in range(20):
        raw = [t.encode() for t in mixed(60, k % 4) if t]
        stop = np.cumsum([0, *map(len, raw)])
        data = np.frombuffer(b"".join(raw), np.uint8)
        got, want = cache.encode(data, stop[:-1], stop[1:]), merges.encode_many(data, stop[:-1], stop[1:])
        assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_distinct_strings():
    raw = [t.encode() for t in mixed(500, 9) if t] + [b"a" * 16, b"a" * 17, b"a" * 16 + b"\x00", b"a\x00", b"a", b"a\x00\x00"] * 2
    stop = np.cumsum([0, *map(len, raw)])
    places, number = bpe.distinct(np.frombuffer(b"".join(raw), np.uint8), stop[:-1], stop[1:])
    assert [raw[places[n]] for n in number] == raw and len(places) == len(set(raw))


def test_boundaries_beyond_the_lookahead_are_final():
    """Continuations may change a token only within the lookahead from the end of what was read; shorter bounds fail."""
    merges, r = bpe.MergeList(BYTE), random.Random(1)
    pieces = [merges.token_bytes[i].decode("latin-1") for i in range(300, 50_000, 7)]
    worst = 0
    for _ in range(400):
        head = "".join(r.choice(pieces) for _ in range(30)).encode("latin-1")
        ends = [set(np.cumsum(merges.lengths[merges._merge(np.frombuffer(head + "".join(r.choice(pieces) for _ in range(3)).encode("latin-1"), np.uint8), True)]).tolist()) for _ in range(4)]
        changed = [e for e in set().union(*ends) if e <= len(head) and not all(e in x for x in ends)]
        worst = max([worst, *(len(head) - e for e in changed)])
    assert 0 < worst <= merges.lookahead < 1000


# operator 12


@pytest.mark.parametrize("chunk", [7, 64, 700, 5000, 1 << 21])
def test_stream_in_chunks_of_any_size(chunk):
    from tokenizers import Tokenizer

    r, library = random.Random(3), Tokenizer.from_file(BYTE)
    texts = [None, "", *mixed(120, 1)]
    if chunk > 7:
        texts += ["a" * 5000, " " * 4000 + "x", "'" * 3000 + "s", "é" * 2000, "日本" * 1500, "".join(r.choice("abcdefgh") for _ in range(6000)), " \n" * 3000,
                  " " * 700 + "\n\n", "x " * 2000, "\xa0" * 2500 + "a", "<|endoftext|>" * 50, "z" * 2000 + "<|endoftext|>" + "z" * 1999 + "<|endof", "🎉" * 900]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts, pa.string())})
    got = list(op12_transducer.stream(byte_level(BYTE), iter([batch.slice(0, 50), batch.slice(50)]), chunk))
    assert [g[0] for g in got] == list(range(len(texts)))
    assert [np.concatenate(g[1]).tolist() if g[1] else [] for g in got] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [g[2] for g in got] == [t or "" for t in texts]


def test_the_encoder_s_state_stays_small():
    encoder = op12_transducer.Encoder(byte_level(BYTE))
    for piece in ("ab" * 5000, " " * 10_000, "日" * 3000):
        for _ in range(20):
            encoder.feed(np.frombuffer(piece.encode(), np.uint8), np.zeros(0, np.int64))
            assert len(encoder.tail) < 6 * encoder.keep


def test_decoder_is_the_library_s_on_any_ids():
    from tokenizers import Tokenizer

    r, library, coder = random.Random(7), Tokenizer.from_file(BYTE), byte_level(BYTE)
    for _ in range(1500):
        ids = [r.choice([r.randrange(256), r.randrange(50_257)]) for _ in range(r.randint(0, 12))]
        raw, step, decoder = coder.text_bytes(np.array(ids, np.int64)).tobytes(), r.randint(1, 5), op12_transducer.Decoder()
        text = "".join(decoder.feed(raw[i:i + step]) for i in range(0, len(raw), step)) + decoder.end()
        assert text == library.decode(ids, skip_special_tokens=False)


def test_transducer_on_a_table(spark, rows, docs, crowded, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE)
    want = Counter((r[0], tuple(library.encode(r[1] or "", add_special_tokens=False).ids), r[1] or "") for r in rows)
    for table in (docs, crowded):
        assert Counter((r.doc_id, tuple(r.ids), r.text) for r in op12_transducer.transduce(table, BYTE).collect()) == want
    assert op12_transducer.transduce(none, BYTE).count() == 0


def test_transducer_query(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE)
    want = set()
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.add((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert {tuple(r) for r in op12_transducer.query(spark, "/root/testdata/sf0.001").collect()} == want


# operator 11


def want_aligned(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    of_b = lambda i: bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return aligned(texts, lambda t: a.encode(t, add_special_tokens=False).ids, lambda i: bytes(bpe.BYTE_OF[c] for c in a.id_to_token(i)), b.encode, of_b)


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.mark.parametrize("sizes", [{}, {"max_pairs": 150, "subs": 4, "cache_bytes": 2000}])
def test_alignment(spark, sizes, monkeypatch):
    texts = [None, "", " ", "\n", " x", "\nx", "x ", "x\n", "▁a b", *mixed(250, 11)]
    texts += texts[30:60]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS pair", "2 AS n_best", "3 AS groups").repartition(3)
    monkeypatch.setattr(op11_alignment, "CHUNK", 64)
    got = {r.doc_id: tuple(r[c] for c in FIGURES) for r in op11_alignment.alignment(df, BYTE, PIECE, **sizes).collect()}
    assert [got[i] for i in range(len(texts))] == want_aligned(texts)
    assert sum(w[0] > 0 for w in got.values()) > 100


def test_alignment_of_repeated_rows_null_ids_and_no_rows(spark, none):
    rows = [(None, "a b"), (None, "a b"), (1, "a b"), (1, None), (1, "a\xa0b")]
    got = op11_alignment.alignment(spark.createDataFrame(rows, "doc_id long, text string"), BYTE, PIECE)
    assert Counter((r.doc_id, *(r[c] for c in FIGURES)) for r in got.collect()) == Counter((r[0], *w) for r, w in zip(rows, want_aligned([r[1] for r in rows])))
    assert op11_alignment.alignment(none, BYTE, PIECE).count() == 0


def test_alignment_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len(r.text or "") < 1500]  # the brute force compares all tokens of a text
    got = {r.doc_id: r for r in op11_alignment.query(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    for r, w in zip(short, want_aligned([r.text for r in short])):
        g = got[r.doc_id]
        assert (g.n_a, g.n_b, g.n_groups, g.n_links, g.groups_sha256) == (*w[:4], sha(w[6]) if w[0] else "")


# operator 13


def word_lists(n, seed):
    r = random.Random(seed)
    for _ in range(n):
        k = r.choice([1, 2, 2, 3, 5, 50])
        w = [r.randrange(k) for _ in range(r.randint(0, 60))]
        if r.random() < .6 and w:
            a = r.randrange(len(w))
            u = w[a:a + r.randint(1, 7)]
            w = w[:a] + u * r.randint(1, 9) + u[:r.randint(0, len(u))] + w[a:]
        yield w


@pytest.mark.parametrize("least,exponent", [(2, 2), (3, 3), (6, 4)])
def test_runs_of_suffix_array(least, exponent):
    lists = list(word_lists(900, least))
    for i in range(0, len(lists), 9):
        own = lists[i:i + 9]
        first = np.cumsum([0, *map(len, own)])
        start, end, period = op13_runs.SuffixArray(np.array(sum(own, []), np.int64), first).runs(least, exponent)
        got = [[] for _ in own]
        for a, b, q in zip(start.tolist(), end.tolist(), period.tolist()):
            d = int(np.searchsorted(first, a, "right")) - 1
            got[d].append((a - int(first[d]), b - a, q))
        assert got == [runs(w, least, exponent) for w in own]


def test_suffix_array_is_sorted():
    for w in word_lists(60, 4):
        own = op13_runs.SuffixArray(np.array(w, np.int64), np.array([0, len(w)]))
        assert own.order.tolist() == sorted(range(len(w)), key=lambda i: w[i:])


def collapsed(w, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_collapse(spark, rows, crowded, none):
    extra = [(900, "x " * 5000), (901, " a b" * 7 + "\n a"), (902, "a b c a b c a b c a b"), (903, "é é é é é é"), (903, "é é é é é é")]
    df = crowded.select("doc_id", "text", "start", "n_words").unionByName(spark.createDataFrame(extra, "doc_id long, text string").selectExpr("*", "'x' AS start", "'x' AS n_words"))
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.text) for r in op13_runs.collapse(df).collect())
    want = Counter()
    for i, t in [*[(r[0], r[1]) for r in rows], *extra]:
        w = words(t)
        found = runs(w) if len(w) < 400 or i == 900 else None
        if i == 900:
            found = [(0, 5000, 1)]
        if found is None:
            found = [tuple(x) for x in next(iter(g[2] for g in got if g[0] == i and g[1] == len(w)))]
        want[i, len(w), tuple(found), collapsed(w, found)] += 1
    assert got == want
    assert op13_runs.collapse(none).count() == 0


def test_runs_query(spark):
    want = set()
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        w, h = words(r.text), zlib.crc32(str(r.doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 700:
            continue
        found = runs(w)
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        want.add((r.doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(collapsed(w, found))))
    got = {tuple(r) for r in op13_runs.query(spark, "/root/testdata/sf0.001").collect()}
    assert len(want) > 100 and want <= got and sum(x[1] for x in want) > 10
