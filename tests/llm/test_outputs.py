"""Chat formatting, WARC, language identification, packing, token files and the pipeline."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import contamination, groups, quality, repeats, simhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from wortlab.llm import op1_chat, op2_warc, op3_langid, op4_quality, op5_packing, op6_simple8b
from wortlab.llm.common import written
from wortlab.llm.tokens import Encoder, encoder
from wortlab.session import scratch_path

SF = "/root/testdata/sf0.001"
public_tokenizers = pytest.importorskip("public_tokenizers")


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


ODD = ["", " ", "a\n\nb  c", "x \n y", " lead", "trail \n", "tab\tin a\tb", "don't I'll 's 't", "nb sp   x", "é ́a", "a\x1cb c", "İ ΣΑΣ ﬁ",
       "<|endoftext|> x<|startoftext|>", "x\x00y z", "日本語 テスト 🎉 x", "a" * 300 + " b", "\r\n a \r\nb", "\x85x y\x85 z", "1 2 34 5,6 .. !!", "\n a", "a \n", "  x"]


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "spaced"), ("word_bpe_49k.json", "bare")])
def test_unit_cache_gives_the_library_s_ids(rows, name, kind):
    texts, ids, coder = [*ODD, *[r[1] or "" for r in rows]], library(name), Encoder(public_tokenizers.path(name), kind)
    for _ in range(2):  # cold and warm
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [ids(t) for t in texts]


SPECIAL = ["a <|endoftext|> b", "a  <|endoftext|>\n\n<|startoftext|>b", "<|endoftext|>", "x<|endoftext|>y z\n<|endoftext|>\tq", "<|ENDOFTEXT|> <|endoftext|", "don't <|startoftext|> . x"]


def plain(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "spaced"), ("word_bpe_49k.json", "bare")])
def test_special_tokens_in_texts_are_those_of_the_plain_call(name, kind):
    r = random.Random(8)
    mixed = ["".join(r.choice(["<|endoftext|>", "<|startoftext|>", " ", "  ", "\n", "\t", "a", "Is", "'s", ".", "é", "1"]) for _ in range(25)) for _ in range(300)]
    texts, ids, coder = [*ODD, *SPECIAL, *mixed], plain(name), encoder(public_tokenizers.path(name), kind)
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [ids(t) for t in texts]


def test_special_tokens_in_packing_and_token_files(spark):
    df = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string").repartition(2)
    want, total = plain(op5_packing.TOKENIZER), Counter()
    for r in op5_packing.pack(df, public_tokenizers.path(op5_packing.TOKENIZER), op5_packing.KIND).collect():
        total[r.doc_id] += r.length
    assert total == Counter({i: len(want(t)) + 1 for i, t in enumerate(SPECIAL)})
    want = plain(op6_simple8b.TOKENIZER)
    manifest = op6_simple8b.write_token_files(df, scratch_path(spark, "test-special"), public_tokenizers.path(op6_simple8b.TOKENIZER), op6_simple8b.KIND)
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in op6_simple8b.read_token_files(manifest).collect()}
    raw = [np.array([*want(t), 2], "<u4").tobytes() for t in SPECIAL]
    assert got == {i: (len(x) // 4, zlib.crc32(x)) for i, x in enumerate(raw)}


# chat

CHAT = [(1, 0, "system", "Be <|kind|>"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 2, "ann", "two"), (1, 3, "ann", "bye"), (1, 3, "ann", "bye"),
        (None, 0, "ann", "alone"), (2, None, None, "late"), (2, 0, "bob x", "first"), (3, 0, "system", "only")]


def chat_brute(rows, part):
    out = []
    for conv in dict.fromkeys(r[0] for r in rows):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "unknown", r[3] or ""))
        for me in sorted({r[2] or "unknown" for r in own} - {"system"}):
            for k in range(0, len(own), part):
                text, mask = "", []
                for _, _, who, said in own[k:k + part]:
                    who = who or "unknown"
                    text += "<|im_start|>" + ("system" if who == "system" else "assistant" if who == me else "user name=" + who.replace(" ", "_")) + "\n"
                    body = (said or "").replace("<|", "< |") + "<|im_end|>\n"
                    if who == me:
                        mask.append((len(text), len(text) + len(body)))
                    text += body
                out.append((conv, me, k // part, text, tuple(mask)))
    return Counter(out)


@pytest.mark.parametrize("part", [2, 64])
def test_chat(spark, part):
    df = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS pos", "2 AS mask", "3 AS part").repartition(3)
    got = op1_chat.perspectives(df, part=part)
    assert Counter((r.conv_id, r.perspective, r.part, r.rendered, tuple(map(tuple, r["mask"]))) for r in got.collect()) == chat_brute(CHAT, part)
    assert op1_chat.perspectives(df.limit(0)).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# WARC

PAGES = [(1, "http://a.example/x", "<p>é</p>"), (5, "http://b.example/", "<p>é</p>"), (3, None, "<p>é</p>"), (4, "u", None), (6, "u", ""), (7, "http://c\r\n.example", "x" * 100000),
         (7, "http://c\r\n.example", "x" * 100000), (None, "n", "<p>é</p>"), (None, "n", "own"), (8, "http://d.example/1", "solo"), (7, "other", "x" * 100000)]


@pytest.mark.parametrize("least", [0, 5])
def test_warc_roles_and_assembly(spark, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS sha", "2 AS kind", "3 AS response_id")
    manifest = op2_warc.write_archives(pages, scratch_path(spark, f"test-warc-{least}"), least, file_bytes=500)
    records = op2_warc.read_records(manifest).cache()
    rows = op2_warc.assemble(records).collect()
    got = Counter()
    for r in rows:
        page = int(r.metadata["pageId"]) if r.metadata["pageId"] else None
        got[page, int(r.metadata["payloadBytes"]), r.response.payload_digest, r.response.kind, r.metadata.get("refersToPage")] += r.n_copies
        assert r.request.kind == "request" and (r.response.payload is None) == (r.response.kind == "revisit")
    want = Counter()
    for page, _, html in PAGES:
        html = html or ""
        top = max((p for p, _, h in PAGES if (h or "") == html and p is not None), default=None)
        again = len(html.encode()) >= least and page != top
        want[page, len(html.encode()), op2_warc.digest(html.encode()), "revisit" if again else "response", str(top) if again else None] += 1
    assert got == want
    lone = op2_warc.assemble(records.where("kind = 'metadata'")).first()
    assert lone.response is None and lone.n_copies == 0


def test_warc_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert op2_warc.assemble(op2_warc.read_records(op2_warc.write_archives(none, scratch_path(spark, "test-warc-none")))).count() == 0


# language

def test_forward_backward():
    rng = np.random.default_rng(0)
    for sizes in ([1], [3, 2, 5], [0, 6, 1, 0, 4]):
        first = np.cumsum([0, *sizes])
        scores, start, move = rng.normal(size=(first[-1], 3)) * 3, rng.normal(size=3), rng.normal(size=(3, 3))
        for step in (1, 2, 64):
            got = op3_langid.posteriors(scores, first, start, move, step)
            for a, b in zip(first[:-1], first[1:]):
                total = np.zeros((b - a, 3))
                for y in itertools.product(range(3), repeat=int(b - a)):
                    if y:
                        w = np.exp(start[y[0]] + sum(scores[a + i, k] for i, k in enumerate(y)) + sum(move[i, j] for i, j in zip(y, y[1:])))
                        total[range(b - a), y] += w
                assert np.allclose(total / total.sum(axis=1, keepdims=True), got[a:b])


def test_held_out_accuracy(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    got = op3_langid.query(spark, SF).join(d.select("doc_id", "lang"), "doc_id").collect()
    tested = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang == r.lang_pred for r in tested) >= 0.9 * len(tested) > 0


def test_code_switched_words():
    stretches = [("x", "kalo milo kalo silo " * 12)] * 20 + [("y", "trum grend strum brant " * 12)] * 20
    model = op3_langid.fit(stretches, chains=200)
    text = b"kalo milo silo kalo milo trum grend strum brant trum"
    w = op3_langid.words_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    p = op3_langid.posteriors(model.emissions(w), w.first, model.start, model.move)
    assert p.argmax(axis=1).tolist() == [0] * 5 + [1] * 5


def test_every_language_is_learned(spark):
    r, rows = random.Random(4), []
    for k in range(80):
        vocab = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)]
        rows += [(100 * k + i, " ".join(r.choice(vocab) for _ in range(30)), f"l{k:02d}") for i in range(8 if k < 70 else 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    trained = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    got = {x.doc_id: (x.lang_pred, len(x.shares)) for x in op3_langid.language_id(df).collect()}
    assert len(trained) == 80 and {n for _, n in got.values()} == {80}
    assert sum(got[i][0] == lang for i, _, lang in rows) >= 0.9 * len(rows) and {p for p, _ in got.values()} == trained


def test_repeated_ids_leave_the_sample_whole_and_bounded(spark):
    rows = [(i, f"word{'abcdefghijklmnopqrstuvwxyz'[i % 26]} number{'xyz'[i // 26]} {'again' if k else 'first'}", "en") for i in range(60) for k in range(50 if i < 30 else 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = [tuple(r.text.split()[:2]) for r in op3_langid.training_stretches(df, "doc_id", "text", "lang", rows=12).collect()]
    assert len(got) == len(set(got)) == 12


def test_language_edges(crowded, none, spark):
    got = {r.doc_id: r for r in op3_langid.language_id(crowded).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (0, 1, 2, 16)) and got[7].lang_pred in ("en", "de")
    assert op3_langid.language_id(none).count() == 0
    unlabelled = crowded.selectExpr("doc_id", "text", "cast(null as string) AS lang")
    assert {r.lang_pred for r in op3_langid.language_id(unlabelled).collect()} == {"und"}


# packing

def padding(n, size):
    return 0 if n & (n - 1) == 0 else size - n


def test_cuts_are_optimal():
    rng = np.random.default_rng(3)
    for size in (8, 16):
        for _ in range(60):
            place = np.concatenate(([0], np.cumsum(rng.integers(1, 6, rng.integers(1, 14)))))
            cost = rng.integers(0, 6, len(place))
            best = [0.0] + [np.inf] * (len(place) - 1)
            for j in range(1, len(place)):
                best[j] = cost[j] + min((best[i] + padding(int(place[j] - place[i]), size) for i in range(j) if place[j] - place[i] <= size), default=np.inf)
            cuts = op5_packing.choose_cuts(place, cost, size, np.ones(len(place), int))
            value = sum(padding(int(b - a), size) + cost[np.searchsorted(place, b)] for a, b in zip(cuts[:-1], cuts[1:]))
            assert cuts[0] == 0 and cuts[-1] == place[-1] and value == best[-1]


@pytest.mark.parametrize("size,chunk", [(4096, 1 << 20), (64, 1000)])
def test_pieces_hold_every_id_once(crowded, rows, monkeypatch, size, chunk):
    monkeypatch.setattr(op5_packing, "CHUNK", chunk)  # read by the tasks of a local session only where they run in a fork
    ids = library(op5_packing.TOKENIZER)
    got = op5_packing.pack(crowded, public_tokenizers.path(op5_packing.TOKENIZER), op5_packing.KIND, size=size).collect()
    sequences, total = {}, Counter()
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        total[r.doc_id] += r.length
        assert len(r.ids) == 4 * r.length > 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= size
    want = Counter()
    for r in rows:
        want[r[0]] += len(ids(r[1])) + 1
    assert total == want
    long = sorted((r for r in got if r.doc_id == 13), key=lambda r: r.start)
    assert np.frombuffer(b"".join(r.ids for r in long), "<u4").tolist() == [*ids(rows[13][1]), 2] and {r.doc_tokens for r in long} == {want[13]}


# token files

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70000), st.integers(0, 2**64 - 1)), max_size=300), st.integers(1, 40))
def test_simple8b_round_trip(values, times):
    v = np.array(values * times, np.uint64)
    w, o = op6_simple8b.encode(v)
    assert (op6_simple8b.decode(w, o.astype(np.int64), len(v)) == v).all() and len(o) == -(-len(v) // op6_simple8b.BLOCK)


def test_file_round_trip():
    ids = np.array([5, 70000, 5, 2, 4_000_000_000, 2], np.uint32)
    assert [x.tolist() if hasattr(x, "tolist") else x for x in op6_simple8b.read_file(op6_simple8b.file_bytes([None, -3], [4, 2], ids))] == [[None, -3], [4, 2], ids.tolist()]


def test_token_files(spark, crowded, rows, none):
    path, ids = public_tokenizers.path(op6_simple8b.TOKENIZER), library(op6_simple8b.TOKENIZER)
    manifest = op6_simple8b.write_token_files(crowded, scratch_path(spark, "test-ids"), path, op6_simple8b.KIND, file_ids=500)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in op6_simple8b.read_token_files(manifest).collect())
    assert manifest.count() > 3
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    names = [g[1] for g in got]
    assert names == sorted(names, key=lambda x: (x is not None, x or 0))
    raw = lambda t: np.array([*ids(t), 2], "<u4").tobytes()
    assert Counter(g[1:] for g in got) == Counter((r[0], len(raw(r[1])) // 4, zlib.crc32(raw(r[1]))) for r in rows)
    empty = op6_simple8b.write_token_files(none, scratch_path(spark, "test-ids-none"), path, op6_simple8b.KIND)
    assert op6_simple8b.read_token_files(empty).count() == 0


# pipeline

def test_pipeline_stages(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    df = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in op4_quality.quality_rules(df).where("kept").collect()}
    assert all(not quality(r[1])[-1] for r in docs if r[0] in kept)
    want = [r for r in docs if r[0] in kept]
    prints = [simhash(r[1]) for r in want]
    root, least = groups(prints), {}
    for r, g in zip(want, root):
        least[g] = min(least.get(g, r[0]), r[0])
    expected = [lambda rows: want, lambda rows: [r for r, g in zip(want, root) if r[0] == least[g]]]
    for (name, stage), make in zip(corpus_pipeline.STAGES[:2], expected):
        df = written(stage(spark, df, SF), name)
        docs = make(docs)
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"] and Counter(map(tuple, df.collect())) == Counter(docs)
    cut = []
    for r, (w, gone) in zip(docs, repeats([r[1] for r in docs])):
        text = " ".join(x for x, g in zip(w, gone) if not g) if any(gone) else r[1]
        cut.append((r[0], text, r[2], r[3], len(text)))
    df = written(corpus_pipeline.repeated_passages(spark, df, SF), "cut")
    assert Counter(map(tuple, df.collect())) == Counter(cut)
    clean = [r for r in cut if not contamination(r[1], items)[1]]
    df = written(corpus_pipeline.benchmark_passages(spark, df, SF), "clean")
    assert Counter(map(tuple, df.collect())) == Counter(clean) and len(clean) > 0
    ids, total = library(op5_packing.TOKENIZER), Counter()
    for r in corpus_pipeline.packing(spark, df, SF).collect():
        total[r.doc_id] += r.length
    assert total == Counter({r[0]: len(ids(r[1])) + 1 for r in clean})


def test_pipeline_stages_on_odd_tables(spark, docs, none):
    for table in (docs, none):
        df = table
        for name, stage in corpus_pipeline.STAGES:
            df = written(stage(spark, df, SF), name)
        df.count()
    assert df.count() == 0


def test_near_duplicates_leave_one_row_of_each_group(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abcdx"}
    rows = [(1, "a"), (1, "a"),  # a repeated row
            (3, "b"), (3, "c"), (2, "c"),  # 3 names its first group only
            (None, "d"), (None, "d"),  # a group of null ids
            (None, "a"), (4, "x"), (None, "b")]
    df = spark.createDataFrame([(i, texts[k], "en", "s", len(texts[k])) for i, k in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    want = Counter((i, texts[k]) for i, k in ((1, "a"), (3, "b"), (2, "c"), (None, "d"), (4, "x")))
    df = written(corpus_pipeline.near_duplicates(spark, df, SF), "one")
    assert Counter((r.doc_id, r.text) for r in df.collect()) == want
    assert Counter((r.doc_id, r.text) for r in corpus_pipeline.repeated_passages(spark, df, SF).collect()) == want
