"""Quality rules, SimHash, repeated passages, decontamination and license scan against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from brute import LOW, alnum, contamination, groups, quality, repeats, simhash, words

from wortlab.llm import op4_quality, op7_decontam, op8_simhash, op9_license, op10_substring
from wortlab.llm.common import Words, blocks, sliding_argmin

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def bag(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_quality_counts(crowded, rows):
    assert bag(op4_quality.quality_rules(crowded), "doc_id", *COUNTS) == Counter((r[0], *quality(r[1])) for r in rows)


def test_quality_verdict_and_filter_agree(docs):
    kept = op4_quality.quality_rules(docs).where("kept")
    assert bag(kept, "doc_id") == bag(op4_quality.keep_good(docs), "doc_id") and kept.count() > 0
    assert op4_quality.keep_good(docs).columns == docs.columns


def test_quality_thresholds_are_a_parameter(docs):
    strict = op4_quality.quality_rules(docs, thresholds=(("many", "n_words", ">", 0),))
    assert strict.where("kept").count() == 0 and "fails_many" in strict.columns


def test_quality_plan_has_no_python(docs):
    plan = op4_quality.keep_good(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hash" not in plan


def test_simhash(crowded, rows):
    prints = [simhash(r[1]) for r in rows]
    root = groups(prints)
    least = {g: min((r[0] for r, o in zip(rows, root) if o == g and r[0] is not None), default=None) for g in set(root)}
    want = Counter((r[0], format(p, "016x"), least[g]) for r, p, g in zip(rows, prints, root))
    assert bag(op8_simhash.simhash_neardup(crowded), "doc_id", "fingerprint", "component_id") == want


@pytest.mark.parametrize("bound", [1, 4, 64])
def test_simhash_links_do_not_depend_on_the_posting_bound(spark, bound):
    r = random.Random(2)
    seeds = [r.getrandbits(64) for _ in range(6)]
    prints = sorted({s ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for s in seeds for _ in range(40)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r.node: r.root for r in op8_simhash.components(op8_simhash.links(nodes, max_posting=bound)).collect()}
    root = groups(prints)
    parts = {}
    for p, g in zip(signed, root):
        parts.setdefault(g, set()).add(p)
    want = {p: min(m) for m in parts.values() for p in m if len(m) > 1}
    assert found == want


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 101)]
    found = {r.node: r.root for r in op8_simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}


def test_keep_one(docs, rows):
    kept, root, least = op8_simhash.keep_one(docs), groups([simhash(r[1]) for r in rows]), {}
    for r, g in zip(rows, root):
        least[g] = min(least.get(g, float("inf")), float("inf") if r[0] is None else r[0])
    assert kept.columns == docs.columns
    assert bag(kept, "doc_id", "text") == Counter((r[0], r[1]) for r, g in zip(rows, root) if r[0] == least[g])


def test_substring_dedup(crowded, rows):
    want = Counter()
    for r, (w, gone) in zip(rows, repeats([r[1] for r in rows])):
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want[r[0], len(w), sum(gone), kept if any(gone) else r[1]] += 1
    assert bag(op10_substring.substring_dedup(crowded), "doc_id", "n_words", "n_removed", "text") == want


@pytest.mark.parametrize("most", [op10_substring.MAX_KEYS, 0])
def test_substring_dedup_of_a_row_repeated_ten_thousand_times(spark, most, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(op10_substring, "MAX_KEYS", most)
    passage, short = " ".join(f"w{i}" for i in range(40)), " ".join(f"s{i}" for i in range(34))
    texts = [(1, passage + " tail of one"), (2, "other " + passage), (3, short), (4, " ".join(f"u{i}" for i in range(50)))]
    df = spark.range(10_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(texts[0][1]).alias("text")).unionByName(
        spark.createDataFrame([*texts[1:], texts[2]], "doc_id long, text string")).repartition(6)
    got = op10_substring.substring_dedup(df).groupBy("doc_id", "n_words", "n_removed", "text").count().collect()
    assert {tuple(r) for r in got} == {(1, 43, 43, "", 10_000), (2, 41, 40, "other", 1), (3, 34, 0, short, 2), (4, 50, 0, texts[3][1], 1)}


def test_substring_dedup_of_short_windows(docs, rows):
    want = Counter((r[0], sum(g)) for r, (w, g) in zip(rows, repeats([r[1] for r in rows], 3)))
    assert bag(op10_substring.substring_dedup(docs, min_words=3), "doc_id", "n_removed") == want


def test_spans_name_the_removed_words(docs):
    for r in op10_substring.substring_dedup(docs).collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_suffix_automaton():
    r = random.Random(1)
    for _ in range(30):
        texts = [[r.choice("abc") for _ in range(r.randint(0, 25))] for _ in range(3)]
        query = [r.choice("abcd") for _ in range(20)]
        a = op10_substring.SuffixAutomaton()
        for t in texts:
            a.add(t)
        held = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        want = [max((n for n in range(i + 2) if n == 0 or tuple(query[i + 1 - n:i + 1]) in held)) for i in range(len(query))]
        assert a.matching(query) == want


def test_reference_passages_and_bound(spark, docs, rows):
    reference = spark.createDataFrame([(rows[11][1],), (None,)], "text string")
    got = {r.doc_id: r.n_removed for r in op10_substring.remove_reference_passages(docs, reference).collect()}
    assert got[11] == len(words(rows[11][1])) and got[18] == 2 * got[11] and got[10] == got[11] and got[13] == 0
    with pytest.raises(ValueError):
        op10_substring.remove_reference_passages(docs, reference, max_reference_bytes=10)


ITEMS = [(0, None), (1, ""), (2, "ka"), (3, "zz yy"), (None, "lo mi"), (4, "x9")]


def test_decontamination(spark, crowded, rows):
    shout = rows[11][1].translate({v: k for k, v in LOW.items()})  # ASCII letters only
    items = [*ITEMS, (5, shout), (5, "tor tor"), (10, rows[30][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = op7_decontam.verbatim_matches(crowded, bench).collect()
    got = Counter((r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(map(str, r["items"])).encode()).hexdigest(), r.contaminated) for r in found)
    want = Counter()
    for r in rows:
        n, hit, k, sha = contamination(r[1], items)
        want[r[0], n, hit, k, sha, hit > 0] += 1
    assert got == want
    whole = next(r for r in found if r.doc_id == 11)
    assert max(m.length for m in whole.matches) == len(alnum(rows[11][1]))  # the passage is one longest match


def test_empty_benchmark_and_bound(spark, docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert op7_decontam.drop_contaminated(docs, empty).count() == docs.count()
    with pytest.raises(ValueError):
        op7_decontam.verbatim_matches(docs, spark.createDataFrame([(1, "x" * 50)], "item_id long, text string"), max_benchmark_bytes=10)


def test_license_notices(spark):
    mit = op9_license.TEMPLATES[2][1]
    broken = mit.replace("without restriction", "with some restriction").replace("merge, ", "")
    noise = " ".join(f"word{i}" for i in range(40))
    texts = [None, "", noise, f"{noise}. Released under the MIT License. {noise}", f"{noise} {broken} {noise}", "Licensed under the Apache License, Version 2.0.",
             "Licensed under the Apache License.", f"Released under the MIT License. {noise} released UNDER the mit license", "license " * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS spans", "2 AS license")
    got = {(r.doc_id, r.license): r for r in op9_license.license_scan(docs).collect()}
    assert set(got) == {(3, "MIT"), (4, "MIT"), (5, "Apache-2.0"), (7, "MIT")}
    assert got[3, "MIT"].spans[0].start == 40 and got[3, "MIT"].spans[0].end == 45 and len(got[7, "MIT"].spans) == 2
    assert 0.9 <= got[4, "MIT"].coverage < 1 and got[4, "MIT"].spans[0].start == 40


def licenses(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {i: set() for i in range(len(texts))}
    for r in op9_license.license_scan(docs).collect():
        found[r.doc_id].add(r.license)
    return [found[i] for i in range(len(texts))]


def test_every_template_is_its_own_license_only(spark):
    noise = " ".join(f"word{i}" for i in range(20))
    got = licenses(spark, [f"{noise} {text} {noise}" for _, text in op9_license.TEMPLATES])
    assert [(n, t, g) for (n, t), g in zip(op9_license.TEMPLATES, got) if g != {n}] == []


def test_sibling_licenses(spark):
    cc = "This work is licensed under a Creative Commons Attribution{} License."
    gnu = op9_license._gnu
    want = [(cc.format("-NonCommercial 4.0 International"), {"CC-BY-NC-4.0"}), (cc.format("-NoDerivatives 4.0 International"), {"CC-BY-ND-4.0"}),
            (cc.format("-NonCommercial-ShareAlike 4.0 International"), {"CC-BY-NC-SA-4.0"}), (cc.format(" 4.0 International"), {"CC-BY-4.0"}),
            (cc.format(" 3.0 Unported"), {"CC-BY-3.0"}), (cc.format("-NonCommercial 7.0 International"), set()), (cc.format(" 7.0 International"), set()),
            ("Licensed under CC BY 4.0.", {"CC-BY-4.0"}), ("Licensed under CC BY-NC 4.0.", {"CC-BY-NC-4.0"}), ("Licensed under CC BY-NC-ND 4.0.", {"CC-BY-NC-ND-4.0"}),
            ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}),
            ("This work is licensed under the GNU General Public License, version 3.", {"GPL-3.0"}),
            ("This work is licensed under the GNU General Public License, version 9.", set()),
            ("This work is licensed under the GNU Affero General Public License, version 3.", {"AGPL-3.0"}),
            ("This work is licensed under the GNU Lesser General Public License, version 2.1.", {"LGPL-2.1"}),
            ("This work is licensed under the GNU Library General Public License, version 2.", {"LGPL-2.0"}),
            (gnu("Affero General", "3", " of the License"), {"AGPL-3.0"}), (gnu("Lesser General", "3", " of the License"), {"LGPL-3.0"}),
            (gnu("Affero General", "7", " of the License"), set()), (gnu("Lesser General", "2.1", " of the License").replace("program", "library"), {"LGPL-2.1"}),
            (op9_license._BSD + " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS", {"BSD-2-Clause"}),
            (f"{op9_license._BSD} {op9_license._ENDORSE.replace('the copyright holder', 'Example Works')}", {"BSD-3-Clause"}),
            (op9_license._BSD.split(" Redistributions in binary")[0], set()), (op9_license._ISC + " provided", {"0BSD"}),
            ("Released under the Example MIT Style License.", set()), ("Licensed under the ISC License.", {"ISC"})]
    assert [(t, w, g) for (t, w), g in zip(want, licenses(spark, [t for t, _ in want])) if g != w] == []


def test_license_notices_on_consecutive_lines(spark):
    notices = ["Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0.", op9_license._gnu("General", "3", " of the License")]
    docs = spark.createDataFrame([(i, "\n".join([t] * 50)) for i, t in enumerate(notices)] + [(9, "\n".join(notices[:2] * 3))], "doc_id long, text string")
    got = {(r.doc_id, r.license): [(s.start, s.end) for s in r.spans] for r in op9_license.license_scan(docs).collect()}
    size = [len(alnum(t)) for t in notices]
    want = {(i, n): [(k * size[i], (k + 1) * size[i]) for k in range(50)] for i, n in enumerate(("MIT", "CC-BY-NC-4.0", "Apache-2.0", "GPL-3.0"))}
    both = size[0] + size[1]
    want |= {(9, "MIT"): [(k * both, k * both + size[0]) for k in range(3)], (9, "CC-BY-NC-4.0"): [(k * both + size[0], (k + 1) * both) for k in range(3)]}
    assert got == want


def test_alignment_does_not_reach_for_far_words():
    text = "released x y z released under the mit license".split()
    assert op9_license.align("released under the mit license".split(), text, 2, 8) == (5, 4, 9)
    assert op9_license.align("a b c d e f".split(), "a b c d e x x x x f".split(), 0, 8, 0.9) == (5, 0, 5)


def test_banded_alignment_is_the_longest_common_subsequence():
    r = random.Random(4)
    for _ in range(100):
        a, b = ([r.choice("abcde") for _ in range(r.randint(1, 9))] for _ in range(2))
        lcs = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                lcs[i + 1][j + 1] = lcs[i][j] + 1 if x == y else max(lcs[i][j + 1], lcs[i + 1][j])
        assert op9_license.align(a, b, 0, 12)[0] == lcs[-1][-1]


def test_words_and_least_places():
    import pyarrow as pa

    texts = ["", " a  b\n", None, "é x y", "z" * 200]
    (rows, data, off), = blocks([pa.record_batch({"text": texts})], "text")
    w = Words(data, off)
    assert [data[a:b].tobytes().decode() for a, b in zip(w.start, w.end)] == [x for t in texts for x in words(t)]
    x = np.array([3, 1, 1, 2, 0, 5, 0], np.uint64)
    for k in range(1, 8):
        assert sliding_argmin(x, k).tolist() == [i + int(x[i:i + k].argmin()) for i in range(len(x) - k + 1)]


def test_empty_tables(spark, none):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for df in (op4_quality.quality_rules(none), op8_simhash.simhash_neardup(none), op10_substring.substring_dedup(none),
               op7_decontam.verbatim_matches(none, bench), op9_license.license_scan(none)):
        assert df.count() == 0
