"""Log odds, compound splitting, collocations and name matching on small inputs."""

import functools
import math
import random

import pytest
from pyspark.sql import functions as F

from wortlab.operators import lexicon as LX

VOCAB = {"haus": 40, "tür": 20, "haustür": 2, "business": 9, "plan": 12, "arbeit": 30, "platz": 18, "start": 8, "auto": 9, "bahn": 7, "autobahn": 6, "ess": 3, "zimmer": 5, "arb": 1}


def best_split(piece, logp, min_part=3, link=-4.0):
    @functools.cache
    def best(b):
        if b == 0:
            return 0.0, ()
        ways = []
        for a in range(b):
            for part, cost in ((piece[a:b], 0.0), *([(piece[a:b - 1], link)] if piece[b - 1] == "s" and b < len(piece) else [])):
                if len(part) >= min_part and part in logp and best(a) is not None:
                    ways.append((best(a)[0] + (logp[part] + cost), (*best(a)[1], part)))
        return max(ways, default=None)
    return best(len(piece))


def test_compounds_are_split_as_by_brute_force(spark):
    total, r = sum(VOCAB.values()), random.Random(4)
    logp = {w: math.log(n / total) for w, n in VOCAB.items()}
    made = ["".join(r.choice([*VOCAB, "s", "x"]) for _ in range(r.randint(1, 4))) for _ in range(300)]
    words = sorted({*VOCAB, *made, "businessplan", "arbeitsplatz", "haus-tür", "start-up", "a-b", "ess", "hausx", "ä"})
    vocab = spark.createDataFrame(list(logp.items()), "word string, logp double")
    got = {x.word: (tuple(x.parts), x.score) for x in LX.split_compounds(spark.createDataFrame([(w,) for w in words + words[:5]] + [(None,), ("",)], "word string").repartition(4), vocab).collect()}
    want = {}
    for w in words:
        own = [(best_split(p, logp), p) for p in w.split("-") if p]
        parts = tuple(x for s, p in own for x in (s[1] if s else (p,)))
        want[w] = parts, pytest.approx(sum(s[0] for s, _ in own)) if all(s for s, _ in own) else None
    assert got == want
    assert got["businessplan"][0] == ("business", "plan") and got["arbeitsplatz"][0] == ("arbeit", "platz") and got["autobahn"][0] == ("autobahn",)
    assert got["start-up"][0] == ("start", "up")


def test_hyphenated_words(spark):
    df = spark.createDataFrame([("Das Start-up, im E-Mail-Verkehr - und x-1 a- -b",), (None,)], "text string")
    assert [r[0] for r in df.select(LX.hyphen_parts("text")).collect()] == [["start-up", "e-mail-verkehr"], []]


def test_log_odds_tell_shared_words_from_borrowed_ones(spark):
    rows = [("en", "team")] * 60 + [("de", "team")] * 2 + [("en", "hand")] * 30 + [("de", "hand")] * 30 + [("de", "haus")] * 60 + [("en", "deal")] + [("fr", "team")] * 9
    got = {r.word: r for r in LX.log_odds(spark.createDataFrame(rows, "lang string, word string"), "lang", "en", "de", prior=50.0).collect()}
    assert got["team"].z > LX.ENGLISH_Z and abs(got["hand"].z) < 1 and got["haus"].z < -LX.ENGLISH_Z and 0 < got["deal"].z < LX.ENGLISH_Z
    assert (got["team"].n_source, got["team"].n_target) == (60, 2)
    one = spark.createDataFrame(rows[:5], "lang string, word string")
    assert LX.log_odds(one, "lang", "en", "de").count() == 0 and LX.log_odds(one.limit(0), "lang", "en", "de").count() == 0


def collocations_brute(texts, lexicon, window, least, k):
    n = {}
    for w in texts:
        for i, x in enumerate(w):
            for j in range(max(i - window, 0), min(i + window, len(w) - 1) + 1):
                if j != i and x in lexicon:
                    n[x, w[j]] = n.get((x, w[j]), 0) + 1
    t, out = sum(n.values()), []
    rows, cols = {}, {}
    for (x, y), c in n.items():
        rows[x], cols[y] = rows.get(x, 0) + c, cols.get(y, 0) + c
    f = lambda v: v * math.log(v) if v > 0 else 0.0
    for x in rows:
        own = []
        for y in cols:
            a, r, c = n.get((x, y), 0), rows[x], cols[y]
            if a >= least and a * t > r * c:
                own.append((-round(2 * (f(a) + f(r - a) + f(c - a) + f(t - r - c + a) - f(r) - f(t - r) - f(c) - f(t - c) + f(t)), 4), y, a))
        out += [(x, y, a, -g) for g, y, a in sorted(own)[:k]]
    return sorted(out)


@pytest.mark.parametrize("window", [1, 3])
def test_collocations(spark, window):
    r = random.Random(window)
    texts = [[r.choice("team deal plan haus markt und die".split()) for _ in range(r.randint(0, 30))] for _ in range(60)] + [["team", "deal"] * 9, []]
    lexicon = {"team", "deal"}
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "words array<string>").repartition(3)
    got = LX.collocations(df, F.col("words"), spark.createDataFrame([(w,) for w in lexicon], "word string"), window, k=4).collect()
    assert sorted((x.word, x.other, x.n, pytest.approx(x.llr, abs=1e-3)) for x in got) == collocations_brute(texts, lexicon, window, 2, 4)


def test_names_of_several_words_the_longest_wins(spark):
    texts = ["Die Vereinigten Staaten von Amerika und Deutschlands Nachbar", "USA USA usa's", "Südkorea, Saudi-Arabien!", "Volksrepublik China", "nichts", None, "", "Chinatown"]
    df = spark.createDataFrame(list(enumerate(texts)), "article_id long, text string").withColumn("name", F.lit("x"))
    got = {r.article_id: (r.entities, r.mentions) for r in LX.name_mentions(df, LX.name_table(spark), LX.longest_name()).collect()}
    assert got == {0: (["Germany", "USA"], 2), 1: (["USA"], 3), 2: (["Saudi Arabia", "South Korea"], 2), 3: (["China"], 1)}
    assert LX.name_mentions(df.limit(0), LX.name_table(spark), LX.longest_name()).count() == 0
    with pytest.raises(ValueError):
        LX.name_table(spark, {"x": tuple(f"n{i}" for i in range(LX.MAX_NAMES + 1))})
