"""Ranked summaries against a plain version of the same ranking."""

import random
import re

from wortlab.operators import summary as SU
from wortlab.operators.enrich import SENTENCE_RE, WORD_RE

WORDS = ["haus", "markt", "meeting", "straße", "regen", "der", "und", "firma", "über", "team", "wolke", "zahl"]


def best(items, k):
    if len(items) <= k:
        return items
    words = [set(w for w in re.findall(WORD_RE, s.lower()) if len(w) >= SU.MIN_LETTERS) for _, s in items]
    n = len(items)
    weight = [[0.0 if i == j else float(len(words[i] & words[j])) for j in range(n)] for i in range(n)]
    total = [sum(row) for row in weight]
    ranks = [1.0] * n
    for _ in range(SU.ROUNDS):
        ranks = [(1 - SU.DAMPING) + SU.DAMPING * sum((weight[i][j] / total[j] if total[j] else 0.0) * ranks[j] for j in range(n)) for i in range(n)]
    order = sorted(range(n), key=lambda i: (-round(ranks[i], SU.PLACES), items[i][0]))
    return sorted(items[i] for i in order[:k])


def brute(text, k, part):
    items = list(enumerate(s for s in (x.strip() for x in re.findall(SENTENCE_RE, text or "")) if s))
    while len(items) > part:
        items = [x for i in range(0, len(items), part) for x in best(items[i:i + part], k)]
    return " ".join(s for _, s in best(items, k))


def text_of(rng, n):
    return " ".join(" ".join(rng.choices(WORDS, k=rng.randint(1, 9))) + rng.choice(".!?") for _ in range(n))


def test_ranked_summary_is_the_plain_ranking(spark):
    rng = random.Random(5)
    texts = [None, "", " \n ", "Ein Satz.", "...", "gleich haus. " * 9] + [text_of(rng, n) for n in (2, 3, 4, 8, 9, 20, 57, 130)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for k, part in ((1, 4), (3, 8), (3, 40)):
        got = {r.id: r.summary for r in SU.ranked_summary(df, k=k, part=part).collect()}
        assert got == {i: brute(t, k, part) for i, t in enumerate(texts)}, (k, part)
    assert SU.ranked_summary(df.limit(0)).collect() == []


def test_the_sentence_that_others_share_words_with_comes_first(spark):
    text = "Wetter bleibt trocken. Firma kauft Markt. Markt und Firma planen Meeting. Meeting im Team. Ganz anderes Thema."
    df = spark.createDataFrame([(1, text)], "id long, text string")
    assert SU.ranked_summary(df, k=1).first().summary == "Markt und Firma planen Meeting."
