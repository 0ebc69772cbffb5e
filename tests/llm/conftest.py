import random

import pytest

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


def vocabulary(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(["ka", "lo", "mi", "the", "ße", "né", "x9", "Tor"]) for _ in range(r.randint(1, 4))) for _ in range(n)]


def make_rows():
    """Null, empty, blank, short, repeated, long, near-equal and passage-sharing texts; repeated rows; a null id."""
    r, vocab = random.Random(5), vocabulary(900, 3)
    prose = lambda n: " ".join(r.choice(vocab) + (".\n" if r.random() < 0.06 else "") for _ in range(n))
    passage, base = prose(60), prose(300)
    near = base.split(" ")
    near[150] = "changed"
    texts = [None, "", " \n\t ", "one", "two words", "Are. " * 120, "a b c d " * 40, base, base, " ".join(near), prose(80) + " " + passage + " " + prose(40),
             passage, prose(5) + " " + passage.upper(), prose(5000), "### *** | <x> " * 30, "line one is here\n" * 60, "…", "  é x " * 30,
             passage + " " + passage, *[prose(r.randint(20, 200)) for _ in range(20)]]
    rows = [(i, t, ["en", "de", None][i % 3], f"src{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[7], rows[0], rows[25], (None, base, "en", "s", 1), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, FIELDS).repartition(3)


@pytest.fixture(scope="session")
def crowded(docs):
    """The documents with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    own = ("n_words", "kept", "fp", "key", "_key", "places", "anchor", "hash", "row", "_at", "_text", "_id", "start", "spans", "component_id", "items", "path")
    return docs.withColumns({c: F.lit("x") for c in own})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], FIELDS)
