import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in "ba de ki lo mu na pe ri so tu ve zo".split() for b in "ran tel mis dor kan vel".split()]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + ". "


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents with copies, near copies, empty, null and very long texts, repeated and missing ids, and a column that clashes with an output."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        t = "".join(sentence(rng, rng.randint(5, 14)) for _ in range(rng.randint(3, 12)))
        rows.append((i, t, rng.choice(["aa", "bb"]), rng.choice(["s1", "s1", "s2", None])))
    base = rows[7][1].split()
    for k in range(8):  # near copies of document 7, chained
        w = list(base)
        for _ in range(1 + k % 3):
            w[rng.randrange(len(w))] = "changed"
        rows.append((100 + k, " ".join(w), "aa", "s1"))
    rows += [(120, rows[3][1], "aa", "s2"), (121, rows[3][1].upper(), "aa", "s2"), (122, "", "aa", "s1"), (123, None, None, None), (124, "one two", "bb", "s3"), (125, "one two", "bb", "s3")]
    rows += [(126, "   \n\t ", "bb", "s3"), (127, "".join(sentence(rng, 10) for _ in range(3000)), "aa", "s1"), (5, rows[5][1], "aa", "s1"), (5, "a second text under an old id with some words", "aa", "s1"), (None, "a text without any id at all but with words", "bb", "s2"), (128, "#" * 200 + " 12 !!", None, "s1")]
    return [(i, t, lang, src, len(t or "")) for i, t, lang, src in rows]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
