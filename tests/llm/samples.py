"""Small tables for the operators' tests."""

import random

import pytest

#: Null, empty, very long, tied and repeated texts; columns whose names clash with those of results.
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
EDGE = [
    (1, None, "x"),
    (2, "", "x"),
    (3, "The same text, twice.", "a"),
    (4, "The same text, twice.", "b"),
    (4, "The same text, twice.", "b"),
    (None, "The same text, twice.", "c"),
    (None, "Text of no id.", None),
    (7, LONG, "y"),
    (8, " \t\n", None),
    (9, "naïve — 日本語 \U0001f600 'tis I'll 12345", "z"),
]
SCHEMA = "doc_id bigint, text string, score string"


def texts_of(seed, n):
    """Texts with exact copies, near copies, shared passages and a large family."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("xyz") + str(rng.randrange(60))
    base = [[word() for _ in range(rng.randrange(1, 120))] for _ in range(n)]
    passage, original = [word() for _ in range(35)], [word() for _ in range(150)]
    out = []
    for words in base:
        kind = rng.random()
        if kind < 0.2 and out:
            words = list(rng.choice(out))
        elif kind < 0.4:
            words = list(original)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = word()
        elif kind < 0.6:
            at = rng.randrange(len(words))
            words = words[:at] + passage + words[at:]
        out.append(words)
    return [" ".join(w) for w in out]


@pytest.fixture(scope="session", autouse=True)
def shared(tmp_path_factory, spark):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
