import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from samples import EDGE, SCHEMA, edge, nothing, shared  # noqa: F401

from lineweft.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, k):
    counted = [(id, Counter(terms(text))) for id, text in docs]
    counted = [(id, c, sum(c.values())) for id, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for id, c, n in counted:
            m = 10 + (90 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in wanted
                if t in c
            )
            if score > 0:
                scored.append((-score, id is None, id or 0, id))
        for rank, (score, _, _, id) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, id, -score))
    return sorted(out, key=repr)


def corpus(seed, n):
    """Words of very different frequency, copies and documents of one word."""
    rng = random.Random(seed)
    draw = lambda: f"w{int(rng.paretovariate(0.6)) % 400}"
    docs = []
    for i in range(n):
        words = [draw() for _ in range(rng.randrange(1, 60))]
        docs.append((i, docs[-1][1] if docs and rng.random() < 0.1 else ", ".join(words).title()))
    items = [(i, " ".join(draw() for _ in range(rng.randrange(0, 25)))) for i in range(30)]
    return docs, items


@pytest.mark.parametrize("k,block_terms,segment", [(10, 500_000, 32 << 20), (3, 20, 20_000)])
def test_ranks_equal_brute_force(spark, k, block_terms, segment):
    docs, items = corpus(k, 3000)
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    index = search.build_index(table, segment_bytes=segment)
    got = sorted((tuple(r) for r in search.search(table, asked, k, index=index, block_terms=block_terms).collect()), key=repr)
    assert got == brute_force(docs, items, k)


def test_edge_rows_ties_and_repeated_items(spark, edge):
    items = [(1, "the SAME naïve 日本語 w5"), (1, "w7 twice"), (None, "text"), (None, "same"), (3, None), (4, "?!"), (5, "absent")]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((tuple(r) for r in search.search(edge, asked).collect()), key=repr)
    assert got == brute_force([(i, t) for i, t, _ in EDGE], items, 10)
    assert {r[0] for r in got} == {1, None}


def test_vocabulary_too_large_to_ship_and_text_ids(spark, edge):
    docs = [(f"d{i}", t) for i, t, _ in EDGE]
    items = [("a", "the same text w3"), ("b", "twice")]
    table = spark.createDataFrame(docs, "doc_id string, text string")
    asked = spark.createDataFrame(items, "item_id string, text string")
    index = search.build_index(table, wanted=asked.selectExpr("lower(text)"), max_wanted_bytes=0)
    got = sorted((tuple(r) for r in search.search(table, asked, index=index).collect()), key=repr)
    assert got == brute_force(docs, items, 10)


def test_nothing(spark, edge, nothing):
    asked = spark.createDataFrame([(1, "same")], "item_id bigint, text string")
    assert search.search(nothing, asked).count() == 0
    assert search.search(edge, asked.limit(0)).count() == 0
    assert search.search(spark.createDataFrame([(1, None, "x"), (2, "", "x")], SCHEMA), asked).count() == 0


def test_blocks_are_skipped():
    """Once an item has its best, only blocks that can reach them are scored."""
    n = 128 * 200
    texts = ["common filler"] * n
    texts[3] = texts[-1] = "common rare"
    segment = search.Segment(_segment(texts), n, 2 * n)
    scored = []
    segment.impacts = type("Watched", (), {})  # the lists below are all that is read
    for term, rows in (("common", range(n)), ("rare", (3, n - 1))):
        docs = np.array(rows)
        values = np.full(len(docs), 7)
        at, most = segment.skips(docs, values)
        segment.of_term = None
        scored.append((term, (docs, values, at, most)))
    lists = dict(scored)
    read = []
    segment.lists = {t: (0, len(v[0])) for t, v in lists.items()}

    class Values(np.ndarray):
        def __getitem__(self, key):
            read.append(key)
            return super().__getitem__(key)

    docs, values, at, most = lists["common"]
    lists["common"] = (docs, values.view(Values), at, most)
    segment.of_term = lists.__getitem__
    best = search.best_of(segment, [("common", 5), ("rare", 10_000)], [], 1)
    assert best == [(-7 * 10_005, False, 3)]
    assert 0 < sum(s.stop - s.start for s in read) <= 2 * 128


def _segment(texts):
    import pyarrow as pa

    found = search.inverted(pa.array(texts), None)
    return {
        "ids": list(range(len(texts))),
        "lengths": found["lengths"].astype("<i8").tobytes(),
        "terms": found["terms"],
        "dfs": found["dfs"].tolist(),
        "docs": found["docs"].astype("<i4").tobytes(),
        "tfs": found["tfs"].astype("<i4").tobytes(),
    }
