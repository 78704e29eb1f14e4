import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import shared  # noqa: F401

from lineweft.llm import negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int, score string"
LARGEST = 2**63 - 1


def brute_force(rows, anchor_every=100, positives=5, most=10):
    def integer(x):
        return int(x) * 256 if abs(x) >= 2**53 else math.floor(256 * x)

    used = [
        (n, id, [integer(x) for x in v], label)
        for n, (id, v, label, *_) in enumerate(rows)
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, anchor, a, own in used:
        if anchor is None or anchor % anchor_every:
            continue
        scored = []
        for m, id, c, label in used:
            score = min(max(sum(x * y for x, y in zip(a, c)), -LARGEST - 1), LARGEST)
            scored.append((-score, id is None, id or 0, m, id, label))
        scored.sort()
        for p in [s for s in scored if s[5] == own and s[3] != n][:positives]:
            fit = [s for s in scored if s[5] != own and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]]
            out += [(anchor, p[4], rank, s[4], -p[0], -s[0]) for rank, s in enumerate(fit[:most], 1)]
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((tuple(r) for r in negatives.mine(table, **options).collect()), key=repr)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 70), st.integers(0, 70), st.integers(1, 70), st.integers(1, 20), st.integers(0, 99))
def test_strassen_equals_plain_products(m, k, n, small, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(2**40), 2**40, (m, k)), rng.integers(-(2**18), 2**18, (k, n))
    assert (negatives.product(a, b, small) == a @ b).all()
    assert (negatives.product(a.astype(object), b.astype(object), small) == a.astype(object) @ b.astype(object)).all()


def vectors(seed, n, width, labels):
    """Few directions with noise, many copies, and ids that repeat."""
    rng = random.Random(seed)
    base = [[rng.gauss(0, 0.3) for _ in range(width)] for _ in range(12)]
    rows = []
    for i in range(n):
        v = [x + rng.gauss(0, 0.05) for x in rng.choice(base)] if rng.random() < 0.7 else list(base[0])
        rows.append((i if rng.random() < 0.97 else 200, v, rng.randrange(labels) if rng.random() < 0.6 else 0, "x"))
    return rows


@pytest.mark.parametrize("width,labels,block", [(64, 10, 16 << 20), (7, 3, 700), (33, 300, 16 << 20)])
def test_mining_equals_brute_force(spark, width, labels, block):
    rows = vectors(width, 900, width, labels)
    got = mined(spark, rows, anchor_every=50, block_bytes=block)
    assert got == brute_force(rows, anchor_every=50) and got


def test_rows_that_take_no_part_ties_and_odd_vectors(spark):
    one = [1.0, 0.5]
    rows = [
        (0, one, 1, "a"), (0, one, 1, "a"), (100, [], 1, "b"), (200, [1.0], 2, "b"), (None, one, 1, "c"), (None, [0.5], 2, "c"),
        (3, None, 1, "d"), (4, [1.0, None], 1, "d"), (5, [float("nan"), 1.0], 2, "d"), (6, [float("inf")], 1, "d"),
        (7, one, None, "e"), (8, [0.5, 0.5], 2, "e"), (9, [0.5, 0.5], 2, None), (9, [0.5, 0.5], 2, None), (10, [0.5, 0.5, 9.0], 3, None),
        (300, [-1.0, -1.0], 4, ""), (301, [1.0, 1.0], 4, ""), (302, [0.25], 5, ""),
    ]
    assert mined(spark, rows) == brute_force(rows)


def test_scores_beyond_64_bits(spark):
    rows = [(0, [1e300, 1.0], 1, ""), (1, [1e299, 2.0], 1, ""), (2, [1e-290, 0.0], 2, ""), (3, [2.0**60, 1.0], 1, ""), (4, [0.5, 0.5], 2, "")]
    rows += [(100, [2.0**20, 3.0], 1, ""), (101, [2.0**20 * 0.5, 1.0], 2, "")]
    assert mined(spark, rows) == brute_force(rows)


def test_nothing_and_no_anchor(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1, "")]) == []
    assert mined(spark, [(100, [1.0], 1, ""), (1, [1.0], 2, "")]) == []


def test_heaps_merge_alike_in_any_order():
    rng = np.random.default_rng(5)
    score, id, of = rng.integers(0, 5, 300), rng.integers(0, 40, 300), rng.integers(0, 4, 300)
    row, none = np.arange(300), rng.random(300) < 0.1
    found = []
    for order in (row, row[::-1], rng.permutation(300)):
        heaps = negatives.Heaps(4, 6)
        for part in np.split(order, [10, 150]):
            heaps.offer(of[part], score[part], id[part], none[part], row[part])
        found.append(heaps.entries()["row"].tolist())
        assert heaps.least.tolist() == [sorted(score[of == q])[-6] for q in range(4)]
    assert found[0] == found[1] == found[2]


def test_all_columns_but_three_are_ignored(spark):
    rows = vectors(1, 200, 8, 3)
    table = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("x")).withColumn("values", F.lit(1))
    assert sorted((tuple(r) for r in negatives.mine(table).collect()), key=repr) == brute_force(rows)
