import collections
import re
import time

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from samples import EDGE, edge, nothing, shared, texts_of  # noqa: F401

from lineweft import session
from lineweft.llm import exact, jaccard, substrings
from lineweft.llm.tables import bit_map

BLANKS = r"[^\x20\x09-\x0D]+"


def test_marks_edge_cases(edge, nothing):
    rows = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.mark_copies(edge).collect()), key=repr)
    assert rows == sorted(
        [
            (1, 2, 2, False), (2, 2, 2, True), (3, 4, 4, False), (4, 4, 4, True), (4, 4, 4, True),
            (None, 4, 4, False), (None, None, 1, True), (7, 7, 1, True), (8, 8, 1, True), (9, 9, 1, True),
        ],
        key=repr,
    )
    assert exact.mark_copies(nothing).count() == 0


def test_keeps_one_row_per_text(edge, nothing):
    kept = exact.keep_one(edge)
    assert kept.columns == edge.columns
    assert {(r.doc_id, r.text) for r in kept.collect()} == {
        (2, ""), (4, EDGE[3][1]), (None, "Text of no id."), (7, EDGE[7][1]), (8, EDGE[8][1]), (9, EDGE[9][1])
    }
    assert exact.keep_one(nothing).count() == 0


def test_a_null_text_stays_null(spark):
    docs = spark.createDataFrame([(5, None), (4, "")], "doc_id bigint, text string")
    assert [tuple(r) for r in exact.keep_one(docs).collect()] == [(5, None)]


def test_colliding_digests_stop_the_job(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "doc_id bigint, text string")
    with pytest.raises(PySparkException, match="share the digest"):
        exact.mark_copies(docs, digest=lambda c: F.lit(b"0")).collect()


def windows_removed(rows, window):
    seen, out = set(), {}
    for i, text in rows:
        words = re.findall(BLANKS, text or "")
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            if key in seen:
                gone[at : at + window] = [True] * window
            seen.add(key)
        out[i] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g))
    return out


def test_substrings_equal_brute_force(spark):
    rows = list(enumerate(texts_of(1, 150)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.drop_repeated(docs, window=20).collect()}
    assert got == windows_removed(rows, 20)


def test_substrings_with_a_full_sketch_are_the_same(spark, monkeypatch):
    rows = list(enumerate(texts_of(2, 60)))
    monkeypatch.setattr(substrings, "_repeated", lambda sketch, runs: runs == runs)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.drop_repeated(docs, window=7).collect()}
    assert got == windows_removed(rows, 7)


def test_substring_edge_cases(edge, nothing):
    got = substrings.drop_repeated(edge, window=3)
    assert got.count() == len(EDGE)
    by_id = collections.defaultdict(list)
    for r in got.collect():
        by_id[r.doc_id].append((r.n_words, r.n_removed))
    assert by_id[1] == by_id[2] == [(0, 0)] and by_id[3] == [(4, 0)] and by_id[4] == [(4, 4)] * 2
    assert sorted(by_id[None]) == [(4, 0), (4, 4)]
    assert substrings.drop_repeated(nothing).count() == 0


def brute_components(rows, n, percent):
    sets = {}
    for i, text in rows:
        words = re.findall(BLANKS, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        size = min(n, len(words))
        sets[i] = {tuple(words[a : a + size]) for a in range(len(words) - size + 1)} if words else set()
    label = {i: i for i in sets}
    changed = True
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (len(s), label[i]) for i, s in sets.items()}


@pytest.mark.parametrize(("seed", "percent", "k2", "n2"), [(3, 90, 1, 3), (4, 80, 2, 4), (5, 90, 0, 1)])
def test_similar_documents_equal_brute_force(spark, seed, percent, k2, n2):
    rows = list(enumerate(texts_of(seed, 160)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = jaccard.similar_documents(docs, percent=percent, k2=k2, n2=n2, capacity=2000)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute_components(rows, 3, percent)


def test_similar_document_edge_cases(edge, nothing):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_documents(edge).collect()), key=repr)
    assert len(got) == len(EDGE)
    assert (1, 0, 1) in got and (2, 0, 2) in got and (4, 2, 3) in got and (None, 2, 3) in got and (None, 2, None) in got
    assert jaccard.similar_documents(nothing).count() == 0


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().toString()
    return files.count("shuffle_")


def test_cut_lineage_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = session.cut_lineage(spark.range(100_000).selectExpr("id % 1009 AS k").groupBy("k").count())
    deadline = time.time() + 20
    while shuffle_files(spark) > before and time.time() < deadline:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert rows.count() == 1009


def test_signatures_are_dropped_when_blocks_are_known(spark, edge):
    begun = session.written_tables()
    found = jaccard.similar_documents(edge)
    assert all("signatures" not in spark.read.parquet(path).columns for path in session._written[begun:])
    assert found.count() == edge.count()


@pytest.mark.parametrize("percent", [60, 80])
def test_rarest_features_equal_brute_force(spark, percent):
    rows = list(enumerate(texts_of(8, 160)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert jaccard.signature_features(percent, 1, 2) < jaccard._LEAST_FEATURES
    found = jaccard.similar_documents(docs, percent=percent, capacity=2000)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute_components(rows, 3, percent)


def test_texts_without_common_words_are_no_candidates(spark, monkeypatch):
    """Signatures of no feature at all once made one family of nearly all texts."""
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(60 + i % 7))) for i in range(300)]
    rows += [(1000 + i, f"{text} end") for i, text in rows[:10]]
    sent, verified = [], jaccard.verified_links
    monkeypatch.setattr(jaccard, "verified_links", lambda blocks, *others: sent.append(blocks.count()) or verified(blocks, *others))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = jaccard.similar_documents(docs, shingle_words=5, percent=80)
    assert sent == [20]
    linked = {r.doc_id: r.component_id for r in found.collect() if r.doc_id != r.component_id}
    assert linked == {1000 + i: i for i in range(10)}


def test_bit_maps_equal_their_bits(spark):
    values = [0, 1, 7, 8, (1 << 17) - 1, 1 << 17, (1 << 20) + 5, -1, -1]
    for bits in (64, 1 << 17, 1 << 19):
        got = np.unpackbits(np.frombuffer(bit_map(spark.createDataFrame([(v,) for v in values], "v bigint"), "v", bits), np.uint8), bitorder="little")
        assert np.flatnonzero(got).tolist() == sorted({v & (bits - 1) for v in values})
