import hashlib

import corpus_pipeline
from pyspark.sql import functions as F
from samples import shared, texts_of  # noqa: F401
from test_duplicates import brute_components
from test_tokens import TIKTOKEN

from lineweft.llm import quality


def near_copies(n=12):
    """Pairs whose five-word shingles have a similarity from 0.8 to 0.9: a word in the midst of the second text differs."""
    out = []
    for at in range(n):
        words = [f"p{at}w{i}" for i in range(54 + 4 * at)]
        changed = list(words)
        changed[len(words) // 2] = "other"
        out += [" ".join(words), " ".join(changed)]
    return out


def similarity(one, two, n=5):
    one, two = ({tuple(w[a : a + n]) for a in range(len(w) - n + 1)} for w in (one.split(), two.split()))
    return len(one & two) / len(one | two)


def test_near_copies_from_four_fifths_on_go(spark):
    texts = near_copies()
    assert all(0.8 <= similarity(*texts[at : at + 2]) < 0.9 for at in range(0, len(texts), 2))
    rows = list(enumerate(texts + texts_of(11, 120)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    left = {r.doc_id for r in corpus_pipeline.one_per_component(spark, docs, "").collect()}
    assert left == {i for i, (_, least) in brute_components(rows, 5, 80).items() if i == least}
    assert left & set(range(len(texts))) == set(range(0, len(texts), 2))


def test_rows_go_for_their_own_text_only(spark, tmp_path):
    one, two = near_copies(1)
    dirty = "benchmark " + " ".join(f"b{i}" for i in range(20))
    clean = [" ".join(f"{name}{i}" for i in range(30)) for name in "xyz"]
    spark.createDataFrame([("i", dirty)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = [(1, one), (2, clean[0]), (3, clean[1]), (None, clean[2]), (4, "")]
    near, hit = [(2, two), (None, two + " end")], [(3, dirty), (None, dirty + " end")]
    docs = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    left = corpus_pipeline.one_per_component(spark, docs(kept + near), "").collect()
    assert sorted(map(tuple, left), key=repr) == sorted(kept, key=repr)
    left = corpus_pipeline.uncontaminated(spark, docs(kept + hit), str(tmp_path)).collect()
    assert sorted(map(tuple, left), key=repr) == sorted(kept, key=repr)


def test_the_whole_equals_its_stages_by_hand(spark, tmp_path):
    """Rows with null, repeated and unique ids through all stages, each done by brute force on what the one before keeps."""
    good, bad = "good clear words about things", "junk junk spam spam click here"
    rows = [(i, f"{good if i % 3 else bad} number {i} {'one two three four five six seven ' * (i % 4)}", i) for i in range(60)]
    labels = [(i, int(i % 3 > 0)) for i in range(60)]
    one, two = near_copies(1)
    dirty = "benchmark " + " ".join(f"b{i}" for i in range(20))
    rows += [(100, one, 1), (101, two, 2), (102, one, 3), (None, one, 4), (103, dirty, 5), (104, f"{good} {dirty} {good}", 6)]
    rows += [(105, None, 7), (106, "", 8), (None, good, 9), (107, good, 10), (107, good, 11), (7, f"{good} other text of seven", 12)]
    kinds = {"documents": (rows, "doc_id bigint, text string, more int"), "labels": (labels, "doc_id bigint, quality int"),
             "benchmark": ([("i", dirty)], "item_id string, text string")}
    for name, (values, kind) in kinds.items():
        spark.createDataFrame(values, kind).repartition(2).write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))

    scored = quality.quality_scorer(docs, spark.read.parquet(str(tmp_path / "labels.parquet")))
    by_text = {(r.text or ""): r.s for r in docs.select("text", scored(F.col("text")).alias("s")).collect()}
    assert {s >= 0.3 for s in by_text.values()} == {True, False}
    kept = [r for r in rows if by_text[r[1] or ""] >= 0.3]
    found = corpus_pipeline.good_quality(spark, docs, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(kept, key=repr)

    best = {}
    for id, text, more in kept:
        found = ((id is not None, id or 0, more), (id, text, more))
        best[text or ""] = max(best.get(text or "", found), found, key=lambda x: x[0])
    kept = [row for _, row in best.values()]
    numbered = [((id is None, id or 0, n), text or "") for n, (id, text, _) in enumerate(kept)]
    components = brute_components(numbered, 5, 80)
    groups = {}
    for key, text in numbered:
        groups.setdefault(components[key][1], []).append(key)
    kept = [kept[min(keys)[2]] for keys in groups.values()]

    def hit(text):
        words = (text or "").lower().split()
        wanted = dirty.split()
        windows = {tuple(wanted[a : a + 13]) for a in range(len(wanted) - 12)}
        inside = {a + k for a in range(len(words) - 12) if tuple(words[a : a + 13]) in windows for k in range(13)}
        return bool(inside) and 20 * len(inside) >= len(words)

    kept = [row for row in kept if not hit(row[1])]
    got = [(r.doc_id, r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    expected = []
    for id, text, _ in kept:
        ids = TIKTOKEN.encode_ordinary(text or "")
        expected.append((id, len(ids), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert len(got) < len(rows) and not any(i in (103, 104) for i, *_ in got)
