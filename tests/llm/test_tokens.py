import hashlib
import zlib

import numpy as np
import public_tokenizers
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import EDGE, edge, nothing, shared  # noqa: F401

from lineweft.llm import bpe, tokenfiles

VOCABULARY = bpe.RankVocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
TIKTOKEN = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=VOCABULARY.ranks, special_tokens={}
)
TIKTOKEN_PARTS = regex.compile(public_tokenizers.PATTERN)
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def counted(rows):
    return sorted(rows, key=repr)


def test_bpe_equals_the_library_with_and_without_dictionary(edge):
    expected = counted((i, TIKTOKEN.encode_ordinary(t or "")) for i, t, _ in EDGE)
    for words in (0, 100):
        encoded = bpe.encode(edge, VOCABULARY, dictionary_words=words)
        assert counted((r.doc_id, list(r.ids)) for r in encoded.collect()) == expected


def test_bpe_round_trip_and_empty_table(spark, edge, nothing):
    encoded = bpe.encode(edge, VOCABULARY)
    back = encoded.select("doc_id", bpe.decode(F.col("ids"), VOCABULARY).alias("bytes")).collect()
    assert counted((r.doc_id, bytes(r.bytes)) for r in back) == counted((i, (t or "").encode()) for i, t, _ in EDGE)
    assert bpe.token_digests(bpe.encode(nothing, VOCABULARY), VOCABULARY).count() == 0


def test_bpe_long_words_and_ties(spark):
    words = ["a" * 300, "ab" * 100, "the" * 50, "é" * 40, "  \n\n  x"]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id bigint, text string")
    got = {r.doc_id: list(r.ids) for r in bpe.encode(docs, VOCABULARY, dictionary_words=0).collect()}
    assert got == {i: TIKTOKEN.encode_ordinary(w) for i, w in enumerate(words)}


def test_bpe_of_very_long_words_with_a_small_plan(spark):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdeé"), 20_000)), "z" * 20_000, "1" * 9_999, " " * 5_000]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id bigint, text string")
    encoded = bpe.token_digests(bpe.encode(docs, VOCABULARY), VOCABULARY)
    # Neither the vocabulary nor the corpus's words are held in the driver's plan.
    assert len(encoded._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    expected = [np.array(TIKTOKEN.encode_ordinary(w), "<u4").tobytes() for w in words]
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encoded.collect()}
    assert got == {
        i: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(w.encode()).hexdigest())
        for i, (w, ids) in enumerate(zip(words, expected, strict=True))
    }


@given(st.text("abé \n12'", max_size=60))
def test_merges_equal_the_library(text):
    assert [i for w in TIKTOKEN_PARTS.findall(text) for i in bpe.merged(w.encode(), VOCABULARY.ranks)] == TIKTOKEN.encode_ordinary(text)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.booleans())
def test_planes_round_trip(ids, bits):
    ids = np.array(ids, "<u4")
    assert (tokenfiles.from_planes(tokenfiles.to_planes(ids, bits), len(ids), bits) == ids).all()


def test_token_files(spark, tmp_path, edge):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    encoded = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t, _ in EDGE}
    for name, chunk, bits in (("small", 64, False), ("bits", 1000, True)):
        folder = str(tmp_path / name)
        tokenfiles.write_tokens(edge, folder, TOKENIZER, end_id=2, chunk_ids=chunk, bits=bits)
        rows = tokenfiles.read_documents(spark, folder, bits).collect()
        got = counted((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows)
        assert got == counted(
            (i, len(encoded[t]), zlib.crc32(np.array(encoded[t], "<u4").tobytes())) for i, t, _ in EDGE
        )
        in_order = sorted(rows, key=lambda r: r.start)
        assert [r.start for r in in_order] == np.cumsum([0, *(r.n_tokens for r in in_order)])[:-1].tolist()
        ids = [r.doc_id for r in in_order]
        assert ids == sorted(ids, key=lambda i: (i is not None, i))
        index = tokenfiles.chunk_index(spark, folder).orderBy("start").collect()
        assert all(r.n <= chunk for r in index) and sum(r.n for r in index) == sum(r.n_tokens for r in rows)


def test_token_files_of_nothing(spark, tmp_path, nothing):
    folder = str(tmp_path / "none")
    tokenfiles.write_tokens(nothing, folder, TOKENIZER, end_id=2)
    assert tokenfiles.read_documents(spark, folder).count() == 0


def test_token_files_of_texts_with_added_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = ["<|endoftext|> hi", "a<|endoftext|>b", "<|EndOfText|> | <|startoftext|>x", "<|end oftext|>", "plain | text", None]
    docs = spark.createDataFrame([(None if i == 4 else 7, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    tokenfiles.write_tokens(docs, str(tmp_path / "files"), TOKENIZER, end_id=2)
    got = sorted(r.ids_crc32 for r in tokenfiles.read_documents(spark, str(tmp_path / "files")).collect())
    encoded = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert encoded[0] == [49407, 1883, 2]
    assert got == sorted(zlib.crc32(np.array(ids, "<u4").tobytes()) for ids in encoded)
