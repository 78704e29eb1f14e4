"""Byte-level BPE: ranked merges over the bytes of distinct words, decoding by pieces.

A word is one match of the splitting pattern, found by Spark in the rows themselves. Words then pass through
``mapInArrow``: Arrow codes the different words of a run of texts, each of them is merged once, the pair of lowest
rank and then the leftmost first, and the ids are put in the words' places. A task remembers the words it has
merged within bounds. Only (id, words) rows enter a task and only (id, ids) rows leave it; there is no shuffle, and
nothing but the ranks is sent along.

Null and empty texts have no tokens. Rows are encoded one by one: repeated rows and null ids
stay as they are. Columns other than the id and the text are not touched.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words are coded and merged in runs of texts that have up to this many, one text at least.
_WORDS_AT_ONCE = 1 << 18


class RankVocabulary:
    """Ranks read from a file of base64 pieces and ids, with the pattern that cuts text into words.

    ``path`` is read on the driver only. The pattern may use Unicode classes; white space
    in it is Unicode white space.
    """

    def __init__(self, path: str, pattern: str):
        self.pattern = "(?U)" + pattern
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(piece): int(rank) for piece, rank in (x.split() for x in lines if x.strip())}
        if missing := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"no rank for bytes {missing[:5]}")

    def pieces(self) -> pa.Array:
        """Bytes by id; none where the numbering has a gap."""
        pieces = [b""] * (max(self.ranks.values()) + 1)
        for piece, rank in self.ranks.items():
            pieces[rank] = piece
        return pa.array(pieces, pa.large_binary())


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: bytes as parts, then merges in order of rank, leftmost first; a word that has a rank is one id.

    Pairs wait in a heap, so a word costs little more than its length. A pair that a merge has changed
    meanwhile is told by the ends of its parts.
    """
    if (whole := ranks.get(word)) is not None:
        return [whole]
    n = len(word)
    # By where a part starts: where it ends (0: it is part of another) and where the one before it starts.
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
    waiting = [(rank, i, i + 1, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(waiting)
    while waiting:
        _, left, right, stop = heapq.heappop(waiting)
        if ends[left] != right or ends[right] != stop:
            continue
        ends[left], ends[right] = stop, 0
        if stop < n:
            before[stop] = left
            if (rank := ranks.get(word[left : ends[stop]])) is not None:
                heapq.heappush(waiting, (rank, left, stop, ends[stop]))
        if (earlier := before[left]) >= 0 and (rank := ranks.get(word[earlier:stop])) is not None:
            heapq.heappush(waiting, (rank, earlier, left, stop))
    return [ranks[word[start:end]] for start, end in enumerate(ends) if end]


class WordIds(dict):
    """Ids of words as little-endian 32-bit integers, merged when first asked for."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = np.array(merged(word, self.ranks), "<u4").tobytes()
        return ids


def words_of(text: Column, vocabulary: RankVocabulary) -> Column:
    """The matches of the pattern, in order."""
    return F.regexp_extract_all(text, F.lit(vocabulary.pattern), F.lit(0))


def _ends(lists: pa.Array) -> np.ndarray:
    """Where each list begins among the flattened values, and where the last one ends."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _runs(lists: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, number) of runs of lists of up to ``_WORDS_AT_ONCE`` values, one list at least."""
    ends, at = _ends(lists), 0
    while at < len(lists):
        end = max(at + 1, int(np.searchsorted(ends, ends[at] + _WORDS_AT_ONCE, "right")) - 1)
        yield at, end - at
        at = end


def _parts(values: pa.Array) -> tuple[np.ndarray, memoryview]:
    """The offsets and the bytes of an array of large binaries that was not sliced."""
    _, offsets, data = values.buffers()
    return np.frombuffer(offsets, np.int64)[: len(values) + 1], memoryview(data or b"")


def list_ids(words: pa.Array, known: WordIds) -> pa.Array:
    """Lists of words to lists of ids; each different word is looked up once."""
    coded = words.flatten().cast(pa.large_binary()).dictionary_encode()
    each = pa.array([known[word] for word in coded.dictionary.to_pylist()], pa.large_binary())
    offsets, data = _parts(each.take(coded.indices))
    ends = offsets[_ends(words)] // 4
    ids = pa.array(np.frombuffer(data, "<i4", ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids)


def encode(
    docs: DataFrame,
    vocabulary: RankVocabulary,
    text: str = "text",
    id: str = "doc_id",
    dictionary_words: int = 200_000,
) -> DataFrame:
    """``id`` and ``ids`` (array of int) of every row, as the merges of its words give them.

    ``dictionary_words`` bounds the words that a task remembers (some 200 bytes each); the result does not
    depend on it.
    """
    words = words_of(F.coalesce(F.col(text), F.lit("")), vocabulary)
    rows = docs.select(F.col(id).alias("doc_id"), words.alias("words"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    ranks = vocabulary.ranks

    def encoded(batches):
        known = WordIds(ranks)
        for batch in batches:
            for start, n in _runs(batch.column("words")):
                if len(known) > dictionary_words:
                    known.clear()
                some = batch.slice(start, n)
                ids = list_ids(some.column("words"), known)
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), ids], ["doc_id", "ids"])

    return rows.mapInArrow(encoded, f"doc_id {id_type}, ids array<int>")


def _joined(lists: pa.Array, offsets: np.ndarray, data) -> pa.Array:
    """One binary for each list, of the bytes between the ``offsets`` of its ends; null lists stay null."""
    places = offsets[_ends(lists)].astype(np.int32)
    whole = pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(places), pa.py_buffer(data)])
    return pc.if_else(lists.is_valid(), whole, pa.scalar(None, pa.binary())) if lists.null_count else whole


def little_endian(ids: Column) -> Column:
    """The ids as little-endian unsigned 32-bit integers, one after the other."""

    @F.arrow_udf("binary")
    def joined(lists: pa.Array) -> pa.Array:
        values = lists.flatten().to_numpy().astype("<i4")
        return _joined(lists, 4 * np.arange(len(values) + 1), values.tobytes())

    return joined(ids)


def decode(ids: Column, vocabulary: RankVocabulary) -> Column:
    """The bytes of all pieces, one after the other."""
    pieces = vocabulary.pieces()

    @F.arrow_udf("binary")
    def joined(lists: pa.Array) -> pa.Array:
        return _joined(lists, *_parts(pieces.take(lists.flatten())))

    return joined(ids)


def token_digests(encoded: DataFrame, vocabulary: RankVocabulary) -> DataFrame:
    """Counts and digests of encoded rows: ids as 32-bit integers, and the bytes they decode to."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(little_endian(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), vocabulary), 256).alias("decoded_sha256"),
    )
