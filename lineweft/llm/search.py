"""Ranked lexical search of many items over all documents: term-at-a-time over short lists, document-at-a-time over long ones.

``build_index`` tokenises the documents once and writes segments: a row per few megabytes of
text with its inverted lists, so nothing of a document moves. ``search`` sums document
frequencies over the segments, ships the items' terms with their weights in blocks of bounded
size, and ranks each block of items against all segments where they lie. Within a segment and
for one item

* the short lists are summed term by term into accumulators, which from then on count as one
  list with a known bound in each block of documents;
* this list and the long ones are walked together in document order. A block whose bounds
  cannot reach the item's tenth score so far is skipped unread; the others are scored whole.

A task keeps the best documents of each item over all its segments, so later ones skip more,
and the best of all tasks are merged by a window that first cuts within tasks.

All scores are 64-bit integers: of the term weight w = floor(1000 ln((2N+2)/(2df+1))) times
(1000000000 tf) div (1000 tf + 8 m), with m = 10 + (90 n N) div L, summed over an item's
different terms. Scores are exact while they stay below 2^63.

Null and empty texts have no term; such documents count neither in N nor in df and are never
found. Rows that share a document id are ranked as documents of their own. Rows that share an
item id, null too, are one item with the terms of them all. Ties go by ascending document id,
null last. An item without a hit has no row. Only id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineweft.llm.words import LOWER_ALNUM
from lineweft.session import cut_lineage

#: Documents of a block; lists of up to this share of a segment's documents are short.
_BLOCK, _SHORT = 128, 1 / 16
#: Blocks scored in one go.
_RUN = 16
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text: Column) -> Column:
    """Terms of a text with repeats, only A-Z lower-cased; none for null."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), F.lit(_TERM), 0)


def _slices(batch: pa.RecordBatch, text_bytes: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of up to ``text_bytes`` of text, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, done + text_bytes, "right")))
        yield batch.slice(at, end - at)
        at = end


def inverted(texts: pa.Array, wanted: pa.Array | None) -> dict:
    """Inverted lists of some texts: terms, how many documents each has, those documents and their counts, terms per document.

    ``wanted``: leave out all other terms; they still count in the lengths.
    """
    n = len(texts)
    whole = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])
    data = whole.buffers()[2]
    plain = (data.to_pybytes() if data else b"").translate(LOWER_ALNUM)
    clean = pa.LargeStringArray.from_buffers(n, whole.buffers()[1], pa.py_buffer(plain), None, 0, whole.offset)
    lists = pc.ascii_split_whitespace(clean)
    owner = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
    coded = lists.flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy(), coded.dictionary
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)[codes] if len(words) else np.zeros(0, bool)
    lengths = np.bincount(owner[real], minlength=n)
    if wanted is None:
        found = pc.index_in(words, pc.filter(words, pc.not_equal(words, "")))
    else:
        found = pc.index_in(words, wanted.cast(words.type))
    at = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    used, dense = np.unique(at[at >= 0], return_inverse=True)
    place = np.full(len(words), -1, np.int64)
    place[at >= 0] = dense
    terms = words.take(pa.array(np.flatnonzero(at >= 0)[np.argsort(dense)]))
    token = place[codes] if len(words) else np.zeros(0, np.int64)
    kept = token >= 0
    keys, counts = np.unique(token[kept] * n + owner[kept], return_counts=True)
    return {
        "terms": terms.to_pylist(),
        "dfs": np.bincount(keys // max(n, 1), minlength=len(used)),
        "docs": keys % max(n, 1),
        "tfs": counts,
        "lengths": lengths,
    }


def build_index(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    wanted: DataFrame | None = None,
    max_wanted_bytes: int = 32 << 20,
    segment_bytes: int = 32 << 20,
) -> DataFrame:
    """Segments of the documents, written to the shared folder.

    ``wanted`` is a table of one column of terms: other terms get no lists. It is shipped to
    the tasks only if its terms take ``max_wanted_bytes`` at most; else all terms get lists.
    """
    only = None
    if wanted is not None:
        terms = wanted.toDF("term").distinct()
        size = terms.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
        if size <= max_wanted_bytes:
            only = docs.sparkSession.sparkContext.broadcast(terms.toArrow().column(0).to_pylist())

    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def segments(batches):
        known = None if only is None else pa.array(only.value, pa.large_string())
        for batch in batches:
            for part in _slices(batch, segment_bytes):
                found = inverted(part.column("text"), known)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.column("doc_id").to_pylist()], pa.list_(part.column("doc_id").type)),
                        pa.array([found["lengths"].astype("<i8").tobytes()], pa.binary()),
                        pa.array([int((found["lengths"] > 0).sum())], pa.int64()),
                        pa.array([int(found["lengths"].sum())], pa.int64()),
                        pa.array([found["terms"]], pa.list_(pa.string())),
                        pa.array([found["dfs"]], pa.list_(pa.int32())),
                        pa.array([found["docs"].astype("<i4").tobytes()], pa.binary()),
                        pa.array([found["tfs"].astype("<i4").tobytes()], pa.binary()),
                    ],
                    ["ids", "lengths", "n_docs", "n_terms", "terms", "dfs", "docs", "tfs"],
                )

    return cut_lineage(
        rows.mapInArrow(
            segments,
            f"ids array<{id_type}>, lengths binary, n_docs bigint, n_terms bigint, terms array<string>, dfs array<int>, "
            "docs binary, tfs binary",
        )
    )


class Segment:
    """A segment's lists with the share of the score that does not depend on the item, and their block bounds."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.ids = row["ids"]
        lengths, of = np.unique(np.frombuffer(row["lengths"], "<i8"), return_inverse=True)
        # Lengths times N may pass 64 bits.
        norms = np.array([10 + 90 * int(n) * n_docs // n_terms for n in lengths], np.int64)[of]
        self.docs = np.frombuffer(row["docs"], "<i4").astype(np.int64)
        tf = np.frombuffer(row["tfs"], "<i4").astype(np.int64)
        self.impacts = 1_000_000_000 * tf // (1000 * tf + 8 * norms[self.docs])
        ends = np.cumsum(row["dfs"] or [0]).tolist()
        self.lists = dict(zip(row["terms"], zip([0, *ends[:-1]], ends, strict=True), strict=True)) if row["terms"] else {}
        self.blocks = -(-len(self.ids) // _BLOCK)
        self._edges = np.arange(self.blocks + 1) * _BLOCK
        self._bounds: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def skips(self, docs: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each block begins in a list, and the largest value in each block."""
        at = np.searchsorted(docs, self._edges)
        most = np.zeros(self.blocks, np.int64)
        full = at[:-1] < at[1:]
        if len(values):
            most[full] = np.maximum.reduceat(values, at[:-1][full])
        return at, most

    def of_term(self, term: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        start, end = self.lists[term]
        if term not in self._bounds:
            self._bounds[term] = self.skips(self.docs[start:end], self.impacts[start:end])
        return self.docs[start:end], self.impacts[start:end], *self._bounds[term]


def accumulated(lists: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: documents of some lists and the sums of their weighted values."""
    docs = np.concatenate([d for d, _, _ in lists])
    values = np.concatenate([v * w for _, v, w in lists])
    order = np.argsort(docs, kind="stable")
    docs, values = docs[order], values[order]
    first = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
    return docs[first], np.add.reduceat(values, first)


def best_of(segment: Segment, terms: list[tuple[str, int]], best: list[tuple], k: int) -> list[tuple]:
    """The best of ``best`` and of a segment's documents for one item; entries sort as (-score, id is null, id)."""
    lists = [(segment.lists[t][1] - segment.lists[t][0], t, w) for t, w in terms if t in segment.lists and w > 0]
    if not lists:
        return best
    limit = max(1, int(len(segment.ids) * _SHORT))
    walked, least = [], -best[-1][0] if len(best) == k else 0
    if short := [segment.of_term(t)[:2] + (w,) for n, t, w in lists if n <= limit]:
        docs, sums = accumulated(short)
        walked.append((docs, sums, 1, *segment.skips(docs, sums)))
        if len(sums) >= k:  # what the long lists add is never negative
            least = max(least, int(np.partition(sums, -k)[-k]))
    for n, t, w in lists:
        if n > limit:
            docs, values, at, most = segment.of_term(t)
            walked.append((docs, values, w, at, most))
    bounds = sum(most * w for *_, w, _, most in walked)
    block = 0
    while block < segment.blocks:
        if bounds[block] == 0 or bounds[block] < least:
            ahead = np.flatnonzero((bounds[block:] >= max(least, 1)))
            if not len(ahead):
                break
            block += int(ahead[0])
        fit = bounds[block : block + _RUN] >= max(least, 1)
        end = block + (len(fit) if fit.all() else int(np.argmin(fit)))
        base = block * _BLOCK
        scores = np.zeros((end - block) * _BLOCK, np.int64)
        for docs, values, w, at, _ in walked:
            a, b = at[block], at[end]
            scores[docs[a:b] - base] += values[a:b] * w  # a list names a document once
        floor = max(least, 1)
        if len(scores) > k:
            floor = max(floor, int(np.partition(scores, -k)[-k]))
        found = np.flatnonzero(scores >= floor)
        if len(found):
            ids = [segment.ids[base + i] for i in found.tolist()]
            new = [(-s, i is None, 0 if i is None else i) for s, i in zip(scores[found].tolist(), ids, strict=True)]
            best = sorted(best + new)[:k]
            least = max(least, -best[-1][0]) if len(best) == k else least
        block = end
    return best


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    text: str = "text",
    id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    index: DataFrame | None = None,
    block_terms: int = 500_000,
) -> DataFrame:
    """The ``k`` documents of the highest score for each item: item_id, rank, doc_id, score.

    ``index``: what ``build_index`` made of the documents with the items' terms among its
    terms; made here if missing. Items are worked on in blocks of about ``block_terms`` terms,
    an item with more terms being a block of its own.
    """
    spark = docs.sparkSession
    asked = cut_lineage(
        items.select(F.col(item_id).alias("item_id"), F.explode(terms_of(F.col(item_text))).alias("term")).distinct()
    )
    if index is None:
        index = build_index(docs, text, id, asked.select("term"))
    sums = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = sums[0] or 0, sums[1] or 0
    listed = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("list"))
    df = listed.groupBy(F.col("list.terms").alias("term")).agg(F.sum("list.dfs").alias("df"))
    weighted = cut_lineage(asked.join(df, "term"))
    blocks = -(-weighted.count() // block_terms)
    id_type = index.schema["ids"].dataType.elementType.simpleString()
    item_type = asked.schema["item_id"].dataType.simpleString()
    found = [
        _block_best(index, weighted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block), n_docs, n_terms, k)
        for block in range(blocks)
    ]
    nothing = spark.createDataFrame([], f"item_id {item_type}, doc_id {id_type}, score bigint")
    whole = reduce(DataFrame.unionByName, found, nothing)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _block_best(index: DataFrame, weighted: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The best documents of each task for a block of items, whose terms and frequencies go to the tasks."""
    spark = index.sparkSession
    table = weighted.toArrow().sort_by("item_id")
    weights = {}
    queries: list[tuple] = []
    for item, term, df in zip(*(table.column(c).to_pylist() for c in ("item_id", "term", "df")), strict=True):
        if not queries or queries[-1][0] != item:
            queries.append((item, []))
        if df not in weights:
            weights[df] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        queries[-1][1].append((term, weights[df]))
    shipped = spark.sparkContext.broadcast(queries)
    item_kind = table.schema.field("item_id").type
    item_type = weighted.schema["item_id"].dataType.simpleString()
    id_type = index.schema["ids"].dataType.elementType.simpleString()

    def best(batches):
        kept: list[list] = [[] for _ in shipped.value]
        id_kind = None
        for batch in batches:
            id_kind = batch.schema.field("ids").type.value_type
            for n in range(batch.num_rows):
                (row,) = batch.slice(n, 1).to_pylist()
                segment = Segment(row, n_docs, n_terms) if n_terms else None
                for at, (_, terms) in enumerate(shipped.value if segment else ()):
                    kept[at] = best_of(segment, terms, kept[at], k)
        if id_kind is not None:
            rows = [(item, None if null else i, -s) for (item, _), b in zip(shipped.value, kept, strict=True) for s, null, i in b]
            item, doc, score = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, item_kind), pa.array(doc, id_kind), pa.array(score, pa.int64())], ["item_id", "doc_id", "score"]
            )

    used = index.select("ids", "lengths", "terms", "dfs", "docs", "tfs")
    return used.mapInArrow(best, f"item_id {item_type}, doc_id {id_type}, score bigint")
