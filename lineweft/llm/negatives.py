"""Hard negatives by exact integer products: Strassen multiplication of tiles, mergeable heaps of positives and windows.

Vectors become integers once, are numbered and written; the anchors among them are also
written in blocks of bounded size. A block goes to all tasks, which multiply it with their
candidates tile by tile: ``product`` splits both tiles into quadrants, filled up with zeros
to even sides, and needs seven products where eight are usual, down to small tiles. Whatever
order the sums take, 64-bit integers add exactly.

A first pass over a block's candidates keeps, in each task, the best ``positives`` rows of
each anchor's label; a window merges the tasks' heaps. A second pass, knowing each positive's
score, keeps the best ``negatives`` of other labels in its window of scores, merged alike.
Every anchor meets every row, in blocks: that is the question asked. No heap holds more
than its best, and no row for a pair leaves a task unless it is among them.

Rows with a null label, a null vector, or a null or non-finite component take no part. Shorter
vectors are filled up with zeros. A null id is never an anchor, keeps its label, and comes
last among ties. Rows that share an id, or everything, stay rows of their own: each is
an anchor of its own, and the others are its positives. Products that could pass 64 bits are worked
out with unbounded integers, and scores beyond 64 bits count as the largest or least 64-bit
number. Only the three named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineweft.session import cut_lineage

#: Tiles with a side of up to this many rows or columns are multiplied as they are.
_SMALL = 16
#: Candidates and anchors of a tile.
_TILE, _ANCHORS = 4096, 512
_LEAST, _MOST = -(2**63), 2**63 - 1


def _filled_up(a: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """``a`` with zeros up to a size. ``np.pad`` would put 64-bit zeros among Python's integers, whose sums then overflow."""
    if a.shape == (rows, columns):
        return a
    out = np.zeros((rows, columns), a.dtype)
    out[: a.shape[0], : a.shape[1]] = a
    return out


def _even(a: np.ndarray) -> np.ndarray:
    """``a`` with a row and a column of zeros more where its sides are odd."""
    return _filled_up(a, a.shape[0] + a.shape[0] % 2, a.shape[1] + a.shape[1] % 2)


def product(a: np.ndarray, b: np.ndarray, small: int = _SMALL) -> np.ndarray:
    """``a @ b`` by Strassen's seven products of quadrants, recursively; exact for integers."""
    rows, columns = a.shape[0], b.shape[1]
    if min(rows, columns, a.shape[1]) <= small:
        return a @ b
    a, b = _even(a), _even(b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = product(a11 + a22, b11 + b22, small)
    p2 = product(a21 + a22, b11, small)
    p3 = product(a11, b12 - b22, small)
    p4 = product(a22, b21 - b11, small)
    p5 = product(a11 + a12, b22, small)
    p6 = product(a21 - a11, b11 + b12, small)
    p7 = product(a12 - a22, b21 + b22, small)
    out = np.empty((2 * m, 2 * n), p1.dtype)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out[:rows, :columns]


def scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two integer matrices, the narrower one filled up with zeros, as 64-bit integers.

    64-bit sums are exact modulo 2^64, so only results have to fit, not what lies between.
    """
    width = max(anchors.shape[1], candidates.shape[1])
    anchors, candidates = (_filled_up(x, len(x), width) for x in (anchors, candidates))
    if anchors.dtype != object and candidates.dtype != object:
        most = [int(np.abs(x).max(initial=0)) for x in (anchors, candidates)]
        if most[0] * most[1] * width <= _MOST:
            return product(anchors, candidates.T)
    exact = product(anchors.astype(object), candidates.astype(object).T)
    return np.clip(exact, _LEAST, _MOST).astype(np.int64)


def _integer(x: float, scale: int) -> int:
    """floor(scale * x); from 2^53 on a float is an integer itself."""
    return int(x) * scale if abs(x) >= 2**53 else math.floor(scale * x)


def integers(vectors: pa.Array, scale: int) -> np.ndarray:
    """Rows of floor(scale * x), shorter ones filled up with zeros; 64-bit integers if they fit, else unbounded ones."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if np.abs(flat).max(initial=0) * scale < 2**62:
        whole = np.floor(scale * flat).astype(np.int64)
    else:
        whole = np.array([_integer(x, scale) for x in flat.tolist()], object)
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width), whole.dtype)
    out[np.arange(width) < lengths[:, None]] = whole
    return out


class Heaps:
    """The best entries of many questions: higher scores first, then smaller ids, null ids last."""

    def __init__(self, n: int, size: int):
        self.size, self.n = size, n
        self.least = np.full(n, _LEAST, np.int64)  # an entry below it cannot be among the best
        self._of = np.empty(0, np.int64)
        self._score = np.empty(0, np.int64)
        self._no_id = np.empty(0, bool)
        self._id = np.empty(0, np.int64)
        self._row = np.empty(0, np.int64)

    def offer(self, of: np.ndarray, score: np.ndarray, id: np.ndarray, no_id: np.ndarray, row: np.ndarray) -> None:
        """Merge entries; ``of`` says which question each is for."""
        of, score = np.r_[self._of, of], np.r_[self._score, score]
        id, no_id, row = np.r_[self._id, id], np.r_[self._no_id, no_id], np.r_[self._row, row]
        # Not -score, which the least 64-bit number does not have.
        order = np.lexsort((row, id, no_id, ~score, of))
        sorted_of = of[order]
        kept = order[np.arange(len(of)) - np.searchsorted(sorted_of, sorted_of) < self.size]
        self._of, self._score, self._id = of[kept], score[kept], id[kept]
        self._no_id, self._row = no_id[kept], row[kept]
        full = np.bincount(self._of, minlength=self.n) == self.size
        ends = np.searchsorted(self._of, np.flatnonzero(full), "right") - 1
        self.least[full] = self._score[ends]

    def entries(self) -> dict[str, np.ndarray]:
        return {"of": self._of, "score": self._score, "id": self._id, "no_id": self._no_id, "row": self._row}


def best_in_tile(found: np.ndarray, allowed: np.ndarray, least: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of a tile's allowed scores that can be among the ``size`` best of their row, all ties included."""
    hits = allowed & (found >= least[:, None])
    if found.shape[1] > size and np.count_nonzero(hits) > 4 * size * len(found):
        masked = np.where(hits, found, _LEAST)
        hits &= masked >= np.partition(masked, -size, axis=1)[:, [-size]]
    return np.nonzero(hits)


class _Tile:
    """Some rows of a batch or of a block of anchors."""

    def __init__(self, batch: pa.RecordBatch, scale: int):
        self.row = batch.column("row").to_numpy()
        self.no_id = batch.column("vec_id").is_null().to_numpy(zero_copy_only=False)
        self.id = pc.fill_null(batch.column("vec_id"), 0).to_numpy()
        self.label = batch.column("label").to_numpy()
        self.values = integers(batch.column("values"), scale)


def _tiles(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[_Tile]:
    for batch in batches:
        for at in range(0, batch.num_rows, _TILE):
            yield _Tile(batch.slice(at, _TILE), scale)


def _ids(id: np.ndarray, no_id: np.ndarray) -> pa.Array:
    return pa.array(id, pa.int64(), mask=no_id)


def prepared(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """The rows that take part, numbered and written: row, vec_id, label, values."""
    number = lambda x: x.cast("double")
    sound = lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) < F.lit(float("inf")))
    usable = F.col(label).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, sound)
    return cut_lineage(
        vectors.where(usable).select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id).cast("bigint").alias("vec_id"),
            F.col(label).cast("bigint").alias("label"),
            F.transform(vector, number).alias("values"),
        )
    )


def mine(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    anchor_every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = 256,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """Hard negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose id is divisible by ``anchor_every``. A negative's score is at least
    ``window[0]`` and at most ``window[1]`` percent of the positive's. ``block_bytes``
    bounds the vectors of a block of anchors.
    """
    rows = prepared(vectors, id, vector, label)
    anchors = cut_lineage(rows.where(F.col("vec_id") % anchor_every == 0))
    size = anchors.agg(F.sum(8 * F.size("values") + 64)).first()[0] or 0
    blocks = -(-size // block_bytes)
    found = []
    for block in range(blocks):
        some = anchors.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block)
        best = cut_lineage(_positives(rows, some, positives, scale))
        found.append(_negatives(rows, some, best, negatives, window, scale))
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    return reduce(DataFrame.unionByName, found, vectors.sparkSession.createDataFrame([], schema))


def _merged(entries: DataFrame, keys: list[str], size: int) -> DataFrame:
    """The best entries of each question from those of all tasks."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def _positives(rows: DataFrame, anchors: DataFrame, size: int, scale: int) -> DataFrame:
    """The best other rows of each anchor's label: anchor, row, vec_id, score, rank."""
    shipped = rows.sparkSession.sparkContext.broadcast(anchors.toArrow())

    def best(batches):
        (block,) = shipped.value.combine_chunks().to_batches() or [None]
        groups: dict[int, list] = {}
        if block is not None:
            whole = _Tile(block, scale)
            for label in np.unique(whole.label).tolist():
                at = np.flatnonzero(whole.label == label)
                groups[label] = [(part, Heaps(len(part), size)) for part in np.split(at, range(_ANCHORS, len(at), _ANCHORS))]
        for tile in _tiles(batches, scale):
            for label in np.unique(tile.label).tolist():
                same = np.flatnonzero(tile.label == label)
                for part, heaps in groups.get(label, ()):
                    values = scores(whole.values[part], tile.values[same])
                    other = whole.row[part][:, None] != tile.row[same]
                    of, at = best_in_tile(values, other, heaps.least, size)
                    at_row = same[at]
                    heaps.offer(of, values[of, at], tile.id[at_row], tile.no_id[at_row], tile.row[at_row])
        for part, heaps in (x for group in groups.values() for x in group):
            e = heaps.entries()
            yield pa.RecordBatch.from_arrays(
                [pa.array(whole.row[part][e["of"]]), pa.array(e["row"]), _ids(e["id"], e["no_id"]), pa.array(e["score"])],
                ["anchor", "row", "vec_id", "score"],
            )

    return _merged(rows.mapInArrow(best, "anchor bigint, row bigint, vec_id bigint, score bigint"), ["anchor"], size)


def _negatives(
    rows: DataFrame, anchors: DataFrame, positives: DataFrame, size: int, window: tuple[int, int], scale: int
) -> DataFrame:
    """The best rows of other labels in each positive's window of scores."""
    asked = positives.select("anchor", F.col("row").alias("positive"), F.col("vec_id").alias("positive_id"), "score")
    shipped = rows.sparkSession.sparkContext.broadcast((anchors.toArrow(), asked.toArrow().sort_by("anchor")))

    def best(batches):
        (block,) = shipped.value[0].combine_chunks().to_batches() or [None]
        questions = shipped.value[1]
        parts = []
        if block is not None and len(questions):
            whole = _Tile(block, scale)
            order = np.argsort(whole.row)
            anchor = order[np.searchsorted(whole.row[order], questions.column("anchor").to_numpy())]
            score = questions.column("score").to_pylist()
            low = np.array([-(-window[0] * s // 100) for s in score], np.int64)
            high = np.array([window[1] * s // 100 for s in score], np.int64)
            starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            for first in range(0, len(starts), _ANCHORS):
                begin = starts[first]
                end = starts[first + _ANCHORS] if first + _ANCHORS < len(starts) else len(anchor)
                used = anchor[starts[first : first + _ANCHORS]]
                parts.append((used, begin, np.searchsorted(starts, np.arange(begin, end), "right") - 1 - first, Heaps(end - begin, size)))
        for tile in _tiles(batches, scale):
            for used, begin, of_anchor, heaps in parts:
                values = scores(whole.values[used], tile.values)
                other = whole.label[used][:, None] != tile.label
                # The positives of an anchor one after the other, so that no more than a tile of scores is looked at.
                nth = np.arange(len(of_anchor)) - np.searchsorted(of_anchor, of_anchor)
                for n in range(int(nth.max()) + 1):
                    q = np.flatnonzero(nth == n)
                    mine = values[of_anchor[q]]
                    inside = other[of_anchor[q]] & (mine >= low[begin + q][:, None]) & (mine <= high[begin + q][:, None])
                    of, at = best_in_tile(mine, inside, heaps.least[q], size)
                    heaps.offer(q[of], mine[of, at], tile.id[at], tile.no_id[at], tile.row[at])
        for _, begin, of_anchor, heaps in parts:
            e = heaps.entries()
            q = questions.take(pa.array(begin + e["of"]))
            ids = block.column("vec_id").take(pa.array(anchor[begin + e["of"]]))
            yield pa.RecordBatch.from_arrays(
                [
                    q.column("anchor").combine_chunks(),
                    q.column("positive").combine_chunks(),
                    ids,
                    q.column("positive_id").combine_chunks(),
                    q.column("score").combine_chunks(),
                    pa.array(e["row"]),
                    _ids(e["id"], e["no_id"]),
                    pa.array(e["score"]),
                ],
                ["anchor", "positive", "anchor_id", "positive_id", "positive_score", "row", "vec_id", "score"],
            )

    kinds = "anchor bigint, positive bigint, anchor_id bigint, positive_id bigint, positive_score bigint, row bigint, vec_id bigint, score bigint"
    merged = _merged(rows.mapInArrow(best, kinds), ["anchor", "positive"], size)
    return merged.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
