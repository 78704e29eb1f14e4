"""Substring dedup with a count-min prefilter: words in passages that begin earlier elsewhere go.

A window is a run of ``window`` words. The first pass sketches how often windows occur; the
sketch may overestimate, never underestimate. The second pass groups exactly, by 128-bit
hashes, only the windows that the sketch calls repeated. No window that occurs twice is lost.

What the sketch counts for a window is its least inner run of half the length: equal windows
hold equal runs, at the same place, and neighbouring windows share theirs, so a document
adds one entry for several windows. Task sketches are sparse, merged block by block over a
shuffle, and the merged sketch has at most ``max_cells`` cells of two bits (32 MB); its size
follows the input up to that bound. Beyond it more windows reach the exact grouping, which
stays right.

The exact grouping keeps the least document per window by a map-side ``min``, so a passage
in a third of all documents costs a row per task. The windows that a document was first
with go back to it as one bounded list; it drops its other repeated windows.

Null texts have no words; texts shorter than a window stay. Null ids rank last. Rows with
the same id count as one document that starts at the same places: they do not remove each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweft.llm.tables import null_safe_join
from lineweft.llm.words import covered, hashed_texts, sliding_argmin, texts, window_hashes

_BLOCK = 1 << 20
_ROWS = 2


def _anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the inner runs, and for each window the position of its least run."""
    inner = max(1, window // 2)
    runs = window_hashes(words, inner)
    return runs, sliding_argmin(runs, window - inner + 1)


def _cells(runs: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    """The cell of each run in each row of the sketch; the rows lie one after the other."""
    width = cells // _ROWS
    for row in range(_ROWS):
        shift = np.uint64(0 if row == 0 else 32)
        yield ((runs >> shift) % np.uint64(width)).astype(np.int64) + row * width


def _pack(counts: np.ndarray) -> bytes:
    pairs = counts.reshape(-1, 4)
    packed = pairs[:, 0] | pairs[:, 1] << 2 | pairs[:, 2] << 4 | pairs[:, 3] << 6
    return zstandard.compress(packed.astype(np.uint8).tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    packed = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.stack([packed >> s & 3 for s in (0, 2, 4, 6)], axis=1).reshape(-1)


def sketch_cells(docs: DataFrame, text: str, window: int, max_cells: int) -> int:
    """A power of two, some cells for each window anchor that texts of this size may hold."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    wanted = 4 * size // max(1, 3 * window // 2)
    return min(max(_BLOCK * _ROWS, 1 << int(wanted).bit_length()), max_cells)


def window_sketch(docs: DataFrame, text: str, window: int, cells: int) -> bytes:
    """Counts, up to two, of window anchors over all documents: the merged count-min sketch."""

    def of_task(batches):
        counts, waiting, n = np.zeros(cells, np.uint8), [], 0

        def add():
            for each in _cells(np.concatenate(waiting), cells):
                places, times = np.unique(each, return_counts=True)
                counts[places] = np.minimum(counts[places] + np.minimum(times, 2), 2)
            waiting.clear()

        for batch in batches:
            for words in hashed_texts(batch):
                runs, least = _anchors(words, window)
                waiting.append(runs[np.unique(least)])
                n += len(waiting[-1])
                if n > 1_000_000:
                    add()
                    n = 0
        if waiting:
            add()
        for block in range(cells // _BLOCK):
            part = counts[block * _BLOCK : (block + 1) * _BLOCK]
            if part.any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "counts": [_pack(part)]})

    def merged(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = _unpack(data)
                sums[block] = np.minimum(sums[block] + part, 2) if block in sums else part
        for block, part in sums.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "counts": [_pack(part)]})

    schema = "block int, counts binary"
    parts = docs.select(F.col(text).alias("text")).mapInArrow(of_task, schema)
    blocks = parts.repartition(min(64, cells // _BLOCK), "block").mapInArrow(merged, schema)
    whole = bytearray(cells // 4)
    for block, data in blocks.toLocalIterator():
        raw = zstandard.decompress(data)
        whole[block * _BLOCK // 4 : (block + 1) * _BLOCK // 4] = raw
    return bytes(whole)


def _repeated(sketch: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Whether the sketch holds every run twice or more."""
    found = np.ones(len(runs), bool)
    for each in _cells(runs, len(sketch) * 4):
        found &= (sketch[each >> 2] >> ((each & 3) << 1).astype(np.uint8) & 3) >= 2
    return found


def drop_repeated(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    window: int = 20,
    max_cells: int = 1 << 27,
) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_removed`` and ``kept``, the words left joined by blanks."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    sketch = spark.sparkContext.broadcast(window_sketch(rows, "text", window, sketch_cells(rows, "text", window, max_cells)))

    def flagged(words: np.ndarray) -> np.ndarray:
        """Starts of the windows that may occur elsewhere."""
        runs, least = _anchors(words, window)
        anchors, which = np.unique(least, return_inverse=True)
        table = np.frombuffer(sketch.value, np.uint8)
        return np.flatnonzero(_repeated(table, runs[anchors])[which]) if len(anchors) else anchors

    def candidates(batches):
        for batch in batches:
            firsts, seconds, ids, counts = [], [], batch.column("doc_id").to_pylist(), []
            for words in hashed_texts(batch):
                starts = flagged(words)
                if not len(starts):
                    counts.append(0)
                    continue
                first = window_hashes(words, window, 0)[starts]
                first, at = np.unique(first, return_index=True)
                firsts.append(first)
                seconds.append(window_hashes(words, window, 1)[starts[at]])
                counts.append(len(first))
            if not firsts:
                firsts = seconds = [np.empty(0, np.uint64)]
            owner = np.repeat(np.arange(len(ids)), counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(firsts).view(np.int64)),
                    pa.array(np.concatenate(seconds).view(np.int64)),
                    batch.column("doc_id").take(pa.array(owner)),
                ],
                ["first", "second", "doc_id"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    windows = rows.mapInArrow(candidates, f"first bigint, second bigint, doc_id {id_type}")
    owners = windows.groupBy("first", "second").agg(F.min("doc_id").alias("owner"))
    won = owners.groupBy(F.col("owner").alias("doc_id")).agg(F.collect_list("first").alias("won"))

    def cut(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for value, values, won_here in zip(texts(batch), hashed_texts(batch), batch.column("won"), strict=True):
                words = (value or b"").split()
                starts = flagged(values)
                gone = np.empty(0, np.int64)
                if len(starts):
                    # The sketch counts both places of a window that the document itself repeats, so they are among these.
                    every = window_hashes(values, window, 0)[starts]
                    _, first_at = np.unique(every, return_index=True)
                    later = np.ones(len(every), bool)
                    later[first_at] = False
                    mine = won_here.values.to_numpy(zero_copy_only=False) if won_here.is_valid else gone
                    later |= ~np.isin(every, mine.astype(np.int64).view(np.uint64))
                    gone = starts[later]
                if len(gone):
                    stay = ~covered(gone, window, len(words))
                    kept.append(b" ".join(compress(words, stay)))
                    n_removed.append(len(words) - int(stay.sum()))
                else:
                    kept.append(b" ".join(words))
                    n_removed.append(0)
                n_words.append(len(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array([x.decode() for x in kept], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    joined = null_safe_join(rows, won, ["doc_id"], "left")
    return joined.mapInArrow(cut, f"doc_id {id_type}, n_words bigint, n_removed bigint, kept string")
