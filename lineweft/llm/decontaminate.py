"""Benchmark decontamination by winnowing: fingerprints select, joins find, extension proves.

Words are hashed; the fingerprint of a run of ``window - guard + 1`` words is its hash, and of
``guard`` neighbouring runs only the least is kept, on both sides by the same rule. Two
texts that share ``window`` words in a row therefore share a fingerprint inside them.

Fingerprints of documents pass a bit map of the benchmark's ones first (``filter_bits`` long,
whatever the benchmark, so broadcasting it is bounded), and what passes is joined with the
benchmark's fingerprints by Spark. Each hit carries the hashes of the words around it, a
bounded number. Extension compares both surroundings word by word and keeps runs that fill a
window. Benchmark runs are joined as distinct contents, not per item, so that a passage that many
items share costs one row per hit; items come back in by a join on the windows that occur.

An item of fewer words than a window is one window by itself; its whole hash is looked for
at every place of the documents, through the same bit map and join.

Null and empty texts have no words. Repeated document rows are judged row by row; item ids
that occur in several rows count once, and rows without an item id are not looked for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweft.llm.tables import bit_map, in_bit_map, null_safe_join
from lineweft.llm.words import LOWER_ALNUM, hashed_texts, sliding_argmin, window_hashes
from lineweft.session import cut_lineage


def fingerprints(words: np.ndarray, window: int, guard: int) -> tuple[np.ndarray, np.ndarray]:
    """Run hashes, and the positions of those that winnowing keeps."""
    runs = window_hashes(words, window - guard + 1)
    return runs, np.unique(sliding_argmin(runs, guard))


def _item_rows(batches, window: int, guard: int):
    """Per item and window: its kind (0, or the length of a short item), hash, and joined fingerprints."""
    for batch in batches:
        out: dict[str, list] = {"row": [], "kind": [], "hash": [], "check": [], "finger": [], "at": []}
        for row, words in enumerate(hashed_texts(batch, LOWER_ALNUM)):
            if not len(words):
                continue
            size = min(window, len(words))
            kind = 0 if size == window else size
            whole, check = window_hashes(words, size, 0), window_hashes(words, size, 1)
            if kind:
                finger, at = whole, np.zeros(1, np.int64)
            else:
                runs, _ = fingerprints(words, window, guard)
                least = sliding_argmin(runs, guard)
                finger, at = runs[least], least - np.arange(len(least))
            out["row"] += [row] * len(whole)
            out["kind"] += [kind] * len(whole)
            for name, values in (("hash", whole), ("check", check), ("finger", finger)):
                out[name] += values.view(np.int64).tolist()
            out["at"] += at.tolist()
        yield {"item_id": batch.column("item_id").take(pa.array(out["row"], pa.int64())), **out}


def benchmark_windows(items: DataFrame, text: str, id: str, window: int, guard: int) -> DataFrame:
    """One row per item and window: 128-bit content, the fingerprint inside it and its offset."""
    id_type = items.schema[id].dataType.simpleString()
    schema = f"item_id {id_type}, kind int, hash bigint, check bigint, finger bigint, at int"

    def rows(batches):
        for out in _item_rows(batches, window, guard):
            yield pa.RecordBatch.from_arrays(
                [out["item_id"], pa.array(out["kind"], pa.int32()),
                 *(pa.array(out[name], pa.int64()) for name in ("hash", "check", "finger")),
                 pa.array(out["at"], pa.int32())],
                ["item_id", "kind", "hash", "check", "finger", "at"],
            )

    picked = items.where(F.col(id).isNotNull()).select(F.col(id).alias("item_id"), F.col(text).alias("text"))
    return picked.mapInArrow(rows, schema).distinct()


_HIT = pa.struct(
    [("kind", pa.int32()), ("finger", pa.int64()), ("hash", pa.int64()), ("check", pa.int64()), ("start", pa.int32())]
)


def _hits(docs: DataFrame, sieve, lengths: list[int], window: int, guard: int, filter_bits: int) -> DataFrame:
    """Per row: word count, and the windows around every fingerprint that passes the filter."""

    def of_text(words: np.ndarray, table: np.ndarray) -> list[np.ndarray]:
        def passing(values, places):
            return places[in_bit_map(table, values[places], filter_bits)]

        found = []
        for kind in [0, *lengths]:
            length = kind or window
            if len(words) < length:
                continue
            if kind:
                fingers = window_hashes(words, length)
                starts = places = passing(fingers, np.arange(len(fingers)))
            else:
                fingers, places = fingerprints(words, window, guard)
                places = np.repeat(passing(fingers, places), guard)
                starts = places - np.tile(np.arange(guard), len(places) // guard)
                inside = (starts >= 0) & (starts + window <= len(words))
                places, starts = places[inside], starts[inside]
            if len(starts):
                first, second = window_hashes(words, length, 0), window_hashes(words, length, 1)
                hashes = (fingers[places], first[starts], second[starts])
                found.append([np.full(len(starts), kind), *(h.view(np.int64) for h in hashes), starts])
        return found

    def rows(batches):
        table = np.frombuffer(sieve.value, np.uint8)
        for batch in batches:
            n_words, ends, found = [], [0], []
            for words in hashed_texts(batch, LOWER_ALNUM):
                here = of_text(words, table)
                n_words.append(len(words))
                ends.append(ends[-1] + sum(len(x[0]) for x in here))
                found += here
            flat = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 5
            hits = pa.StructArray.from_arrays(
                [pa.array(c).cast(f.type) for c, f in zip(flat, _HIT, strict=True)], fields=list(_HIT)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("content"),
                    pa.array(n_words, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), hits),
                ],
                ["doc_id", "content", "n_words", "hits"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    hit = "struct<kind:int,finger:bigint,hash:bigint,check:bigint,start:int>"
    return docs.mapInArrow(rows, f"doc_id {id_type}, content bigint, n_words bigint, hits array<{hit}>")


def contaminated_words(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    window: int = 13,
    guard: int = 7,
    filter_bits: int = 1 << 26,
) -> DataFrame:
    """Per document row: ``doc_id``, ``n_words``, ``n_hit``, ``items`` (ids with occurring windows, ascending).

    Rows are told apart by id and a hash of the text; rows equal in both have equal answers.
    """
    windows = cut_lineage(benchmark_windows(items, item_text, item_id, window, guard))
    content = ["kind", "finger", "hash", "check"]
    contents = cut_lineage(windows.select(*content).distinct())
    lengths = sorted(r.kind for r in contents.select("kind").where("kind > 0").distinct().collect())
    sieve = docs.sparkSession.sparkContext.broadcast(bit_map(contents, "finger", filter_bits))
    rows = docs.select(
        F.col(id).alias("doc_id"), F.xxhash64(text).alias("content"), F.col(text).alias("text")
    )
    marked = cut_lineage(_hits(rows, sieve, lengths, window, guard, filter_bits))
    hits = marked.where(F.size("hits") > 0).select("doc_id", "content", F.inline("hits"))
    proven = hits.join(contents, content).select("doc_id", "content", *content[:1], "hash", "check", "start").distinct()
    words = F.flatten(
        F.transform(
            F.collect_list(F.struct("start", F.when(F.col("kind") == 0, window).otherwise(F.col("kind")).alias("size"))),
            lambda hit: F.sequence(hit["start"], hit["start"] + hit["size"] - 1),
        )
    )
    row = ["doc_id", "content"]
    n_hit = proven.groupBy(*row).agg(F.size(F.array_distinct(words)).cast("bigint").alias("n_hit"))
    of_window = windows.select("kind", "hash", "check", "item_id").distinct()
    found = proven.select(*row, "kind", "hash", "check").distinct().join(of_window, ["kind", "hash", "check"])
    item_lists = found.groupBy(*row).agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    judged = null_safe_join(n_hit, item_lists, row)
    joined = null_safe_join(marked.drop("hits"), judged, row, "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast(judged.schema["items"].dataType)).alias("items"),
    )
