"""N-gram Jaccard join by PartEnum signatures: similar sets agree on some subset of partitions.

A document is the set of its distinct word shingles. Documents with the same set are one
class from the start, whatever their number. Classes are banded by size so that similar
sets lie in the same or neighbouring bands; a set is signed for its own band and the next
one. Within a band similar sets differ in at most k features, k following from the threshold
and the band's largest size. The feature domain is hashed into ``n1`` partitions of ``n2``
parts each; one of the ``n1`` holds at most ``k2`` differences, so that for one choice of
``n2 - k2`` of its parts both sets agree exactly. A signature is the hash of the features
in such a choice of parts: no similar pair misses a common one.

At lower thresholds a signature holds few features, and one of none at all is common to sets that
have nothing to do with each other. Sets are then signed by their rarest features instead: of
two similar sets with the features in one order each has a common one among its first
``n_shingles - need + 1``, where ``need`` is the least overlap. The order is by the number of classes that
hold a feature, counted exactly. What no other class holds counts, but is neither moved nor signed.

Signatures meet in a map-side ``min``, and only those of two classes go on. Candidates are put
into blocks of bounded content, and blocks that share a signature are compared whole, one
pair of blocks in a task's memory at a time: every candidate is verified on whole sets, no pair of
documents is ever a row, and a pair of blocks gives only the links of a spanning forest.

Null texts and texts without words have the empty set and link with nothing. Rows with the same id are one
document for components. Null ids never name a component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweft.llm.components import components
from lineweft.llm.tables import bit_map, in_bit_map
from lineweft.llm.words import LOWER, hashed_texts, mixed, window_hashes
from lineweft.session import cut_lineage, drop_tables, written_tables

_FILTER_BITS = 1 << 27
_REMEMBERED = 1_000_000
_SALTS = 16
#: Sets that are compared with all others at a time.
_COMPARED = 64
#: With fewer features in a signature, as the threshold and the parts have it, sets are signed by their rarest ones.
_LEAST_FEATURES = 6
#: Features that a task gives on at a time, so that long texts do not fill its memory.
_GIVEN = 1 << 20


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of the ``n``-word shingles of a text's word hashes, ascending; fewer words are one shingle."""
    return np.unique(window_hashes(words, min(n, len(words))))


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


class Bands:
    """Sizes cut into ranges whose ends differ by the threshold, as parts of a hundred."""

    def __init__(self, percent: int):
        self.percent = percent
        self.last = [0]

    def of(self, size: int) -> int:
        while self.last[-1] < size:
            self.last.append((self.last[-1] + 1) * 100 // self.percent)
        return int(np.searchsorted(self.last, size))

    def differences(self, band: int) -> int:
        """How many features two similar sets of at most the band's size can differ in."""
        self.of(self.last[-1] + 1) if band >= len(self.last) else None
        return 2 * self.last[band] * (100 - self.percent) // (100 + self.percent)


def signatures(shingles: np.ndarray, bands: Bands, k2: int, n2: int) -> np.ndarray:
    """Signatures of a set for its band and the next; equal sets of one feature need none."""
    out = []
    own = bands.of(len(shingles))
    for band in (own, own + 1):
        k = bands.differences(band)
        if not k:
            continue
        k2_here = min(k2, k)
        n1 = -(-(k + 1) // (k2_here + 1))
        n2_here = max(n2, k2_here + 1) if k2_here else 1
        parts = ((shingles >> np.uint64(17)) % np.uint64(n1 * n2_here)).astype(np.int64)
        # Halves of the hashes are added as floats below 2**53, that is exactly.
        low = np.bincount(parts, (shingles & np.uint64(0xFFFFFFFF)).astype(np.float64), n1 * n2_here)
        high = np.bincount(parts, (shingles >> np.uint64(32)).astype(np.float64), n1 * n2_here)
        with np.errstate(over="ignore"):
            sums = low.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + high.astype(np.uint64) * np.uint64(
                0xC2B2AE3D27D4EB4F
            )
            sums = sums.reshape(n1, n2_here)
            for choice, chosen in enumerate(combinations(range(n2_here), n2_here - k2_here)):
                place = np.arange(n1, dtype=np.uint64) * np.uint64(1 << 16) + np.uint64(choice + (band << 40))
                out.append(mixed(sums[:, chosen].sum(axis=1) + mixed(place)))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _node(key: bytes) -> int:
    """A class in signature rows: 64 bits of its key. Links carry the whole key."""
    return int.from_bytes(key[:8], "little", signed=True)


def signed_documents(docs: DataFrame, n: int, percent: int, k2: int, n2: int) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``key`` of the set (null if empty), ``node`` and ``signatures``.

    A task signs a class once; its other rows carry no signatures.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches):
        bands, done = Bands(percent), set()
        for batch in batches:
            sizes, keys, nodes, signed = [], [], [], []
            for words in hashed_texts(batch, LOWER):
                found = shingle_set(words, n)
                key = set_key(found) if len(found) else None
                sizes.append(len(found))
                keys.append(key)
                nodes.append(_node(key) if key else None)
                if key is None or key in done:
                    signed.append(None)
                    continue
                if len(done) < _REMEMBERED:
                    done.add(key)
                signed.append(signatures(found, bands, k2, n2).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(nodes, pa.int64()), pa.array(signed, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "key", "node", "signatures"],
            )

    schema = f"doc_id {id_type}, n_shingles bigint, key binary, node bigint, signatures array<bigint>"
    return docs.mapInArrow(rows, schema)


def signature_features(percent: int, k2: int, n2: int) -> float:
    """About how many features a signature of the largest set of a band holds."""
    return (100 + percent) / (2 * max(100 - percent, 1)) * (k2 + 1) * (n2 - k2) / n2


def _classes(batch: pa.RecordBatch, n: int, done: set) -> Iterator[tuple[bytes, np.ndarray]]:
    """(key, shingles) of a batch's sets that are not empty and not in ``done``, which remembers them."""
    for words in hashed_texts(batch, LOWER):
        found = shingle_set(words, n)
        key = set_key(found) if len(found) else None
        if key is None or key in done:
            continue
        if len(done) < _REMEMBERED:
            done.add(key)
        yield key, found


def sized_documents(docs: DataFrame, n: int) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles`` and ``key`` of the set (null if empty)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches):
        for batch in batches:
            sets = [(len(found), set_key(found) if len(found) else None) for found in (shingle_set(words, n) for words in hashed_texts(batch, LOWER))]
            columns = [pa.array([x[at] for x in sets], kind) for at, kind in enumerate((pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_shingles", "key"])

    return docs.mapInArrow(rows, f"doc_id {id_type}, n_shingles bigint, key binary")


def shared_features(docs: DataFrame, n: int) -> DataFrame:
    """(signature, copies): features that several classes hold, with the number of those; copies of a class count once a task."""

    def rows(batches):
        done, waiting, size = set(), [], 0

        def given():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(waiting).view(np.int64))], ["signature"])

        for batch in batches:
            for _, found in _classes(batch, n, done):
                waiting.append(found)
                size += len(found)
                if size >= _GIVEN:
                    yield given()
                    waiting, size = [], 0
        if waiting:
            yield given()

    each = docs.select("text").mapInArrow(rows, "signature bigint")
    return each.groupBy("signature").agg(F.count("*").alias("copies")).where("copies > 1")


def _need(size, percent: int):
    """The least overlap of a set with one that is similar to it."""
    return -(-percent * size // 100)


def sharing_sets(docs: DataFrame, shared: DataFrame, n: int, percent: int) -> DataFrame:
    """``node``, ``key``, ``n_shingles`` and ``shingles`` of the classes, once each, that share enough features with others to be similar to any.

    Nearly only of those: a bit map of fixed size says which features are shared.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(bit_map(shared, "signature", _FILTER_BITS))

    def rows(batches):
        table, done = np.frombuffer(wanted.value, np.uint8), set()

        def given(sets):
            keys = [key for key, _ in sets]
            return pa.RecordBatch.from_arrays(
                [pa.array([_node(key) for key in keys], pa.int64()), pa.array(keys, pa.binary()),
                 pa.array([len(found) for _, found in sets], pa.int64()),
                 pa.array([found.view(np.int64) for _, found in sets], pa.list_(pa.int64()))],
                ["node", "key", "n_shingles", "shingles"],
            )

        waiting, size = [], 0
        for batch in batches:
            for key, found in _classes(batch, n, done):
                if in_bit_map(table, found, _FILTER_BITS).sum() >= _need(len(found), percent):
                    waiting.append((key, found))
                    size += len(found)
                if size >= _GIVEN:
                    yield given(waiting)
                    waiting, size = [], 0
        yield given(waiting)

    found = docs.select("text").mapInArrow(rows, "node bigint, key binary, n_shingles bigint, shingles array<bigint>")
    return found.repartition("node").dropDuplicates(["node", "key"])


def rarest_features(sets: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """(node, n_shingles, signature): of a set's features the rarest, so many that two similar sets have one in common.

    The features that only this set holds are the first of them and not given.
    """
    each = sets.select("node", "key", "n_shingles", F.explode("shingles").alias("signature")).join(shared, "signature")
    ranked = each.groupBy("node", "key", "n_shingles").agg(
        F.sort_array(F.collect_list(F.struct("copies", "signature"))).alias("features")
    )
    need = F.expr(f"int((n_shingles * {percent} + 99) div 100)")
    first = F.slice("features", F.lit(1), F.greatest(F.size("features") - need + 1, F.lit(0)))
    return ranked.select("node", "n_shingles", F.explode(first).alias("f")).select("node", "n_shingles", "f.signature")


def _passing(signed: DataFrame, shared: DataFrame) -> DataFrame:
    """Signature rows, nearly only the shared ones: a bit map of fixed size keeps the rest from the shuffle."""
    wanted = signed.sparkSession.sparkContext.broadcast(bit_map(shared, "signature", _FILTER_BITS))

    def rows(batches):
        table = np.frombuffer(wanted.value, np.uint8)
        for batch in batches:
            lists = batch.column("signatures")
            values = lists.flatten().to_numpy(zero_copy_only=False)
            owners = np.repeat(np.arange(len(batch)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            keep = in_bit_map(table, values.view(np.uint64), _FILTER_BITS)
            owner = pa.array(owners[keep])
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(owner), batch.column("n_shingles").take(owner), pa.array(values[keep])],
                ["node", "n_shingles", "signature"],
            )

    rows_of = signed.where(F.size("signatures") > 0).select("node", "n_shingles", "signatures")
    return rows_of.mapInArrow(rows, "node bigint, n_shingles bigint, signature bigint")


def _leaders(each: DataFrame) -> DataFrame:
    """(signature, leader) of signatures of several classes: the least member leads, found by a map-side ``min``."""
    met = each.groupBy("signature").agg(F.min("node").alias("leader"), F.max("node").alias("other"))
    return cut_lineage(met.where("leader <> other").select("signature", "leader"))


def signature_members(signed: DataFrame) -> DataFrame:
    """(node, n_shingles, signature, leader): the signatures that several classes have."""
    shared = _leaders(
        signed.where(F.size("signatures") > 0).select("node", "n_shingles", F.explode("signatures").alias("signature"))
    )
    return cut_lineage(_passing(signed, shared).join(shared, "signature").distinct())


def candidate_blocks(members: DataFrame, capacity: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of candidates, and the pairs of blocks that share a signature.

    Members and leaders make families; a family is cut by size band and hash into blocks of about ``capacity``
    shingles, so a set is sent once for each other block its own meets, not once for each other set.
    """
    families = components(members.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct())
    nodes = members.select("node", "n_shingles").distinct().join(families, "node")
    weights = nodes.groupBy("label").agg(F.ceil(F.sum("n_shingles") / F.lit(capacity)).alias("blocks"))
    blocks = cut_lineage(
        nodes.join(weights, "label").select(
            "node", F.xxhash64("label", F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("block")
        )
    )
    placed = members.join(blocks, "node").select("signature", "block").distinct()
    pairs = (
        placed.withColumnRenamed("block", "one")
        .join(placed.withColumnRenamed("block", "two"), "signature")
        .where("one <= two")
        .select("one", "two")
        .distinct()
    )
    return blocks, pairs


def candidate_sets(docs: DataFrame, blocks: DataFrame, n: int) -> DataFrame:
    """``node``, ``key`` and ``shingles`` of the candidate classes, once each."""
    wanted = docs.sparkSession.sparkContext.broadcast(bit_map(blocks, "node", _FILTER_BITS))

    def rows(batches):
        table, done = np.frombuffer(wanted.value, np.uint8), set()
        for batch in batches:
            nodes, keys, sets = [], [], []
            for words in hashed_texts(batch, LOWER):
                found = shingle_set(words, n)
                key = set_key(found) if len(found) else None
                if key is None or key in done:
                    continue
                node = np.array([_node(key)], np.int64)
                if in_bit_map(table, node.view(np.uint64), _FILTER_BITS)[0]:
                    if len(done) < _REMEMBERED:
                        done.add(key)
                    nodes.append(int(node[0]))
                    keys.append(key)
                    sets.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                ["node", "key", "shingles"],
            )

    found = docs.select("text").mapInArrow(rows, "node bigint, key binary, shingles array<bigint>")
    # Dealt by node, as they are then joined; a task has left out its own copies, so the shuffle sends no more for it.
    return found.repartition("node").dropDuplicates(["node", "key"])


def _links(sets: list[np.ndarray], left: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs (left, any later) of sets whose similarity reaches the threshold.

    Some left sets at a time are counted against all by a product of tables that have only
    those sets' features as columns, so memory follows the number of sets and not that of features.
    """
    sizes = np.array([len(s) for s in sets])
    _, columns = np.unique(np.concatenate(sets), return_inverse=True)
    owners = np.repeat(np.arange(len(sets)), sizes)
    shared = np.bincount(columns)[columns] > 1
    columns, owners = columns[shared], owners[shared]
    place = np.full(int(columns.max(initial=0)) + 1, -1)
    for first in range(0, len(left), _COMPARED):
        part = left[first : first + _COMPARED]
        used = np.unique(columns[np.isin(owners, part)])
        place[:] = -1
        place[used] = np.arange(len(used))
        here = place[columns] >= 0
        table = np.zeros((len(sets), len(used)), np.float32)
        table[owners[here], place[columns[here]]] = 1
        common = table[part] @ table.T
        union = sizes[part][:, None] + sizes[None, :] - common
        linked = 100 * common.astype(np.int64) >= percent * union.astype(np.int64)
        for at, other in zip(*np.nonzero(linked), strict=True):
            if part[at] != other:
                yield int(part[at]), int(other)


def verified_links(blocks: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between keys that join what similar sets join: a spanning forest per pair of blocks."""
    sides = pairs.select("one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("block"))
    # Nodes meet their pairs of blocks first, so sets move twice only: to their nodes, then to the pairs.
    wanted = blocks.join(sides, "block").select("node", "one", "two", (F.col("block") == F.col("one")).alias("left"))
    filled = sets.join(wanted, "node").select("one", "two", "left", "key", "shingles")

    def compare(rows):
        keys = [row[3] for row in rows]
        left = np.array([at for at, row in enumerate(rows) if row[2]], np.int64)
        roots = list(range(len(rows)))

        def root(at):
            while roots[at] != at:
                roots[at] = at = roots[roots[at]]
            return at

        for a, b in _links([row[4] for row in rows], left, percent) if len(left) and len(rows) > 1 else ():
            a, b = root(a), root(b)
            if a != b:
                roots[b] = a
                yield keys[a], keys[b]

    def linked(batches):
        waiting, here = [], None
        for batch in batches:
            ones, twos = batch.column("one").to_pylist(), batch.column("two").to_pylist()
            lefts, keys = batch.column("left").to_pylist(), batch.column("key").to_pylist()
            shingles = batch.column("shingles")
            ends = shingles.offsets.to_numpy() - shingles.offsets[0].as_py()
            flat = shingles.flatten().to_numpy(zero_copy_only=False)
            out = []
            for at, pair in enumerate(zip(ones, twos, strict=True)):
                if pair != here:
                    out += compare(waiting)
                    waiting, here = [], pair
                waiting.append((*pair, lefts[at], keys[at], flat[ends[at] : ends[at + 1]]))
            yield _link_rows(out)
        yield _link_rows(list(compare(waiting)))

    dealt = filled.repartition("one", "two").sortWithinPartitions("one", "two")
    return dealt.mapInArrow(linked, "a binary, b binary")


def _link_rows(links: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.binary()) for i in (0, 1)], ["a", "b"])


def similar_documents(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    shingle_words: int = 3,
    percent: int = 90,
    k2: int = 1,
    n2: int = 2,
    capacity: int = 1 << 18,
) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles`` and ``component_id``, the least id reachable by links."""
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    rarest = signature_features(percent, k2, n2) < _LEAST_FEATURES
    if rarest:
        shared = cut_lineage(shared_features(rows, shingle_words))
        sets = cut_lineage(sharing_sets(rows, shared, shingle_words, percent))
        begun, sized = written_tables(), sized_documents(rows, shingle_words)
        each = cut_lineage(rarest_features(sets, shared, percent))
        members = cut_lineage(each.join(_leaders(each), "signature").distinct())
    else:
        begun = written_tables()
        sized = signed = cut_lineage(signed_documents(rows, shingle_words, percent, k2, n2))
        members = signature_members(signed)
    blocks, pairs = candidate_blocks(members, capacity)
    pairs = cut_lineage(pairs)
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)).cast("int").alias("salt")
    slim = cut_lineage(sized.select("doc_id", "n_shingles", "key", salt))
    # Signatures and what led from them to the blocks are not read again: the last three tables are left.
    drop_tables(rows.sparkSession, begun, but_last=3)
    sets = sets.select("node", "key", "shingles") if rarest else candidate_sets(rows, blocks, shingle_words)
    links = verified_links(blocks, pairs, sets, percent)
    labels = components(links).withColumnRenamed("node", "key")
    classes = slim.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("copies")
    )
    grouped = classes.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    named = grouped.join(grouped.groupBy("label").agg(F.min("least").alias("component_id")), "label")
    # Only rows whose class has copies or links can have another row's id; those stand under every salt.
    told = named.where((F.col("copies") > 1) | (F.col("component_id") < F.col("least"))).select(
        "key", "component_id", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt")
    )
    return slim.join(told, ["key", "salt"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
