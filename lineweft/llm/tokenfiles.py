"""Token ids in files: fixed-size blocks of ids, transposed into planes, each plane compressed.

Documents are ordered by a range shuffle on their id, so every part holds a run of them and
parts follow one another. A part is cut into chunks of ``chunk_ids`` ids, documents running
on across chunks. A chunk is stored as planes: plane p holds byte p (or bit p) of each id, so
the nearly constant high planes shrink to nothing under zstandard. Its row is also its index entry:
where its ids begin in the part, and which piece of which document lies where in it. Rows
are written by Spark as Parquet, so any store that Spark reaches will do.

Null and empty texts hold the end id alone. Null ids come first. Rows with the same id lie in the order of a hash of
their texts and are told apart by their place. Where a text spells one of the tokenizer's added tokens, such as ``<|endoftext|>``,
it becomes that token, as in the library. Columns other than id and text are not touched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineweft.llm.words import LOWER, coded, slices

_REMEMBERED = 900_000
#: Texts are encoded in runs of this many bytes; what a run takes beside them is some ten times that.
_TEXT_BYTES = 2 << 20
_BETWEEN = "|"
_tokenizers: dict[str, tuple] = {}


def _tokenizer(path: str):
    """The tokenizer of a file, the words it has seen, the id of the sign put between words and its added tokens, once per worker."""
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        (between,) = tokenizer.encode(_BETWEEN, add_special_tokens=False).ids
        added = [token.content.lower() for token in tokenizer.get_added_tokens_decoder().values()]
        _tokenizers[path] = (tokenizer, {}, between, added)
    return _tokenizers[path]


def text_ids(some: pa.Array, path: str, lower: bool) -> Iterator[bytes]:
    """Ids of some texts, each as little-endian 32-bit integers, as the library encodes them without adding tokens.

    A text that spells an added token, such as an end of text, may hold it across words; it is
    encoded whole. All others are put together from the ids of the texts' different words.
    """
    tokenizer, _, _, added = _tokenizer(path)
    # Lower-casing A-Z first changes nothing for a tokenizer that lower-cases, and saves words.
    words, codes, ends = coded(some, LOWER if lower else None)
    each = word_ids(words.to_pylist(), path)
    sizes = np.fromiter(map(len, each), np.int64, len(each)) // 4
    starts, flat = np.concatenate([[0], np.cumsum(sizes)]), np.frombuffer(b"".join(each), "<u4")
    lengths = sizes[codes]
    before = np.concatenate([[0], np.cumsum(lengths)])
    ids = flat[np.repeat(starts[codes] - before[:-1], lengths) + np.arange(before[-1])]
    spelled = np.zeros(len(some), bool)
    for token in added:
        spelled |= pc.fill_null(pc.match_substring(pc.ascii_lower(some), token), False).to_numpy(zero_copy_only=False)
    start = 0
    for at, end in enumerate(before[ends].tolist()):
        if spelled[at]:
            found = tokenizer.encode(some[at].as_py(), add_special_tokens=False).ids
            yield np.array(found, "<u4").tobytes()
        else:
            yield ids[start:end].tobytes()
        start = end


def word_ids(words: list[bytes], path: str) -> list[bytes]:
    """Ids of different words, each as little-endian 32-bit integers.

    For tokenizers that drop white space and never merge across it, a text's ids are those
    of its words. New words are encoded in one text, a sign of one token between them, and
    remembered within bounds; a word that holds the sign is encoded by itself.
    """
    tokenizer, known, between, _ = _tokenizer(path)
    if len(known) > _REMEMBERED:
        known.clear()
    new = [word for word in words if word not in known]
    sign = _BETWEEN.encode()
    for word in [w for w in new if sign in w]:
        ids = tokenizer.encode(word.decode(errors="replace"), add_special_tokens=False).ids
        known[word] = np.array(ids, "<u4").tobytes()
    if new := [w for w in new if sign not in w]:
        joined = f" {_BETWEEN} ".join(word.decode(errors="replace") for word in new)
        # The same ids as ``encode`` gives, without the places in the text, which nobody asks for.
        (found,) = tokenizer.encode_batch_fast([joined], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        data, places = ids.tobytes(), 4 * np.flatnonzero(ids == between)
        if len(places) != len(new) - 1:
            raise ValueError("a word holds the sign between words")
        parts = map(slice, [0, *(places + 4).tolist()], [*places.tolist(), len(data)])
        known.update(zip(new, map(data.__getitem__, parts), strict=True))
    return [known[word] for word in words]


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Compressed planes of 32-bit ids, lowest first; trailing planes of zeros are left out."""
    shape = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    planes = list(shape.T)
    if bits:
        planes = [np.packbits(plane >> b & 1) for plane in planes for b in range(8)]
    while planes and not planes[-1].any():
        planes.pop()
    return [zstandard.compress(plane.tobytes(), 3) for plane in planes]


def from_planes(planes: list[bytes], n: int, bits: bool = False) -> np.ndarray:
    out = np.zeros((n, 4), np.uint8)
    for at, data in enumerate(planes):
        plane = np.frombuffer(zstandard.decompress(data), np.uint8)
        if bits:
            out[:, at // 8] |= np.unpackbits(plane, count=n) << (at % 8)
        else:
            out[:, at] = plane
    return out.view("<u4").reshape(-1)


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    text: str = "text",
    id: str = "doc_id",
    chunk_ids: int = 1 << 16,
    bits: bool = False,
    lower: bool = True,
) -> None:
    """Encode all documents in ascending order of their ids and write the chunks.

    ``lower`` says that the tokenizer lower-cases its input.
    """
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")
    names = ["doc", "doc_id", "piece", "last", "start", "at", "n"]

    def encoded(batch):
        for some in slices(batch, text_bytes=_TEXT_BYTES):
            for ids in text_ids(some, tokenizer, lower):
                yield ids + end

    def chunks(batches):
        part, chunk, first = TaskContext.get().partitionId(), 0, 0
        buffer, pieces, doc, position = bytearray(), [], 0, 0

        def flush(n):
            nonlocal chunk, first, buffer, pieces
            ids = np.frombuffer(bytes(buffer[: 4 * n]), "<u4")
            row = {"part": part, "chunk": chunk, "first": first, "n": n, "planes": to_planes(ids, bits), "pieces": pieces}
            chunk, first, buffer, pieces = chunk + 1, first + n, buffer[4 * n :], []
            return pa.RecordBatch.from_pylist([row], schema)

        schema = None
        for batch in batches:
            if schema is None:
                piece = pa.struct(
                    [("doc", pa.int64()), ("doc_id", batch.column("doc_id").type), ("piece", pa.int32()),
                     ("last", pa.bool_()), ("start", pa.int64()), ("at", pa.int32()), ("n", pa.int32())]
                )
                schema = pa.schema(
                    [("part", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n", pa.int32()),
                     ("planes", pa.list_(pa.binary())), ("pieces", pa.list_(piece))]
                )
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded(batch), strict=True):
                total, done, no = len(ids) // 4, 0, 0
                while done < total:
                    at = len(buffer) // 4
                    n = min(chunk_ids - at, total - done)
                    buffer += ids[4 * done : 4 * (done + n)]
                    done += n
                    pieces.append(dict(zip(names, (doc, doc_id, no, done == total, position, at, n), strict=True)))
                    no += 1
                    if at + n == chunk_ids:
                        yield flush(chunk_ids)
                doc, position = doc + 1, position + total
        if buffer:
            yield flush(len(buffer) // 4)

    fields = f"doc: bigint, doc_id: {id_type}, piece: int, last: boolean, start: bigint, at: int, n: int"
    # Rows of one id, or of none, may fall into several parts.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(
        chunks,
        f"part int, chunk int, first bigint, n int, planes array<binary>, pieces array<struct<{fields}>>",
    ).write.parquet(folder)


def chunk_index(spark: SparkSession, folder: str) -> DataFrame:
    """Where each chunk's ids begin among all ids; reads no plane."""
    chunks = spark.read.parquet(folder).select("part", "chunk", "first", "n")
    totals = chunks.groupBy("part").agg(F.sum("n").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("offset"))
    return chunks.join(offsets, "part").select("part", "chunk", (F.col("offset") + F.col("first")).alias("start"), "n")


def read_documents(spark: SparkSession, folder: str, bits: bool = False) -> DataFrame:
    """Documents decoded from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    A document inside one chunk is summed there; the pieces of a longer one meet, at most
    one document in a group.
    """
    chunks = spark.read.parquet(folder)
    id_type = chunks.schema["pieces"].dataType.elementType["doc_id"].dataType.simpleString()

    def pieces(batches):
        for batch in batches:
            out, sums, parts = [], [], []
            for row in batch.to_pylist():
                data = from_planes(row["planes"], row["n"], bits).tobytes()
                for p in row["pieces"]:
                    ids = data[4 * p["at"] : 4 * (p["at"] + p["n"])]
                    whole = p["piece"] == 0 and p["last"]
                    sums.append(zlib.crc32(ids) if whole else None)
                    parts.append(None if whole else ids)
                    out.append((row["part"], p["doc"], p["doc_id"], p["start"], p["piece"], p["n"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [()] * 6, kinds(batch), strict=True)]
                + [pa.array(sums, pa.int64()), pa.array(parts, pa.binary())],
                ["part", "doc", "doc_id", "start", "piece", "n", "crc", "ids"],
            )

    def kinds(batch):
        piece = batch.schema.field("pieces").type.value_type
        return [pa.int32(), pa.int64(), piece.field("doc_id").type, pa.int64(), pa.int32(), pa.int32()]

    found = chunks.select("part", "n", "planes", "pieces").mapInArrow(
        pieces, f"part int, doc bigint, doc_id {id_type}, start bigint, piece int, n int, crc bigint, ids binary"
    )
    docs = found.groupBy("part", "doc").agg(
        F.max("doc_id").alias("doc_id"),
        F.min("start").alias("start"),
        F.sum("n").alias("n_tokens"),
        F.max("crc").alias("crc"),
        F.sort_array(F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("piece", "ids")))).alias("pieces"),
    )
    bytes_ = F.unhex(F.array_join(F.transform("pieces", lambda p: F.hex(p["ids"])), ""))
    offsets = chunk_index(spark, folder).where("chunk = 0").select("part", F.col("start").alias("offset"))
    return docs.join(offsets, "part").select(
        "doc_id",
        (F.col("offset") + F.col("start")).alias("start"),
        "n_tokens",
        F.coalesce("crc", F.crc32(bytes_)).alias("ids_crc32"),
    )
