"""Words of a text as bytes, their hashes and the hashes of word windows, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: A word's hash is remembered as long as a task has seen fewer different words than this.
_REMEMBERED = 1_000_000
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

#: Byte tables: A-Z lower-cased; the same with every other ASCII sign but digits as a blank.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LOWER_ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


class WordHashes(dict):
    """Stable 64-bit hashes of words, worked out when first asked for."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def hashed(words: list[bytes], known: WordHashes) -> np.ndarray:
    """Hashes of ``words``; ``known`` keeps those seen before and is emptied when it grows too large."""
    if len(known) > _REMEMBERED:
        known.clear()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def coded(texts: pa.Array, table: bytes | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, codes, ends): the different words of some texts, which of them each word is, and where each text's words end.

    Words are what stands between ASCII white space, after ``table`` has replaced bytes. Split
    and coded by Arrow for all texts at once; null texts have no words.
    """
    whole = pc.fill_null(texts.cast(pa.large_binary()), b"")
    places = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = bytes(memoryview(whole.buffers()[2])[places[0] : places[-1]]) if whole.buffers()[2] else b""
    data = data.translate(table) if table else data
    clean = pa.LargeStringArray.from_buffers(len(whole), pa.py_buffer(places - places[0]), pa.py_buffer(data))
    lists = pc.ascii_split_whitespace(clean)
    words = lists.flatten().cast(pa.large_binary()).dictionary_encode()
    codes = words.indices.to_numpy().astype(np.int64)
    # White space at the ends of a text leaves an empty word there.
    real = pc.greater(pc.binary_length(words.dictionary), 0).to_numpy(zero_copy_only=False)
    keep = real[codes] if len(codes) else np.zeros(0, bool)
    so_far = np.concatenate([[0], np.cumsum(keep)])
    ends = so_far[lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()] if len(whole) else np.zeros(0, np.int64)
    return words.dictionary, codes[keep], ends


def slices(batch: pa.RecordBatch, column: str = "text", text_bytes: int = 8 << 20) -> Iterator[pa.Array]:
    """Runs of a batch's texts of up to ``text_bytes``, one text at least."""
    texts = batch.column(column)
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + text_bytes, "right")))
        yield texts.slice(at, end - at)
        at = end


def hashed_texts(batch: pa.RecordBatch, table: bytes | None = None, column: str = "text") -> Iterator[np.ndarray]:
    """The hashes of the words of each text of a batch, in order; each different word of a run of texts is hashed once."""
    for some in slices(batch, column):
        words, codes, ends = coded(some, table)
        each = np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))
        start, values = 0, each[codes]
        for end in ends.tolist():
            yield values[start:end]
            start = end


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of sums, so that low bits and order depend on all of them."""
    with np.errstate(over="ignore"):
        values = values ^ (values >> np.uint64(32))
        values = values * np.uint64(0xD6E8FEB86659FD93)
        values = values ^ (values >> np.uint64(32))
        values = values * np.uint64(0xD6E8FEB86659FD93)
        return values ^ (values >> np.uint64(32))


def window_hashes(words: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """One hash for each run of ``length`` words; ``which`` picks one of two independent functions."""
    if len(words) < length or length < 1:
        return np.empty(0, np.uint64)
    base = int(_BASES[which])
    total, covered = None, 0
    power, width, powered = words, 1, base
    rest = length
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                n = len(words) - covered - width + 1
                part = power[covered : covered + n]
                weight = np.uint64(pow(base, covered, 1 << 64))
                total = part * weight if total is None else total[:n] + part * weight
                covered += width
            rest >>= 1
            if rest:
                power = power[: len(power) - width] + power[width:] * np.uint64(powered)
                powered = powered * powered % (1 << 64)
                width *= 2
        return mixed(total[: len(words) - length + 1] + np.uint64(length))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, the position of its first least one."""
    if len(values) < width:
        return np.empty(0, np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(values, width)
    return runs.argmin(axis=1) + np.arange(len(runs))


def covered(starts: np.ndarray, lengths: int | np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a run that begins at one of ``starts``."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + lengths, -1)
    return np.cumsum(edges[:n]) > 0


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes | None]:
    """The texts of a batch as UTF-8 bytes, one at a time."""
    for value in batch.column(column).cast(pa.large_binary()):
        yield value.as_py()
