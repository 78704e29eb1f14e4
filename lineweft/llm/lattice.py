"""Subword lattice language model: the probability of a text, summed over all segmentations.

The pieces of an existing vocabulary are the arcs of a lattice over the characters of a
word; a character without a piece is spelled by byte pieces. A piece's weight is its
probability in the training corpus, counted over the vocabulary's own segmentation of all
different training words, each once, as the discount below takes as much from each of them. A forward recursion in log space adds up all paths, so the result is the
marginal probability of the word. Every word the training corpus holds has one more arc over its
whole length, with absolute discounting: P(w) = max(c - d, 0) / N + d * V / N * lattice(w).
A text is its words and one end; the model and the baseline share the counts c, N and V.

Words are counted in the tasks first, then by a shuffle that grows with the corpus. The most
frequent words, at most ``shipped_words`` of them, are broadcast with their counts and probabilities;
all other words of a document meet their counts in a join, one row per document and word, and come
back as a sum per document. So the broadcast is bounded and no count is lost.

Null and empty texts consist of the end alone. Rows are told apart by id and a hash of
the text; rows equal in both are scored alike. Null ids count as training rows. An empty training
corpus has N = 0 and leaves all probability to the lattice with equal weights.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweft.llm.quality import held_out
from lineweft.llm.tables import null_safe_join
from lineweft.llm.words import LOWER, coded, slices, texts
from lineweft.session import cut_lineage

_REMEMBERED = 1_000_000
_LOG10 = math.log(10)


@dataclass
class Lattice:
    """Piece log weights; ``log_probability`` sums the paths through a word."""

    weights: dict[str, float]
    byte_weights: list[float]
    longest: int

    @classmethod
    def of(cls, model: bytes, counts: np.ndarray) -> Lattice:
        """Weights from piece counts, half a count added to each piece."""
        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        usable = [i for i in range(len(pieces)) if not (pieces.is_control(i) or pieces.is_unknown(i))]
        logs = np.log(counts[usable] + 0.5) - math.log(counts[usable].sum() + 0.5 * len(usable))
        by_id = dict(zip(usable, logs.tolist(), strict=True))
        spelled = {i: pieces.id_to_piece(i) for i in usable if not pieces.is_byte(i)}
        byte_weights = [by_id[pieces.piece_to_id(f"<0x{b:02X}>")] for b in range(256)]
        return cls({p: by_id[i] for i, p in spelled.items()}, byte_weights, max(map(len, spelled.values())))

    def log_probability(self, word: str) -> float:
        """Natural log of the sum over all segmentations of a word, its start marked."""
        marked = "▁" + word
        get, longest = self.weights.get, self.longest
        forward = [0.0]
        for end in range(1, len(marked) + 1):
            reached = []
            for start in range(max(0, end - longest), end):
                weight = get(marked[start:end])
                if weight is not None:
                    reached.append(forward[start] + weight)
            if get(marked[end - 1]) is None:
                reached.append(forward[end - 1] + sum(self.byte_weights[b] for b in marked[end - 1].encode()))
            best = max(reached)
            forward.append(best + math.log(sum([math.exp(x - best) for x in reached])))
        return forward[-1]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts; tasks add up within bounds before the shuffle does."""

    def rows(batches):
        counts: Counter = Counter()
        for batch in batches:
            for some in slices(batch):
                words, codes, _ = coded(some, LOWER)
                times = np.bincount(codes, minlength=len(words))
                for word, n in zip(words.to_pylist(), times.tolist(), strict=True):
                    if n:
                        counts[word] += n
                if len(counts) > _REMEMBERED:
                    yield table(counts)
                    counts.clear()
        yield table(counts)

    def table(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["word", "n"],
        )

    return docs.select("text").mapInArrow(rows, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def piece_counts(counts: DataFrame, model: bytes, size: int) -> np.ndarray:
    """How often the segmentations of all counted words, each taken once, use each piece."""
    shipped = counts.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        pieces = sentencepiece.SentencePieceProcessor(model_proto=shipped.value)
        sums = np.zeros(size)
        for batch in batches:
            ids = pieces.encode(batch.column("word").to_pylist(), num_threads=1)
            sums += np.bincount(np.array([i for some in ids for i in some], np.int64), minlength=size)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums[used])], ["piece", "n"])

    found = counts.mapInArrow(rows, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size)
    out[found.column("piece").to_numpy()] = found.column("n").to_numpy()
    return out


def _word_log10(count: int, lattice_log: float, n: int, v: int, discount: float) -> float:
    """Discounted share of the word plus the mass left over, spread by the lattice."""
    left = discount * v / n if n else 1.0
    spread = math.log(left) + lattice_log
    if count <= discount or not n:
        return spread / _LOG10
    whole = math.log((count - discount) / n)
    high, low = max(whole, spread), min(whole, spread)
    return (high + math.log1p(math.exp(low - high))) / _LOG10


def score_texts(
    docs: DataFrame,
    model_path: str,
    text: str = "text",
    id: str = "doc_id",
    held_out_remainder: int = 1,
    shipped_words: int = 200_000,
    discount: float = 0.75,
) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    with open(model_path, "rb") as file:
        model = file.read()
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    training = rows.where(~held_out(F.col("doc_id"), held_out_remainder))
    counts = cut_lineage(word_counts(training))
    total = counts.agg(F.sum("n"), F.count("*")).first()
    ends = training.select("doc_id").count()
    n, v = (total[0] or 0) + ends, total[1] + (1 if ends else 0)
    size = len(sentencepiece.SentencePieceProcessor(model_proto=model))
    lattice = Lattice.of(model, piece_counts(counts, model, size))
    top = counts.orderBy(F.desc("n"), "word").limit(shipped_words).toArrow()
    frequent = {
        word.encode(): (
            math.log10(count + 0.5),
            _word_log10(count, lattice.log_probability(word), n, v, discount),
        )
        for word, count in zip(top.column("word").to_pylist(), top.column("n").to_pylist(), strict=True)
    }
    shared = context.broadcast((frequent, lattice))
    end_base = math.log10(ends + 0.5)
    end_score = math.log10(max(ends - discount, discount) / n) if n else 0.0
    per_token = math.log10(n + 0.5 * (v + 1))

    def partial(batches):
        frequent, lattice = shared.value
        known: dict[bytes, float] = {}
        for batch in batches:
            sums, rare, ends_at = [], [], [0]
            for value in texts(batch):
                base = own = 0.0
                n_tokens, n_known = 1, 0
                for word, times in Counter((value or b"").translate(LOWER).split()).items():
                    n_tokens += times
                    found = frequent.get(word)
                    if found is not None:
                        base += times * found[0]
                        own += times * found[1]
                        n_known += times
                        continue
                    log = known.get(word)
                    if log is None:
                        if len(known) > _REMEMBERED:
                            known.clear()
                        log = known[word] = lattice.log_probability(word.decode(errors="replace"))
                    rare.append((word, times, log))
                sums.append((n_tokens, n_known, base, own))
                ends_at.append(len(rare))
            columns = list(zip(*sums, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
            words, times, logs = zip(*rare, strict=True) if rare else ((), (), ())
            found = pa.StructArray.from_arrays(
                [pa.array(words, pa.binary()).cast(pa.string()), pa.array(times, pa.int64()), pa.array(logs, pa.float64())],
                ["word", "times", "log"],
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("content")]
                + [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                + [pa.ListArray.from_arrays(pa.array(ends_at, pa.int32()), found)],
                ["doc_id", "content", "n_tokens", "n_known", "base", "own", "rare"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, content bigint, n_tokens bigint, n_known bigint, base double, own double, "
        "rare array<struct<word: string, times: bigint, log: double>>"
    )
    keyed = rows.select("doc_id", F.xxhash64("text").alias("content"), "text")
    scored = cut_lineage(keyed.mapInArrow(partial, schema))
    key = ["doc_id", "content"]
    # Rows equal in id and text are one here, and get the same sums.
    each = scored.where(F.size("rare") > 0).dropDuplicates(key).select(*key, F.inline("rare"))
    met = each.join(counts.select("word", "n"), "word", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    left = math.log(discount * v / n) if n else 0.0
    spread = F.lit(left) + F.col("log")
    whole = F.log((F.col("c") - discount) / F.lit(float(max(n, 1))))
    high, low = F.greatest(whole, spread), F.least(whole, spread)
    own = F.when(F.col("c") <= discount, spread).otherwise(high + F.log1p(F.exp(low - high))) / _LOG10
    rare = met.groupBy(*key).agg(
        F.sum(F.col("times") * F.log10(F.col("c") + 0.5)).alias("rare_base"),
        F.sum(F.col("times") * own).alias("rare_own"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    whole_rows = null_safe_join(scored.drop("rare"), rare, key, "left")

    def plus(column, more):
        return F.col(column) + F.coalesce(more, F.lit(0))

    return whole_rows.select(
        "doc_id",
        held_out(F.col("doc_id"), held_out_remainder).alias("held_out"),
        "n_tokens",
        (plus("n_known", "rare_known") + (1 if ends else 0)).cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (plus("base", "rare_base") + end_base - F.col("n_tokens") * per_token).alias("base_score"),
        (plus("own", "rare_own") + end_score).alias("score"),
    )
