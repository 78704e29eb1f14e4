"""Quality classifier: learned vectors of hashed words, character n-grams and word pairs, averaged, softmax.

The features of a text are its words (case kept), the character n-grams of each word with
its ends marked, and the pairs of neighbouring words, each hashed to one of ``buckets`` vectors.
The text's vector is the mean over all of them; a softmax over two classes gives the score.
Training is plain stochastic gradient descent with numpy on the driver, over a sample of
labelled rows of documented size: ``max_examples`` rows in the order of a hash of their ids.

The output layer is linear, so scoring needs one number per bucket, the difference of the two
class logits; these ``buckets`` numbers are all that is broadcast. A task remembers the sum
for each word it has met, within bounds, and reads every text whole.

Null and empty texts get the score of the bias alone. Without any labelled row the score is
0.5. A label that occurs in several rows of an id counts as its largest value; null labels
and ids teach nothing. Other columns are not touched, so they cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweft.llm.words import WordHashes, hashed, texts

_REMEMBERED = 1_000_000


@dataclass(frozen=True)
class Settings:
    max_examples: int = 4000
    buckets: int = 1 << 18
    dimensions: int = 16
    shortest: int = 2
    longest: int = 4
    epochs: int = 12
    rate: float = 0.5
    seed: int = 7


def word_grams(word: bytes, settings: Settings) -> list[str]:
    """A word's features by name: itself, and its character n-grams with its ends marked."""
    spelled = word.decode(errors="replace")
    marked = f"<{spelled}>"
    ends = range(len(marked) + 1)
    grams = [marked[at : at + n] for n in range(settings.shortest, settings.longest + 1) for at in ends[: -n or None]]
    grams.append(f"w {spelled}")
    return grams


def bucket(gram: str, settings: Settings) -> int:
    return xxhash.xxh3_64_intdigest(gram.encode(errors="replace")) % settings.buckets


class Remembered(dict):
    """Values worked out when first asked for."""

    def __init__(self, work_out):
        self.work_out = work_out

    def __missing__(self, key):
        value = self[key] = self.work_out(key)
        return value


def pair_features(hashes: np.ndarray, settings: Settings) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
        mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(settings.buckets)).astype(np.int64)


def _feature_rows(settings: Settings):
    """Per text: its different buckets and their shares among all its features."""

    def rows(batches):
        known = WordHashes()
        grams = Remembered(lambda word: np.array([bucket(g, settings) for g in word_grams(word, settings)]))
        for batch in batches:
            buckets, shares = [], []
            for value in texts(batch):
                words = (value or b"").split()
                places, times = [pair_features(hashed(words, known), settings)], []
                if len(grams) > _REMEMBERED:
                    grams.clear()
                times.append(np.ones(len(places[0])))
                for word, count in Counter(words).items():
                    places.append(grams[word])
                    times.append(np.full(len(grams[word]), count))
                used, which = np.unique(np.concatenate(places), return_inverse=True)
                sums = np.bincount(which, np.concatenate(times), len(used))
                buckets.append(used.astype(np.int32))
                shares.append((sums / max(1.0, sums.sum())).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(buckets, pa.list_(pa.int32())),
                 pa.array(shares, pa.list_(pa.float32()))],
                ["doc_id", "label", "buckets", "shares"],
            )

    return rows


def labelled_features(
    docs: DataFrame, labels: DataFrame, settings: Settings, text: str, id: str, label: str
) -> pa.Table:
    """The bounded training sample, featurised by tasks.

    Of several rows with one id the least text is learnt from, and of several labels the largest.
    """
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull())
    one = known.groupBy(F.col(id).alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.max_examples)
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    picked = rows.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct("text")).alias("least"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, label int, buckets array<int>, shares array<float>"
    return picked.select("doc_id", "label", "least.text").mapInArrow(_feature_rows(settings), schema).toArrow()


def train(examples: pa.Table, settings: Settings) -> tuple[np.ndarray, float]:
    """One logit difference per bucket, and the bias."""
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1, 1, (settings.buckets, settings.dimensions)).astype(np.float32) / settings.dimensions
    output = np.zeros((settings.dimensions, 2), np.float32)
    bias = np.zeros(2, np.float32)
    if not len(examples):
        return np.zeros(settings.buckets, np.float32), 0.0
    examples = examples.sort_by("doc_id")
    labels = examples.column("label").to_numpy()
    buckets = [np.asarray(x.values) for x in examples.column("buckets")]
    shares = [np.asarray(x.values) for x in examples.column("shares")]
    total = settings.epochs * len(labels)
    for step, at in enumerate(np.concatenate([rng.permutation(len(labels)) for _ in range(settings.epochs)])):
        rate = np.float32(settings.rate * (1 - step / total))
        used, share = buckets[at], shares[at]
        hidden = share @ vectors[used]
        logits = hidden @ output + bias
        odds = np.exp(logits - logits.max())
        error = odds / odds.sum()
        error[labels[at]] -= 1
        back = output @ error
        output -= rate * np.outer(hidden, error)
        bias -= rate * np.float32(0.1) * error
        # The mean hands each vector only its share of the gradient; as usual it gets the whole of it.
        vectors[used] -= (rate * np.minimum(1, share * len(share)))[:, None] * back[None, :]
    direction = output[:, 1] - output[:, 0]
    return (vectors @ direction).astype(np.float32), float(bias[1] - bias[0])


def scorer(docs: DataFrame, weights: np.ndarray, bias: float, settings: Settings):
    """A function of a text column: the probability of label 1."""
    shipped = docs.sparkSession.sparkContext.broadcast(weights.tobytes())

    @F.arrow_udf("double")
    def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = np.frombuffer(shipped.value, np.float32).astype(np.float64)
        known = WordHashes()
        weights = Remembered(lambda gram: float(table[bucket(gram, settings)]))

        def of_word(word):
            """Sum and number of a word's weights, as one complex number, which adds up both."""
            grams = word_grams(word, settings)
            return complex(sum(map(weights.__getitem__, grams)), len(grams))

        sums = Remembered(of_word)
        for column in columns:
            logits = []
            for value in column.cast(pa.large_binary()):
                words = (value.as_py() or b"").split()
                if len(sums) > _REMEMBERED or len(weights) > 2 * _REMEMBERED:
                    sums.clear()
                    weights.clear()
                pairs = pair_features(hashed(words, known), settings)
                total = sum(map(sums.__getitem__, words), 0j)
                logits.append((total.real + table[pairs].sum()) / max(1.0, total.imag + len(pairs)) + bias)
            yield pa.array(1 / (1 + np.exp(-np.clip(np.array(logits, np.float64), -500, 500))))

    return scored


def held_out(id: Column, remainder: int) -> Column:
    """Whether the crc32 of the id's text leaves ``remainder`` when divided by five; false for null ids."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == remainder, F.lit(False))


def quality_scorer(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    label: str = "quality",
    settings: Settings = Settings(),
):
    """A scoring function of text columns, learned from those labelled rows that are not held out."""
    teaching = labels.where(~held_out(F.col(id), 0))
    return scorer(docs, *train(labelled_features(docs, teaching, settings, text, id, label), settings), settings)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    label: str = "quality",
    threshold: float = 0.3,
    settings: Settings = Settings(),
) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` and ``predicted``, 1 from the threshold on."""
    scored = quality_scorer(docs, labels, text, id, label, settings)
    scores = docs.select(F.col(id).alias("doc_id"), scored(F.col(text)).alias("score"))
    return scores.select(
        "doc_id",
        held_out(F.col("doc_id"), 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
