"""Quality classifier: supervised subword embeddings.

A text is a bag of features: its words, the character n-grams of its bytes, and for each word whether it
repeats the one before, each hashed to one of ``buckets`` rows of a table of vectors. The mean vector goes through a softmax over two classes. Vectors and
softmax are trained together by stochastic gradient descent in numpy, on a sample of at most
``sample_rows`` labelled texts (those with the smallest hash of their id; features are counted per bucket
inside Spark tasks, so at most ``sample_rows * buckets`` numbers reach the driver, whatever the texts'
lengths). Only the text is an input of a score.

Scoring is linear in the mean vector, so each bucket has one number: the gap of the two class logits. All
texts of a batch are hashed together as one buffer of bytes; n-grams end at the ends of a text.

Defined results: a null or empty text has no features, and its score is that of the softmax's bias. Labels
that are null are not learned from; without any label, or with labels of one class only, the score is the
smoothed share of label 1. Repeated rows each get a row. Only the id, the text and the labels are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedloom.llm.common import map_arrow, pieces, utf8

BUCKETS = 1 << 15
NGRAMS = (3, 5)
DIMENSIONS = 8
SAMPLE_ROWS = 4000
EPOCHS = 8
RATE = 0.5
BATCH = 16
THRESHOLD = 0.3
FOLDS = 5
SEED = 11
_PIECE = 1 << 20
_WORD_PRIME = np.uint64(0x9E3779B97F4A7C15)
_GRAM_PRIME = np.uint64(0x100000001B3)
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def _inverse(odd: np.uint64) -> np.uint64:
    """Inverse of an odd number modulo 2^64, by Newton's steps."""
    x = int(odd)
    for _ in range(6):
        x = x * (2 - int(odd) * x) % 2**64
    return np.uint64(x)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mixed(values: np.ndarray, salt: int, buckets: int) -> np.ndarray:
    """Buckets of 64-bit values; ``salt`` keeps kinds of features apart."""
    values = (values + np.uint64(salt)) * _WORD_PRIME
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    return (values >> np.uint64(40)).astype(np.int64) % buckets


def _features(block: np.ndarray, ngrams: tuple[int, ...], buckets: int, texts: np.ndarray | None = None):
    """Yields (bucket, position of the first byte) of all features in a block of bytes; ``texts`` is where each text starts."""
    bytes64 = block.astype(np.uint64) + np.uint64(1)
    for salt, n in enumerate(ngrams, 1):
        if len(block) >= n:
            gram = bytes64[: len(block) - n + 1].copy()
            for k in range(1, n):
                gram = gram * _GRAM_PRIME + bytes64[k : len(block) - n + 1 + k]
            yield _mixed(gram, salt, buckets), np.arange(len(gram)), n
    inside = ~_SPACES[block]
    edges = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if len(starts):
        # A word's hash: the difference of prefix sums of byte * p^position, shifted back to its start.
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(bytes64 * _powers(_WORD_PRIME, len(block)), dtype=np.uint64)))
        back = _powers(_inverse(_WORD_PRIME), len(block))
        words = (sums[ends] - sums[starts]) * back[starts]
        yield _mixed(words, 0, buckets), starts, 0
        # The word pair that says most whatever the words are: a word after itself.
        again = np.flatnonzero(words[1:] == words[:-1]) + 1
        if texts is not None:  # both words are in the same text
            text_of = np.searchsorted(texts, starts, "right")
            again = again[text_of[again] == text_of[again - 1]]
        yield _mixed(np.zeros(len(again), np.uint64), len(ngrams) + 1, buckets), starts[again], 0


def _blocks(texts: list[bytes]):
    """Blocks of about a megabyte: (bytes, starts of texts, index of the first text). A zero byte ends a text.

    A text longer than that is cut at white space; its parts come as blocks of their own.
    """
    held, first, size = [], 0, 0
    for at, text in enumerate(texts):
        if len(text) > _PIECE:
            if held:
                yield held, first
            for piece in pieces(text, _PIECE):
                yield [piece], at
            held, first, size = [], at + 1, 0
            continue
        held.append(text)
        size += len(text)
        if size >= _PIECE:
            yield held, first
            held, first, size = [], at + 1, 0
    if held:
        yield held, first


def _joined(held: list[bytes], widest: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one buffer, and where each starts; spaces between them are as wide as an n-gram."""
    gap = b" " * widest
    lengths = np.fromiter((len(x) for x in held), np.int64, len(held))
    starts = np.concatenate(([0], np.cumsum(lengths + widest)[:-1]))
    return np.frombuffer(gap.join(held) + gap, np.uint8), starts


def bucket_sums(texts: list[bytes], weights: np.ndarray, ngrams: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Per text the sum of its features' weights, and how many features it has."""
    total, count = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    widest = max(ngrams)
    for held, first in _blocks(texts):
        block, starts = _joined(held, widest)
        ends = starts + np.fromiter((len(x) for x in held), np.int64, len(held))
        where = slice(first, first + len(held))
        for bucket, position, n in _features(block, ngrams, len(weights), starts):
            sums = np.concatenate(([0.0], np.cumsum(weights[bucket])))
            if n:  # n-grams start at every byte
                low, high = starts, np.maximum(starts, ends - n + 1)
            else:
                low, high = np.searchsorted(position, starts), np.searchsorted(position, ends)
            low, high = np.minimum(low, len(bucket)), np.minimum(high, len(bucket))
            total[where] += sums[high] - sums[low]
            count[where] += high - low
    return total, count


def bucket_counts(text: bytes, buckets: int, ngrams: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of one text and the share of its features in each."""
    counts = np.zeros(buckets, np.int64)
    for held, _ in _blocks([text]):
        block = np.frombuffer(held[0], np.uint8)
        for bucket, _, _ in _features(block, ngrams, buckets):
            counts += np.bincount(bucket, minlength=buckets)
    found = np.flatnonzero(counts)
    return found.astype(np.int32), (counts[found] / max(1, counts.sum())).astype(np.float32)


@dataclass(frozen=True)
class QualityModel:
    """What a score needs: one number per bucket and the bias, as the gap between the logits of 1 and 0."""

    gaps: np.ndarray
    bias: float
    ngrams: tuple[int, ...]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        total, count = bucket_sums(texts, self.gaps, self.ngrams)
        return 1 / (1 + np.exp(-(total / np.maximum(1, count) + self.bias)))


def train(
    bags: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    buckets: int = BUCKETS,
    ngrams: tuple[int, ...] = NGRAMS,
    dimensions: int = DIMENSIONS,
    epochs: int = EPOCHS,
    rate: float = RATE,
    seed: int = SEED,
) -> QualityModel:
    """Stochastic gradient descent on the cross-entropy; the rate falls in a line to zero."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(set(labels.tolist())) < 2:
        return QualityModel(np.zeros(buckets), float(np.log(share / (1 - share))), ngrams)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dimensions, 1 / dimensions, (buckets, dimensions)).astype(np.float32)
    softmax, bias = np.zeros((dimensions, 2), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * -(-len(bags) // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            step, chosen = rate * (1 - done / steps), order[at : at + BATCH]
            done += 1
            means = np.stack([bags[i][1] @ vectors[bags[i][0]] for i in chosen])
            logits = means @ softmax + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            slope = odds / odds.sum(axis=1, keepdims=True)
            slope[np.arange(len(chosen)), labels[chosen]] -= 1
            back = slope @ softmax.T
            softmax -= step * means.T @ slope
            bias -= step * slope.mean(axis=0)
            for i, pull in zip(chosen, back):
                # Means of many features move little; the step is per share of the text, as in the forward pass.
                vectors[bags[i][0]] -= (step * VECTOR_RATE) * np.outer(bags[i][1], pull)
    gap = softmax[:, 1] - softmax[:, 0]
    return QualityModel((vectors @ gap).astype(np.float64), float(bias[1] - bias[0]), ngrams)


#: Steps of the vectors against those of the softmax: a bucket holds only a small share of a text.
VECTOR_RATE = 10.0


def held_out(id_col: str = "doc_id", folds: int = FOLDS) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text falls into fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = FOLDS,
    sample_rows: int = SAMPLE_ROWS,
    buckets: int = BUCKETS,
    ngrams: tuple[int, ...] = NGRAMS,
    **training: float,
) -> QualityModel:
    """Learn from the labelled rows outside the held-out fold."""
    known = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("doc_id", folds))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    # At most sample_rows rows of two numbers: the list is broadcast, and texts stay where they are.
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(known), "doc_id")

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        bags = [bucket_counts(x, buckets, ngrams) for x in utf8(batch.column(1))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([b[0].tobytes() for b in bags], pa.binary()), pa.array([b[1].tobytes() for b in bags], pa.binary())],
            ["doc_id", "label", "buckets", "shares"],
        )

    schema = "doc_id bigint, label int, buckets binary, shares binary"
    rows = map_arrow(texts.select(F.col("doc_id").cast("bigint"), "text", "label"), per_batch, schema)
    # Rows that repeat an id count once, and the order does not depend on the run.
    unique = rows.groupBy("doc_id").agg(F.min_by(F.struct("label", "buckets", "shares"), F.struct("buckets", "shares")).alias("x"))
    found = sorted(unique.select("doc_id", "x.*").collect(), key=lambda r: r.doc_id)
    bags = [(np.frombuffer(r.buckets, np.int32), np.frombuffer(r.shares, np.float32)) for r in found]
    return train(bags, np.array([r.label for r in found], np.int64), buckets, ngrams, **training)


def with_scores(spark: SparkSession, docs: DataFrame, model: QualityModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with the score as ``name``."""
    sent = spark.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c != name]
    schema = docs.select(*columns).schema.add(name, "double")

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = sent.value.scores(utf8(batch.column(columns.index(text_col))))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*columns, name])

    return map_arrow(docs.select(*columns), per_batch, schema)
