"""A quality classifier: logistic regression on hashed word n-grams, learned by follow-the-regularised-leader.

Features are word 1- and 2-grams in two spellings: as written, and as the shapes of the words (lower case,
capitalised, upper case, digits, mixed, a run of one sign, the word before again). Each is hashed to one of
`BUCKETS` places, so a model has a fixed size. Training takes a bounded sample of the labelled rows, in a
fixed order, because the updates follow one another; features are computed where the texts are. Scoring is
a sparse dot product per text, in every partition, with the weights as a broadcast.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 1 << 20

#: Labelled rows that training takes at most: those whose ids hash lowest.
TRAINING_ROWS = 8000

#: Words whose hashes a task keeps.
KNOWN_WORDS = 500_000

tokens = re.compile(r"\w+|[^\w\s]+").findall
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.array([0x0, 0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x2545F4914F6CDD1D], np.uint64)
_SAME = 1


@dataclass(frozen=True)
class Ftrl:
    """Step sizes and penalties of FTRL-proximal, and how often the sample is passed."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.1
    passes: int = 4


class Features:
    """Hashed n-grams of texts; keeps the hashes of words it has met."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets = np.uint64(buckets)
        self.words: dict[str, tuple[int, int]] = {}

    def _word(self, word: str) -> tuple[int, int]:
        if len(self.words) >= KNOWN_WORDS:
            self.words.clear()
        if word.isalpha():
            shape = "a" if word.islower() else "A" if word.isupper() and len(word) > 1 else "Aa" if word.istitle() else "aA"
        elif word.isdigit():
            shape = "0"
        elif word.isalnum():
            shape = "a0"
        else:
            shape = word[0] * min(len(word), 3)
        pair = self.words[word] = (xxhash.xxh64_intdigest(word), xxhash.xxh64_intdigest(shape, 7) | 2)
        return pair

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and values, the values of each spelling having length 1; place `buckets` is the constant."""
        places, values = [np.array([self.buckets], np.int64)], [np.ones(1)]
        words = tokens(text or "")
        if words:
            known = self.words
            pairs = [known.get(w) or self._word(w) for w in words]
            written = np.fromiter((p[0] for p in pairs), np.uint64, len(pairs))
            shapes = np.fromiter((p[1] for p in pairs), np.uint64, len(pairs))
            shapes[1:][written[1:] == written[:-1]] = _SAME
            for k, grams in enumerate((written, shapes)):
                hashed = [self._placed(grams, 2 * k)]
                if len(grams) > 1:
                    hashed.append(self._placed(grams[:-1] * _MIX ^ grams[1:], 2 * k + 1))
                at, n = np.unique(np.concatenate(hashed), return_counts=True)
                value = np.ones(len(at)) if k == 0 else np.sqrt(n)
                places.append(at.astype(np.int64))
                values.append(value / math.sqrt((value * value).sum()))
        return np.concatenate(places), np.concatenate(values)

    def _placed(self, grams: np.ndarray, salt: int) -> np.ndarray:
        mixed = (grams ^ _SALT[salt]) * _MIX
        return (mixed ^ (mixed >> np.uint64(29))) % self.buckets


def learn(rows: list[tuple[np.ndarray, np.ndarray, int]], ftrl: Ftrl, buckets: int = BUCKETS) -> np.ndarray:
    """Weights by place after the rows in their order; the last place is the constant."""
    z, n = np.zeros(buckets + 1), np.zeros(buckets + 1)
    free = np.ones(buckets + 1)
    free[buckets] = 0  # the constant bears no penalty that would hold it at zero

    def weights(at: np.ndarray | slice) -> np.ndarray:
        l1 = ftrl.l1 * free[at]
        w = -(z[at] - np.sign(z[at]) * l1) / ((ftrl.beta + np.sqrt(n[at])) / ftrl.alpha + ftrl.l2)
        return np.where(np.abs(z[at]) > l1, w, 0.0)

    for _ in range(ftrl.passes):
        for at, x, y in rows:
            w = weights(at)
            g = (sigmoid(float(w @ x)) - y) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ftrl.alpha * w
            n[at] += g * g
    return weights(slice(None))


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def held_out() -> Column:
    """Rows that no label is learned from: those whose id, as text, has a crc32 of 2 modulo 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, ftrl: Ftrl | None = None, max_rows: int = TRAINING_ROWS) -> bytes | None:
    """The weights as 32-bit floats, or None if no labelled row may be learned from.

    Labels that are null, held out or without a text take no part; of several labels of an id the lowest counts.
    """
    ftrl = ftrl or Ftrl()
    wanted = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .withColumn("place", F.xxhash64("doc_id"))
    )
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    # Labels without a document would take up the sample, so the ids of the documents come first.
    present = wanted.join(texts.select("doc_id"), "doc_id", "left_semi")
    chosen = present.orderBy("place", "doc_id").limit(max_rows)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [features.of(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([a.astype(np.int32) for a, _ in found], pa.list_(pa.int32())),
                    pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32())),
                ],
                ["place", "quality", "at", "x"],
            )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for place, y, at, x in zip(*batch.columns, strict=True):
                at, x = at.values.to_numpy().astype(np.int64), x.values.to_numpy().astype(np.float64)
                rows.append((place.as_py(), int(at.sum()), at, x, y.as_py()))
        rows.sort(key=lambda r: r[:2])
        if rows:
            w = learn([r[2:] for r in rows], ftrl).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary())], ["weights"])

    # Of rows that repeat an id the text with the lowest hash counts, so the bound on rows holds.
    found = texts.join(F.broadcast(chosen), "doc_id")
    sample = found.groupBy("doc_id", "place", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = sample.select("place", "quality", "text")
    ready = sample.mapInArrow(featurise, "place long, quality int, at array<int>, x array<float>")
    # At most `max_rows` rows, whatever the corpus: the updates follow one another, so one task makes them.
    model = ready.repartition(1).mapInArrow(fit, "weights binary").first()
    return bytes(model["weights"]) if model else None


def score(spark: SparkSession, docs: DataFrame, weights: bytes | None, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from the threshold on) of every row.

    Null and empty texts are scored by the constant alone. Without weights nothing speaks against a text: its
    score is 1. Repeated rows stay; a null doc_id is not held out.
    """
    sent = spark.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = None if sent.value is None else np.frombuffer(sent.value, np.float32).astype(np.float64)
        features = Features()
        for batch in batches:
            scores = []
            for text in batch.column(2):
                if w is None:
                    scores.append(1.0)
                else:
                    at, x = features.of(text.as_py())
                    scores.append(sigmoid(float(w[at] @ x)))
            predicted = pa.array([int(s >= threshold) for s in scores], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), predicted],
                ["doc_id", "held_out", "score", "predicted"],
            )

    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return texts.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )


def keep_good(spark: SparkSession, docs: DataFrame, weights: bytes | None, threshold: float = 0.7) -> DataFrame:
    """The rows, with all their columns, whose texts score at least the threshold."""
    sent = spark.sparkContext.broadcast(weights)
    at_text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = None if sent.value is None else np.frombuffer(sent.value, np.float32).astype(np.float64)
        features = Features()
        for batch in batches:
            if w is not None:
                found = (features.of(x.as_py()) for x in batch.column(at_text))
                batch = batch.filter(pa.array([sigmoid(float(w[at] @ x)) >= threshold for at, x in found], pa.bool_()))
            yield batch

    return docs.mapInArrow(run, docs.schema)
