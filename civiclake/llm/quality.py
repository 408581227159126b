"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL, scored as sparse dot products.

Tokens are runs of letters and digits, and runs of other signs; a token equal to the one before it is replaced
by a repeat mark. Features are the tokens and
the pairs of neighbours, hashed into ``2**BITS`` slots; a slot that occurs c times among the t features of a
text weighs sqrt(c / t), so that every text has length 1. Training is follow-the-regularised-leader with
per-slot rates: z and n are summed, weights follow from them in closed form, slots with |z| <= l1 weigh 0.

The model is fitted on a bounded sample of the distinct labelled documents (id, text, label): the ``sample`` ones
with the smallest hashes of their ids (default SAMPLE). It is trained in one task on features that many tasks have made, and is broadcast
(2**BITS floats, 1 MB). Every text is scored whole.

Contract: one row per input row. Null and empty texts have no feature and get the score of the bias. A null
doc_id is never held out and never trained on. Null labels are ignored, repeated rows and labels count once, contrary labels both. Without
any label the score is 0.5. Other columns are kept; one of the score's name is refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm.common import blocks, buffers, free_name, mix, small_batches, table, word_hashes

BITS = 18
#: Labelled rows to train on, at most.
SAMPLE = 16_000
#: Score from which a text counts as good.
GOOD = 0.7

_SAME = np.arange(256, dtype=np.uint8)
_CLASSES = np.full(256, 2, np.uint8)  # other signs
_CLASSES[[32, 9, 10, 11, 12, 13]] = 0
_CLASSES[128:] = 1
for _span in (b"az", b"AZ", b"09"):
    _CLASSES[_span[0]: _span[1] + 1] = 1
_REPEAT = np.uint64(0x5E9A7)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def features(data: np.ndarray, at: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of a block of texts: text number, slot and weight of every feature, sorted by text and slot."""
    hashes, _, _, words = word_hashes(data, at, _SAME, _CLASSES)
    texts = len(at) - 1
    owner = np.repeat(np.arange(texts, dtype=np.uint64), np.diff(words))
    paired = owner[1:] == owner[:-1] if len(owner) else np.empty(0, bool)
    again = np.zeros(len(hashes), bool)
    again[1:] = paired & (hashes[1:] == hashes[:-1])
    tokens = np.where(again, _REPEAT, hashes)
    pairs = mix(tokens[:-1] * _PAIR + tokens[1:])[paired]
    shift = np.uint64(64 - bits)
    keys = np.concatenate([owner << np.uint64(bits) | mix(tokens) >> shift, owner[1:][paired] << np.uint64(bits) | pairs >> shift])
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    text = (keys[first] >> np.uint64(bits)).astype(np.int64)
    totals = np.bincount(text, counts, texts)
    return text, (keys[first] & np.uint64((1 << bits) - 1)).astype(np.int32), np.sqrt(counts / totals[text])


class Ftrl:
    """Weights of a logistic regression by follow the regularised leader."""

    def __init__(self, bits: int = BITS, alpha: float = 1.0, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-4):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(1 + (1 << bits)), np.zeros(1 + (1 << bits))  # the last slot is the bias

    def weights(self, slots) -> np.ndarray:
        z = self.z[slots]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(self.n[slots])) / self.alpha + self.l2)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        slots, values = np.append(slots, -1), np.append(values, 1.0)
        w = self.weights(slots)
        gradient = (1 / (1 + np.exp(-float(w @ values))) - label) * values
        before = self.n[slots]
        after = before + gradient * gradient
        self.z[slots] += gradient - (np.sqrt(after) - np.sqrt(before)) / self.alpha * w
        self.n[slots] = after


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = 6) -> np.ndarray:
    """Weights (the last one is the bias) learnt from labelled documents that are not held out."""
    small_batches(docs.sparkSession)
    rank = F.xxhash64("doc_id")
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marks = marks.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    chosen = marks.distinct().withColumn("rank", rank).orderBy("rank", "doc_id", "quality").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("key")).join(F.broadcast(chosen), "doc_id")  # `sample` rows at most

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            data, at = buffers(batch.column("text"))
            text, slots, values = features(data, at)
            cut = np.searchsorted(text, np.arange(len(at)))
            yield pa.RecordBatch.from_arrays([
                batch.column("rank"), batch.column("doc_id"), batch.column("quality"), batch.column("key"),
                pa.array([slots[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                pa.array([values[a:b].astype("<f4").tobytes() for a, b in zip(cut, cut[1:])], pa.binary())],
                ["rank", "doc_id", "quality", "key", "slots", "values"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.frombuffer(s, np.int32), np.frombuffer(v, "<f4").astype(float), q) for batch in batches
                for s, v, q in zip(*(batch.column(c).to_pylist() for c in ("slots", "values", "quality")))][:sample]
        model = Ftrl()
        for _ in range(rounds):
            for row in rows:
                model.learn(*row)
        yield pa.RecordBatch.from_pydict({"weights": [model.weights(slice(None)).astype("<f4").tobytes()]})

    rows = texts.mapInArrow(sparse, "rank long, doc_id long, quality int, key long, slots binary, values binary").distinct()
    ordered = rows.orderBy("rank", "doc_id", "quality", "slots", "key").limit(sample)
    fitted = ordered.coalesce(1).mapInArrow(fit, "weights binary").first()
    return np.frombuffer(fitted["weights"], "<f4") if fitted else np.zeros(1 + (1 << BITS), "<f4")


def score(docs: DataFrame, weights: np.ndarray, name: str = "score") -> DataFrame:
    """All columns of ``docs`` with ``name``, the probability of label 1; ``docs`` has a column text and none of that name."""
    if free_name(docs, name) != name:
        raise ValueError(f"documents have a column {name} already; give another name")
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            data, at = buffers(batch.column("text"))
            text, slots, values = features(data, at)
            total = np.bincount(text, model.value[slots] * values, len(at) - 1) + float(model.value[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-total)), pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(run, docs.withColumn(name, F.lit(0.0)).schema)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
