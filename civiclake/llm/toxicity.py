"""Toxicity by compression distance: one zstandard dictionary of ordinary text, one of toxic text.

Texts are compared as bytes with A-Z as a-z; signs, digits and blanks become one space. Both dictionaries open
with the same part, which zstandard trains on windows of ordinary text, entropy tables included, so that common
text costs the same under either. Behind it each holds the words that mark its own class: GRAM-byte strings whose
share of a text differs between the classes by more than SURE standard errors and RATIO times, in the words that
begin with them. A window of WINDOW bytes is compressed under both; the difference of the two lengths says which
text it is nearer to. A text's differences (largest, sum, how many exceed calibrated steps) give its probability
by a logistic regression over the labelled texts.

The model is learnt in one task from a bounded sample: of each class the ``sample`` distinct labelled documents
(id, text, label) with the smallest hashes of their ids, at most LONGEST bytes each (default SAMPLE; at most
BYTES of text a class). The calibration weighs the classes as if PRIOR of the texts were toxic. Every text is scored whole.

Contract: one row per input row. Null and empty texts have no window and get the score of such texts. A null
doc_id is never held out and never trained on. Null labels are ignored, repeated rows and labels count once,
contrary labels both. Where a class is missing or the texts are too few for a dictionary, all scores are the share
of toxic labels, 0 without labels. Very long texts are windows like any others. Columns beyond the named ones are
kept; a column ``score`` of the input is refused.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm.common import blocks, buffers, free_name, mix, small_batches, table

#: Labelled documents of each class to learn from, their bytes in sum, and the bytes of one of them, at most.
SAMPLE, BYTES, LONGEST = 8_000, 32 << 20, 1 << 20
#: Score from which a text counts as toxic.
TOXIC = 0.7
#: Bytes of a window, and by how many neighbours overlap.
WINDOW, OVERLAP = 128, 8
#: Bytes of the trained part and of the marking words of a dictionary.
TRAINED, MARKS = 1024, 512
GRAM, SURE, RATIO = 5, 4.0, 8.0
#: Differences of a window that are counted.
STEPS = (1, 2, 4, 8)
#: Toxic share of the sample that the calibration stands for.
PRIOR = 0.3
_SLOTS = 21

_FLAT = np.full(256, 32, np.uint8)
_FLAT[128:] = np.arange(128, 256)
_FLAT[97:123] = _FLAT[65:91] = np.arange(97, 123)


def flatten(data: np.ndarray) -> np.ndarray:
    """Lower-case letters and other scripts of one text, single spaces between and around."""
    flat = _FLAT[np.concatenate([[32], data, [32]]).astype(np.uint8)]
    keep = np.ones(len(flat), bool)
    keep[1:] = (flat[1:] != 32) | (flat[:-1] != 32)
    return flat[keep]


def _grams(flat: np.ndarray) -> np.ndarray:
    """The slot of the GRAM bytes from every place on."""
    n = max(len(flat) - GRAM + 1, 0)
    value = np.zeros(n, np.uint64)
    for k in range(GRAM):
        value |= flat[k: k + n].astype(np.uint64) << np.uint64(8 * k)
    return (mix(value) >> np.uint64(64 - _SLOTS)).astype(np.int64)


def _moments(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Mean share of every slot in the texts, and the square of its standard error."""
    total, squares, n = np.zeros(1 << _SLOTS), np.zeros(1 << _SLOTS), max(len(texts), 1)
    for text in texts:
        slots, counts = np.unique(_grams(text), return_counts=True)
        share = counts / np.sqrt(max(len(text), 1))
        total[slots] += share
        squares[slots] += share * share
    mean = total / n
    return mean, np.maximum(squares / n - mean * mean, 0) / n


def _marking(texts: list[np.ndarray], marks: np.ndarray) -> bytes:
    """Words that begin with marking strings, up to where these end, the most frequent ones last; no string twice."""
    found: Counter[bytes] = Counter()
    for text in texts:
        hit = marks[_grams(text)]
        starts = np.flatnonzero(hit & (text[: len(hit)] == 32))
        if not len(starts):
            continue
        misses = np.append(np.flatnonzero(~hit), len(hit))
        raw = text.tobytes()
        for start, stop in zip(starts.tolist(), misses[np.searchsorted(misses, starts)].tolist()):
            blank = raw.find(b" ", start + 1, stop + GRAM - 1)
            found[raw[start: blank + 1 if blank > 0 else stop + GRAM - 1]] += 1
    held: list[bytes] = []
    known: set[bytes] = set()
    room = MARKS
    for word, count in sorted(found.items(), key=lambda w: (-w[1] * len(w[0]), w[0])):
        own = {word[k: k + GRAM] for k in range(len(word) - GRAM + 1)}
        if count > 1 and own - known and len(word) <= room:
            known |= own
            held.append(word)
            room -= len(word)
    return b"".join(reversed(held))


def windows(flat: np.ndarray) -> list[bytes]:
    """The windows of a text; none of a blank one."""
    raw = flat.tobytes()
    return [raw[k: k + WINDOW + OVERLAP] for k in range(0, len(raw) - 1, WINDOW)]


@dataclass
class Model:
    """Two dictionaries and the calibration of their differences."""

    ordinary: bytes = b""
    toxic: bytes = b""
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    share: float = 0.0  # the score where nothing has been learnt

    @cached_property
    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        settings = zstandard.ZstdCompressionParameters(
            window_log=15, hash_log=14, chain_log=14, search_log=4, min_match=GRAM, target_length=0, strategy=zstandard.STRATEGY_BTOPT,
            write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        held = [zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_FULLDICT) for d in (self.ordinary, self.toxic)]
        return tuple(zstandard.ZstdCompressor(dict_data=d, compression_params=settings) for d in held)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "compressors"}  # made anew by each worker

    def differences(self, flat: np.ndarray) -> np.ndarray:
        """By how many bytes each window is shorter under the toxic dictionary."""
        plain, marked = (c.compress for c in self.compressors)
        return np.array([len(plain(w)) - len(marked(w)) for w in windows(flat)], np.int64)

    def features(self, flat: np.ndarray) -> np.ndarray:
        d = self.differences(flat)
        if not len(d):
            return np.zeros(5 + len(STEPS))
        high = np.sort(d)[::-1][:3]
        return np.array([high[0], high.sum(), d.mean(), np.log1p(max(d.sum(), 0)), np.log1p(len(flat)), *(np.log1p((d >= s).sum()) for s in STEPS)])

    def score(self, flat: np.ndarray) -> float:
        if not len(self.weights):
            return self.share
        x = np.append((self.features(flat) - self.mean) / self.scale, 1.0) @ self.weights
        return float(1 / (1 + np.exp(-np.clip(x, -500, 500))))


def learn(toxic: list[np.ndarray], ordinary: list[np.ndarray]) -> Model:
    """The model of two lists of flat texts."""
    model = Model(share=len(toxic) / max(len(toxic) + len(ordinary), 1))
    if not toxic or not ordinary:
        return model
    try:
        trained = zstandard.train_dictionary(TRAINED, [w for text in ordinary[:2000] for w in windows(text)]).as_bytes()
    except zstandard.ZstdError:  # too little text
        return model
    (bad, bad_error), (good, good_error) = _moments(toxic), _moments(ordinary)
    error = SURE * np.sqrt(bad_error + good_error)
    marks = [_marking(toxic, (bad - good > error) & (bad > RATIO * good)), _marking(ordinary, (good - bad > error) & (good > RATIO * bad))]
    room = max(map(len, marks))
    model.toxic, model.ordinary = (trained + m.rjust(room) for m in marks)
    x = np.array([model.features(text) for text in [*toxic, *ordinary]])
    y = np.repeat([1.0, 0.0], [len(toxic), len(ordinary)])
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.column_stack([(x - model.mean) / model.scale, np.ones(len(x))])
    weigh = np.where(y == 1, PRIOR / len(toxic), (1 - PRIOR) / len(ordinary)) * len(y)
    weights, ridge = np.zeros(x.shape[1]), 1e-2 * np.eye(x.shape[1])
    for _ in range(40):  # Newton's steps
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        weights = weights + np.linalg.solve((x.T * (weigh * p * (1 - p) + 1e-6)) @ x + ridge, x.T @ (weigh * (y - p)) - ridge @ weights)
    model.weights = weights
    return model


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _flat_texts(column: pa.Array) -> Iterator[np.ndarray]:
    data, at = buffers(column)
    return (flatten(data[a:b]) for a, b in zip(at, at[1:]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of the labelled documents that are not held out."""
    small_batches(docs.sparkSession)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id"))).distinct().withColumn("rank", F.xxhash64("doc_id"))
    first = lambda label: marks.where(F.col("toxic") == label).orderBy("rank", "doc_id").limit(sample)
    chosen = first(0).unionAll(first(1))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= LONGEST).join(F.broadcast(chosen), "doc_id")  # 2 * `sample` rows at most
    texts = texts.withColumn("key", F.sha2("text", 256)).dropDuplicates(["doc_id", "toxic", "key"])
    classes = [texts.where(F.col("toxic") == label).orderBy("rank", "doc_id", "key").limit(sample) for label in (0, 1)]

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list] = [], []
        room = [BYTES, BYTES]
        for batch in batches:
            for flat, label in zip(_flat_texts(batch.column("text")), batch.column("toxic").to_pylist()):
                if room[label] > 0:
                    held[label].append(flat)
                    room[label] -= len(flat)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(learn(held[1], held[0]))]})

    made = classes[0].unionAll(classes[1]).select("toxic", "text").coalesce(1).mapInArrow(fit, "model binary").first()
    return pickle.loads(made["model"]) if made else Model()


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with ``score``, the probability that its column text is toxic."""
    if free_name(docs, "score") != "score":
        raise ValueError("documents have a column score already; rename it first")
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            scores = [held.value.score(flat) for flat in _flat_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])

    return docs.mapInArrow(run, docs.withColumn("score", F.lit(0.0)).schema)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))
