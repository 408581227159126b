"""Benchmark decontamination: CGK walks, bit sampling and exact edit distance.

Texts and items are compared as bytes with A-Z as a-z and every run of blanks as one space. An item matches a text
if at most ``SHARE`` of the item's length in edits turn it into a substring of the text.

1. Embedding. A CGK walk reads a string: each step writes the byte it stands on and then stays or goes on, as a coin
   for (walk, step, byte) says. Coins come from a hash, so all strings share them and no table of them is kept. Two
   strings that differ by few edits fall in step again after each, and most of their steps agree: edit distance has
   become Hamming distance.
2. Bit sampling. Windows open at every byte of an item and at a stride of bytes in the texts, and extend over the
   item; a table samples some of their first steps. The stride and the width within which steps are sampled follow
   the item's size (CLASSES), so that a copy contains many windows that some item window is aligned with. TABLES
   tables over WALKS walks look the sampled steps up; a find whose sampled width agrees in AGREE of its steps is a
   candidate. Recall is thus a matter of chance; RECALL is what the tests hold it to, for edits spread evenly and at
   random up to the bound. Candidates come from these buckets alone.
3. Verification. Finds of a text and an item are put in bands of 2k + 1 starts, k being the edits allowed. An edit
   spoils GRAM strings of GRAM bytes at most, so a copy holds the rest of the item's; where enough of them are there,
   the edit distance of the item to the best substring around the band, by bit-parallel dynamic programming, decides.

The benchmark is held in blocks of at most ITEM_BYTES bytes of text; a larger one is read in several passes.

Contract: one row per document row and item, repeated rows included. Null or blank texts and items match
nothing; null ids are returned as nulls. Texts are scanned whole. An empty benchmark gives no rows. Columns
beyond the named ones are ignored by :func:`leaks` and kept by :func:`without_leaks`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm.common import blocks, buffers, materialise, mix, small_batches, table

SHARE = 0.1
#: Share of the pairs within the bound that is found, at least; measured in the tests.
RECALL = 0.95
#: Smallest item of a class, bytes within which its steps are sampled, stride in the texts, steps that a table samples.
CLASSES = ((80, 24, 16, 12), (40, 16, 2, 10), (20, 8, 1, 8), (4, 4, 1, 6), (1, 0, 1, 1))
WALKS, TABLES = 3, 12
#: Share of a find's steps that agree, at least.
AGREE = 0.5
#: Bytes of benchmark text that one pass holds; a worker's tables take about a hundred times as much.
ITEM_BYTES = 1 << 20
#: Finds that are compared at once.
FINDS = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32
#: Bytes of the strings that are counted before an edit distance is taken.
GRAM = 4
_FILTER = 22
_STEP = np.uint64(0x9E3779B97F4A7C15)


def normalise(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes of a block of texts, their offsets, and the original place of each byte."""
    low = _LOWER[data]
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != 32) | (low[:-1] != 32)
    starts = at[:-1][at[:-1] < len(low)]
    keep[starts] = low[starts] != 32  # no blank opens a text
    kept = np.concatenate([[0], np.cumsum(keep)])
    return low[keep], kept[at], np.flatnonzero(keep)


def coins(walk: int, steps: int) -> np.ndarray:
    """Whether a walk goes on after a step on a byte."""
    n = np.arange(steps * 256, dtype=np.uint64) + np.uint64(walk << 40)
    return (mix(n * _STEP + _STEP) >> np.uint64(63)).astype(np.uint8).reshape(steps, 256)


def embed(data: np.ndarray, starts: np.ndarray, walk: int, steps: int) -> np.ndarray:
    """The steps (rows) of a walk from each start (columns); behind the data are zeros."""
    data = np.concatenate([data, np.zeros(steps + 1, np.uint8)])
    at, out = starts.astype(np.int64), np.empty((steps, len(starts)), np.uint8)
    for step, go in enumerate(coins(walk, steps)):
        data.take(at, out=out[step], mode="clip")
        at += go[out[step]]
    return out


def _grams(data: np.ndarray) -> np.ndarray:
    """The GRAM bytes from every place on."""
    n = max(len(data) - GRAM + 1, 0)
    out = np.zeros(n, np.uint32)
    for k in range(GRAM):
        out = out << np.uint32(8) | data[k: k + n]
    return out


def _sampled(steps: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Hashes of the chosen steps of every window."""
    out = np.zeros(steps.shape[1], np.uint64)
    for row in chosen:
        out *= _STEP
        out += steps[row]
    return mix(out)


def nearest(item: bytes, text: bytes, anchored: bool = False) -> tuple[int, int]:
    """Edits between the item and the nearest substring of the text, and where the first such ends (Myers' bit
    vectors); an anchored substring begins where the text does."""
    m = len(item)
    held = np.frombuffer(item, np.uint8)
    masks = {int(c): int.from_bytes(np.packbits(held == c, bitorder="little").tobytes(), "little") for c in np.unique(held)}
    full, top = (1 << m) - 1, 1 << m - 1
    up, down, score, best, end = full, 0, m, m, 0
    for k, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | down
        diagonal = ((eq & up) + up ^ up) | eq
        plus, minus = down | ~(diagonal | up) & full, up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1 | anchored) & full, minus << 1 & full
        up, down = minus | ~(x | plus) & full, plus & x
        if score < best:
            best, end = score, k + 1
            if not best:
                break
    return best, end


def distance(item: bytes, text: bytes) -> int:
    """Edits between the item and the substring of the text that is nearest to it."""
    return nearest(item, text)[0]


class Buckets:
    """The tables of the items of one class."""

    def __init__(self, items: np.ndarray, texts: list[bytes], width: int, stride: int, samples: int):
        self.stride, self.steps = stride, max(2 * width, 1)
        gap = bytes(self.steps + 1)
        self.data = np.frombuffer(b"".join(texts[k] + gap for k in items), np.uint8)
        sizes = np.array([len(texts[k]) for k in items])
        windows = np.maximum(sizes - width, 0) + 1
        begins = np.cumsum(sizes + len(gap)) - sizes - len(gap)
        self.item, nth = np.repeat(items, windows), np.repeat(np.cumsum(windows) - windows, windows)
        self.offset = np.arange(len(nth)) - nth
        self.place = np.repeat(begins, windows) + self.offset
        self.tables = []
        embedded = [embed(self.data, self.place, walk, self.steps) for walk in range(WALKS)]
        for table in range(TABLES):
            chosen = np.sort(np.random.default_rng(table).permutation(self.steps)[:samples])
            hashes = _sampled(embedded[table % WALKS], chosen)
            order = np.lexsort((self.offset, self.item, hashes)).astype(np.int32)
            cell = self.offset // np.maximum(np.array([int(SHARE * s) for s in sizes])[np.searchsorted(items, self.item)], 1)
            first = np.ones(len(order), bool)  # of the equal windows that lie within the edits of an item one is enough
            first[1:] = (np.diff(hashes[order]) != 0) | (np.diff(self.item[order]) != 0) | (np.diff(cell[order]) != 0)
            order = order[first]
            known = np.zeros(1 << _FILTER, bool)
            known[hashes >> np.uint64(64 - _FILTER)] = True
            self.tables.append((chosen, hashes[order], order, known))

    def finds(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the text and item windows that share a bucket and agree in enough steps."""
        starts = np.arange(0, len(data), self.stride)
        padded = np.concatenate([data, np.zeros(self.steps + 1, np.uint8)])
        for walk in range(WALKS):
            steps = embed(data, starts, walk, self.steps)
            for chosen, hashes, order, known in self.tables[walk::WALKS]:
                here = _sampled(steps, chosen)
                maybe = np.flatnonzero(known[here >> np.uint64(64 - _FILTER)])
                low, high = np.searchsorted(hashes, here[maybe]), np.searchsorted(hashes, here[maybe], "right")
                maybe, low, count = maybe[high > low], low[high > low], (high - low)[high > low]
                total = np.cumsum(count)
                cuts = np.searchsorted(total, np.arange(FINDS, int(total[-1]) if len(total) else 0, FINDS))
                for part in np.split(np.arange(len(maybe)), cuts):
                    n = count[part]
                    window = order[np.repeat(low[part] - np.cumsum(n) + n, n) + np.arange(n.sum())]
                    place = np.repeat(maybe[part], n)
                    equal = np.zeros(len(window), np.int32)
                    at, go = self.place[window], coins(walk, self.steps)
                    for step in range(self.steps):
                        byte = self.data[np.minimum(at, len(self.data) - 1)]
                        equal += byte == steps[step][place]
                        at += go[step][byte]
                    good = equal >= AGREE * self.steps
                    yield starts[place[good]], window[good]


@dataclass
class Items:
    """A block of the benchmark; workers make their tables themselves."""

    ids: list[int | None]
    texts: list[bytes]

    def __post_init__(self) -> None:
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.most = np.array([int(SHARE * len(t)) for t in self.texts], np.int64)
        self.least = self.sizes - GRAM + 1 - GRAM * self.most  # strings of an item that a copy holds

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("buckets", "grams")}

    @cached_property
    def grams(self) -> list[list[int]]:
        return [_grams(np.frombuffer(t, np.uint8)).tolist() for t in self.texts]

    @cached_property
    def buckets(self) -> list[Buckets]:
        out, above = [], 1 << 62
        for least, width, stride, samples in CLASSES:
            items = np.flatnonzero((self.sizes >= least) & (self.sizes < above))
            above = least
            if len(items):
                out.append(Buckets(items, self.texts, width, stride, samples))
        return out

    def bands(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts, items and bands of starts with a find, sorted. Band b holds the starts from b * (2k + 1) - m bytes
        behind the text's first."""
        bands = int(np.diff(at).max(initial=0) + self.sizes.max(initial=0)) + 3  # no band borders on another item's
        keys = [np.empty(0, np.int64)]
        for bucket in self.buckets:
            for place, window in bucket.finds(data):
                text = np.searchsorted(at, place, side="right") - 1
                item = bucket.item[window]
                start = place - at[text] + self.sizes[item] - bucket.offset[window]
                here = (start >= 0) & (start // (2 * self.most[item] + 1) < bands)
                keys.append(np.unique(((text * len(self.texts) + item) * bands + start // (2 * self.most[item] + 1))[here]))
        keys = np.unique(np.concatenate(keys))
        return keys // bands // len(self.texts), keys // bands % len(self.texts), keys % bands

    def matches(self, data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text number, item number, distance, place in the normalised text) of all matches of a block."""
        texts, items, bands = self.bands(data, at)
        raw, every = data.tobytes(), _grams(data)
        last = np.flatnonzero((np.diff(texts) != 0) | (np.diff(items) != 0) | (np.diff(bands) != 1)) + 1  # runs of bands
        now, best = None, (0, 0)
        for run in np.split(np.arange(len(bands)), last):
            if not len(run):
                continue
            pair = int(texts[run[0]]), int(items[run[0]])
            if pair != now:
                if now and best[0] <= self.most[now[1]]:
                    yield *now, *best
                now, best = pair, (int(self.most[pair[1]]) + 1, 0)
            if not best[0]:
                continue
            item, m, k = self.texts[pair[1]], int(self.sizes[pair[1]]), int(self.most[pair[1]])
            begin, stop = int(at[pair[0]]), int(at[pair[0] + 1])
            width = 2 * k + 1
            low = max(begin, begin + int(bands[run[0]]) * width - m - 2 * k)
            high = min(stop, begin + (int(bands[run[-1]]) + 1) * width + 3 * k)
            if self.least[pair[1]] > 0:
                there = set(every[low: high - GRAM + 1].tolist())
                if sum(map(there.__contains__, self.grams[pair[1]])) < self.least[pair[1]]:
                    continue
            d, end = nearest(item, raw[low:high])
            if d < best[0]:
                end += low
                length = nearest(item[::-1], raw[max(begin, end - m - k): end][::-1], True)[1]
                best = d, end - length - begin
        if now and best[0] <= self.most[now[1]]:
            yield *now, *best


def prepared(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark in blocks of bounded size, normalised; one is held at a time."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.trim("text") != "")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // ITEM_BYTES)
    for k in range(count):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).orderBy("item_id", "text").collect()
        raw = [np.frombuffer(r["text"].encode(), np.uint8) for r in part]
        texts = [normalise(x, np.array([0, len(x)]))[0].tobytes().rstrip(b" ") for x in raw]
        held = [(r["item_id"], t) for r, t in zip(part, texts) if t]
        if held:
            yield Items([i for i, _ in held], [t for _, t in held])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance, start): items found in documents; start is the first byte of the nearest substring in the text."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = ["doc_id", "item_id", "distance", "start"]

    def scan(items: Items) -> DataFrame:
        held = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in blocks(batches):
                raw, cut = buffers(batch.column("text"))
                data, at, origin = normalise(raw, cut)
                ids = batch.column("doc_id").to_pylist()
                rows = [(ids[t], held.value.ids[i], d, int(origin[at[t] + s] - cut[t])) for t, i, d, s in held.value.matches(data, at)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), [pa.int64(), pa.int64(), pa.int32(), pa.int64()])], names)

        return docs.mapInArrow(run, "doc_id long, item_id long, distance int, start long")

    parts: list[DataFrame] = []
    for items in prepared(benchmark):
        if parts:  # the pass before is carried out and its items are let go
            parts[-1] = materialise(parts[-1], "leaks")
        parts.append(scan(items))
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], "doc_id long, item_id long, distance int, start long")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, all columns kept."""
    small_batches(docs.sparkSession)
    for k, items in enumerate(prepared(benchmark)):
        docs = materialise(docs, "clean") if k else docs
        held = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in blocks(batches):
                data, at, _ = normalise(*buffers(batch.column("text")))
                clean = np.ones(batch.num_rows, bool)
                for text, *_ in held.value.matches(data, at):
                    clean[text] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
