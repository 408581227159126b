"""Shared helpers of the corpus operators: tables, the shared folder, text buffers, block hashes."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from civiclake.session import shared_dir

#: Rows of an Arrow batch handed to Python; texts run to 100 KB, so the default of 10,000 is too many.
BATCH_ROWS = 500
#: The folder that holds the package.
ROOT = str(Path(__file__).resolve().parents[2])
#: Bytes of an Arrow batch.
BATCH_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; Spark alone opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of this session, unless it has a smaller bound already, and lets its Python
    workers find this package where it lies in the same place as on the driver."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a frame to the shared folder and reads it back: a cut that survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column as one array, and the n + 1 offsets of its values; null is empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    column = column.cast(pa.large_string()).cast(pa.large_binary())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0]: at[-1]], at - at[0]


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches into runs of rows of at most ``limit`` bytes of text, one row at least."""
    for batch in batches:
        column = batch.column(text)
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for k, size in enumerate(sizes):
            if k > start and total + size > limit:
                yield batch.slice(start, k - start)
                start, total = k, 0
            total += int(size)
        if start < len(sizes):
            yield batch.slice(start)


#: 64-bit mixing constants (the finaliser of a public-domain hash).
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(h: np.ndarray) -> np.ndarray:
    """Scrambles unsigned 64-bit values; a bijection."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h ^= h >> np.uint64(33)
    h *= _M2
    h ^= h >> np.uint64(33)
    return h


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


_cache: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the hash base and of its inverse modulo 2^64."""
    if len(_cache.get("up", ())) < n:
        size = 1 << max(16, n.bit_length())
        _cache.update(up=_powers(_BASE, size), down=_powers(_INVERSE, size))
    return _cache["up"][:n], _cache["down"][:n]


#: A-Z to a-z; every other byte stays.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


#: The lowest bytes of an integer.
_LOWEST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_hashes(data: np.ndarray, at: np.ndarray, lower: np.ndarray = _LOWER, classes: np.ndarray = ~_BLANK,
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of many texts at once: hashes, first bytes, ends, and the n + 1 offsets of each text's words.

    Words are runs of bytes of one class other than 0; by default of bytes other than space and 9-13, with
    A-Z as a-z. A word's hash starts from its length and scrambles in eight bytes after eight, so that no
    arrangement of letters cancels out.
    """
    n = len(data)
    kind = np.zeros(n + 2, np.uint8)
    kind[1:-1] = classes[data]
    here = kind[1:-1] != 0
    begins = here & (kind[1:-1] != kind[:-2])
    ends = here & (kind[1:-1] != kind[2:])
    inner = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < n)]  # texts border without a blank
    begins[inner] |= here[inner]
    ends[inner - 1] |= here[inner - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    eight = np.concatenate([lower[data], np.zeros(7, np.uint8)]).astype(np.uint64)
    for width in (1, 2, 4):
        eight = eight[:-width] | eight[width:] << np.uint64(8 * width)
    size = last - first
    hashes, some, done = mix(size.astype(np.uint64) + _M2), np.arange(len(first)), 0
    while len(some):
        here = eight[first[some] + done] & _LOWEST[np.minimum(size[some] - done, 8)]
        hashes[some] = mix((hashes[some] ^ here) * np.uint64(_BASE))
        done += 8
        some = some[size[some] > done]
    return hashes, first, last, np.searchsorted(first, at)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
