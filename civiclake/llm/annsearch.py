"""Nearest neighbours by randomly rotated one-bit codes with error bounds, and exact reranking.

Vectors are centred on a median per dimension (of a bounded sample, so that a few huge ones do not move it), rotated by a random orthogonal matrix and reduced to the
signs of their coordinates: D bits, the length of the centred vector, and the inner product of the unit vector
with its code, which corrects the estimate. For a query q and a vector o the inner product of their unit
vectors is estimated as <code, q> / <code, o>; its error stays within ``epsilon`` standard deviations of a
random rotation with the probability that ``epsilon`` sets. The estimate gives bounds on the distance.

Blocks of coded vectors meet blocks of queries. A pair of blocks keeps, per query, the vectors whose lower
bound does not exceed the k-th smallest upper bound of the block, reranks these by their true distance in double
precision and hands on its k best; the k best of all blocks are the result. Every vector is coded and every
block is met; no list has a cap. A vector whose bounds overflow is compared in full.

Contract: queries are the usable rows whose id is divisible by ``every``, candidates all usable rows but the
query's own. A null vector, a zero vector and one with a null or non-finite component take no part, nor do
vectors of another dimension than the sample's most common one, or rows with a null id. Repeated rows are
candidates each. Ties in distance go to the smaller id. With fewer candidates than k all are returned; an
empty table has no rows. Values may be as large or small as doubles are. Columns beyond the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civiclake.llm.common import small_batches, table

#: Vectors from which the mean is taken, at most.
SAMPLE = 10_000
#: Standard deviations that an error bound spans. The recall measured against brute force is in the README.
EPSILON = 1.9
#: Vectors of a block of codes, and queries of a block.
BLOCK, QUERIES = 4096, 512


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths of the centred vectors, and inner products of unit vector and code."""
    with np.errstate(all="ignore"):
        turned = (vectors - mean) @ turn
        return _coded(turned)


def _coded(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    length = np.linalg.norm(turned, axis=1)
    inner = np.abs(turned).sum(axis=1) / np.where(length > 0, length, 1) / np.sqrt(turned.shape[1])
    return np.packbits(turned > 0, axis=1), length, np.where(length > 0, inner, 1.0)


def bounds(bits: np.ndarray, length: np.ndarray, inner: np.ndarray, query: np.ndarray, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances of rotated, centred queries (rows) to coded vectors (columns)."""
    dim = query.shape[1]
    size = np.linalg.norm(query, axis=1, keepdims=True)
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    dots = query.astype(np.float32) @ signs.T / np.sqrt(dim)  # <code, q>, the code having length 1
    estimate = dots * (length / inner)
    error = epsilon * size * (length * np.sqrt(np.maximum(1 - inner * inner, 0)) / inner) / np.sqrt(max(dim - 1, 1))
    base = size * size + length * length
    slack = 1e-4 * (base + 1e-12)  # for single precision
    return base - 2 * (estimate + error) - slack, base - 2 * (estimate - error) + slack


def survivors(low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """Which columns of each row may belong to its k nearest."""
    if high.shape[1] <= k:
        return np.ones(high.shape, bool)
    high = np.where(np.isnan(high), np.inf, high)  # a bound that overflows proves nothing
    return ~(low > np.partition(high, k - 1, axis=1)[:, k - 1: k])


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances; where squares leave the range of doubles, vectors are first scaled by a power of two."""
    with np.errstate(over="ignore", under="ignore"):
        total = np.square(vectors - query).sum(axis=1)
        out = np.sqrt(total)
        for k in np.flatnonzero((total == np.inf) | (total < 1e-280)):
            power = int(np.frexp(max(np.abs(vectors[k]).max(), np.abs(query).max()))[1]) + 1
            apart = np.ldexp(vectors[k], -power) - np.ldexp(query, -power)
            within = int(np.frexp(np.abs(apart).max())[1])
            out[k] = np.ldexp(np.sqrt(np.square(np.ldexp(apart, -within)).sum()), within + power)
        return out


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding array<double>) of the rows that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding"))
    v = F.col("embedding")
    return rows.where(F.col("vec_id").isNotNull() & v.isNotNull()).where(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def search(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest vectors of each query."""
    spark = vectors.sparkSession
    small_batches(spark)
    ready = usable(vectors)
    dims = ready.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if dims is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = dims["dim"]
    ready = ready.where(F.size("embedding") == dim)
    sample = ready.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select(F.posexplode("embedding"))
    means = sample.groupBy("pos").agg(F.median("col").alias("mean")).orderBy("pos").collect()  # a row per dimension
    mean, turn = np.array([r["mean"] for r in means]), rotation(dim)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(at, BLOCK)
                ids.append(piece.column("vec_id").to_numpy())
                parts.append(_matrix(piece.column("embedding"), dim))
                held += piece.num_rows
                if held >= BLOCK:
                    yield _block(ids, parts, mean, turn)
                    ids, parts, held = [], [], 0
        if held:
            yield _block(ids, parts, mean, turn)

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        vectors = np.array(group["query"].tolist(), "<f8")
        return pd.DataFrame({"q": [group["q"].iloc[0]], "queries": [group["query_id"].to_numpy("<i8").tobytes()], "wanted": [vectors.tobytes()]})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["ids", "vectors", "bits", "length", "inner", "queries", "wanted"]
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                ids, queries = np.frombuffer(row[0], "<i8"), np.frombuffer(row[5], "<i8")
                vectors, wanted = np.frombuffer(row[1], "<f8").reshape(-1, dim), np.frombuffer(row[6], "<f8").reshape(-1, dim)
                bits, length, inner = np.frombuffer(row[2], np.uint8).reshape(len(ids), -1), np.frombuffer(row[3]), np.frombuffer(row[4])
                found = []
                for a in range(0, len(queries), 64):
                    part = wanted[a: a + 64]
                    with np.errstate(all="ignore"):
                        low, high = bounds(bits, length, inner, (part - mean) @ turn)
                    own = queries[a: a + 64, None] == ids
                    high[own] = np.inf  # the query itself bounds nothing
                    stays = survivors(low, high, k) & ~own
                    for r in range(len(part)):
                        some = np.flatnonzero(stays[r])
                        score = distances(vectors[some], part[r])
                        best = np.lexsort((ids[some], score))[:k]
                        found.append((np.full(len(best), queries[a + r]), ids[some[best]], score[best]))
                columns = [np.concatenate(c) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    # A query block is a hash class of the queries; their number follows the number of queries.
    asked = asked_vectors(ready, every)
    classes = max(1, -(-asked.count() // QUERIES))
    asked = asked.withColumn("q", F.pmod(F.xxhash64("query_id"), F.lit(classes)).cast("int"))
    asked = asked.groupBy("q").applyInPandas(gather, "q int, queries binary, wanted binary")
    coded = ready.mapInArrow(code, "ids binary, vectors binary, bits binary, length binary, inner binary")
    # Every block of vectors is dealt to every block of queries by the number of the latter, in an equi-join.
    dealt = coded.select("*", F.explode(F.sequence(F.lit(0), F.lit(classes - 1))).alias("q"))
    met = dealt.join(asked, "q").drop("q").mapInArrow(meet, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _block(ids: list[np.ndarray], parts: list[np.ndarray], mean: np.ndarray, turn: np.ndarray) -> pa.RecordBatch:
    vectors = np.concatenate(parts)
    bits, length, inner = encode(vectors, mean, turn)
    packed = {"ids": np.concatenate(ids), "vectors": vectors, "bits": bits, "length": length, "inner": inner}
    return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in packed.values()], list(packed))


def asked_vectors(ready: DataFrame, every: int) -> DataFrame:
    """(query_id, query) of the queries; of several rows with one id the smallest vector asks."""
    rows = ready.where(F.col("vec_id") % every == 0)
    return rows.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("query"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth embedding."""
    return search(table(spark, sf_dir, "embeddings"))
