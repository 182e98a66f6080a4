"""Nearest vectors by inner product: randomly rotated one-bit codes with error bounds, then exact reranking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

NEAREST, EVERY = 20, 20
#: Width of the error bounds in standard errors of an estimate; candidates beyond the bound are not reranked.
EPSILON = 1.9
#: Vectors and queries that one task compares.
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 4_096
ROTATION_SEED = 11
_SLICE = 256
#: Signs of the eight bits of each byte, lowest bit first.
_SIGNS = (np.arange(256)[None, :] >> np.arange(8)[:, None] & 1).astype(np.float32) * 2 - 1


def rotation(d: int, seed: int = ROTATION_SEED) -> np.ndarray:
    """A random orthogonal matrix, the same in every process."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


class Codes:
    """One-bit codes of vectors about their mean: sign bits of the rotated residual, its length and its correction.

    For a unit residual o with code x (entries +-1/sqrt(d)) and a query q: <x,q> / <x,o> estimates <o,q>, with a
    standard error of about |q| sqrt((1 - <x,o>^2) / <x,o>^2 / (d - 1)).
    """

    def __init__(self, vectors: np.ndarray):
        n, d = vectors.shape
        self.d, self.turn = d, rotation(d)
        self.centre = vectors.mean(0) if n else np.zeros(d)
        rest = (vectors - self.centre) @ self.turn.T
        self.length = np.linalg.norm(rest, axis=1)
        positive = rest > 0
        self.bits = np.packbits(positive, axis=1, bitorder="little")
        safe = np.where(self.length > 0, self.length, 1)
        self.fit = np.where(self.length > 0, np.abs(rest).sum(1) / np.sqrt(d) / safe, 1)

    def signed_sums(self, turned: np.ndarray) -> np.ndarray:
        """Sums of each query's components, plus where a code's bit is set and minus elsewhere, from the packed bytes.

        For each eight components a table has the sums of all 256 bytes; a code looks its bytes up.
        """
        width = self.bits.shape[1]
        padded = np.zeros((len(turned), width * 8), np.float32)
        padded[:, : self.d] = turned
        tables = padded.reshape(len(turned), width, 8) @ _SIGNS
        out = np.zeros((len(turned), len(self.bits)), np.float32)
        for k in range(width):
            out += np.take(tables[:, k], self.bits[:, k], axis=1)
        return out

    def bounds(self, queries: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (queries x vectors) of the inner products, from the packed bits and corrections."""
        turned = (queries @ self.turn.T).astype(np.float32)
        dots = self.signed_sums(turned).astype(np.float64) / np.sqrt(self.d)
        mid = dots * (self.length / self.fit) + (queries @ self.centre)[:, None]
        error = np.sqrt(np.maximum(0, 1 - self.fit**2)) / self.fit / np.sqrt(max(1, self.d - 1))
        wide = (self.length * epsilon * error + 1e-6) * np.linalg.norm(queries, axis=1)[:, None]
        return mid - wide, mid + wide


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, epsilon: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vec_id, exact inner product) of each query's k nearest within the block, itself left out.

    The k of best lower bounds are looked at first; then all whose upper bounds reach the least exact product of these
    are reranked. Ties go to the smaller vec_id.
    """
    codes = Codes(vectors)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(queries), _SLICE):
        q, own = queries[at : at + _SLICE], query_ids[at : at + _SLICE]
        low, high = codes.bounds(q, epsilon)
        self_ = own[:, None] == ids[None, :]
        low[self_] = high[self_] = -np.inf
        first = np.argpartition(low, len(ids) - k, axis=1)[:, len(ids) - k :] if len(ids) > k else None
        for i in range(len(q)):
            enough = -np.inf if first is None or low[i, first[i]].min() == -np.inf else (vectors[first[i]] @ q[i]).min() - 1e-9
            near = np.flatnonzero((high[i] >= enough) & ~self_[i])
            rough = vectors[near] @ q[i]
            if len(near) > k:
                near = near[rough >= np.partition(rough, len(near) - k)[len(near) - k] - 1e-9]
            exact = (vectors[near] * q[i]).cumsum(axis=1)[:, -1]  # one after the other, so that reruns agree to the last bit
            order = np.lexsort((ids[near], -exact))[:k]
            out.append((np.full(len(order), own[i]), ids[near[order]], exact[order]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _valid(vectors: DataFrame) -> DataFrame:
    v = F.transform("embedding", lambda x: x.cast("double"))
    huge = F.lit(float("inf"))
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < huge))
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("_v"))
    return own.where(F.col("vec_id").isNotNull() & F.col("_v").isNotNull() & finite & F.exists("_v", lambda x: x != 0))


def _grouped(dims: int, k: int, epsilon: float):
    def run(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(group))
        ids = t.column("vec_id").to_numpy()
        v = t.column("_v").combine_chunks()
        v = v.flatten().to_numpy().reshape(len(ids), dims) if len(ids) else np.empty((0, dims))
        asks = t.column("_asks").to_numpy(zero_copy_only=False).astype(bool)
        order = np.argsort(ids[~asks], kind="stable")
        got = search_block(ids[~asks][order], v[~asks][order], ids[asks], v[asks], k, epsilon) if (~asks).any() else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(got[0], pa.int64()), pa.array(got[1], pa.int64()), pa.array(got[2], pa.float64())], ["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, every: int = EVERY, k: int = NEAREST, epsilon: float = EPSILON, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k vectors of largest inner product with each whose vec_id every divides.

    Vectors that are null or zero, or hold null, NaN or infinite components, take no part, nor do those without a
    vec_id; an empty table gives no rows. Vectors of another width than the queries' are only compared with their
    like. Rows that repeat a vec_id are one vector: the first by components. All candidates come back where there are
    fewer than k.

    Vectors and queries are hashed into blocks of bounded size, and each block of queries meets each block of vectors
    once: query rows are copied to the vector blocks and the other way round, never all rows to one machine. A block
    gives k rows a query, and of these the k best are ranked. Every row is indexed, in its block.
    """
    one = _valid(vectors).groupBy("vec_id").agg(F.min("_v").alias("_v")).withColumn("_d", F.size("_v"))
    sizes = one.groupBy("_d").agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).collect()  # one row a width
    parts = []
    for d, n, q in sorted(tuple(r) for r in sizes):
        nd, nq = max(1, -(-n // block_rows)), max(1, -(-q // block_queries))
        own = one.where(F.col("_d") == d).select("vec_id", "_v")
        data = own.select("vec_id", "_v", F.lit(False).alias("_asks"), F.pmod(F.xxhash64("vec_id"), F.lit(nd)).cast("int").alias("_a"), F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("_b"))
        asks = own.where(F.col("vec_id") % every == 0).select("vec_id", "_v", F.lit(True).alias("_asks"), F.explode(F.sequence(F.lit(0), F.lit(nd - 1))).alias("_a"), F.pmod(F.xxhash64(F.lit("q"), "vec_id"), F.lit(nq)).cast("int").alias("_b"))
        parts.append(data.unionByName(asks).groupBy("_a", "_b").applyInArrow(_grouped(d, k, epsilon), "query_id long, vec_id long, score double"))
    if not parts:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's queries and neighbours: nearest() over embeddings with its defaults; rows, nulls and ties as there."""
    return nearest(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]), lambda x, y: x + y) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 20
"""
