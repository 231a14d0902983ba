"""Nearest neighbours by randomly rotated one-bit codes.

Vectors are taken relative to a centre, scaled to unit length, padded and turned by
one random rotation; a code keeps the sign of each coordinate, packed to bits,
with two correction scalars (distance to the centre, inner product of the unit vector with its
code). From a query and a code the inner product is estimated with a bound on
its error, so most vectors are ruled out by their code alone and only those whose
lower bound beats the k-th best distance so far are measured.

Codes of ``code_bits`` per dimension: padding before the rotation makes
codes longer and the bounds narrower.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from firmweave.storage import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CODE_BITS = 4  # for each dimension
# standard errors of an estimate that a bound allows for; 1.9 rules a right neighbour out about
# once in 17 looks at the edge, 4 once in 16,000
ERRORS = 4.0
CENTRE_SAMPLE = 10_000
BLOCK_ROWS = 4_096
# queries that meet a block of rows at once
BLOCK_QUERIES = 65_536
# rows that meet a block of queries in one task
PART_ROWS = 200_000
SEED = 42


def rotation(dim: int, bits: int = CODE_BITS, seed: int = SEED) -> np.ndarray:
    """The first ``dim`` rows of a random orthogonal matrix, as padded dimensions hold zeros; columns a multiple of 64."""
    size = max(64, -(-dim * bits // 64) * 64)
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return np.ascontiguousarray((q * np.sign(np.diag(r)))[:dim]).astype(np.float32)


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, distance to the centre, inner product of unit vector and code) of each row."""
    moved = vectors - centre
    norm = np.linalg.norm(moved, axis=1)
    turned = (moved / np.where(norm > 0, norm, 1)[:, None]).astype(np.float32) @ turn
    return np.packbits(turned > 0, axis=1), norm, np.abs(turned).sum(axis=1, dtype=np.float64) / math.sqrt(turn.shape[1])


def lower_bounds(
    codes: np.ndarray, norm: np.ndarray, own: np.ndarray, queries: np.ndarray, centre: np.ndarray, turn: np.ndarray, errors: float = ERRORS
) -> np.ndarray:
    """Squared distances (queries x rows) that the true ones are not below, up to ``errors`` standard errors."""
    size = turn.shape[1]
    signs = (2.0 * np.unpackbits(codes, axis=1, count=size).astype(np.float32) - 1.0) / math.sqrt(size)
    moved = queries - centre
    length = np.linalg.norm(moved, axis=1)
    turned = moved.astype(np.float32) @ turn
    # a vector at the centre has no direction: its distance is the query's
    estimate = (turned @ signs.T) * np.where(norm > 0, norm / np.maximum(own, 1e-9), 0)
    slack = errors * np.sqrt(np.maximum(1 - own**2, 0)) / np.maximum(own, 1e-9) / math.sqrt(size - 1)
    most = estimate + length[:, None] * (norm * slack) + 1e-6 * (1 + length[:, None] * norm)
    return length[:, None] ** 2 + norm**2 - 2 * most


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(id, v): rows with a key whose vector is not null, not zero and holds only finite numbers."""
    v = F.col(column).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col(key).cast("bigint").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))
    )


def build_index(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", bits: int = CODE_BITS) -> tuple[DataFrame, np.ndarray, np.ndarray] | None:
    """(rows with codes, centre, rotation); None without usable vectors.

    Every usable row is coded; the centre is the mean of up to CENTRE_SAMPLE rows, which
    changes bounds but no distance. Vectors must be of one length (the commonest; others take no part).
    """
    ready = usable(vectors, key, column)
    lengths = ready.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not lengths:
        return None
    dim = lengths[0]["dim"]
    ready = ready.filter(F.size("v") == dim)
    sample = np.array([r.v for r in ready.select("v").limit(CENTRE_SAMPLE).toLocalIterator()])
    centre, turn = sample.mean(axis=0), rotation(dim, bits)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.asarray(batch.column(1).flatten()).reshape(-1, dim)
            packed, norm, own = encode(rows, centre, turn)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([p.tobytes() for p in packed], pa.binary()), pa.array(norm), pa.array(own.astype(float))],
                ["id", "v", "code", "norm", "own"],
            )

    coded = ready.mapInArrow(code, "id bigint, v array<double>, code binary, norm double, own double")
    return cut_lineage(coded), centre, turn


def search(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", every: int = 100, k: int = 10,
    bits: int = CODE_BITS, errors: float = ERRORS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows by Euclidean distance of every row whose key is divisible by ``every``.

    Every row but those of the query's own key is a candidate; all are given if they are fewer than k. Ties go to the
    smaller key. Rows without a key, and vectors that are null, zero, of another length than most, or hold null or non-finite numbers,
    take no part. Repeated rows (equal in key and vector) count once. Other columns are not read.
    """
    spark = vectors.sparkSession
    schema = "query_id bigint, vec_id bigint, score double"
    index = build_index(vectors.dropDuplicates([key, column]), key, column, bits)
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows, centre, turn = index
    asked = rows.filter(F.col("id") % every == 0).select("id", "v")
    # queries are numbered into blocks of bounded size; all rows visit each block
    blocks = max(1, math.ceil(asked.count() / block_queries))
    block_of = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(math.ceil(rows.count() / PART_ROWS), math.ceil(partitions / blocks))
    visits = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int").alias("part"),
        F.lit(False).alias("query"), "id", "v", "code", "norm", "own",
    )
    # each task that holds rows of a block needs the block's queries
    posed = asked.select(
        block_of.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(True).alias("query"), "id", "v",
        F.lit(None).cast("binary").alias("code"), F.lit(0.0).alias("norm"), F.lit(0.0).alias("own"),
    )

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, finder = None, None
        for batch in batches:
            head = batch.column(0).to_numpy().astype(np.int64) * parts + batch.column(1).to_numpy()
            query = np.asarray(batch.column(2).to_numpy(zero_copy_only=False))
            ids = batch.column(3).to_numpy()
            v = np.asarray(batch.column(4).flatten()).reshape(len(ids), -1)
            codes = batch.column(5)
            norm, own = batch.column(6).to_numpy(), batch.column(7).to_numpy()
            for at in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(head)) + 1):
                if current != head[at[0]]:
                    if finder is not None:
                        yield from finder.found()
                    current, finder = head[at[0]], Finder(centre, turn, k, errors)
                asks, gives = at[query[at]], at[~query[at]]
                if len(asks):
                    finder.ask(ids[asks], v[asks])
                if len(gives):
                    packed = np.frombuffer(b"".join(codes.take(pa.array(gives)).to_pylist()), np.uint8).reshape(len(gives), -1)
                    finder.visit(ids[gives], v[gives], packed, norm[gives], own[gives])
        if finder is not None:
            yield from finder.found()

    dealt = posed.unionByName(visits).repartition(max(partitions, blocks * parts), "block", "part").sortWithinPartitions("block", "part", F.desc("query"), "id")
    found = dealt.mapInArrow(nearest, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    # each part gave k rows of a query at most
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


class Finder:
    """The k nearest of the rows that visit a block of queries."""

    def __init__(self, centre: np.ndarray, turn: np.ndarray, k: int, errors: float):
        self.centre, self.turn, self.k, self.errors = centre, turn, k, errors
        self.ids, self.v, self.best, self.measured = np.empty(0, np.int64), None, None, 0

    def ask(self, ids: np.ndarray, v: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids])
        self.v = v if self.v is None else np.concatenate([self.v, v])

    def visit(self, ids, v, codes, norm, own) -> None:
        if self.v is None:
            return
        if self.best is None:
            self.best = [(np.empty(0), np.empty(0, np.int64)) for _ in self.ids]
        for s in range(0, len(ids), BLOCK_ROWS):
            e = min(s + BLOCK_ROWS, len(ids))
            for t in range(0, len(self.ids), 256):
                low = lower_bounds(codes[s:e], norm[s:e], own[s:e], self.v[t : t + 256], self.centre, self.turn, self.errors)
                for q in range(len(low)):
                    self._measure(t + q, low[q], ids[s:e], v[s:e])

    def _measure(self, q: int, low: np.ndarray, ids: np.ndarray, v: np.ndarray) -> None:
        """Measure rows in the order of their bounds while these are below the k-th best distance."""
        order = np.argsort(low, kind="stable")
        at, step = 0, 4 * self.k
        while at < len(order):
            scores, keys = self.best[q]
            limit = scores[self.k - 1] ** 2 if len(scores) >= self.k else np.inf
            take = order[at : at + step]
            take = take[low[take] <= limit * (1 + 1e-9)]
            if not len(take):
                break
            at += len(take)
            other = take[ids[take] != self.ids[q]]
            self.measured += len(other)
            score = np.sqrt(((v[other] - self.v[q]) ** 2).sum(axis=1))
            scores, keys = np.concatenate([scores, score]), np.concatenate([keys, ids[other]])
            best = np.lexsort((keys, scores))[: self.k]
            self.best[q] = scores[best], keys[best]

    def found(self) -> Iterator[pa.RecordBatch]:
        for q, (scores, keys) in enumerate(self.best or []):
            if len(keys):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), self.ids[q])), pa.array(keys), pa.array(scores)], ["query_id", "vec_id", "score"]
                )
