"""Exact k-nearest neighbours within a radius for dense vectors a user supplies.

Vectors are placed in the cell of their nearest pivot and first searched in that cell. The k-th
distance found there, or the radius, bounds the second pass: a query visits another
cell only if the hyperplane between the two pivots is within its bound
(Lu et al., "Efficient Processing of k Nearest Neighbor Joins using
MapReduce", VLDB 2012). Cells are dealt to groups of bounded size, large ones split into blocks, so no
task sees an unbounded group; a query goes once to a group, however many of its cells it visits, and only the k best of a block leave it.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from firmweave.operators.relational import lookup
from firmweave.storage import cut_lineage

# executors get the kernels with the task, so they need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_PIVOTS = 1_024
MAX_PIVOT_BYTES = 32 * 1024 * 1024
BLOCK_ROWS = 32_768  # rows, and queries, that meet in one task
HELD_PAIRS = 2_000_000  # found in a task before all but the nearest are dropped


def unit_vectors(df: DataFrame, column: str) -> DataFrame:
    """Scale an array column to length 1 (all-zero vectors stay as they are)."""
    norm = F.sqrt(F.aggregate(column, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x))
    return df.withColumn("__norm", norm).withColumn(
        column, F.when(F.col("__norm") > 0, F.transform(column, lambda x: x / F.col("__norm"))).otherwise(F.col(column))
    ).drop("__norm")


def user_vectors(df: DataFrame, column: str, encode, output: str = "vector") -> DataFrame:
    """Vectors from a user's batch function ``Series[str] -> Series[list[float]]``."""
    return df.withColumn(output, F.pandas_udf(encode, "array<double>")(F.col(column)))


def _pivots(distinct: DataFrame, rows: int) -> np.ndarray:
    wanted = max(1, min(MAX_PIVOTS, rows // 512 + 1))
    first = distinct.select("vector").first()
    if first is None:
        return np.zeros((0, 0))
    wanted = max(1, min(wanted, MAX_PIVOT_BYTES // (8 * max(1, len(first["vector"])))))
    # a hash order makes the sample repeatable; its size is bounded above
    sample = distinct.orderBy(F.xxhash64("id"), "id").limit(wanted).select("vector").collect()
    return np.array([r["vector"] for r in sample], dtype="float64")


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T
    return np.sqrt(np.maximum(square, 0))


def _closeness(y: np.ndarray):
    """A function of vectors and as many limits: places (i, j) of all pairs with rows of ``y`` within the limits, and of some just beyond.

    Products are made of single precision, with its error allowed for, or of double if numbers are too large for that. One product and one
    comparison a pair tell: x y - y y / 2 >= (x x - limit * limit) / 2.
    """
    longest = np.sqrt((y * y).sum(1).max())

    @functools.cache
    def against(kind: type) -> np.ndarray:
        return np.c_[y, -(y * y).sum(1) / 2].astype(kind).T

    def close(x: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        square = (x * x).sum(1)
        largest = max(longest, np.sqrt(square.max()))
        error = lambda kind: (x.shape[1] + 8) * float(np.finfo(kind).eps) * 2 * largest * largest
        # also if they are no numbers, or the error is not small against the limits
        kind = np.float32 if largest < 1e15 and error(np.float32) <= 1e-3 * (limit * limit).max() else np.float64
        slack = error(kind)
        least = ((square - limit * limit) / 2 - slack).astype(kind)
        return np.nonzero(np.c_[x, np.ones(len(x))].astype(kind) @ against(kind) >= np.nextafter(least, kind(-np.inf))[:, None])

    return close


def neighbours(
    df: DataFrame, id_col: str, vector_col: str, *, k: int, radius: float, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(a, b, distance, rank): up to ``k`` nearest other rows with L2 distance < ``radius``.

    Ties go to the smaller id. Copies of one vector are searched once: their
    ``k + 1`` smallest ids stand for all of them, and every copy looks its list up.
    """
    rows = cut_lineage(
        df.filter(F.col(vector_col).isNotNull())
        .select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    )
    # a ranked limit is applied before the shuffle, so many copies stay cheap
    few = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    groups = cut_lineage(
        rows.withColumn("n", few).filter(F.col("n") <= k + 1)
        .groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select(F.col("ids")[0].alias("id"), "ids", "vector")
    )
    near = _distinct_neighbours(groups.select("id", "vector"), k, radius, block_rows)
    reach = near.select("a", "b", "distance").unionByName(
        groups.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("distance"))
    )
    lists = (
        reach.join(groups.select(F.col("id").alias("b"), "ids"), "b")
        .select("a", "distance", F.explode("ids").alias("b"))
        .groupBy("a")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("distance", "b"))), 1, k + 1).alias("near"))
        .withColumnRenamed("a", "gid")
    )
    owner = groups.select("vector", F.col("id").alias("gid"))
    listed = lookup(lookup(rows, owner, "vector", "inner").drop("vector"), lists, "gid", "inner")
    mine = F.slice(F.filter("near", lambda x: x["b"] != F.col("id")), 1, k)
    return listed.select(F.col("id").alias("a"), F.posexplode(mine).alias("pos", "x")).select(
        "a", "x.b", "x.distance", (F.col("pos") + 1).alias("rank")
    )


def _groups_of(sizes: dict[int, int], cells: int, block_rows: int) -> tuple[list[int], list[int]]:
    """(group of each cell, blocks of each group): neighbouring cells together up to ``block_rows`` rows; a larger one alone, in blocks."""
    group, blocks, held = [], [], block_rows
    for cell in range(cells):
        rows = sizes.get(cell, 0)
        if not blocks or held + rows > block_rows:
            blocks.append(max(1, -(-rows // block_rows)))
            held = 0
        held += rows
        group.append(len(blocks) - 1)
    return group, blocks


def _distinct_neighbours(rows: DataFrame, k: int, radius: float, block_rows: int) -> DataFrame:
    kind = dict(rows.dtypes)["id"]
    pivots = _pivots(rows, rows.count())
    between = _distances(pivots, pivots)
    eps = 1e-6

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(home=_distances(np.stack(batch["vector"].to_numpy()).astype("float64"), pivots).argmin(1))

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Cells that the radius leaves open, each with how far away it begins."""
        for batch in batches:
            if not len(batch):
                continue
            d = _distances(np.stack(batch["vector"].to_numpy()).astype("float64"), pivots)
            home = batch["home"].to_numpy()
            near = d[np.arange(len(d)), home]
            apart = between[home]
            with np.errstate(divide="ignore", invalid="ignore"):
                margin = (d * d - (near * near)[:, None]) / (2 * apart)
            # equal pivots have no hyperplane between them
            margin[apart == 0] = 0
            visit = ~(margin > radius + eps)
            yield batch.assign(cells=[np.flatnonzero(v) for v in visit], margins=[np.maximum(m[v], 0) for m, v in zip(margin, visit)])

    settled = cut_lineage(rows.mapInPandas(settle, f"id {kind}, vector array<double>, home int"))
    counted = {r["home"]: r["n"] for r in settled.groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row for each pivot
    group, blocks = _groups_of(counted, len(pivots), block_rows)
    # without vectors there are no cells
    group_of = F.split(F.lit(",".join(map(str, group or [0]))), ",").cast("array<int>")
    blocks_of = F.split(F.lit(",".join(map(str, blocks or [1]))), ",").cast("array<bigint>")

    def dealt(visits: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Queries and data of the visited groups of cells, by blocks of bounded size. A query goes once to each block, with the cells it visits there."""
        grouped = visits.withColumn("groups", F.transform("cells", lambda c: F.get(group_of, c)))
        asked = grouped.select("id", "vector", "bound", "cells", "groups", F.explode(F.array_distinct("groups")).alias("g"))
        chunks = grouped.select(F.explode(F.array_distinct("groups")).alias("g")).groupBy("g").agg(
            F.ceil(F.count(F.lit(1)) / block_rows).cast("bigint").alias("chunks"))
        chunks = F.broadcast(cut_lineage(chunks))  # at most one row for each pivot
        data = (
            settled.withColumn("g", F.get(group_of, F.col("home"))).join(chunks, "g")
            .withColumn("block", F.pmod(F.xxhash64("id"), F.get(blocks_of, F.col("g"))))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
            .select("g", "block", "chunk", "id", "vector", F.col("home").alias("cell"))
        )
        mine = F.transform(
            F.filter(F.arrays_zip("cells", "groups"), lambda z: z["groups"] == F.col("g")), lambda z: z["cells"])
        query = (
            asked.join(chunks, "g")
            .withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks"))
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.get(blocks_of, F.col("g")) - 1)))
            .select(
                F.col("g").alias("c"), F.col("block").alias("r"), F.col("chunk").alias("q"),
                F.col("id").alias("a"), F.col("vector").alias("x"), "bound", mine.alias("cells"),
            )
        )
        return query, data

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": left["a"][:0], "b": left["a"][:0], "distance": np.zeros(0)})
        x = np.stack(left["x"].to_numpy()).astype("float64")
        y = np.stack(right["vector"].to_numpy()).astype("float64")
        ids, others, bound = left["a"].to_numpy(), right["id"].to_numpy(), left["bound"].to_numpy()
        visited = [np.asarray(c) for c in left["cells"]]
        asking, cell = np.repeat(np.arange(len(x)), [len(c) for c in visited]), np.concatenate(visited)
        order = np.argsort(cell, kind="stable")
        asking, cell = asking[order], cell[order]
        homes = right["cell"].to_numpy()
        a_code, b_code = (pd.factorize(v, sort=True)[0] for v in (ids, others))
        b_code = np.where(b_code < 0, len(others), b_code)  # nulls last
        held, size = [], 0

        def nearest() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            i, j, distance = (np.concatenate(v) for v in zip(*held))
            ranked = np.lexsort((b_code[j], distance, a_code[i]))
            ranked = ranked[a_code[i[ranked]] >= 0]
            code, at = a_code[i[ranked]], np.arange(len(ranked))
            first = np.maximum.accumulate(np.where(np.r_[True, code[1:] != code[:-1]][: len(at)], at, 0))
            ranked = ranked[at - first < k]
            return i[ranked], j[ranked], distance[ranked]

        for c in np.unique(homes):
            here = np.flatnonzero(homes == c)
            visitors = asking[np.searchsorted(cell, c):np.searchsorted(cell, c, "right")]
            z = y[here]
            close = _closeness(z)
            for start in range(0, len(visitors), 512):
                some = visitors[start:start + 512]
                i, j = close(x[some], bound[some] + eps)
                i, j = some[i], here[j]
                apart = ids[i] != others[j]
                i, j = i[apart], j[apart]
                exact = np.zeros(len(i))
                for s in range(0, len(i), 65_536):
                    exact[s:s + 65_536] = np.linalg.norm(x[i[s:s + 65_536]] - y[j[s:s + 65_536]], axis=1)
                near = (exact < radius) & (exact <= bound[i])
                held.append((i[near], j[near], exact[near]))
                size += int(near.sum())
                if size > HELD_PAIRS:
                    held = [nearest()]
                    size = len(held[0][0])
        if not held:
            return pd.DataFrame({"a": left["a"][:0], "b": left["a"][:0], "distance": np.zeros(0)})
        i, j, distance = nearest()
        return pd.DataFrame({"a": ids[i], "b": others[j], "distance": distance})

    def searched(visits: DataFrame) -> DataFrame:
        query, data = dealt(visits)
        return (
            query.groupBy("c", "r", "q").cogroup(data.groupBy("g", "block", "chunk"))
            .applyInPandas(best, f"a {kind}, b {kind}, distance double")
        )

    rank = F.row_number().over(Window.partitionBy("a").orderBy("distance", "b"))
    ranked = lambda found: found.withColumn("rank", rank).filter(F.col("rank") <= k)
    near = cut_lineage(ranked(searched(settled.select("id", "vector", F.lit(radius).alias("bound"), F.array("home").alias("cells")))))
    bounds = near.filter(F.col("rank") == k).select(F.col("a").alias("id"), F.col("distance").alias("bound"))
    bounded = cut_lineage(settled.join(bounds, "id", "left"))
    placed = bounded.mapInPandas(reach, f"id {kind}, vector array<double>, home int, bound double, cells array<int>, margins array<double>")
    far = searched(_further_visits(placed, near, k, eps).withColumn("bound", F.coalesce("bound", F.lit(radius))))
    return ranked(near.drop("rank").unionByName(far))


def _further_visits(placed: DataFrame, near: DataFrame, k: int, eps: float) -> DataFrame:
    """(id, vector, bound, cells): cells besides its own that may hold one of a vector's ``k`` nearest. ``bound`` is the distance
    of the k-th in its own cell among ``near``, null if that has fewer; ``placed`` has it with the open cells, which are not written."""
    in_reach = lambda z: (z["cells"] != F.col("home")) & (F.col("bound").isNull() | (z["margins"] <= F.col("bound") + eps))
    cells = F.transform(F.filter(F.arrays_zip("cells", "margins"), in_reach), lambda z: z["cells"])
    return placed.select("id", "vector", "bound", cells.alias("cells")).filter(F.size("cells") > 0)


def radius_pairs(
    df: DataFrame, id_col: str, vector_col: str, *, k: int, min_cosine: float
) -> DataFrame:
    """Unordered pairs (a, b) of k-nearest unit vectors with cosine above ``min_cosine``."""
    from firmweave.operators.vectors import l2_radius, oriented

    found = neighbours(
        unit_vectors(df, vector_col), id_col, vector_col, k=k, radius=l2_radius(min_cosine)
    )
    return oriented(found)


def hybrid_vector_pairs(
    df: DataFrame, name_col: str, vector_col: str, *, k: int, min_cosine: float, lexical: float
) -> DataFrame:
    """Name pairs that are near by user vectors and lexically."""
    from firmweave.operators.vectors import lexically_close

    return lexically_close(
        radius_pairs(df, name_col, vector_col, k=k, min_cosine=min_cosine), lexical
    )
