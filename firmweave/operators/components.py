"""Connected components by alternating large-star and small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond", SoCC 2014.
Every round is a grouped minimum plus a lookup of that minimum; a round's
edges are written to the shared folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from firmweave.operators.relational import HOT_KEY_ROWS, dense_number, lookup, salted_join
from firmweave.storage import cut_lineage, release


def _with_minimum(edges: DataFrame, hub_rows: int, small: bool = False) -> DataFrame:
    """Attach ``m``, the smallest ``v`` of each ``u``; a hub's edges are salted.

    ``small`` says that ``edges`` has too few rows to hold a hub at all.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree"))
    if small:
        return edges.join(least.drop("degree"), "u")
    hubs = least.filter(F.col("degree") >= hub_rows).select(
        "u", F.ceil(F.col("degree") / hub_rows).alias("salts")
    )
    return salted_join(edges, least.drop("degree"), hubs, "u", "inner")


def group_edges(df: DataFrame, key: str, node: str, hub_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Edges (src, dst) from every node to the smallest node that shares its ``key``."""
    pairs = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("u"), F.col(node).alias("v"))
    starred = _with_minimum(pairs, hub_rows)
    return starred.filter("v != m").select(F.col("v").alias("src"), F.col("m").alias("dst"))


def connected_components(edges: DataFrame, hub_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """(node, component) for every node that has an edge; component is the smallest node."""
    current = cut_lineage(
        edges.filter("src != dst")
        .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .distinct()
    )
    while True:
        rows, done = _star_forest(current)
        if done:
            break
        small = 2 * rows < hub_rows
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: every larger neighbour of u moves to the smallest of u's neighbourhood
        large = (
            _with_minimum(both, hub_rows, small)
            .filter("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        # small star: u and its smaller neighbours all move to the smallest of them
        low = _with_minimum(large, hub_rows, small)
        moved = cut_lineage(
            low.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .filter("u != v")
            .distinct()
        )
        release(current)  # one round's edges at a time are on disk
        current = moved
    return (
        current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")))
        .distinct()
    )


def _star_forest(edges: DataFrame) -> tuple[int, bool]:
    """Row count, and whether every node has one parent and no parent has a parent itself."""
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("parent")),
                F.struct(F.col("v").alias("x"), F.lit(0).alias("child"), F.lit(1).alias("parent")),
            )
        )
    )
    seen = ends.groupBy("x").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    row = seen.agg(
        F.coalesce(F.sum("child"), F.lit(0)).alias("rows"),
        F.coalesce(F.max(F.col("child") + F.col("parent")), F.lit(0)).alias("worst"),
    ).first()
    return row["rows"], row["worst"] <= 1


def label_components(nodes: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """(node, component) for all ``nodes``; a node without edges is its own component."""
    found = connected_components(edges).withColumnRenamed("node", node)
    return (
        nodes.select(node).distinct().join(found, node, "left")
        .withColumn("component", F.coalesce("component", node))
    )


def numbered_labels(components: DataFrame, column: str, prefix: str) -> DataFrame:
    """(component, label) with labels ``<prefix>000000``, ... in component order."""
    numbers = dense_number(components.select(column).distinct(), column)
    return numbers.select(column, F.format_string(f"{prefix}%06d", "number").alias("label"))


def remap(df: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """Replace ``column`` by its component where ``mapping`` (node, component) has one."""
    found = mapping.withColumnRenamed("node", column)
    return (
        lookup(df, found, column, "left")
        .withColumn(column, F.coalesce("component", column))
        .drop("component")
    )
