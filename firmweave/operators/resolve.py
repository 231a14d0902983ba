"""Entity resolution: first pass on name vectors, second pass on fuzzy names and aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firmweave.functions.text import core_name, match_key
from firmweave.operators.components import (
    connected_components, group_edges, label_components, numbered_labels,
)
from firmweave.operators.fuzzy import best_other_names
from firmweave.operators.golden import refine_names, refined_entities
from firmweave.operators.relational import HOT_KEY_ROWS, lookup, salted_join
from firmweave.operators.vectors import LEXICAL, MIN_COSINE, NEIGHBOURS, hybrid_pairs
from firmweave.storage import cut_lineage

# Fixed value: an exact core name links entities only above this many characters.
MIN_CORE_LENGTH = 3


def name_node(column: str = "company_name") -> Column:
    """Node of a firm in the first-pass graph: its core name, or the full name if no core is left."""
    return F.coalesce(F.nullif(core_name(column), F.lit("")), F.col(column), F.lit(""))


def cluster_firms(
    firms: DataFrame, k: int = NEIGHBOURS, min_cosine: float = MIN_COSINE,
    lexical: float = LEXICAL, pairs: DataFrame | None = None,
) -> DataFrame:
    """Firms plus ``cluster_id``.

    Firms with equal core names are one node, so neighbours and components are
    computed on distinct names. ``pairs`` (a, b) replaces the built-in name
    pairs, for example with ``knn.hybrid_vector_pairs`` on a user's vectors.
    """
    firms = firms.withColumn("unique_id", F.col("unique_id").cast("string")).withColumn("node", name_node())
    nodes = name_nodes(firms)
    if pairs is None:
        cores = nodes.filter(core_name("node") != "").select(F.col("node").alias("name"))
        pairs = hybrid_pairs(cores, k=k, min_cosine=min_cosine, lexical=lexical)
    found = cut_lineage(label_components(nodes, pairs.select(F.col("a").alias("src"), F.col("b").alias("dst")), "node"))
    # clusters are numbered by the smallest firm id in them
    least = found.join(nodes, "node").groupBy("component").agg(F.min("least").alias("least"))
    labels = numbered_labels(least, "least", "v_")
    cluster_of = cut_lineage(
        # most nodes can be in one component
        lookup(found, least.join(labels, "least"), "component", "inner")
        .select("node", F.col("label").alias("cluster_id"))
    )
    return salted_join(firms, cluster_of, hot_nodes(nodes), "node", "inner").drop("node")


def name_nodes(firms: DataFrame) -> DataFrame:
    """Table (node, least, n): smallest firm id and number of firms of each name node."""
    return cut_lineage(
        firms.groupBy("node").agg(F.min("unique_id").alias("least"), F.count(F.lit(1)).alias("n"))
    )


def hot_nodes(nodes: DataFrame, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    return nodes.filter(F.col("n") >= hot_rows).select("node", F.ceil(F.col("n") / hot_rows).alias("salts"))


def alias_variants(entities: DataFrame) -> DataFrame:
    """(canonical_id, variant): lower-case primary name and aliases of each entity."""
    names = F.array("primary_company_name")
    if "aliases" in entities.columns:
        names = F.concat(names, F.coalesce("aliases", F.array().cast("array<string>")))
    return (
        entities.select("canonical_id", F.explode(names).alias("variant"))
        .select("canonical_id", match_key("variant").alias("variant"))
        .filter("variant != ''")
        .distinct()
    )


def second_pass_edges(entities: DataFrame, scorer=None, reach: tuple[int, int] | None = None) -> DataFrame:
    """Edges (src, dst) of canonical ids from fuzzy names, equal core names and shared aliases; ``scorer`` and ``reach`` as in ``best_other_names``."""
    cores = entities.select("canonical_id", core_name("primary_company_name").alias("core")).filter("core != ''")
    owners = cores.groupBy("core").agg(F.min("canonical_id").alias("owner"))
    best = best_other_names(owners, "core", scorer=scorer, reach=reach)
    fuzzy = (
        best.join(owners.select(F.col("core").alias("name"), F.col("owner").alias("src")), "name")
        .join(owners.select(F.col("core").alias("best"), F.col("owner").alias("dst")), "best")
        .select("src", "dst")
    )
    exact = group_edges(cores.filter(F.length("core") > MIN_CORE_LENGTH), "core", "canonical_id")
    shared = group_edges(alias_variants(entities), "variant", "canonical_id")
    return fuzzy.unionByName(exact).unionByName(shared)


def master_clusters(entities: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Entities plus ``master_cluster_id``."""
    edges = second_pass_edges(entities) if edges is None else edges
    found = cut_lineage(label_components(entities, edges, "canonical_id"))
    labels = numbered_labels(found, "component", "m_")
    mapping = lookup(found, labels, "component", "inner").select("canonical_id", F.col("label").alias("master_cluster_id"))
    return entities.join(mapping, "canonical_id")


def second_pass(entities: DataFrame, scorer=None, reach: tuple[int, int] | None = None) -> DataFrame:
    """Refined entities: merged, renamed to core names, aliases cleaned, largest first.

    ``scorer`` replaces the token-sort ratio of two core names (see ``best_other_names``).
    """
    edges = None if scorer is None else second_pass_edges(entities, scorer, reach)
    refined = refine_names(refined_entities(master_clusters(entities, edges)))
    return refined.orderBy(F.desc("record_count"), "canonical_id")


__all__ = [
    "alias_variants", "cluster_firms", "connected_components", "master_clusters", "name_node",
    "second_pass", "second_pass_edges",
]
