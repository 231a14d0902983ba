"""Fill missing domains from lookup tables, merge entities by domain, choose logos."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from firmweave.functions.text import clean_domain, is_missing, match_key
from firmweave.operators.fuzzy import best_reference
from firmweave.operators.golden import unified_entities
from firmweave.operators.relational import lookup
from firmweave.storage import cut_lineage

# Industries of the fuzzy reference, cut-off in the standard flow,
# logo addresses in order of preference, and domains that mean "none".
AUTOMOTIVE = r"(?i)auto|motor|vehicle"
FUZZY_CUTOFF = 94
LOGO_TEMPLATES = [
    "https://api.companyenrich.com/logo/{domain}",
    "https://www.google.com/s2/favicons?domain={domain}&sz=256",
]
NO_DOMAIN = ["Missing", "nan"]


def unified_reference(*tables: DataFrame) -> DataFrame:
    """Lookup tables united, without gaps, one row for each ``ref_name`` (smallest domain wins)."""
    return (
        reduce(DataFrame.unionByName, tables)
        .dropna(subset=["ref_name", "ref_domain"])
        .groupBy("ref_name")
        .agg(F.min(F.struct("ref_domain", "ref_industry")).alias("r"))
        .select("ref_name", "r.ref_domain", "r.ref_industry")
    )


def automotive(reference: DataFrame) -> DataFrame:
    return reference.filter(F.col("ref_industry").rlike(AUTOMOTIVE))


def _fill(entities: DataFrame, found: DataFrame, key: Column) -> DataFrame:
    """Fill missing domains from ``found`` (key, ref_domain), unique on key; other rows are not joined."""
    missing = is_missing("domain")
    filled = lookup(
        entities.filter(missing).withColumn("key", key), found.select("key", "ref_domain"), "key"
    ).withColumn("domain", F.coalesce(F.nullif("domain", F.lit("")), "ref_domain"))
    return entities.filter(~missing).unionByName(filled.select(*entities.columns))


def fill_exact(entities: DataFrame, reference: DataFrame) -> DataFrame:
    """Fill missing domains by exact (case-insensitive) name."""
    keyed = (
        reference.withColumn("key", match_key("ref_name"))
        .groupBy("key").agg(F.min(F.struct("ref_name", "ref_domain")).alias("r"))
        .select("key", "r.ref_domain")
    )
    return _fill(entities, keyed, match_key("primary_company_name"))


def fill_bulk(entities: DataFrame, bulk: DataFrame) -> DataFrame:
    """Fill missing domains from a table far larger than the entities.

    Only keys of missing names leave the scan. The keys are written first, so
    Spark broadcasts them exactly if their known size allows it.
    """
    keys = cut_lineage(
        entities.filter(is_missing("domain"))
        .select(match_key("primary_company_name").alias("key")).distinct()
    )
    hits = (
        bulk.select(match_key("ref_name").alias("key"), "ref_domain").dropna()
        .join(keys, "key", "left_semi")
        .groupBy("key").agg(F.min("ref_domain").alias("ref_domain"))
    )
    return _fill(entities, hits, match_key("primary_company_name"))


def fill_fuzzy(entities: DataFrame, reference: DataFrame, cutoff: float = FUZZY_CUTOFF) -> DataFrame:
    """Fill missing domains by the best fuzzy name in ``reference``."""
    names = entities.filter(is_missing("domain")).select(F.col("primary_company_name").alias("name")).dropna().distinct()
    best = best_reference(names, reference, cutoff).withColumnRenamed("name", "key")
    return _fill(entities, best, F.col("primary_company_name"))


def clean_domains(entities: DataFrame) -> DataFrame:
    return entities.withColumn("domain", clean_domain("domain"))


def unify_domains(entities: DataFrame) -> DataFrame:
    """Merge entities that share a domain; the smallest id stands for the group.

    An entity has one domain, so the groups are already the components.
    """
    entities = cut_lineage(entities)  # read four times
    rich = entities.filter(~is_missing("domain"))
    least = rich.groupBy("domain").agg(F.min("canonical_id").alias("least"))
    moved = lookup(rich, least, "domain", "inner").withColumn("canonical_id", F.col("least"))
    return unified_entities(
        entities.filter(is_missing("domain")).unionByName(moved.select(*entities.columns))
    )


def with_logos(entities: DataFrame, url_status: DataFrame) -> DataFrame:
    """Add ``logo_url``: the first logo address that ``url_status`` (url, status) reports as 200."""
    usable = ~is_missing("domain") & ~F.col("domain").isin(NO_DOMAIN)
    domain = F.when(usable, match_key("domain"))
    keyed = entities.withColumn("__domain", domain)
    urls = [
        F.struct(F.lit(i).alias("rank"), F.replace(F.lit(t), F.lit("{domain}"), F.col("__domain")).alias("url"))
        for i, t in enumerate(LOGO_TEMPLATES)
    ]
    live = url_status.filter("status = 200").select("url").distinct()
    chosen = (
        keyed.select("__domain").dropna().distinct()
        .select("__domain", F.inline(F.array(*urls)))
        .join(live, "url")
        .groupBy("__domain").agg(F.min(F.struct("rank", "url")).alias("best"))
        .select("__domain", F.col("best.url").alias("logo_url"))
    )
    known = lookup(keyed.filter(F.col("__domain").isNotNull()), chosen, "__domain")
    none = keyed.filter(F.col("__domain").isNull()).withColumn("logo_url", F.lit(None).cast("string"))
    return known.unionByName(none).drop("__domain")


def domain_fill_rate(entities: DataFrame) -> DataFrame:
    filled = F.count_if(~is_missing("domain"))
    return entities.agg(
        F.count(F.lit(1)).alias("total"),
        filled.alias("filled"),
        F.round(F.try_divide(filled * 100.0, F.count(F.lit(1))), 6).alias("fill_percent"),
    )
