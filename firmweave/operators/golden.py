"""Golden records: one row per entity built from value counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firmweave.functions.similarity import indel_budget, indel_distance, within_edits
from firmweave.functions.text import core_name, strip
from firmweave.operators.relational import mode_of, value_counts, values_of

# An alias must differ from the primary name by more edits than
# this, and a refined alias must score at most 98 against it.
ALIAS_EDIT_DISTANCE = 3
NEAR_COPY = dict(num=1, den=50, strict=True)


def distinct_aliases(names: Column, primary: Column) -> Column:
    """Names that are not small variations of ``primary``."""
    root = F.lower(F.trim(primary))
    return F.filter(
        names,
        lambda x: (F.lower(F.trim(x)) != root)
        & (F.levenshtein(F.lower(F.trim(x)), root) > ALIAS_EDIT_DISTANCE),
    )


def first_pass_entities(clusters: DataFrame) -> DataFrame:
    """Entities from clustered firms: modal name and website, countries, aliases, row count."""
    fields = ["company_name", "country", "original_name", "website"]
    profile = value_counts(clusters, "cluster_id", fields)
    return (
        profile.groupBy("cluster_id")
        .agg(
            mode_of("company_name").alias("primary_company_name"),
            values_of("country").alias("operating_countries"),
            values_of("original_name").alias("names"),
            mode_of("website").alias("primary_website"),
            F.sum("weight").alias("record_count"),
        )
        .select(
            F.col("cluster_id").alias("canonical_id"),
            "primary_company_name",
            "operating_countries",
            distinct_aliases(F.col("names"), F.col("primary_company_name")).alias("aliases"),
            "primary_website",
            "record_count",
        )
    )


def merged_entities(entities: DataFrame, key: str, domain: str, names: str = "all") -> DataFrame:
    """Collapse entities that share ``key``: modes, united arrays, summed record counts.

    ``names="all"`` adds the primary names to the united aliases.
    """
    weight = (
        F.coalesce("record_count", F.lit(0)) if "record_count" in entities.columns else F.lit(1)
    )
    fields = ["primary_company_name", "aliases", "operating_countries", domain]
    united = ["aliases", "primary_company_name"] if names == "all" else ["aliases"]
    return (
        value_counts(entities, key, fields, weight)
        .groupBy(key)
        .agg(
            mode_of("primary_company_name").alias("primary_company_name"),
            values_of(*united).alias("names"),
            F.sum("weight").alias("record_count"),
            values_of("operating_countries").alias("operating_countries"),
            mode_of(domain).alias("domain"),
        )
    )


def refined_entities(entities: DataFrame, key: str = "master_cluster_id") -> DataFrame:
    """Second-pass golden table before alias clean-up (column ``all_variations``)."""
    return merged_entities(entities, key, "primary_website").select(
        F.col(key).alias("canonical_id"),
        "primary_company_name",
        F.col("names").alias("all_variations"),
        "record_count",
        "operating_countries",
        "domain",
    )


def refine_names(refined: DataFrame) -> DataFrame:
    """Primary name reduced to its core; aliases unique without case and without near copies."""
    base = refined.withColumn("primary_company_name", core_name("primary_company_name"))
    alias = base.select(
        "canonical_id",
        strip(F.lower("primary_company_name")).alias("root"),
        F.explode("all_variations").alias("alias"),
    ).select("canonical_id", "root", strip("alias").alias("alias"))
    alias = alias.withColumn("folded", F.lower("alias")).filter("alias != '' and folded != root")
    budget = indel_budget(F.length("folded") + F.length("root"), **NEAR_COPY)
    close = (budget > 0) & within_edits(F.col("folded"), F.col("root"), F.greatest(F.lit(0), budget))
    near = alias.filter(close).filter(indel_distance(F.col("folded"), F.col("root")) > budget)
    kept = (
        alias.filter(~close).unionByName(near)
        .groupBy("canonical_id", "folded").agg(F.min("alias").alias("alias"))
        .groupBy("canonical_id").agg(F.sort_array(F.collect_list("alias")).alias("aliases"))
    )
    return (
        base.drop("all_variations")
        .join(kept, "canonical_id", "left")
        .withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))
    )


def unified_entities(entities: DataFrame) -> DataFrame:
    """Entities that got the same ``canonical_id`` collapsed to one row each (six columns)."""
    return merged_entities(entities, "canonical_id", "domain", names="aliases").select(
        "canonical_id",
        "primary_company_name",
        F.coalesce("names", F.array().cast("array<string>")).alias("aliases"),
        "record_count",
        "operating_countries",
        "domain",
    )


def serving_entities(clusters: DataFrame) -> DataFrame:
    """The 13-column golden table for serving, straight from clustered firms."""
    text = [
        "company_name", "address", "city", "website", "industry_tags", "certifications",
        "employees", "founded_year", "country", "source_dataset", "scraped_at",
    ]
    latest = F.max(F.when(F.col("field") == "scraped_at", F.col("value").try_cast("date")))
    return (
        value_counts(clusters, "cluster_id", text)
        .groupBy("cluster_id")
        .agg(
            mode_of("company_name").alias("primary_company_name"),
            values_of("company_name").alias("names"),
            mode_of("address").alias("address"),
            mode_of("city").alias("city"),
            values_of("country").alias("operating_countries"),
            mode_of("website").alias("primary_website"),
            mode_of("industry_tags").alias("industry_tags"),
            mode_of("certifications").alias("certifications"),
            mode_of("employees").alias("employees"),
            mode_of("founded_year", "int").alias("founded_year"),
            mode_of("source_dataset").alias("source_dataset"),
            latest.alias("scraped_at"),
        )
        .select(
            F.col("cluster_id").alias("canonical_id"),
            "primary_company_name",
            F.filter("names", lambda x: x != F.col("primary_company_name")).alias("aliases"),
            "address",
            "city",
            "operating_countries",
            "primary_website",
            "industry_tags",
            "certifications",
            "employees",
            "founded_year",
            "source_dataset",
            "scraped_at",
        )
    )
