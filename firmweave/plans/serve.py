"""Questions users ask of the master table. Every function returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Texts that count as empty in the statistics, and report sizes.
EMPTY_DOMAINS = ["", "-", "Missing", "unknown"]
EMPTY_LOGOS = ["", "-"]
EMPTY_DESCRIPTIONS = ["Information not found.", "Information not found", "Missing"]
SEARCH_ROWS = 20
LIST_ROWS = 50
TOP_ROWS = 10


def search(master: DataFrame, text: str, limit: int = SEARCH_ROWS) -> DataFrame:
    """Entities whose name, aliases or domain contain ``text``, ignoring case."""
    pattern = "%" + text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
    hit = (
        F.col("primary_company_name").ilike(pattern)
        | F.array_join("aliases", ",").ilike(pattern)
        | F.col("domain").ilike(pattern)
    )
    columns = [
        "canonical_id", "primary_company_name", "domain", "record_count", "aliases",
        "operating_countries", "logo_url",
    ]
    return master.filter(hit).select(*columns).orderBy("canonical_id").limit(limit)


def list_all(master: DataFrame, limit: int = LIST_ROWS) -> DataFrame:
    return master.orderBy("canonical_id").limit(limit)


def inspect(master: DataFrame, canonical_id: str) -> DataFrame:
    """(field, value) for one entity; arrays are joined with commas."""
    def shown(name: str, kind: str) -> Column:
        value = F.array_join(name, ", ") if kind.startswith("array") else F.col(name).cast("string")
        return F.struct(F.lit(name).alias("field"), value.alias("value"))

    return master.filter(F.col("canonical_id") == canonical_id).select(
        F.inline(F.array(*[shown(n, k) for n, k in master.dtypes]))
    )


def stats(firms: DataFrame, master: DataFrame) -> DataFrame:
    """One row: rows, names, entities and how many have a domain, logo and description."""
    def filled(column: str, empty: list[str]) -> Column:
        return F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(empty))

    raw = firms.agg(
        F.struct(
            F.count(F.lit(1)).alias("raw_rows"), F.count_distinct("company_name").alias("raw_names")
        )
    ).scalar()
    final = master.agg(
        F.count(F.lit(1)).alias("clusters"),
        filled("domain", EMPTY_DOMAINS).alias("domains"),
        filled("logo_url", EMPTY_LOGOS).alias("logos"),
        filled("description", EMPTY_DESCRIPTIONS).alias("descriptions"),
    )
    counted = final.withColumn("raw", raw).select("raw.*", *final.columns)

    def share(part: str) -> Column:
        return F.round(F.try_divide(F.col(part) * 100.0, F.col("clusters")), 6)

    return counted.select(
        "*",
        F.round(F.try_divide(F.col("raw_rows") * 1.0, F.col("clusters")), 6).alias("consolidation"),
        share("domains").alias("domain_percent"),
        share("logos").alias("logo_percent"),
        share("descriptions").alias("description_percent"),
    )


def top_entities(master: DataFrame, limit: int = TOP_ROWS) -> DataFrame:
    """Largest entities by merged records, with their number of countries."""
    return (
        master.select(
            "canonical_id",
            "primary_company_name",
            "record_count",
            F.size(F.coalesce("operating_countries", F.array().cast("array<string>")))
            .cast("bigint").alias("country_count"),
        )
        .orderBy(F.desc("record_count"), "canonical_id")
        .limit(limit)
    )
