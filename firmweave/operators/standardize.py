"""Harmonise differing source columns, give rows stable ids, standardise values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from firmweave.functions import text as X

# Harmonised column -> source columns that may fill it, best first.
ALIASES = {
    "raw_company_name": ["company_name", "scraped_name", "name"],
    "raw_website": ["website", "url"],
    "raw_country": ["country", "country_code"],
    "raw_city": ["city"],
    "raw_address": ["address"],
    "raw_industry": ["industry_tags", "tags", "industry"],
    "raw_certs": ["certifications"],
    "raw_employees": ["employees"],
    "raw_founded_year": ["founded_year"],
    "raw_source": ["source_dataset", "source"],
    "raw_date": ["scraped_at"],
}
# What JSON lines accept instead.
JSON_ALIASES = {
    "raw_country": ["country", "location.country", "country_code"],
    "raw_city": ["city", "location.city"],
    "raw_address": ["address", "location.address"],
    "raw_employees": ["employees", "employee_count"],
    "raw_founded_year": ["founded_year", "est_year"],
}
RAW_COLUMNS = ["raw_id", *ALIASES]

# Copies of one row beyond this many are spread over tasks before they are numbered.
COPIES_PER_TASK = 100_000


def _resolve(schema: T.StructType, path: str) -> str | None:
    """The real path of a possibly nested column, ignoring case; None if it is not there."""
    found: list[str] = []
    for part in path.split("."):
        if not isinstance(schema, T.StructType):
            return None
        field = next((f for f in schema.fields if f.name.lower() == part.lower()), None)
        if field is None:
            return None
        found.append(f"`{field.name}`")
        schema = field.dataType
    return ".".join(found)


def harmonise(
    df: DataFrame, kind: str, aliases: dict[str, list[str]] | None = None
) -> DataFrame:
    """The text columns of ``ALIASES`` from whichever source columns exist."""
    names = {**ALIASES, **(JSON_ALIASES if kind == "jsonl" else {}), **(aliases or {})}
    defaults = {"raw_source": F.lit(kind), "raw_date": F.current_date()}
    columns = []
    for target, candidates in names.items():
        path = next((p for p in (_resolve(df.schema, c) for c in candidates) if p), None)
        value = F.col(path) if path else defaults.get(target, F.lit(None))
        columns.append(value.cast("string").alias(target))
    return df.select(*columns)


def row_key(kind: Column | str, *values: Column) -> Column:
    """md5 over a label and values; a NULL differs from an empty text."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    parts = [F.coalesce(v.cast("string"), F.lit("<null>")) for v in values]
    return F.md5(F.concat_ws("\x1f", kind, *parts))


def with_row_ids(df: DataFrame, kind: str, id_column: str = "raw_id", copies_per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Add an id that depends on the row's values only; equal rows are told apart by a copy number.

    Equal rows are counted (combined before the shuffle) and unfolded again, so
    a row that fills a third of the input does not fill one task.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    one = F.lit(1).cast("bigint")
    few = counted.filter(F.col("__n") <= copies_per_task).withColumn("__copy", F.explode(F.sequence(one, "__n")))
    many = (
        counted.filter(F.col("__n") > copies_per_task)
        .withColumn("__from", F.explode(F.sequence(one, "__n", F.lit(copies_per_task).cast("bigint"))))
        .repartition(*columns, "__from")
        .withColumn("__copy", F.explode(F.sequence("__from", F.least("__n", F.col("__from") + copies_per_task - 1))))
        .drop("__from")
    )
    return few.unionByName(many).select(
        row_key(kind, *[F.col(c) for c in columns], F.col("__copy")).alias(id_column), *columns
    )


def harmonised_union(frames: dict[str, DataFrame]) -> DataFrame:
    """All formats in one table of ``RAW_COLUMNS``."""
    parts = [with_row_ids(harmonise(df, kind), kind) for kind, df in frames.items()]
    return reduce(DataFrame.unionByName, parts).select(*RAW_COLUMNS)


def standardize(raw: DataFrame) -> DataFrame:
    """The 13-column firms table; rows without a name are left out."""
    c = F.col
    return raw.filter(~X.is_blank("raw_company_name")).select(
        c("raw_id").alias("unique_id"),
        c("raw_company_name").alias("original_name"),
        X.canonical_name("raw_company_name").alias("company_name"),
        X.bare_website("raw_website").alias("website"),
        X.canonical_country("raw_country").alias("country"),
        F.lower(F.trim("raw_city")).alias("city"),
        F.lower(F.trim("raw_address")).alias("address"),
        F.lower(F.trim("raw_industry")).alias("industry_tags"),
        F.upper(F.trim("raw_certs")).alias("certifications"),
        F.trim("raw_employees").alias("employees"),
        X.lenient_int("raw_founded_year").alias("founded_year"),
        c("raw_source").alias("source_dataset"),
        X.lenient_date("raw_date").alias("scraped_at"),
    )
