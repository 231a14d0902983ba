"""Company-like rows derived from the given tables, as DataFrames and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from firmweave.functions.text import (
    COUNTRY_SPELLINGS, DIVISION_TAGS, LEGAL_SUFFIXES, clean_domain, core_name,
)
from firmweave.operators.components import numbered_labels
from firmweave.operators.golden import first_pass_entities
from firmweave.operators.relational import salted_join
from firmweave.operators.resolve import hot_nodes, name_node, name_nodes
from firmweave.operators.standardize import standardize
from firmweave.sources.readers import reference_table
from firmweave.storage import cut_lineage
from workload.registry import table

# ---------------------------------------------------------------- DataFrames


def firms_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    words = F.split("p_name", " ")
    name = F.when(key % 4 == 3, F.concat_ws(" ", words[1], words[0])).otherwise(F.col("p_name"))
    name = F.when(key % 5 == 1, F.upper(name)).otherwise(name)
    suffixes = ["", " GmbH", " Inc.", " Ltd", " Automotive Division", " & Co. KG", ",  AG"]
    suffix = F.element_at(F.array(*[F.lit(x) for x in suffixes]), (key % 7 + 1).cast("int"))
    countries = ["DE", "Deutschland", "usa", " us ", "KR", "Brazil", "Türkiye", None]
    years = ["1999", "1999.0", " 2001 ", "abc", None]
    dates = ["2024-01-02", "2024", "2024-01-02T03:04:05", None]
    sources = ["csv", "jsonl", "parquet"]

    def pick(values, index):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))

    return table(spark, sf_dir, "part").select(
        key.cast("string").alias("raw_id"),
        F.when(key % 97 == 0, None).when(key % 89 == 0, "   ").otherwise(F.concat(name, suffix)).alias("raw_company_name"),
        F.when(key % 3 != 0, F.concat(F.lit("https://www."), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(".com/about"))).alias("raw_website"),
        pick(countries, F.col("p_size") % 8).alias("raw_country"),
        F.concat(F.lit(" "), "p_brand", F.lit(" ")).alias("raw_city"),
        F.concat(F.lit("  "), "p_type").alias("raw_address"),
        F.when(F.col("p_type") == "ECONOMY", "auto parts").otherwise(F.col("p_type")).alias("raw_industry"),
        F.lower("p_brand").alias("raw_certs"),
        F.concat(F.lit(" "), F.col("p_size").cast("string")).alias("raw_employees"),
        pick(years, key % 5).alias("raw_founded_year"),
        pick(sources, key % 3).alias("raw_source"),
        pick(dates, key % 4).alias("raw_date"),
    )


def firms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize(firms_raw(spark, sf_dir))


def core_clusters(firms: DataFrame) -> DataFrame:
    """Firms with a cluster for each core name, numbered by the smallest firm id."""
    named = firms.withColumn("node", name_node())
    nodes = name_nodes(named)
    labels = numbered_labels(nodes, "least", "v_")
    clusters = nodes.join(labels, "least").select("node", F.col("label").alias("cluster_id"))
    return salted_join(named, clusters, hot_nodes(nodes), "node", "inner").drop("node")


def core_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-pass entities of ``core_clusters``, as a table of their own."""
    return cut_lineage(first_pass_entities(core_clusters(firms(spark, sf_dir))))


def firm_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every firm as an entity of its own, named by its core name, many without a domain."""
    return firms(spark, sf_dir).select(
        F.col("unique_id").alias("canonical_id"),
        core_name("company_name").alias("primary_company_name"),
        F.array("original_name").alias("aliases"),
        F.lit(1).cast("bigint").alias("record_count"),
        F.when(F.col("country").isNotNull(), F.array("country")).alias("operating_countries"),
        clean_domain("website").alias("domain"),
    )


def reference_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    form = F.when(key % 3 == 1, F.concat("p_name", F.lit(" co"))).when(key % 3 == 2, F.initcap("p_name")).otherwise(F.col("p_name"))
    domain = F.concat(F.replace("p_name", F.lit(" "), F.lit("")), F.lit("-"), (key % 10).cast("string"), F.lit(".com"))
    rows = table(spark, sf_dir, "part").select(
        form.alias("name"),
        F.when(key % 11 != 0, domain).alias("domain"),
        F.when(F.col("p_size") % 3 == 0, "automotive").when(F.col("p_size") % 3 == 1, "Motor vehicles").otherwise("retail").alias("industry"),
    )
    return reference_table(rows)


def bulk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return sold.join(part, sold.l_partkey == part.p_partkey).select(
        F.concat(F.lit(" "), F.upper("p_name"), F.lit(" ")).alias("ref_name"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-"), F.col("l_suppkey").cast("string"), F.lit(".com")).alias("ref_domain"),
    )


# ----------------------------------------------------------------------- SQL

FIRMS_RAW_SQL = """
firms_raw AS (
  SELECT CAST(p_partkey AS VARCHAR) AS raw_id,
    CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 89 = 0 THEN '   '
         ELSE (CASE WHEN p_partkey % 5 = 1 THEN upper(base) ELSE base END)
              || (['', ' GmbH', ' Inc.', ' Ltd', ' Automotive Division', ' & Co. KG', ',  AG'])[p_partkey % 7 + 1]
    END AS raw_company_name,
    CASE WHEN p_partkey % 3 <> 0 THEN 'https://www.' || replace(p_name, ' ', '-') || '.com/about' END AS raw_website,
    (['DE', 'Deutschland', 'usa', ' us ', 'KR', 'Brazil', 'Türkiye', NULL])[p_size % 8 + 1] AS raw_country,
    ' ' || p_brand || ' ' AS raw_city,
    '  ' || p_type AS raw_address,
    CASE WHEN p_type = 'ECONOMY' THEN 'auto parts' ELSE p_type END AS raw_industry,
    lower(p_brand) AS raw_certs,
    ' ' || CAST(p_size AS VARCHAR) AS raw_employees,
    (['1999', '1999.0', ' 2001 ', 'abc', NULL])[p_partkey % 5 + 1] AS raw_founded_year,
    (['csv', 'jsonl', 'parquet'])[p_partkey % 3 + 1] AS raw_source,
    (['2024-01-02', '2024', '2024-01-02T03:04:05', NULL])[p_partkey % 4 + 1] AS raw_date
  FROM (SELECT *, CASE WHEN p_partkey % 4 = 3 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)
                       ELSE p_name END AS base FROM part)
)"""


def country_sql(column: str) -> str:
    arms = " ".join(
        f"WHEN upper(trim({column})) IN ({', '.join(repr(s) for s in spellings)}) THEN '{country}'"
        for country, spellings in COUNTRY_SPELLINGS.items()
    )
    return f"CASE {arms} ELSE upper(trim({column})) END"


def core_sql(column: str) -> str:
    text = f"trim(lower(coalesce({column}, '')))"
    for tag in DIVISION_TAGS:
        text = f"regexp_replace({text}, '{tag}', '', 'gi')"
    tail = rf"[\s.,/&-]*(?:\b(?:{LEGAL_SUFFIXES})\b[\s.,/&-]*)*$"
    return f"upper(trim(regexp_replace({text}, '{tail}', '', 'i')))"


def domain_sql(column: str) -> str:
    host = f"regexp_replace(regexp_extract(regexp_replace(lower(trim({column})), '^(https?://)?', ''), '^[^/?#]*'), '^www\\.', '')"
    return (
        f"CASE WHEN regexp_matches({host}, '\\.[^.]{{2,}}$') AND {host} NOT IN "
        "('linkedin.com','facebook.com','twitter.com','wikipedia.org','google.com','baidu.com',"
        "'github.com','youtube.com','instagram.com','juraforum.de','weforum.org','motogp.com') "
        f"THEN {host} END"
    )


FIRMS_SQL = FIRMS_RAW_SQL + rf""",
firms AS (
  SELECT raw_id AS unique_id, raw_company_name AS original_name,
    regexp_replace(lower(trim(raw_company_name)), '\s+', ' ', 'g') AS company_name,
    regexp_replace(lower(trim(raw_website)), '^(https?://)?(www\.)?', '') AS website,
    {country_sql('raw_country')} AS country,
    lower(trim(raw_city)) AS city, lower(trim(raw_address)) AS address, lower(trim(raw_industry)) AS industry_tags,
    upper(trim(raw_certs)) AS certifications, trim(raw_employees) AS employees,
    TRY_CAST(raw_founded_year AS INTEGER) AS founded_year, raw_source AS source_dataset,
    TRY_CAST(raw_date AS DATE) AS scraped_at
  FROM firms_raw WHERE raw_company_name IS NOT NULL AND trim(raw_company_name) <> ''
)"""

NODES_SQL = FIRMS_SQL + f""",
named AS (
  SELECT *, CASE WHEN core <> '' THEN core ELSE coalesce(company_name, '') END AS node
  FROM (SELECT *, {core_sql('company_name')} AS core FROM firms)
)"""

CLUSTERS_SQL = NODES_SQL + """,
clusters AS (
  SELECT named.* EXCLUDE (node, core), 'v_' || lpad(CAST(no - 1 AS VARCHAR), 6, '0') AS cluster_id
  FROM named JOIN (SELECT node, row_number() OVER (ORDER BY least_id) AS no
                   FROM (SELECT node, min(unique_id) AS least_id FROM named GROUP BY node)) USING (node)
)"""


def mode_sql(table_name: str, key: str, column: str, name: str) -> str:
    """CTE ``name`` (key, value): most frequent value, smallest on ties."""
    return f""",
{name} AS (
  SELECT {key}, {column} AS value FROM (
    SELECT {key}, {column}, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {column}) AS rn
    FROM {table_name} WHERE {column} IS NOT NULL GROUP BY {key}, {column}) WHERE rn = 1
)"""


def entities_sql(source: str = "clusters", name: str = "entities") -> str:
    """CTE ``entities``: the first-pass golden table of ``clusters``."""
    return (
        mode_sql(source, "cluster_id", "company_name", f"{name}_name")
        + mode_sql(source, "cluster_id", "website", f"{name}_site")
        + f""",
{name} AS (
  SELECT g.cluster_id AS canonical_id, n.value AS primary_company_name, operating_countries,
    list_sort(list_filter(names, lambda x: x IS NOT NULL AND lower(trim(x)) <> lower(trim(n.value))
                          AND levenshtein(lower(trim(x)), lower(trim(n.value))) > 3)) AS aliases,
    s.value AS primary_website, record_count
  FROM (SELECT cluster_id, list_sort(array_agg(DISTINCT country) FILTER (WHERE country IS NOT NULL)) AS operating_countries,
               array_agg(DISTINCT original_name) AS names, count(*) AS record_count
        FROM {source} GROUP BY cluster_id) g
  LEFT JOIN {name}_name n USING (cluster_id) LEFT JOIN {name}_site s USING (cluster_id)
)"""
    )


ENTITIES_SQL = CLUSTERS_SQL + entities_sql()

FIRM_ENTITIES_SQL = FIRMS_SQL + f""",
firm_entities AS (
  SELECT unique_id AS canonical_id, {core_sql('company_name')} AS primary_company_name, [original_name] AS aliases,
    CAST(1 AS BIGINT) AS record_count, CASE WHEN country IS NOT NULL THEN [country] END AS operating_countries,
    {domain_sql('website')} AS domain
  FROM firms
)"""

REFERENCE_SQL = """
reference_rows AS (
  SELECT CASE WHEN p_partkey % 3 = 1 THEN p_name || ' co'
              WHEN p_partkey % 3 = 2 THEN upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:]
                   || ' ' || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:]
              ELSE p_name END AS ref_name,
    CASE WHEN p_partkey % 11 <> 0 THEN replace(p_name, ' ', '') || '-' || CAST(p_partkey % 10 AS VARCHAR) || '.com' END AS ref_domain,
    CASE WHEN p_size % 3 = 0 THEN 'automotive' WHEN p_size % 3 = 1 THEN 'Motor vehicles' ELSE 'retail' END AS ref_industry
  FROM part
),
reference AS (
  SELECT ref_name, ref_domain, ref_industry FROM (
    SELECT *, row_number() OVER (PARTITION BY ref_name ORDER BY ref_domain, ref_industry) AS rn
    FROM reference_rows WHERE ref_name IS NOT NULL AND ref_domain IS NOT NULL) WHERE rn = 1
)"""


def lcs_sql(a: str, b: str) -> str:
    """Length of the longest common subsequence, one matrix row for each character of ``a``."""
    return f"""CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE coalesce(list_reduce(
      list_transform(string_split({a}, ''), lambda c: list_transform(string_split({b}, ''), lambda d: CASE WHEN c = d THEN 1 ELSE 0 END)),
      lambda prev, e: list_transform(range(1, len(e) + 1), lambda j: CAST(list_max(list_transform(range(1, j + 1), lambda i:
        greatest(prev[i], CASE WHEN i > 1 THEN prev[i - 1] ELSE 0 END + e[i]))) AS INTEGER)),
      list_transform(string_split({b}, ''), lambda d: 0))[-1], 0) END"""


def ratio_sql(a: str, b: str) -> str:
    total = f"(length({a}) + length({b}))"
    return f"(CASE WHEN {total} = 0 THEN 100.0 ELSE 100.0 * (1 - ({total} - 2 * ({lcs_sql(a, b)})) / CAST({total} AS DOUBLE)) END)"


def token_key_sql(text: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split_regex({text}, '\\s+'), lambda t: t <> '')), ' ')"
