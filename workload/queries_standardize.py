"""Standardisation, harmonisation and name/domain clean-up."""

from pyspark.sql import functions as F

from firmweave.functions import text as X
from firmweave.operators.enrich import domain_fill_rate
from firmweave.operators.standardize import harmonised_union, row_key, with_row_ids
from workload import firms as W
from workload.registry import register, table


@register("standardize_firms", f"WITH {W.FIRMS_SQL} SELECT * FROM firms")
def standardize_firms(spark, sf):
    return W.firms(spark, sf)


@register("lenient_casts", f"""WITH {W.FIRMS_RAW_SQL}
SELECT raw_id, TRY_CAST(raw_founded_year AS INTEGER) AS founded_year, TRY_CAST(raw_date AS DATE) AS scraped_at FROM firms_raw""")
def lenient_casts(spark, sf):
    return W.firms_raw(spark, sf).select(
        "raw_id",
        X.lenient_int("raw_founded_year").alias("founded_year"),
        X.lenient_date("raw_date").alias("scraped_at"),
    )


@register("country_canonical", f"""WITH {W.FIRMS_RAW_SQL}
SELECT raw_country, {W.country_sql('raw_country')} AS country, count(*) AS n FROM firms_raw GROUP BY ALL""")
def country_canonical(spark, sf):
    return (
        W.firms_raw(spark, sf).groupBy("raw_country").agg(F.count(F.lit(1)).alias("n"))
        .select("raw_country", X.canonical_country("raw_country").alias("country"), "n")
    )


@register("core_name", f"""WITH {W.FIRMS_RAW_SQL}
SELECT raw_id, raw_company_name, {W.core_sql('raw_company_name')} AS core FROM firms_raw""")
def core_names(spark, sf):
    return W.firms_raw(spark, sf).select("raw_id", "raw_company_name", X.core_name("raw_company_name").alias("core"))


@register("clean_domain", f"SELECT page_id, url, {W.domain_sql('url')} AS domain FROM pages")
def clean_domains(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", X.clean_domain("url").alias("domain"))


@register("bare_website", r"""SELECT page_id, regexp_replace(lower(trim(url)), '^(https?://)?(www\.)?', '') AS website FROM pages""")
def bare_websites(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.bare_website("url").alias("website"))


@register("name_keys", f"""WITH {W.FIRMS_SQL}
SELECT unique_id, lower(trim(original_name)) AS match_key,
  trim(regexp_replace(lower(original_name), '[^a-z0-9_]', ' ', 'g')) AS comparable,
  {W.token_key_sql("trim(regexp_replace(lower(original_name), '[^a-z0-9_]', ' ', 'g'))")} AS sorted_tokens
FROM firms""")
def name_keys(spark, sf):
    return W.firms(spark, sf).select(
        "unique_id",
        X.match_key("original_name").alias("match_key"),
        X.comparable("original_name").alias("comparable"),
        X.token_sort_key(X.comparable("original_name")).alias("sorted_tokens"),
    )


@register("surrogate_key", """
SELECT md5(concat_ws(chr(31), 'event', coalesce(event_type, '<null>'), coalesce(props, '<null>'), CAST(n AS VARCHAR))) AS row_id,
  event_type, props
FROM (SELECT event_type, props, row_number() OVER (PARTITION BY event_type, props) AS n FROM events)""")
def surrogate_key(spark, sf):
    # many equal rows: every copy needs an id of its own
    return with_row_ids(table(spark, sf, "events").select("event_type", "props"), "event", "row_id")


_HARMONISED = """
  SELECT md5(concat_ws(chr(31), 'csv', name, '<null>', country, '<null>', '<null>', industry, '<null>', '<null>', '<null>', 'csv', '2024-05-01',
         CAST(row_number() OVER (PARTITION BY name, country, industry) AS VARCHAR))) AS raw_id,
    name AS raw_company_name, NULL::VARCHAR AS raw_website, country AS raw_country, NULL::VARCHAR AS raw_city, industry AS raw_industry, 'csv' AS raw_source, '2024-05-01' AS raw_date
  FROM (SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS country, c_mktsegment AS industry FROM customer)
  UNION ALL
  SELECT md5(concat_ws(chr(31), 'jsonl', name, '<null>', country, city, '<null>', '<null>', '<null>', '<null>', '<null>', 'jsonl', '2024-05-01',
         CAST(row_number() OVER (PARTITION BY name, country, city) AS VARCHAR))),
    name, NULL, country, city, NULL, 'jsonl', '2024-05-01'
  FROM (SELECT s_name AS name, CAST(s_nationkey AS VARCHAR) AS country, 'city ' || CAST(s_nationkey % 7 AS VARCHAR) AS city FROM supplier)
  UNION ALL
  SELECT md5(concat_ws(chr(31), 'parquet', name, url, '<null>', '<null>', '<null>', tags, '<null>', '<null>', '<null>', source, '2024-05-01',
         CAST(row_number() OVER (PARTITION BY name, url, tags, source) AS VARCHAR))),
    name, url, NULL, NULL, tags, source, '2024-05-01'
  FROM (SELECT p_name AS name, replace(p_name, ' ', '') || '.com' AS url, p_type AS tags, p_brand AS source FROM part)"""


@register("harmonize_union", _HARMONISED)
def harmonize_union(spark, sf):
    day = F.lit("2024-05-01").alias("scraped_at")
    sources = {
        "csv": table(spark, sf, "customer").select(
            F.col("c_name").alias("scraped_name"), F.col("c_nationkey").alias("country_code"),
            F.col("c_mktsegment").alias("industry"), day,
        ),
        "jsonl": table(spark, sf, "supplier").select(
            F.col("s_name").alias("name"),
            F.struct(
                F.col("s_nationkey").alias("country"),
                F.concat(F.lit("city "), (F.col("s_nationkey") % 7).cast("string")).alias("city"),
            ).alias("location"),
            day,
        ),
        "parquet": table(spark, sf, "part").select(
            F.col("p_name").alias("Company_Name"),
            F.concat(F.replace("p_name", F.lit(" "), F.lit("")), F.lit(".com")).alias("url"),
            F.col("p_type").alias("tags"), F.col("p_brand").alias("source"), day,
        ),
    }
    return harmonised_union(sources).select(
        "raw_id", "raw_company_name", "raw_website", "raw_country", "raw_city", "raw_industry", "raw_source", "raw_date"
    )


@register("row_key", f"""
SELECT p_partkey, md5(concat_ws(chr(31), 'part', p_name, coalesce(p_brand, '<null>'))) AS row_key FROM part
UNION ALL SELECT s_suppkey, md5(concat_ws(chr(31), 'supplier', s_name, CAST(s_nationkey AS VARCHAR))) FROM supplier""")
def row_keys(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", row_key("part", F.col("p_name"), F.col("p_brand")).alias("row_key"))
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("p_partkey"), row_key("supplier", F.col("s_name"), F.col("s_nationkey")).alias("row_key"))
    return part.unionByName(supplier)


@register("domain_fill_rate", f"""
SELECT count(*) AS total, count(*) FILTER (WHERE domain IS NOT NULL AND domain <> '') AS filled,
  round(count(*) FILTER (WHERE domain IS NOT NULL AND domain <> '') * 100.0 / count(*), 6) AS fill_percent
FROM (SELECT {W.domain_sql('url')} AS domain FROM pages)""")
def fill_rate(spark, sf):
    return domain_fill_rate(table(spark, sf, "pages").select(X.clean_domain("url").alias("domain")))
