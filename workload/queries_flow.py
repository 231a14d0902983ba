"""Raw files in three formats, read back, and the whole flow from them to the master table."""

import uuid

from pyspark.sql import functions as F

from firmweave.operators.standardize import harmonised_union
from firmweave.plans.pipeline import run_pipeline
from firmweave.sources.readers import list_files, read_bulk_csv, read_parquet, read_raw
from firmweave.storage import cut_lineage, shared_dir
from workload import firms as W
from workload.queries_enrich import ANSWERS_SQL, BULK_SQL, LIVE_SQL, exact_sql, fuzzy_sql, numbered_sql, part_status, responses, unified_sql
from workload.queries_resolve import CORES_SQL, SECOND_SQL, clean_sql, hybrid_sql
from workload.registry import register

_COLUMNS = [
    "raw_company_name", "raw_website", "raw_country", "raw_city", "raw_address", "raw_industry", "raw_certs", "raw_employees",
    "raw_founded_year", "raw_source", "raw_date",
]
# column names of the raw files: CSV in two orders of columns, JSON lines with a location, Parquet in mixed case
_CSV = ["name", "url", "country", "city", "address", "industry", "certifications", "employees", "founded_year", "source", "scraped_at"]
_PARQUET = ["Company_Name", "Website", "country", "city", "address", "industry_tags", "certifications", "employees", "founded_year", "source_dataset", "scraped_at"]
_AS_IS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "header": True, "escape": '"'}


def _scratch(spark, name):
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def raw_folder(spark, sf):
    """A folder of the derived company rows as CSV, JSON lines and Parquet files."""
    rows = W.firms_raw(spark, sf).select(*_COLUMNS)
    folder = _scratch(spark, "raw")

    def of(kind, names):
        return rows.filter(F.col("raw_source") == kind).toDF(*names)

    early = F.col("raw_employees").cast("int") % 2 == 0
    csv = rows.filter("raw_source = 'csv'")
    csv.filter(early).toDF(*_CSV).write.mode("append").options(**_AS_IS).csv(folder)
    later = csv.filter(~early).toDF(*_CSV).withColumn("note", F.lit("x, y"))
    later.select(*reversed(later.columns)).write.mode("append").options(**_AS_IS).csv(folder)
    of("parquet", _PARQUET).write.mode("append").parquet(folder)
    place = F.struct(F.col("raw_country").alias("country"), F.col("raw_city").alias("city"), F.col("raw_address").alias("address")).alias("location")
    rows.filter("raw_source = 'jsonl'").select(
        F.col("raw_company_name").alias("company_name"), F.col("raw_website").alias("url"), place, F.col("raw_industry").alias("tags"),
        F.col("raw_certs").alias("certifications"), F.col("raw_employees").alias("employee_count"), F.col("raw_founded_year").alias("est_year"),
        F.col("raw_source").alias("source"), F.col("raw_date").alias("scraped_at"),
    ).write.mode("append").json(folder)
    # Spark names JSON lines .json
    for path in list_files(spark, folder):
        if path.endswith(".json"):
            old = spark._jvm.org.apache.hadoop.fs.Path(path)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, spark._jvm.org.apache.hadoop.fs.Path(f"{path}l"))
    return folder


# ids that depend on the rows' values, as in the harmonised table
_FILES_SQL = (
    W.FIRMS_RAW_SQL.replace("firms_raw AS (", "derived AS (", 1) + f""",
firms_raw AS (
  SELECT md5(concat_ws(chr(31), raw_source, {', '.join(f"coalesce({c}, '<null>')" for c in _COLUMNS)},
      CAST(row_number() OVER (PARTITION BY {', '.join(_COLUMNS)}) AS VARCHAR))) AS raw_id, * EXCLUDE (raw_id)
  FROM derived
)"""
)


@register("raw_files_union", f"WITH {_FILES_SQL} SELECT * FROM firms_raw")
def raw_files_union(spark, sf):
    """All rows of the raw files under their harmonised names, read by every reader."""
    return harmonised_union(read_raw(spark, raw_folder(spark, sf)))


_MASTER_SQL = f"""
WITH RECURSIVE {W.NODES_SQL}, {hybrid_sql(CORES_SQL, 0.88)},
name_reach(a, b) AS (
  SELECT DISTINCT node, node FROM named
  UNION SELECT r.a, CASE WHEN h.a = r.b THEN h.b ELSE h.a END FROM name_reach r JOIN hybrid h ON h.a = r.b OR h.b = r.b),
name_owner AS (SELECT a AS node, min(unique_id) AS least_id FROM name_reach JOIN named ON named.node = b GROUP BY a),
clusters AS (
  SELECT named.* EXCLUDE (node, core), 'v_' || lpad(CAST(dense_rank() OVER (ORDER BY least_id) - 1 AS VARCHAR), 6, '0') AS cluster_id
  FROM named JOIN name_owner USING (node)){W.entities_sql()}, {SECOND_SQL},
second AS ({clean_sql('refined')}), {W.REFERENCE_SQL}, {exact_sql('second', 'exact_filled')},
exact AS (SELECT * REPLACE ({W.domain_sql('domain')} AS domain) FROM exact_filled), {BULK_SQL},
bulk_filled AS (SELECT e.* REPLACE (coalesce(nullif(domain, ''), ref_domain) AS domain)
  FROM exact e LEFT JOIN bulk ON k = lower(trim(primary_company_name))),
cleaned AS (SELECT * REPLACE ({W.domain_sql('domain')} AS domain) FROM bulk_filled), {fuzzy_sql(94, 'cleaned')},
fuzzy_filled AS (SELECT e.* REPLACE (coalesce(nullif(domain, ''), ref_domain) AS domain)
  FROM cleaned e LEFT JOIN best_refs ON name = primary_company_name),
filled AS (SELECT * REPLACE ({W.domain_sql('domain')} AS domain) FROM fuzzy_filled), {unified_sql('filled')}, {LIVE_SQL},
{numbered_sql('unified')}, {ANSWERS_SQL}
SELECT u.canonical_id, primary_company_name, coalesce(nullif(verified_domain, 'Missing'), domain) AS domain,
  coalesce(description, 'Information not found.') AS description, record_count, operating_countries, aliases,
  CASE WHEN one THEN 'https://api.companyenrich.com/logo/' || d
       WHEN two THEN 'https://www.google.com/s2/favicons?domain=' || d || '&sz=256' END AS logo_url
FROM unified u LEFT JOIN live ON d = lower(trim(domain)) LEFT JOIN answers ON id = u.canonical_id""".replace(W.FIRMS_RAW_SQL, _FILES_SQL)


@register("master_entities", _MASTER_SQL)
def master_entities(spark, sf):
    """Raw files to master table by the library's own flow: both passes, three lookups, domain merge, logos, and the
    answers to the requests of a first run, which the second run takes up where its stages end."""
    raw, out = raw_folder(spark, sf), _scratch(spark, "out")
    known, bulk = _scratch(spark, "reference"), _scratch(spark, "bulk")
    W.reference_rows(spark, sf).write.parquet(known)
    W.bulk_rows(spark, sf).write.options(**_AS_IS).csv(bulk)
    lookups = dict(
        references=[read_parquet(spark, [known])], bulk=read_bulk_csv(spark, [p for p in list_files(spark, bulk) if p.endswith(".csv")]), url_status=cut_lineage(part_status(spark, sf)),
    )
    run_pipeline(spark, raw, out, **lookups)
    requests = spark.read.parquet(f"{out}/requests/*")
    return run_pipeline(spark, raw, out, **lookups, responses=cut_lineage(responses(requests)))
