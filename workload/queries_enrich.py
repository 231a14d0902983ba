"""Lookup joins, domain merging, logos, verification tables, serving and the whole flow."""

from pyspark.sql import functions as F

from firmweave.functions.text import clean_domain
from firmweave.operators import enrich, verify
from firmweave.operators.fuzzy import best_reference
from firmweave.operators.golden import first_pass_entities
from firmweave.plans import serve
from firmweave.storage import cut_lineage
from workload import firms as W
from workload.registry import register, table

# ------------------------------------------------------------- lookup tables


@register("reference_unique", f"WITH {W.REFERENCE_SQL} SELECT * FROM reference")
def reference_unique(spark, sf):
    return enrich.unified_reference(W.reference_rows(spark, sf))


@register("reference_automotive", f"""WITH {W.REFERENCE_SQL}
SELECT * FROM reference WHERE regexp_matches(ref_industry, '(?i)auto|motor|vehicle')""")
def reference_automotive(spark, sf):
    return enrich.automotive(enrich.unified_reference(W.reference_rows(spark, sf)))


def exact_sql(source: str, name: str) -> str:
    return f"""
exact_keys AS (
  SELECT k, ref_domain FROM (
    SELECT lower(trim(ref_name)) AS k, ref_domain, row_number() OVER (PARTITION BY lower(trim(ref_name)) ORDER BY ref_name) AS rn FROM reference)
  WHERE rn = 1),
{name} AS (
  SELECT e.* REPLACE (coalesce(nullif(domain, ''), ref_domain) AS domain)
  FROM {source} e LEFT JOIN exact_keys ON k = lower(trim(primary_company_name)))"""


@register("direct_join_fill", f"WITH {W.FIRM_ENTITIES_SQL}, {W.REFERENCE_SQL}, {exact_sql('firm_entities', 'exact_filled')} SELECT canonical_id, primary_company_name, domain FROM exact_filled")
def direct_join_fill(spark, sf):
    reference = enrich.unified_reference(W.reference_rows(spark, sf))
    filled = enrich.fill_exact(W.firm_entities(spark, sf), reference)
    return filled.select("canonical_id", "primary_company_name", "domain")


BULK_SQL = """
bulk AS (
  SELECT lower(p_name) AS k, min(replace(p_name, ' ', '-') || '-' || CAST(l_suppkey AS VARCHAR) || '.com') AS ref_domain
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)"""


@register("bulk_lookup_fill", f"""WITH {W.FIRM_ENTITIES_SQL}, {BULK_SQL}
SELECT canonical_id, primary_company_name, coalesce(nullif(domain, ''), ref_domain) AS domain
FROM firm_entities LEFT JOIN bulk ON k = lower(trim(primary_company_name))""")
def bulk_lookup_fill(spark, sf):
    filled = enrich.fill_bulk(W.firm_entities(spark, sf), W.bulk_rows(spark, sf))
    return filled.select("canonical_id", "primary_company_name", "domain")


_COMPARABLE = "trim(regexp_replace(lower({c}), '[^a-z0-9_]', ' ', 'g'))"


def fuzzy_sql(cutoff: float, source: str = "firm_entities") -> str:
    """Best automotive reference by weighted ratio, all pairs within the length limit."""
    def words(x):
        return f"list_sort(list_distinct(list_filter(string_split_regex({x}, '\\s+'), lambda t: t <> '')))"

    def join(x):
        return f"array_to_string({x}, ' ')"

    return f"""
missing_names AS (SELECT DISTINCT primary_company_name AS name, {_COMPARABLE.format(c='primary_company_name')} AS a
  FROM {source} WHERE domain IS NULL OR domain = ''),
auto AS (SELECT ref_name, ref_domain, {_COMPARABLE.format(c='ref_name')} AS b FROM reference
  WHERE regexp_matches(ref_industry, '(?i)auto|motor|vehicle')),
text_pairs AS (
  SELECT a, b, {W.token_key_sql('a')} AS sa, {W.token_key_sql('b')} AS sb, {words('a')} AS wa, {words('b')} AS wb
  FROM (SELECT DISTINCT a FROM missing_names WHERE a <> ''), (SELECT DISTINCT b FROM auto WHERE b <> '')
  WHERE greatest(length(a), length(b)) < 1.5 * least(length(a), length(b))),
token_parts AS (
  SELECT *, list_sort(list_filter(wa, lambda t: list_contains(wb, t))) AS shared,
    {join('list_filter(wa, lambda t: NOT list_contains(wb, t))')} AS oa, {join('list_filter(wb, lambda t: NOT list_contains(wa, t))')} AS ob
  FROM text_pairs),
sized AS (SELECT *, length({join('shared')}) AS base, CASE WHEN len(shared) > 0 THEN 1 ELSE 0 END AS gap FROM token_parts),
token_set AS (
  SELECT *, CASE WHEN gap = 1 AND (oa = '' OR ob = '') THEN 100.0
    ELSE greatest(
      100.0 * (1 - (length(oa) + length(ob) - 2 * ({W.lcs_sql('oa', 'ob')})) / CAST(2 * base + 2 * gap + length(oa) + length(ob) AS DOUBLE)),
      CASE WHEN gap = 1 THEN 100.0 * (1 - (1 + length(oa)) / CAST(2 * base + 1 + length(oa) AS DOUBLE)) ELSE 0 END,
      CASE WHEN gap = 1 THEN 100.0 * (1 - (1 + length(ob)) / CAST(2 * base + 1 + length(ob) AS DOUBLE)) ELSE 0 END) END AS set_score
  FROM sized),
scores AS (SELECT a, b, greatest({W.ratio_sql('a', 'b')}, 0.95 * {W.ratio_sql('sa', 'sb')}, 0.95 * set_score) AS score FROM token_set),
best_refs AS (
  SELECT name, ref_name, ref_domain, score FROM (
    SELECT name, ref_name, ref_domain, score, row_number() OVER (PARTITION BY name ORDER BY round(score, 9) DESC, ref_name, ref_domain) AS rn
    FROM missing_names JOIN scores USING (a) JOIN auto USING (b) WHERE round(score, 9) >= {cutoff}) WHERE rn = 1)"""


@register("fuzzy_domain_lookup", f"""WITH {W.FIRM_ENTITIES_SQL}, {W.REFERENCE_SQL}, {fuzzy_sql(92)}
SELECT name, ref_name, ref_domain, round(score, 6) AS score FROM best_refs""")
def fuzzy_domain_lookup(spark, sf):
    names = W.firm_entities(spark, sf).filter("domain is null or domain = ''").select(F.col("primary_company_name").alias("name"))
    reference = enrich.automotive(enrich.unified_reference(W.reference_rows(spark, sf)))


    return best_reference(names, reference, 92).withColumn("score", F.round("score", 6))


@register("fuzzy_fill", f"""WITH {W.FIRM_ENTITIES_SQL}, {W.REFERENCE_SQL}, {fuzzy_sql(94)}
SELECT canonical_id, primary_company_name, coalesce(nullif(domain, ''), ref_domain) AS domain
FROM firm_entities LEFT JOIN best_refs ON name = primary_company_name""")
def fuzzy_fill(spark, sf):
    reference = enrich.automotive(enrich.unified_reference(W.reference_rows(spark, sf)))
    filled = enrich.fill_fuzzy(W.firm_entities(spark, sf), reference)
    return filled.select("canonical_id", "primary_company_name", "domain")


def unified_sql(source: str) -> str:
    return f"""
moved AS (SELECT * REPLACE (CASE WHEN domain IS NULL OR domain = '' THEN canonical_id
                                 ELSE min(canonical_id) OVER (PARTITION BY domain) END AS canonical_id) FROM {source})
""" + W.mode_sql("moved", "canonical_id", "primary_company_name", "u_name") + W.mode_sql("moved", "canonical_id", "domain", "u_domain") + """,
unified AS (
  SELECT g.canonical_id, n.value AS primary_company_name, list_sort(list_distinct(flatten(lists))) AS aliases, record_count,
    CASE WHEN countries IS NOT NULL THEN list_sort(list_distinct(flatten(countries))) END AS operating_countries, d.value AS domain
  FROM (SELECT canonical_id, array_agg(aliases) AS lists, CAST(sum(record_count) AS BIGINT) AS record_count,
          array_agg(operating_countries) FILTER (WHERE operating_countries IS NOT NULL) AS countries FROM moved GROUP BY canonical_id) g
  LEFT JOIN u_name n USING (canonical_id) LEFT JOIN u_domain d USING (canonical_id)
)"""


@register("domain_unify", f"WITH {W.FIRM_ENTITIES_SQL}, {unified_sql('firm_entities')} SELECT * FROM unified")
def domain_unify(spark, sf):
    return enrich.unify_domains(W.firm_entities(spark, sf))


@register("domain_groups", f"""WITH {W.FIRM_ENTITIES_SQL}
SELECT domain, min(canonical_id) AS first_id, count(*) AS members FROM firm_entities
WHERE domain IS NOT NULL AND domain <> '' GROUP BY domain HAVING count(*) > 1""")
def domain_groups(spark, sf):
    return (
        W.firm_entities(spark, sf).filter("domain is not null and domain != ''")
        .groupBy("domain").agg(F.min("canonical_id").alias("first_id"), F.count(F.lit(1)).alias("members"))
        .filter("members > 1")
    )


# --------------------------------------------------------------------- logos


def page_entities(spark, sf):
    return table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("canonical_id"), clean_domain("url").alias("domain"))


def page_status(spark, sf):
    """Live logo addresses: the first service knows even pages' hosts, the second every third's."""
    pages = table(spark, sf, "pages").select("page_id", clean_domain("url").alias("d"))
    first, second = (F.replace(F.lit(t), F.lit("{domain}"), F.col("d")) for t in enrich.LOGO_TEMPLATES)
    one = pages.select(first.alias("url"), F.when(F.col("page_id") % 7 == 0, 200).otherwise(404).alias("status"))
    two = pages.select(second.alias("url"), F.when(F.col("page_id") % 5 == 0, 200).otherwise(500).alias("status"))
    return one.unionByName(two)


@register("logo_candidates", f"""
WITH p AS (SELECT page_id, {W.domain_sql('url')} AS d FROM pages),
hosts AS (SELECT d, bool_or(page_id % 7 = 0) AS one, bool_or(page_id % 5 = 0) AS two FROM p WHERE d IS NOT NULL GROUP BY d)
SELECT CAST(page_id AS VARCHAR) AS canonical_id, p.d AS domain,
  CASE WHEN one THEN 'https://api.companyenrich.com/logo/' || p.d
       WHEN two THEN 'https://www.google.com/s2/favicons?domain=' || p.d || '&sz=256' END AS logo_url
FROM p LEFT JOIN hosts ON hosts.d = p.d""")
def logo_candidates(spark, sf):
    return enrich.with_logos(page_entities(spark, sf), page_status(spark, sf))


# -------------------------------------------------------------- verification

def numbered_sql(source: str) -> str:
    return f"numbered AS (SELECT *, CAST((row_number() OVER (ORDER BY canonical_id) - 1) // 10 AS BIGINT) AS batch_id FROM {source})"


_REQUESTS = f"{W.FIRM_ENTITIES_SQL}, {numbered_sql('firm_entities')}"


@register("verify_requests", f"""WITH {_REQUESTS}
SELECT batch_id, count(*) AS size, list(canonical_id ORDER BY canonical_id) AS ids,
  CAST(to_json(list({{'id': canonical_id, 'name': primary_company_name, 'current_domain': domain}} ORDER BY canonical_id)) AS VARCHAR) AS payload
FROM numbered GROUP BY batch_id""")
def verify_requests(spark, sf):
    return verify.request_batches(W.firm_entities(spark, sf))


def responses(requests):
    """Answers in the three accepted forms; every fourth batch fails."""
    answer = F.to_json(
        F.transform(
            "ids",
            lambda i: F.struct(
                i.alias("id"),
                F.when(i.endswith("7"), verify.MISSING).otherwise(F.concat(F.lit("site"), i, F.lit(".com"))).alias("verified_domain"),
                F.concat(F.lit("Maker no. "), i).alias("description"),
                (F.length(i) > 2).alias("is_automotive"),
            ),
        )
    )
    kind = F.col("batch_id") % 4
    return requests.select(
        "batch_id",
        F.when(kind == 0, F.concat(F.lit("```json\n"), answer, F.lit("\n```")))
        .when(kind == 1, F.concat(F.lit("```\n"), answer, F.lit("\n```")))
        .when(kind == 2, answer)
        .otherwise(F.lit("Sorry, no answer."))
        .alias("text"),
    )


ANSWERS_SQL = """
answers AS (
  SELECT canonical_id AS id,
    CASE WHEN batch_id % 4 = 3 OR canonical_id LIKE '%7' THEN 'Missing' ELSE 'site' || canonical_id || '.com' END AS verified_domain,
    CASE WHEN batch_id % 4 = 3 THEN 'Information not found.' ELSE 'Maker no. ' || canonical_id END AS description,
    batch_id % 4 = 3 OR length(canonical_id) > 2 AS is_automotive
  FROM numbered)"""
_ANSWERS = f"{_REQUESTS}, {ANSWERS_SQL}"


def _answers(spark, sf):
    requests = cut_lineage(verify.request_batches(W.firm_entities(spark, sf)))
    return verify.ingest_responses(requests, responses(requests))


@register("verify_ingest", f"WITH {_ANSWERS} SELECT * FROM answers")
def verify_ingest(spark, sf):
    return _answers(spark, sf)


@register("master_merge", f"""WITH {_ANSWERS}
SELECT canonical_id, primary_company_name, coalesce(nullif(verified_domain, 'Missing'), domain) AS domain,
  coalesce(description, 'Information not found.') AS description, record_count, operating_countries, aliases, NULL::VARCHAR AS logo_url
FROM firm_entities LEFT JOIN answers ON id = canonical_id""")
def master_merge(spark, sf):
    entities = W.firm_entities(spark, sf).withColumn("logo_url", F.lit(None).cast("string"))
    return verify.master_table(entities, _answers(spark, sf))


@register("master_merge_strict", f"""WITH {_ANSWERS}
SELECT canonical_id, coalesce(verified_domain, domain) AS domain FROM firm_entities LEFT JOIN answers ON id = canonical_id""")
def master_merge_strict(spark, sf):
    entities = W.firm_entities(spark, sf).withColumn("logo_url", F.lit(None).cast("string"))
    return verify.master_table(entities, _answers(spark, sf), strict=True).select("canonical_id", "domain")


# ------------------------------------------------------------------- serving

LIVE_SQL = """
live AS (
  SELECT replace(p_name, ' ', '-') || '.com' AS d, bool_or(p_partkey % 9 = 0) AS one, bool_or(p_partkey % 4 = 0) AS two FROM part GROUP BY 1)"""

_MASTER = W.ENTITIES_SQL + f""",
sites AS (SELECT *, {W.domain_sql('primary_website')} AS domain FROM entities), {LIVE_SQL},
master AS (
  SELECT canonical_id, primary_company_name, domain,
    CASE WHEN right(canonical_id, 1) IN ('1', '5') THEN 'Missing' ELSE 'Maker of ' || primary_company_name END AS description,
    record_count, operating_countries, aliases,
    CASE WHEN one THEN 'https://api.companyenrich.com/logo/' || domain
         WHEN two THEN 'https://www.google.com/s2/favicons?domain=' || domain || '&sz=256' END AS logo_url
  FROM sites LEFT JOIN live ON d = domain)"""


def part_status(spark, sf):
    """Live logo addresses of the domains that part names give."""
    part = table(spark, sf, "part").select("p_partkey", F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(".com")).alias("d"))
    first, second = (F.replace(F.lit(t), F.lit("{domain}"), F.col("d")) for t in enrich.LOGO_TEMPLATES)
    return part.select(first.alias("url"), F.when(F.col("p_partkey") % 9 == 0, 200).otherwise(404).alias("status")).unionByName(
        part.select(second.alias("url"), F.when(F.col("p_partkey") % 4 == 0, 200).otherwise(404).alias("status"))
    )


def core_master(spark, sf):
    """Master table over core-name clusters with logos and descriptions."""
    entities = W.core_entities(spark, sf).withColumn("domain", clean_domain("primary_website")).drop("primary_website")
    answers = entities.select(
        F.col("canonical_id").alias("id"),
        F.lit(None).cast("string").alias("verified_domain"),
        F.when(F.col("canonical_id").rlike("[15]$"), verify.MISSING)
        .otherwise(F.concat(F.lit("Maker of "), "primary_company_name")).alias("description"),
        F.lit(True).alias("is_automotive"),
    )
    return verify.master_table(enrich.with_logos(entities, part_status(spark, sf)), answers)


@register("search", f"""WITH {_MASTER}
SELECT canonical_id, primary_company_name, domain, record_count, aliases, operating_countries, logo_url FROM master
WHERE primary_company_name ILIKE '%bolt%' OR array_to_string(aliases, ',') ILIKE '%bolt%' OR domain ILIKE '%bolt%'
ORDER BY canonical_id LIMIT 20""")
def search(spark, sf):
    return serve.search(core_master(spark, sf), "BOLT")


@register("list_all", f"WITH {_MASTER} SELECT * FROM master ORDER BY canonical_id LIMIT 50")
def list_all(spark, sf):
    return serve.list_all(core_master(spark, sf))


@register("inspect", f"""WITH {_MASTER},
one AS (SELECT * FROM master WHERE canonical_id = 'v_000003')
SELECT 'canonical_id' AS field, canonical_id AS value FROM one UNION ALL SELECT 'primary_company_name', primary_company_name FROM one
UNION ALL SELECT 'domain', domain FROM one UNION ALL SELECT 'description', description FROM one
UNION ALL SELECT 'record_count', CAST(record_count AS VARCHAR) FROM one
UNION ALL SELECT 'operating_countries', array_to_string(operating_countries, ', ') FROM one
UNION ALL SELECT 'aliases', array_to_string(aliases, ', ') FROM one UNION ALL SELECT 'logo_url', logo_url FROM one""")
def inspect(spark, sf):
    return serve.inspect(core_master(spark, sf), "v_000003")


@register("stats", f"""WITH {_MASTER},
f AS (SELECT count(*) AS clusters,
  count(domain) FILTER (WHERE domain <> '' AND domain <> '-' AND domain <> 'Missing' AND domain <> 'unknown') AS domains,
  count(logo_url) FILTER (WHERE logo_url <> '' AND logo_url <> '-') AS logos,
  count(description) FILTER (WHERE description NOT IN ('Information not found.', 'Information not found', 'Missing')) AS descriptions FROM master)
SELECT raw_rows, raw_names, f.*, round(raw_rows * 1.0 / clusters, 6) AS consolidation, round(domains * 100.0 / clusters, 6) AS domain_percent,
  round(logos * 100.0 / clusters, 6) AS logo_percent, round(descriptions * 100.0 / clusters, 6) AS description_percent
FROM (SELECT count(*) AS raw_rows, count(DISTINCT company_name) AS raw_names FROM firms), f""")
def stats(spark, sf):
    return serve.stats(W.firms(spark, sf), core_master(spark, sf))


@register("top_entities", f"""WITH {W.ENTITIES_SQL}
SELECT canonical_id, primary_company_name, record_count, CAST(len(operating_countries) AS BIGINT) AS country_count
FROM entities ORDER BY record_count DESC, canonical_id LIMIT 10""")
def top_entities(spark, sf):
    return serve.top_entities(first_pass_entities(W.core_clusters(W.firms(spark, sf))))
