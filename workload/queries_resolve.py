"""Vectors, fuzzy matching, components and golden records."""

from pyspark.sql import functions as F

from firmweave.functions.text import core_name
from firmweave.operators import golden, knn, resolve, vectors
from firmweave.operators.components import group_edges, label_components, numbered_labels
from firmweave.operators.fuzzy import best_other_names
from workload import firms as W
from workload.registry import register, table

# -------------------------------------------------------------- fuzzy matching


def _best_other_sql(names: str, source: str) -> str:
    """Best other name by token-sort ratio above 90.

    Edit distance is never larger than indel distance, so it prunes pairs without
    loss; a common start of 12 characters adds 12 to the common subsequence.
    """
    return f"""
sorted_names AS (SELECT name, {W.token_key_sql('name')} AS k FROM ({names}) WHERE name <> ''),
key_pairs AS (
  SELECT a.k AS ka, b.k AS kb, length(a.k) + length(b.k) AS total
  FROM (SELECT DISTINCT k FROM sorted_names) a, (SELECT DISTINCT k FROM sorted_names) b
  WHERE a.k = b.k OR (10 * abs(length(a.k) - length(b.k)) < length(a.k) + length(b.k)
    AND 10 * levenshtein(a.k, b.k) < length(a.k) + length(b.k))),
tails AS (
  SELECT *, CASE WHEN same THEN substr(ka, 13) ELSE ka END AS ta, CASE WHEN same THEN substr(kb, 13) ELSE kb END AS tb
  FROM (SELECT *, left(ka, 12) = left(kb, 12) AS same FROM key_pairs)),
scored AS (
  SELECT ka, kb, 100.0 * (1 - (total - 2 * (CASE WHEN same THEN least(12, length(ka), length(kb)) ELSE 0 END + ({W.lcs_sql('ta', 'tb')})))
         / CAST(total AS DOUBLE)) AS score FROM tails),
{source} AS (
  SELECT name, best, score FROM (
    SELECT a.name, b.name AS best, score,
      row_number() OVER (PARTITION BY a.name ORDER BY score DESC, b.name) AS rn
    FROM sorted_names a JOIN scored s ON s.ka = a.k JOIN sorted_names b ON b.k = s.kb
    WHERE a.name <> b.name AND score > 90) WHERE rn = 1
)"""


CORES_SQL = "SELECT DISTINCT node AS name FROM named WHERE core <> ''"


@register("token_sort_matches", f"WITH {W.NODES_SQL}, {_best_other_sql(CORES_SQL, 'best_names')} SELECT name, best, round(score, 6) AS score FROM best_names")
def token_sort_matches(spark, sf):
    names = W.firms(spark, sf).select(core_name("company_name").alias("name"))
    return best_other_names(names).withColumn("score", F.round("score", 6))


@register("customer_name_matches", f"WITH {_best_other_sql('SELECT DISTINCT c_name AS name FROM customer', 'best_names')} SELECT name, best, round(score, 6) AS score FROM best_names")
def customer_name_matches(spark, sf):
    names = table(spark, sf, "customer").select(F.col("c_name").alias("name"))
    return best_other_names(names).withColumn("score", F.round("score", 6))


def hybrid_sql(names: str, cosine: float) -> str:
    return f"""
vn AS ({names}),
gram_counts AS (
  SELECT name, substr('  ' || name || '  ', CAST(i AS BIGINT), 3) AS gram, count(*) AS tf
  FROM (SELECT name, unnest(range(1, length(name) + 3)) AS i FROM vn) GROUP BY ALL),
gram_weights AS (
  SELECT name, gram, tf * (ln(((SELECT count(*) FROM vn) + 1) / (df + 1)) + 1) AS w
  FROM gram_counts JOIN (SELECT gram, count(*) AS df FROM gram_counts GROUP BY gram) USING (gram)),
units AS (SELECT name, gram, w / sqrt(sum(w * w) OVER (PARTITION BY name)) AS w FROM gram_weights),
cosines AS (
  SELECT a.name AS a, b.name AS b, round(sum(a.w * b.w), 9) AS cosine
  FROM units a JOIN units b USING (gram) WHERE a.name <> b.name GROUP BY ALL),
ranked AS (
  SELECT a, b, cosine, row_number() OVER (PARTITION BY a ORDER BY cosine DESC, b) AS rank
  FROM cosines WHERE cosine > {cosine}),
near AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM ranked WHERE rank <= 10),
hybrid AS (
  SELECT a, b FROM (SELECT a, b, {W.token_key_sql('a')} AS ka, {W.token_key_sql('b')} AS kb FROM near)
  WHERE {W.ratio_sql('ka', 'kb')} > 81
)"""


_NAMES = "SELECT DISTINCT company_name AS name FROM firms WHERE company_name <> ''"


@register("name_vectors", f"""WITH {W.NODES_SQL}, {hybrid_sql(CORES_SQL, 0.88)}
SELECT name, gram, round(w, 6) AS w FROM units""")
def name_vectors(spark, sf):
    names = W.firms(spark, sf).select(core_name("company_name").alias("name"))
    return (
        vectors.gram_vectors(names).select("name", F.inline("terms"))
        .select("name", "gram", F.round("w", 6).alias("w"))
    )


@register("cosine_pairs", f"""WITH {W.FIRMS_SQL}, {hybrid_sql(_NAMES, 0.7)}
SELECT a, b, round(cosine, 6) AS cosine FROM cosines WHERE a < b AND cosine >= 0.7""")
def cosine_pairs(spark, sf):
    grams = vectors.gram_vectors(W.firms(spark, sf), "company_name")
    return vectors.cosine_pairs(grams, 0.7).withColumn("cosine", F.round("cosine", 6))


@register("hybrid_matches", f"WITH {W.FIRMS_SQL}, {hybrid_sql(_NAMES, 0.7)} SELECT a, b FROM hybrid")
def hybrid_matches(spark, sf):
    return vectors.hybrid_pairs(W.firms(spark, sf), "company_name", min_cosine=0.7)


# ------------------------------------------------------------- dense vectors

_DISTANCE = "sqrt(list_sum(list_transform(list_zip(x, y), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))"
_VECTORS = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings"


@register("knn_pairs", f"""
SELECT a, b, round(distance, 6) AS distance, rank FROM (
  SELECT a, b, distance, CAST(row_number() OVER (PARTITION BY a ORDER BY distance, b) AS INTEGER) AS rank
  FROM (SELECT l.vec_id AS a, r.vec_id AS b, {_DISTANCE} AS distance
        FROM ({_VECTORS}) l, (SELECT vec_id, x AS y FROM ({_VECTORS})) r WHERE l.vec_id <> r.vec_id)
  WHERE distance < 1.2) WHERE rank <= 10""")
def knn_pairs(spark, sf):
    found = knn.neighbours(table(spark, sf, "embeddings"), "vec_id", "embedding", k=10, radius=1.2)
    return found.withColumn("distance", F.round("distance", 6))


@register("radius_pairs", f"""
WITH units AS (SELECT vec_id, list_transform(x, lambda v: v / sqrt(list_sum(list_transform(x, lambda w: w * w)))) AS x FROM ({_VECTORS})),
ranked AS (
  SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY distance, b) AS rank
  FROM (SELECT l.vec_id AS a, r.vec_id AS b, {_DISTANCE} AS distance
        FROM units l, (SELECT vec_id, x AS y FROM units) r WHERE l.vec_id <> r.vec_id)
  WHERE distance < sqrt(2 * (1 - 0.4)))
SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM ranked WHERE rank <= 10""")
def radius_pairs(spark, sf):
    return knn.radius_pairs(table(spark, sf, "embeddings"), "vec_id", "embedding", k=10, min_cosine=0.4)


# --------------------------------------------------------------- components


@register("components_core_name", f"WITH {W.CLUSTERS_SQL} SELECT unique_id, cluster_id FROM clusters")
def components_core_name(spark, sf):
    named = W.firms(spark, sf).select("unique_id", resolve.name_node().alias("node"))
    found = label_components(named, group_edges(named, "node", "unique_id"), "unique_id")
    labels = numbered_labels(found, "component", "v_")
    return found.join(labels, "component").select("unique_id", F.col("label").alias("cluster_id"))


@register("components_multi_rule", f"""
WITH RECURSIVE {W.NODES_SQL},
links AS (SELECT DISTINCT node, website FROM named WHERE website IS NOT NULL),
reach(a, b) AS (
  SELECT DISTINCT node, node FROM named
  UNION SELECT r.a, y.node FROM reach r JOIN links x ON x.node = r.b JOIN links y ON y.website = x.website),
owner AS (SELECT a AS node, min(unique_id) AS component FROM reach JOIN named ON named.node = b GROUP BY a)
SELECT unique_id, component FROM named JOIN owner USING (node)""")
def components_multi_rule(spark, sf):
    named = W.firms(spark, sf).select("unique_id", "website", resolve.name_node().alias("node"))
    edges = group_edges(named, "node", "unique_id").unionByName(group_edges(named, "website", "unique_id"))
    return label_components(named, edges, "unique_id")


@register("first_pass_clusters", f"""
WITH RECURSIVE {W.NODES_SQL}, {hybrid_sql(CORES_SQL, 0.88)},
reach(a, b) AS (
  SELECT DISTINCT node, node FROM named
  UNION SELECT r.a, CASE WHEN h.a = r.b THEN h.b ELSE h.a END FROM reach r JOIN hybrid h ON h.a = r.b OR h.b = r.b),
owner AS (SELECT a AS node, min(unique_id) AS least_id FROM reach JOIN named ON named.node = b GROUP BY a)
SELECT unique_id, 'v_' || lpad(CAST(dense_rank() OVER (ORDER BY least_id) - 1 AS VARCHAR), 6, '0') AS cluster_id
FROM named JOIN owner USING (node)""")
def first_pass_clusters(spark, sf):
    return resolve.cluster_firms(W.firms(spark, sf)).select("unique_id", "cluster_id")


# ------------------------------------------------------------ golden records


@register("golden_first_pass", f"WITH {W.ENTITIES_SQL} SELECT * FROM entities")
def golden_first_pass(spark, sf):
    return golden.first_pass_entities(W.core_clusters(W.firms(spark, sf)))


_SERVING_MODES = ["company_name", "address", "city", "website", "industry_tags", "certifications", "employees", "founded_year", "source_dataset"]


@register("golden_serving", f"""WITH {W.CLUSTERS_SQL}
{''.join(W.mode_sql('clusters', 'cluster_id', c, 'm_' + c) for c in _SERVING_MODES)}
SELECT g.cluster_id AS canonical_id, m_company_name.value AS primary_company_name,
  list_sort(list_filter(names, lambda x: x <> m_company_name.value)) AS aliases,
  m_address.value AS address, m_city.value AS city, operating_countries, m_website.value AS primary_website,
  m_industry_tags.value AS industry_tags, m_certifications.value AS certifications, m_employees.value AS employees,
  m_founded_year.value AS founded_year, m_source_dataset.value AS source_dataset, scraped_at
FROM (SELECT cluster_id, list_sort(array_agg(DISTINCT country) FILTER (WHERE country IS NOT NULL)) AS operating_countries,
        array_agg(DISTINCT company_name) FILTER (WHERE company_name IS NOT NULL) AS names, max(scraped_at) AS scraped_at
      FROM clusters GROUP BY cluster_id) g
{' '.join(f'LEFT JOIN m_{c} ON m_{c}.cluster_id = g.cluster_id' for c in _SERVING_MODES)}""")
def golden_serving(spark, sf):
    return golden.serving_entities(W.core_clusters(W.firms(spark, sf)))


def _merged_sql(source: str, key: str, name: str) -> str:
    """CTE ``name``: entities of ``source`` merged by ``key``."""
    return (
        W.mode_sql(source, key, "primary_company_name", f"{name}_n")
        + W.mode_sql(source, key, "primary_website", f"{name}_d")
        + f""",
{name} AS (
  SELECT {key} AS canonical_id, n.value AS primary_company_name,
    list_sort(list_distinct(flatten(lists) || names)) AS all_variations, record_count,
    CASE WHEN len(list_distinct(flatten(countries))) > 0 THEN list_sort(list_distinct(flatten(countries))) END AS operating_countries,
    d.value AS domain
  FROM (SELECT {key}, array_agg(aliases) FILTER (WHERE aliases IS NOT NULL) AS lists, array_agg(primary_company_name) AS names,
          CAST(coalesce(sum(record_count), 0) AS BIGINT) AS record_count,
          array_agg(operating_countries) FILTER (WHERE operating_countries IS NOT NULL) AS countries
        FROM {source} GROUP BY {key})
  LEFT JOIN {name}_n n USING ({key}) LEFT JOIN {name}_d d USING ({key})
)"""
    )


def clean_sql(source: str) -> str:
    """Final second-pass rows: core primary name, aliases unique without case, no near copies."""
    root = "lower(trim(root_name))"
    return f"""
SELECT b.canonical_id, root_name AS primary_company_name, coalesce(kept, []) AS aliases, record_count, operating_countries, domain
FROM (SELECT *, {W.core_sql('primary_company_name')} AS root_name FROM {source}) b
LEFT JOIN (
  SELECT canonical_id, list_sort(list(alias)) AS kept FROM (
    SELECT canonical_id, min(alias) AS alias FROM (
      SELECT canonical_id, root_name, trim(unnest(all_variations)) AS alias
      FROM (SELECT *, {W.core_sql('primary_company_name')} AS root_name FROM {source}))
    WHERE alias <> '' AND lower(alias) <> {root} AND {W.ratio_sql('lower(alias)', root)} <= 98
    GROUP BY canonical_id, lower(alias)) GROUP BY canonical_id) a ON a.canonical_id = b.canonical_id"""


_BY_SITE = W.ENTITIES_SQL + """,
sited AS (SELECT e.*, 'm_' || lpad(CAST(dense_rank() OVER (ORDER BY least_id) - 1 AS VARCHAR), 6, '0') AS master_cluster_id
  FROM (SELECT *, CASE WHEN primary_website IS NULL THEN canonical_id
                       ELSE min(canonical_id) OVER (PARTITION BY primary_website) END AS least_id FROM entities) e)
""" + _merged_sql("sited", "master_cluster_id", "refined")


def _by_site(spark, sf):
    entities = W.core_entities(spark, sf)
    return resolve.master_clusters(entities, group_edges(entities, "primary_website", "canonical_id"))


@register("golden_refined", f"WITH {_BY_SITE} SELECT * FROM refined")
def golden_refined(spark, sf):
    return golden.refined_entities(_by_site(spark, sf))


@register("alias_refine", f"WITH {_BY_SITE} {clean_sql('refined')}")
def alias_refine(spark, sf):
    return golden.refine_names(golden.refined_entities(_by_site(spark, sf)))


SECOND_SQL = f"""
cores AS (SELECT canonical_id, {W.core_sql('primary_company_name')} AS core FROM entities), """ + _best_other_sql(
    "SELECT DISTINCT core AS name FROM cores", "best_names"
) + """,
owners AS (SELECT core, min(canonical_id) AS owner FROM cores WHERE core <> '' GROUP BY core),
variants AS (SELECT DISTINCT canonical_id, lower(trim(v)) AS v FROM (
  SELECT canonical_id, unnest(list_append(coalesce(aliases, []), primary_company_name)) AS v FROM entities) WHERE trim(v) <> ''),
links AS (
  SELECT x.owner AS src, y.owner AS dst FROM best_names b JOIN owners x ON x.core = b.name JOIN owners y ON y.core = b.best
  UNION SELECT canonical_id, owner FROM cores JOIN owners USING (core) WHERE length(core) > 3
  UNION SELECT canonical_id, min(canonical_id) OVER (PARTITION BY v) FROM variants),
both_ways AS (SELECT src, dst FROM links UNION SELECT dst, src FROM links),
reach(a, b) AS (
  SELECT canonical_id, canonical_id FROM entities
  UNION SELECT r.a, l.dst FROM reach r JOIN both_ways l ON l.src = r.b),
mastered AS (
  SELECT e.*, 'm_' || lpad(CAST(dense_rank() OVER (ORDER BY component) - 1 AS VARCHAR), 6, '0') AS master_cluster_id
  FROM entities e JOIN (SELECT a AS canonical_id, min(b) AS component FROM reach GROUP BY a) USING (canonical_id)
)""" + _merged_sql("mastered", "master_cluster_id", "refined")


@register("second_pass_entities", f"WITH RECURSIVE {W.ENTITIES_SQL}, {SECOND_SQL} {clean_sql('refined')}")
def second_pass_entities(spark, sf):
    return resolve.second_pass(W.core_entities(spark, sf))
