"""The whole flow, from raw files to the master table, one Parquet table for each stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from firmweave.functions.text import is_missing
from firmweave.operators import enrich, verify
from firmweave.operators.golden import first_pass_entities, serving_entities
from firmweave.operators.resolve import cluster_firms, second_pass
from firmweave.operators.standardize import harmonised_union, standardize
from firmweave.operators.vectors import LEXICAL, MIN_COSINE, NEIGHBOURS
from firmweave.sources.readers import raw_files, read_raw, seed_domain
from firmweave.storage import StageTables, append_metrics


def _rows() -> Column:
    return F.count(F.lit(1))


def _filled() -> Column:
    return F.count_if(~is_missing("domain"))


def run_pipeline(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    *,
    references: list[DataFrame] | None = None,
    bulk: DataFrame | None = None,
    url_status: DataFrame | None = None,
    responses: DataFrame | None = None,
    k: int = NEIGHBOURS,
    min_cosine: float = MIN_COSINE,
    cutoff: float = enrich.FUZZY_CUTOFF,
    strict: bool = False,
    version: str = "",
    csv_options: dict | None = None,
) -> DataFrame:
    """Resolve the companies in ``raw_dir``; returns the master table.

    ``references`` and ``bulk`` are lookup tables (ref_name, ref_domain,
    ref_industry), ``url_status`` says which logo addresses are live, and
    ``responses`` (batch_id, text) answers the ``requests`` table of an earlier
    run. Without them the matching steps leave domains, logos or descriptions
    empty. Stage tables under ``out_dir`` are reused while their inputs stay the
    same: files by name, size and time, lookup DataFrames by their whole plan and the rows no file holds.
    Another ``version`` computes everything anew.
    """
    stages = StageTables(spark, out_dir, version)
    files = raw_files(spark, raw_dir)
    metrics: dict = {"etl_files_processed": sum(map(len, files.values()))}
    metrics |= {f"etl_{kind}_files": len(paths) for kind, paths in files.items()}

    stages.depends_on(raw_dir, csv_options)
    firms, seen = stages.table(
        "firms",
        lambda: standardize(harmonised_union(read_raw(spark, raw_dir, **(csv_options or {})))),
        {"etl_total_rows": _rows()},
    )
    metrics |= seen

    stages.depends_on("first pass", k, min_cosine, LEXICAL)
    clusters, seen = stages.table(
        "clusters", lambda: cluster_firms(firms, k, min_cosine), {"dedupe_input_records": _rows()}
    )
    metrics |= seen
    entities, seen = stages.table(
        "entities", lambda: first_pass_entities(clusters), {"dedupe_total_clusters": _rows()}
    )
    metrics |= seen
    refined, seen = stages.table("refined", lambda: second_pass(entities), {"refined_entities": _rows()})
    metrics |= seen

    # every stage below reads its input more than once, so each one is a table
    current = seed_domain(refined)
    if references:
        stages.depends_on(*references)
        reference, _ = stages.table("reference", lambda: enrich.unified_reference(*references))
        start = current
        current, _ = stages.table(
            "exact", lambda: enrich.clean_domains(enrich.fill_exact(start, reference))
        )
    if bulk is not None:
        stages.depends_on(bulk)
        exact = current
        current, seen = stages.table(
            "bulk", lambda: enrich.clean_domains(enrich.fill_bulk(exact, bulk)), {"bulk_domains": _filled()}
        )
        metrics |= seen
    if references:
        stages.depends_on(cutoff)
        looked_up = current
        current, seen = stages.table(
            "fuzzy", lambda: enrich.fill_fuzzy(looked_up, enrich.automotive(reference), cutoff), {"fuzzy_domains": _filled()}
        )
        metrics |= seen
    filled, seen = stages.table(
        "filled", lambda: enrich.clean_domains(current), {"domains_filled": _filled()}
    )
    metrics |= seen
    unified, seen = stages.table("unified", lambda: enrich.unify_domains(filled), {"unified_domains": _filled()})
    metrics |= seen
    if url_status is not None:
        stages.depends_on(url_status)

    def with_logos() -> DataFrame:
        if url_status is None:
            return unified.withColumn("logo_url", F.lit(None).cast("string"))
        return enrich.with_logos(unified, url_status)

    enriched, seen = stages.table(
        "enriched", with_logos, {"enriched_entities": _rows(), "enriched_domains": _filled()}
    )
    metrics |= seen

    requests, _ = stages.table("requests", lambda: verify.request_batches(enriched))
    stages.depends_on(strict, *([responses] if responses is not None else []))

    def answered() -> DataFrame:
        if responses is None:
            return verify.default_answers(enriched)
        return verify.ingest_responses(requests, responses)

    master, seen = stages.table(
        "master", lambda: verify.master_table(enriched, answered(), strict), {"master_entities": _rows()}
    )
    metrics |= seen
    append_metrics(spark, f"{stages.out_dir}/metrics", metrics)
    return master


def serving_table(spark: SparkSession, clusters: DataFrame, out_dir: str, version: str = "") -> DataFrame:
    """The 13-column golden table of clustered firms, kept under ``out_dir`` like the other stages, with its two counts in the metrics."""
    stages = StageTables(spark, out_dir, version)
    stages.depends_on("serving", clusters)
    golden, seen = stages.table("serving", lambda: serving_entities(clusters), {"serving_golden_records": _rows()})
    metrics = {"serving_input_clusters": clusters.agg(F.count_distinct("cluster_id")).first()[0]} | seen
    append_metrics(spark, f"{stages.out_dir}/metrics", metrics)
    return golden
