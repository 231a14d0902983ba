"""Exchange tables for an outside verification service, and the merge of its answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firmweave.functions.text import strip
from firmweave.operators.relational import dense_number

# Records per request, and what stands for an unanswered record.
BATCH_SIZE = 10
MISSING = "Missing"
NO_DESCRIPTION = "Information not found."
ANSWER = "array<struct<id:string,verified_domain:string,description:string,is_automotive:boolean>>"


def request_batches(entities: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """(batch_id, size, ids, payload): entities in id order, ``size`` to a JSON request."""
    rows = dense_number(
        entities.select("canonical_id", "primary_company_name", "domain"), "canonical_id"
    )
    record = F.struct(
        F.col("canonical_id").alias("id"),
        F.col("primary_company_name").alias("name"),
        F.col("domain").alias("current_domain"),
    )
    batches = rows.groupBy(F.floor(F.col("number") / size).cast("bigint").alias("batch_id")).agg(
        F.sort_array(F.collect_list(record)).alias("records")
    )
    return batches.select(
        "batch_id",
        F.size("records").cast("bigint").alias("size"),
        F.col("records.id").alias("ids"),
        F.to_json("records", {"ignoreNullFields": "false"}).alias("payload"),
    )


def unfenced(text: Column | str) -> Column:
    """Response text without a Markdown code fence."""
    body = strip(text)
    inner = strip(F.substring(body, F.lit(4), F.length(body) - 6))
    inner_json = strip(F.substring(body, F.lit(8), F.length(body) - 10))
    return (
        F.when(body.startswith("```json"), inner_json)
        .when(body.startswith("```"), inner)
        .otherwise(body)
    )


def ingest_responses(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """(id, verified_domain, description, is_automotive) from ``responses`` (batch_id, text).

    Batches without a readable answer get default rows, one for each of their ids.
    """
    body = unfenced("text")
    # an answer is one JSON array and nothing else: as the only field of an object, words after it make no JSON
    whole = F.concat(F.lit('{"answers":'), body, F.lit("}"))
    alone = body.startswith("[") & (F.size(F.json_object_keys(whole)) == 1)
    parsed = responses.select(
        "batch_id", F.when(alone, F.from_json(whole, f"answers {ANSWER}")["answers"]).alias("answers")
    ).filter("answers is not null")
    answered = parsed.select(F.inline("answers")).filter("id is not null")
    failed = requests.join(parsed.select("batch_id").distinct(), "batch_id", "left_anti").select(
        F.explode("ids").alias("id"),
        F.lit(MISSING).alias("verified_domain"),
        F.lit(NO_DESCRIPTION).alias("description"),
        F.lit(True).alias("is_automotive"),
    )
    return answered.unionByName(failed)


def default_answers(entities: DataFrame) -> DataFrame:
    return entities.select(
        F.col("canonical_id").alias("id"),
        F.lit(MISSING).alias("verified_domain"),
        F.lit(NO_DESCRIPTION).alias("description"),
        F.lit(True).alias("is_automotive"),
    )


def master_table(entities: DataFrame, answers: DataFrame, strict: bool = False) -> DataFrame:
    """The eight-column master table.

    A verified domain replaces the current one. ``"Missing"`` counts as no
    answer; with ``strict`` it overwrites even a real domain.
    """
    verified = F.col("verified_domain") if strict else F.nullif("verified_domain", F.lit(MISSING))
    one = (
        answers.groupBy(F.col("id").alias("canonical_id"))
        .agg(F.min(F.struct(verified.alias("verified"), "description")).alias("a"))
        .select("canonical_id", "a.verified", "a.description")
    )
    return entities.join(one, "canonical_id", "left").select(
        "canonical_id",
        "primary_company_name",
        F.coalesce("verified", "domain").alias("domain"),
        F.coalesce("description", F.lit(NO_DESCRIPTION)).alias("description"),
        "record_count",
        "operating_countries",
        "aliases",
        "logo_url",
    )
