"""Registered queries of the corpus operators; each reads its whole table."""

from __future__ import annotations

import corpus_pipeline
from public_tokenizers import PATTERN, path
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from firmweave.llm import (
    bpe, conversation_trie, decontaminate, language_id, line_dedup, quality, quality_rules, simhash_dedup, spelling, substring_dedup, token_files, vector_search, warc_zip,
)
from firmweave.llm.common import Shared, scratch_path
from firmweave.storage import cut_lineage
from workload.registry import register, table


@register("op1_simhash_dedup")
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and group. Null texts and those without words have fingerprint zero and are linked like any other."""
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4, radius=4)


@register("op8_byte_pair_encoding")
def op8_byte_pair_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and what they decode to, as digests. A null text is an empty one, with no ids."""
    shared = bpe.share(spark, bpe.BytePairTokenizer.from_file(path("byte_bpe_50k.tiktoken"), PATTERN))
    return bpe.encode_and_decode(table(spark, sf_dir, "documents"), shared, keep=["doc_id"]).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the token files. A null text is an empty one, with the end id alone; repeated ids stay apart."""
    with open(path("byte_bpe_50k.json"), encoding="utf-8") as definition:
        encoder = Shared(spark, token_files.Encoder(definition.read(), PATTERN))
    files = scratch_path(spark, "sequences")
    token_files.write_sequences(table(spark, sf_dir, "documents"), encoder, files, end_id=0)
    return token_files.read_documents(spark, files).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@register("op5_warc_zip")
def op5_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives. A null html is an empty payload, always a response."""
    archives = scratch_path(spark, "archives")
    warc_zip.write_archives(table(spark, sf_dir, "pages"), archives)
    whole = F.col("record_type") == "response"
    return warc_zip.read_archives(spark, archives).select(
        "page_id",
        F.when(whole, F.octet_length("payload").cast("bigint")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type", "refers_to",
    )


def _leaks_sql() -> str:
    masks = decontaminate.MASKS
    span, window = decontaminate.SPAN, decontaminate.WINDOW
    words = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    at = " UNION ALL ".join(
        f"SELECT {i} AS mask, k.*, [" + ", ".join(f"t[p + {o + 1}]" for o in m) + "] AS seed FROM k" for i, m in enumerate(masks)
    )
    doc_at, item_at = (at.replace(" FROM k", f" FROM {x}").replace("k.*", f"{x}.* EXCLUDE (t)") for x in ("dp", "ip"))
    return f"""
    WITH d AS (SELECT DISTINCT doc_id, text, {words} AS t FROM documents WHERE text IS NOT NULL),
    i AS (SELECT min(item_id) AS item_id, t FROM (SELECT item_id, {words} AS t FROM benchmark) WHERE len(t) >= {decontaminate.LEAST_TOKENS} GROUP BY t),
    dp AS (SELECT doc_id, text, t, unnest(range(0, greatest(len(t) - {span - 1}, 0))) AS p FROM d),
    ip AS (SELECT item_id, t, unnest(range(0, greatest(len(t) - {span - 1}, 0))) AS p FROM i),
    ds AS ({doc_at}), its AS ({item_at}),
    lens AS (SELECT DISTINCT len(t) AS n FROM i WHERE len(t) < {span}),
    whole AS (SELECT doc_id, text, p, t[p + 1:p + n] AS gram FROM (
      SELECT doc_id, text, t, n, unnest(range(0, greatest(len(t) - n + 1, 0))) AS p FROM d, lens)),
    h AS (SELECT DISTINCT ds.doc_id, ds.text, its.item_id, ds.p - its.p AS shift FROM ds JOIN its USING (mask, seed)
          UNION SELECT whole.doc_id, whole.text, i.item_id, p FROM whole JOIN i ON i.t = gram),
    w AS (SELECT h.*, d.t AS dt, i.t AS it, least(len(i.t), {window}) AS compared,
            unnest(range(greatest(0, -shift), least(len(i.t), len(d.t) - shift) - least(len(i.t), {window}) + 1)) AS s
          FROM h JOIN d ON d.doc_id IS NOT DISTINCT FROM h.doc_id AND d.text = h.text JOIN i USING (item_id)),
    m AS (SELECT doc_id, text, item_id, compared, s + shift AS start,
            len(list_filter(range(1, compared + 1), lambda x: it[s + x] = dt[s + shift + x])) AS matched FROM w)
    SELECT doc_id, item_id, max(matched)::INT AS matched, arg_max(start, matched * 1000000000 - start)::INT AS start, any_value(compared)::INT AS compared
    FROM m WHERE matched >= ceil(compared * {decontaminate.AGREEMENT}) GROUP BY doc_id, text, item_id"""


@register("op10_decontaminate", _leaks_sql())
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item, with the passage's place. Null texts hold none; an empty benchmark gives no rows."""
    leaks = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "start", "matched", "compared")


@register("op9_line_dedup")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text without repeated lines. Null texts stay null; a text that loses all its lines is empty."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated(docs, complete=True)


@register("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learnt from those not held out. Null texts and those without letters are ``und``; a null id is not held out."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    model = language_id.LanguageModel.learn(docs.filter("NOT held_out"))
    found = language_id.identify(docs, model, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")


_NEAREST_SQL = """
WITH v AS (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""


@register("op4_vector_search", _NEAREST_SQL)
def op4_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest vectors of every hundredth one. Null, zero and non-finite vectors take no part; repeated rows count once."""
    return vector_search.search(table(spark, sf_dir, "embeddings"), every=100, k=10)


@register("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score and verdict. Null and blank texts score 0; the model learns from these very documents."""
    docs = table(spark, sf_dir, "documents")
    model = quality.QualityModel.learn(docs)
    scored = quality.score_quality(docs, model, keep=["doc_id"])
    return scored.withColumn("keep", F.col("quality") >= quality.LEAST)


register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)


@register("op2_substring_dedup")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share a passage with an earlier one, and where. Null and short texts share none."""
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents")).withColumnRenamed("other", "other_doc_id")


def _rebuilt_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, ids): each conversation c begins with the first h turns of conversation c - c % 20, then goes on with
    its own after its first h; h is crc32 of the decimal c, modulo 4. Equal turn numbers: role and text decide."""
    own = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    by = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    placed = own.withColumn("at", F.row_number().over(by) - 1).withColumn("part", F.lit(1))
    ids = own.select("conv_id").distinct()
    borrowed = F.crc32(F.col("conv_id").cast("string")) % 4
    heads = placed.filter("conv_id % 20 = 0 AND at < 3").withColumnRenamed("conv_id", "base")
    takers = ids.select("conv_id", borrowed.alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base")).filter("h > 0")
    taken = heads.join(takers, "base").filter("at < h").withColumn("part", F.lit(0))
    columns = ["conv_id", "part", "at", "role", "text"]
    return placed.filter(F.col("at") >= borrowed).select(*columns).union(taken.select(*columns)), ids


_CRC_TABLE = """SELECT list(c ORDER BY n) AS tab FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS n))"""


def _crc_sql(digits: str) -> str:
    """crc32 of a string of ASCII characters; ``tab`` is in scope."""
    codes = f"list_transform(string_split({digits}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


_TRIE_SQL = f"""
WITH crc AS ({_CRC_TABLE}),
own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
        FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY place) AS turns FROM own GROUP BY conv_id),
h AS (SELECT conv_id, turns, {_crc_sql("conv_id::VARCHAR")} % 4 AS h FROM o, crc),
c AS (SELECT h.conv_id, list_concat(coalesce(b.turns, [])[:h.h], h.turns[h.h + 1:]) AS turns
      FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 20),
m AS (SELECT conv_id, len(turns) AS size, unnest(range(len(turns) + 1)) AS depth, turns FROM c),
p AS (SELECT conv_id, size, depth, turns[:depth] AS path FROM m),
n AS (SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
      FROM p GROUP BY path),
k AS (SELECT n.*, (SELECT count(*) FROM n x WHERE x.depth = n.depth + 1 AND x.path[:n.depth] = n.path) AS n_children,
        CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(path[depth].text, '[^\\x20\\x09-\\x0D]+')) END AS saved
      FROM n)
SELECT a.conv_id::BIGINT AS conv_id, a.depth::BIGINT AS depth,
  (SELECT u.conv_id FROM n u WHERE u.depth = a.depth - 1 AND u.path = a.path[:a.depth - 1])::BIGINT AS parent_conv_id,
  any_value(a.n_convs)::BIGINT AS n_convs, any_value(a.n_children)::BIGINT AS n_children,
  (count(*) FILTER (d.n_children = 0))::BIGINT AS n_leaves, sum(d.saved)::BIGINT AS saved_tokens, any_value(a.ends_sha256) AS ends_sha256
FROM k a JOIN k d ON d.depth >= a.depth AND d.path[:a.depth] = a.path GROUP BY a.path, a.conv_id, a.depth"""


@register("op12_conversation_trie", _TRIE_SQL)
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations; rows without conv_id take no part, an empty table has no node."""
    turns, ids = _rebuilt_conversations(table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_nodes(turns, ids, order=["part", "at"])


@register("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all texts with their forms; in one run of 97, chosen by crc32, a code point is left out. Null texts have no word, a null id is empty."""
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = table(spark, sf_dir, "documents").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text, F.lit("([a-zÀ-ÿ]+)"), F.lit(1))).alias("run"))
    hashed = runs.filter(F.char_length("run") >= 5).withColumn("h", F.crc32(F.concat_ws(":", "id", "run")))
    word = F.when(F.col("h") % 97 != 0, F.col("run")).otherwise(
        F.expr("concat(substring(run, 1, h % char_length(run)), substring(run, h % char_length(run) + 2))"))
    words = spelling.vocabulary(hashed.select(word.alias("word")), least_chars=5, least_count=3)
    return spelling.variant_forms(cut_lineage(words))


@register("op11_quality_rules")
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document. Trees learn from ``labels`` of quality, TRAIN_ROWS at most; a null text has no word and fails."""
    measured = cut_lineage(quality_rules.measure(table(spark, sf_dir, "documents")))
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") > 0).alias("good"))
    judged = quality_rules.judge(measured, quality_rules.learn(measured, labels))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", *quality_rules.COUNTS, failed.alias("base_failed"), (~failed & (F.col("score") >= 0.5)).alias("kept"), "score")
