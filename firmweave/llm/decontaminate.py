"""Benchmark decontamination by spaced seeds, with Spark expressions only.

A fixed mask looks at some of the tokens in a stretch and ignores the others, so
a substituted token at an ignored position does not hide a passage. Masked hashes of
the test items and of the training documents are joined; a hit fixes how item
and document line up, and the passage counts if a window of the item agrees with
the document there in most tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firmweave.storage import cut_lineage

# tokens looked at from the start of a stretch; together they bridge a substituted token between its ends.
# Items with fewer tokens than the longest mask spans are looked for whole, those of fewer than LEAST_TOKENS not at all: so few words prove nothing.
MASKS = ((0, 1, 3, 4, 7, 9), (0, 2, 3, 5, 8, 9), (0, 1, 2, 6, 8, 9))
SPAN = 1 + max(max(m) for m in MASKS)
LEAST_TOKENS = 5
WINDOW = 20
AGREEMENT = 0.8
# seeds of the items (24 bytes each) that are broadcast at most; beyond, the join is shuffled
BROADCAST_SEEDS = 1_000_000


def token_hashes(text: Column) -> Column:
    """Hashes of the text's runs of letters and digits, lower-cased; null for a null text."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(tokens: Column, mask: tuple[int, ...]) -> Column:
    """Masked hash at every position whose stretch lies in ``tokens``."""
    last = F.size(tokens) - 1 - mask[-1]
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in mask]))


def _all_seeds(df: DataFrame, keep: list[str], masks: dict[int, tuple[int, ...]]) -> DataFrame:
    """(keep..., mask, pos, seed) of the column ``tokens``."""
    listed = df.select(*keep, *[_seeds(F.col("tokens"), m).alias(f"s{i}") for i, m in masks.items()])
    parts = [
        # outer, as Spark would otherwise put a test of the array, and with it all its work, before the explode
        listed.select(*keep, F.lit(i).alias("mask"), F.posexplode_outer(f"s{i}").alias("pos", "seed")).filter("seed IS NOT NULL")
        for i in masks
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _item_seeds(known: DataFrame) -> tuple[DataFrame, dict[int, tuple[int, ...]]]:
    """(item, mask, pos, seed) of the items, and the masks for documents: those of MASKS, and one of n tokens in a row
    for each number n of tokens that a short item has."""
    masks = dict(enumerate(MASKS))
    size = F.size("tokens")
    lengths = sorted(r["n"] for r in known.filter(size < SPAN).select(size.alias("n")).distinct().collect())  # SPAN - LEAST_TOKENS at most
    seeds = _all_seeds(known.filter(size >= SPAN), ["item"], masks)
    for n in lengths:
        whole = {100 + n: tuple(range(n))}
        seeds = seeds.unionByName(_all_seeds(known.filter(size == n), ["item"], whole))
        masks |= whole
    return seeds, masks


def _row_keys(key: str, text: str) -> list[Column]:
    """Two hashes that tell rows of different key or text apart, null keys too."""
    return [F.xxhash64(key, text).alias("r1"), F.xxhash64(F.lit(1), text, key).alias("r2")]


def contaminated(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", window: int = WINDOW, agreement: float = AGREEMENT,
) -> DataFrame:
    """(r1, r2, key, item_key, start, matched, compared): documents that hold a passage of an item.

    A document holds a passage if some ``window`` tokens in a row of an item (all of
    a shorter item) agree with as many tokens in a row of the document in ``agreement`` of the
    positions or more, and a masked seed hits on that alignment; items of LEAST_TOKENS to 9 tokens must be there whole. ``start`` is the first token
    of the best such window in the document, ``matched`` of ``compared`` tokens agree. Items are told apart by their tokens:
    equal ones count once, under their smallest key (null if none has one), and different ones with one key each. One row for each different
    document (by key and text) and item; null texts, and items of fewer than LEAST_TOKENS tokens, give none.
    """
    listed = items.select(F.col(item_key).alias("name"), token_hashes(F.col(item_text)).alias("tokens"))
    known = cut_lineage(
        listed.filter(F.size("tokens") >= LEAST_TOKENS).groupBy("tokens").agg(F.min("name").alias("name"))
        .select("tokens", "name", F.struct(F.xxhash64("tokens").alias("a"), F.xxhash64(F.lit(1), F.col("tokens")).alias("b")).alias("item"))
    )
    all_seeds, masks = _item_seeds(known)
    seeds = all_seeds.select("mask", "seed", "item", F.col("pos").alias("item_pos"))
    lengths = known.select("item", "name", F.col("tokens").alias("item_tokens"))
    n = known.agg(F.coalesce(F.sum(F.size("tokens")), F.lit(0))).first()[0] * len(MASKS)
    small = n <= BROADCAST_SEEDS

    def maybe_broadcast(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    placed = texts.select(*_row_keys("key", "text"), token_hashes(F.col("text")).alias("tokens"))
    hits = cut_lineage(
        _seed_hits(placed, maybe_broadcast(seeds), masks).groupBy("r1", "r2")
        .agg(F.collect_set(F.struct("item", "shift")).alias("hits"))
    )
    # the documents that were hit, read again for the tokens around the hits
    found = texts.select(*_row_keys("key", "text"), "key", "text").join(hits, ["r1", "r2"]).dropDuplicates(["r1", "r2"])
    spread = found.select("r1", "r2", "key", token_hashes(F.col("text")).alias("tokens"), "hits").select(
        "r1", "r2", "key", "tokens", F.explode("hits").alias("hit")
    ).select("r1", "r2", "key", "tokens", "hit.item", "hit.shift")
    lined = spread.join(maybe_broadcast(lengths), "item").withColumn(
        "equal",
        F.transform("item_tokens", lambda t, j: F.coalesce(
            (t == F.when(F.col("shift") + j >= 0, F.get("tokens", F.col("shift") + j))).cast("int"), F.lit(0)
        )),
    ).select("r1", "r2", "key", "item", "name", "shift", "equal", F.size("tokens").alias("n"), F.least(F.size("item_tokens"), F.lit(window)).alias("compared"))
    # windows of the item that lie in the document
    first = F.greatest(F.lit(0), -F.col("shift"))
    last = F.least(F.size("equal"), F.col("n") - F.col("shift")) - F.col("compared")
    best = F.array_max(
        F.transform(
            F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>")),
            lambda s: F.struct(
                F.aggregate(F.slice("equal", s + 1, F.col("compared")), F.lit(0), lambda a, x: a + x).alias("matched"),
                (-(s + F.col("shift"))).alias("minus_start"),
            ),
        )
    )
    return (
        lined.withColumn("best", best)
        .groupBy("r1", "r2", "item").agg(F.first("key").alias("key"), F.first("name").alias("name"), F.max("best").alias("best"), F.first("compared").alias("compared"))
        .filter(F.col("best.matched") >= F.ceil(F.col("compared") * agreement))
        .select(
            "r1", "r2", F.col("key").alias(key), F.col("name").alias(item_key),
            (-F.col("best.minus_start")).alias("start"), F.col("best.matched").alias("matched"), "compared",
        )
    )


def _seed_hits(placed: DataFrame, seeds: DataFrame, masks: dict[int, tuple[int, ...]]) -> DataFrame:
    """(r1, r2, item, shift) where a masked hash of a document equals one of an item."""
    return (
        _all_seeds(placed, ["r1", "r2"], masks).join(seeds, ["mask", "seed"])
        .select("r1", "r2", "item", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct()
    )


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no passage of an item; all columns, repeated rows and null texts stay."""
    columns = docs.columns
    own = [f"c{i}" for i in range(len(columns))]
    plain = docs.toDF(*own)
    key_at, text_at = own[columns.index(key)], own[columns.index(text)]
    bad = contaminated(plain, items, key_at, text_at, item_text="text").select("r1", "r2").distinct()
    return plain.withColumns(dict(zip(("r1", "r2"), _row_keys(key_at, text_at)))).join(bad, ["r1", "r2"], "left_anti").select(*own).toDF(*columns)
