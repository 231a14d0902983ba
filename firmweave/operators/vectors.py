"""Name vectors and an exact cosine join on them.

A name becomes a unit TF-IDF vector over its character n-grams, kept as a
sorted array of terms, rarest first. ``cosine_pairs`` needs no pair-wise scan:
two vectors with cosine >= t share a gram inside both prefixes, where a prefix
ends once the rest of the vector is shorter than t (Bayardo et al., "Scaling Up
All Pairs Similarity Search", WWW 2007).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from firmweave.functions.similarity import token_sort_score
from firmweave.storage import cut_lineage

GRAM_SIZE = 3
_SLACK = 1e-9  # covers floating point error in norms and products

# Neighbours per name, least cosine, least token-sort score (exclusive).
NEIGHBOURS = 10
MIN_COSINE = 0.88
LEXICAL = 81

REFINE_ROWS = 2_000


def l2_radius(cosine: float) -> float:
    """Distance between unit vectors whose cosine is ``cosine``."""
    return math.sqrt(2 * (1 - cosine))


def gram_vectors(names: DataFrame, column: str = "name", size: int = GRAM_SIZE) -> DataFrame:
    """(name, terms): unit vectors as arrays of (df, gram, w), rarest gram first."""
    names = names.select(F.col(column).alias("name")).filter("name != ''").distinct()
    padded = F.concat(F.lit(" " * (size - 1)), "name", F.lit(" " * (size - 1)))
    starts = F.sequence(F.lit(1), F.length("name") + size - 1)
    grams = (
        names.select("name", F.explode(F.transform(starts, lambda i: F.substring(padded, i, F.lit(size)))).alias("gram"))
        .groupBy("name", "gram").agg(F.count(F.lit(1)).alias("tf"))
    )
    spread = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    total = names.agg(F.count(F.lit(1)).alias("n")).scalar()
    weighted = grams.join(spread, "gram").select(
        "name", "gram", "df", (F.col("tf") * (F.log((total + 1) / (F.col("df") + 1)) + 1)).alias("w")
    )
    terms = weighted.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("df", "gram", "w"))).alias("terms"))
    norm = F.sqrt(_square_sum(F.col("terms")))
    return terms.select("name", norm.alias("norm"), "terms").select(
        "name",
        F.transform(
            "terms",
            lambda t: F.struct(t["df"].alias("df"), t["gram"].alias("gram"), (t["w"] / F.col("norm")).alias("w")),
        ).alias("terms"),
    )


def _square_sum(terms: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t["w"] * t["w"])


def _dot(terms: Column, weights: Column) -> Column:
    return F.aggregate(
        terms, F.lit(0.0), lambda acc, t: acc + t["w"] * F.coalesce(weights[t["gram"]], F.lit(0.0))
    )


def _with_tails(vectors: DataFrame) -> DataFrame:
    """(name, terms): terms with ``tail``, the length of a vector from that gram on."""
    size = F.size("terms")
    return vectors.select(
        "name",
        F.transform(
            "terms",
            lambda t, i: F.struct(
                t["gram"].alias("gram"),
                t["w"].alias("w"),
                F.sqrt(_square_sum(F.slice("terms", i + 1, size))).alias("tail"),
            ),
        ).alias("terms"),
    )


def _key_columns(key: Column, need: Column, before: Column) -> list[Column]:
    """(name, key, at, need, w, ws, after) for the gram ``t`` at place ``at``: nothing of the vector but the weights met so far
    and the length of what follows."""
    tail, w = F.col("t.tail"), F.col("t.w")
    after = F.sqrt(F.greatest(F.lit(0.0), tail * tail - w * w))
    return [F.col("name"), key.alias("key"), F.col("at"), need.alias("need"), w.alias("w"), F.concat(before, F.array(w)).alias("ws"), after.alias("after")]


def _first_keys(tails: DataFrame, min_cosine: float) -> DataFrame:
    """Keys of every gram that can be the rarest one a vector shares with a near one."""
    need = F.lit(min_cosine - _SLACK)
    grams = tails.select("name", F.posexplode("terms").alias("at", "t")).filter(F.col("t.tail") >= need)
    return grams.select(*_key_columns(F.xxhash64("t.gram"), need, F.array().cast("array<double>")))


def cosine_pairs(vectors: DataFrame, min_cosine: float, refine_rows: int = REFINE_ROWS) -> DataFrame:
    """Every pair (a, b, cosine), a < b, with cosine >= ``min_cosine`` among ``gram_vectors``.

    A pair meets at the rarest gram it shares. Where that gram is crowded, the rest of both vectors must make up for what
    it leaves missing: they share a later gram too, which narrows the key, as often as needed, or what they
    share so far is enough for both.
    """
    vectors = cut_lineage(vectors, spread=True)
    tails = cut_lineage(_with_tails(vectors))
    keys, found = cut_lineage(_first_keys(tails, min_cosine)), []
    while True:
        counted = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("w").alias("top"))
        crowded = cut_lineage(counted.filter(F.col("n") > refine_rows).select("key", "top"))
        if crowded.isEmpty():
            found.append(_join_keys(keys, min_cosine))
            break
        found.append(_join_keys(keys.join(crowded, "key", "left_anti"), min_cosine))
        deep = cut_lineage(keys.join(crowded, "key").select("name", "key", "at", (F.col("need") - F.col("w") * F.col("top")).alias("need"), "w", "ws", "after"))
        found.append(_join_keys(deep.filter("need <= 0"), min_cosine))
        later = deep.select("name", "key", "need", "ws", F.col("at").alias("from")).join(tails, "name").select(
            "name", "key", "need", "ws", "from", F.posexplode("terms").alias("at", "t")
        ).filter((F.col("at") > F.col("from")) & (F.col("t.tail") >= F.col("need")))
        keys = cut_lineage(later.select(*_key_columns(F.xxhash64("key", "t.gram"), F.col("need"), F.col("ws"))))
    # vectors are fetched once for each pair
    pairs = cut_lineage(reduce(DataFrame.unionByName, found).distinct())
    weights = F.map_from_entries(F.transform("terms", lambda t: F.struct(t["gram"], t["w"])))
    return (
        pairs.join(vectors.select(F.col("name").alias("a"), "terms"), "a")
        .join(vectors.select(F.col("name").alias("b"), weights.alias("weights")), "b")
        .withColumn("cosine", F.round(_dot(F.col("terms"), F.col("weights")), 9))
        .filter(F.col("cosine") >= min_cosine)
        .select("a", "b", "cosine")
    )


def _join_keys(keys: DataFrame, min_cosine: float) -> DataFrame:
    left = keys.select("key", F.col("name").alias("a"), F.col("ws").alias("wa"), F.col("after").alias("ra"))
    right = keys.select("key", F.col("name").alias("b"), F.col("ws").alias("wb"), F.col("after").alias("rb"))
    # if these are the rarest grams a pair shares, this is the most its cosine can be
    shared = F.aggregate(F.zip_with("wa", "wb", lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    return left.join(right, "key").filter(
        (F.col("a") < F.col("b")) & (shared + F.col("ra") * F.col("rb") >= min_cosine - _SLACK)
    ).select("a", "b")


def nearest(pairs: DataFrame, k: int, score: str, descending: bool) -> DataFrame:
    """Both directions of (a, b, score), best ``k`` for each a; ties by b."""
    both = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("a"), F.col("b"), F.col(score)),
                F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col(score)),
            )
        )
    )
    order = F.desc(score) if descending else F.asc(score)
    rank = F.row_number().over(Window.partitionBy("a").orderBy(order, "b"))
    return both.withColumn("rank", rank).filter(F.col("rank") <= k)


def lexically_close(pairs: DataFrame, above: float) -> DataFrame:
    """Keep pairs (a, b) whose token-sort ratio exceeds ``above``; at most k pairs a name get here."""
    return pairs.filter(token_sort_score(F.col("a"), F.col("b")) > above)


def oriented(pairs: DataFrame) -> DataFrame:
    """Each unordered pair once, smaller side first."""
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def hybrid_pairs(
    names: DataFrame, column: str = "name", *, k: int = NEIGHBOURS, min_cosine: float = MIN_COSINE,
    lexical: float = LEXICAL,
) -> DataFrame:
    """Name pairs (a, b) that are near in vector space and lexically."""
    close = cosine_pairs(gram_vectors(names, column), min_cosine).filter(F.col("cosine") > min_cosine)
    ranked = nearest(close, k, "cosine", descending=True)
    return lexically_close(oriented(ranked), lexical)
