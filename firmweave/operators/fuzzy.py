"""Exact fuzzy joins without comparing all pairs.

``ratio_pairs`` finds every pair of texts within an indel budget. If at most
``t`` characters are inserted or deleted, and the shorter text is cut into
``t + 1`` segments, one segment survives whole in the longer text, moved by a
bounded shift (Li et al., "Pass-Join", VLDB 2011, restated for indel distance).
Segments become equi-join keys. Keys too common to join directly are refined by
a second segment of the remaining text, which keeps the result complete: the
remainders of a matching pair are within the same budget.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from firmweave.functions.similarity import (
    LENGTH_RATIO_LIMIT, TOKEN_WEIGHT, indel_budget, indel_distance, weighted_score, within_edits,
)
from firmweave.functions.text import comparable, token_sort_key, tokens
from firmweave.operators.relational import lookup, never_broadcast
from firmweave.storage import cut_lineage

# A key with more index rows than this is refined by a further segment.
REFINE_ROWS = 2_000
# Pairs with a budget up to this meet by deletions; a text of n characters has about n ** 3 / 6 of three.
SMALL_BUDGET = 3


def _segment_start(i: Column, n: Column, m: Column) -> Column:
    """Zero-based start of segment ``i`` (from 1) of ``n`` characters cut into ``m`` segments."""
    return (i - 1) * F.floor(n / m).cast("int") + F.greatest(F.lit(0), i - 1 - (m - n % m))


def _segment_length(i: Column, n: Column, m: Column) -> Column:
    return F.floor(n / m).cast("int") + F.when(i > m - n % m, 1).otherwise(0)


def _segment_key(segment: Column) -> Column:
    # a hash keeps the shuffle narrow; a collision only adds a pair to verify
    return F.xxhash64("base", "m", "i", segment)


def _without(text: Column, start: Column, length: Column) -> Column:
    return F.concat(F.substring(text, F.lit(1), start), F.substring(text, start + length + 1, F.length(text)))


def _index(df: DataFrame) -> DataFrame:
    """Keys of every segment. In and out: text, side, rest, n, m, base (out: key)."""
    i, n, m = F.col("i"), F.col("n"), F.col("m")
    cut = df.withColumn("i", F.explode(F.sequence(F.lit(1), m))).select(
        "text", "side", "rest", "n", "m", "base", "i",
        _segment_start(i, n, m).alias("start"), _segment_length(i, n, m).alias("width"),
    )
    return cut.select(
        "text",
        "side",
        _without(F.col("rest"), F.col("start"), F.col("width")).alias("rest"),
        (n - F.col("width")).alias("n"),
        "m",
        _segment_key(F.substring("rest", F.col("start") + 1, F.col("width"))).alias("key"),
    )


def _probe(df: DataFrame) -> DataFrame:
    """Keys of every substring that may equal a segment of a text with ``n`` characters."""
    i, n, m, gap = F.col("i"), F.col("n"), F.col("m"), F.col("gap")
    budget = m - 1
    shifted = df.withColumn("i", F.explode(F.sequence(F.lit(1), m))).select(
        "text", "side", "rest", "n", "m", "gap", "base", "i",
        _segment_length(i, n, m).alias("width"),
        _segment_start(i, n, m).alias("home"),
        # fewest edits left of the segment / right of it / in total
        F.greatest(1 - i, gap - (m - i), -F.floor((budget - gap) / 2).cast("int")).alias("lo"),
        F.least(i - 1, gap + (m - i), F.floor((budget + gap) / 2).cast("int")).alias("hi"),
    )
    width, start = F.col("width"), F.col("start")
    return (
        shifted.filter("lo <= hi")
        .withColumn("start", F.explode(F.sequence(F.col("home") + F.col("lo"), F.col("home") + F.col("hi"))))
        .filter((start >= 0) & (start + width <= n + gap))
        .select(
            "text",
            "side",
            _without(F.col("rest"), start, width).alias("rest"),
            (n - width).alias("n"),
            "m",
            "gap",
            _segment_key(F.substring("rest", start + 1, width)).alias("key"),
        )
    )


def _length_limits(n: Column, num: int, den: int) -> tuple[Column, Column]:
    """Shortest and longest partner length that the budget can reach."""
    return (
        F.ceil(n * (den - num) / (den + num)).cast("int"),
        F.floor(n * (den + num) / (den - num)).cast("int"),
    )


def _deletions(text: Column, times: int) -> Column:
    """All texts that are left after ``times`` characters are taken out."""
    left = F.array(text)
    for _ in range(times):
        left = F.array_distinct(F.flatten(F.transform(left, lambda t: F.transform(
            F.sequence(F.lit(1), F.length(t)),
            lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))),
        ))))
    return left


def _near(texts: DataFrame, lengths: list[int], num: int, den: int, strict: bool, two_sided: bool) -> DataFrame | None:
    """Pairs (a, b, distance) with a budget up to SMALL_BUDGET that are within it, length(a) <= length(b). Input: text, side.

    Texts at indel distance d have a common rest after d deletions, shared out by their
    lengths. So pairs meet at such a rest, and all that meet are within the budget; three edits at most leave
    no doubt about the distance. ``lengths`` of texts are few where budgets are small. None if no pair can have such a budget.
    """
    sized = texts.withColumn("n", F.length("text"))
    sides: dict[tuple[str, int], list[tuple[int, int, int]]] = {}
    for low in lengths:
        for high in (x for x in lengths if x >= low):
            top = ((low + high) * num - (1 if strict else 0)) // den
            budget, gap = top - (low + high - top) % 2, high - low
            if gap <= budget <= SMALL_BUDGET:
                sides.setdefault(("a", (budget - gap) // 2), []).append((low, low, high))
                sides.setdefault(("b", (budget + gap) // 2), []).append((high, low, high))

    def rests(name: str) -> DataFrame | None:
        parts = []
        for (role, times), sizes in sides.items():
            if role == name:
                partners = F.create_map(*[
                    x for n in {z[0] for z in sizes}
                    for x in (F.lit(n), F.array(*[F.struct(F.lit(low).alias("low"), F.lit(high).alias("high")) for m, low, high in sizes if m == n]))
                ])
                reached = sized.withColumn("partners", F.try_element_at(partners, F.col("n"))).filter("partners IS NOT NULL")
                parts.append(
                    reached.withColumn("rest", F.explode(_deletions(F.col("text"), times)))
                    .withColumn("pair", F.explode("partners"))
                    .select("rest", "pair.low", "pair.high", F.col("text").alias(name), F.col("side").alias(f"side_{name}"))
                )
        return reduce(DataFrame.unionByName, parts) if parts else None

    left, right = rests("a"), rests("b")
    if left is None or right is None:
        return None
    longer = F.col("high") > F.col("low")
    if two_sided:
        once = (F.col("side_a") != F.col("side_b")) & (longer | (F.col("side_a") == 0))
    else:
        once = longer | (F.col("a") < F.col("b"))
    gap = F.col("high") - F.col("low")
    # the distance has the parity of the gap; a gap of one is all there is if one edit does it
    beyond = F.when(gap == 0, F.when(F.col("a") == F.col("b"), 0).otherwise(2)).when(
        gap == 1, F.when(F.levenshtein("a", "b") == 1, 0).otherwise(2)).otherwise(0)
    met = left.join(never_broadcast(right), ["rest", "low", "high"]).filter(once)
    return met.select("a", "b", *(["side_a"] if two_sided else []), (gap + beyond).alias("distance")).distinct()


def _candidates(
    texts: DataFrame, num: int, den: int, strict: bool, two_sided: bool, refine_rows: int
) -> DataFrame:
    """Pairs (a, b) with a budget above SMALL_BUDGET within edit distance, length(a) <= length(b). Input: text, side."""
    n = F.length("text")
    shortest, longest = _length_limits(n, num, den)
    segments = F.array_distinct(
        F.filter(
            F.transform(
                F.sequence(n, F.greatest(n, longest)),
                lambda l: indel_budget(n + l, num, den, strict) + 1,
            ),
            lambda m: m > SMALL_BUDGET + 1,
        )
    )
    index = _index(
        texts.select(
            "text", "side", F.col("text").alias("rest"), n.alias("n"),
            F.explode(segments).alias("m"), n.cast("bigint").alias("base"),
        )
    )
    probe = _probe(
        texts.withColumn("size", n)
        .withColumn("n", F.explode(F.sequence(F.greatest(F.lit(1), shortest), F.col("size"))))
        .select(
            "text",
            "side",
            F.col("text").alias("rest"),
            "n",
            (F.col("size") - F.col("n")).alias("gap"),
            (indel_budget(F.col("size") + F.col("n"), num, den, strict) + 1).alias("m"),
            F.col("n").cast("bigint").alias("base"),
        )
        .filter((F.col("m") > F.col("gap")) & (F.col("m") > SMALL_BUDGET + 1))
    )
    budget = indel_budget(F.length("a") + F.length("b"), num, den, strict)
    gap = F.length("b") - F.length("a")
    once = (F.col("side_a") != F.col("side_b")) & ((gap > 0) | (F.col("side_a") == 0)) if two_sided else (gap > 0) | (F.col("a") < F.col("b"))
    # edit distance never exceeds indel distance
    fits = (gap >= 0) & once & (budget >= gap) & within_edits(F.col("a"), F.col("b"), budget)
    return _meet(index, probe, fits, refine_rows).select("a", "b", *(["side_a"] if two_sided else [])).distinct()


def _meet(index: DataFrame, probe: DataFrame, fits: Column, refine_rows: int) -> DataFrame:
    """Pairs (a, side_a, b, side_b) of index and probe rows with equal keys that are ``fits``.

    A crowded key is refined by a further segment of what is left, as often as the rests are long enough to be cut;
    shorter rests differ by their budget at most, so what meets there is as good as alike.
    """
    found = []
    while True:
        # a remainder shorter than its number of segments cannot be told apart further
        counted = index.groupBy("key").agg(
            F.count(F.lit(1)).alias("rows"), F.min("n").alias("n"), F.min("m").alias("m")
        )
        many = counted.filter((F.col("rows") > refine_rows) & (F.col("n") >= F.col("m")))
        # keys that nothing probes need no refinement
        crowded = cut_lineage(
            probe.select("key").join(never_broadcast(many.select("key")), "key", "left_semi").distinct()
        )
        if crowded.isEmpty():
            found.append(_join_keys(index, probe, fits))
            return reduce(DataFrame.unionByName, found)
        found.append(_join_keys(index.join(never_broadcast(crowded), "key", "left_anti"), probe, fits))
        keep = ["text", "side", "rest", "n", "m", F.col("key").alias("base")]
        index = cut_lineage(_index(index.join(never_broadcast(crowded), "key", "left_semi").select(*keep)), spread=True)
        probe = cut_lineage(
            _probe(probe.join(never_broadcast(crowded), "key", "left_semi").select(*keep, "gap")), spread=True
        )


def _join_keys(index: DataFrame, probe: DataFrame, fits: Column) -> DataFrame:
    left = index.select("key", F.col("text").alias("a"), F.col("side").alias("side_a"))
    right = probe.select("key", F.col("text").alias("b"), F.col("side").alias("side_b"))
    return left.join(never_broadcast(right), "key").filter(fits).select("a", "side_a", "b", "side_b")


def ratio_pairs(
    left: DataFrame, right: DataFrame | None = None, *, num: int, den: int, strict: bool, refine_rows: int = REFINE_ROWS,
) -> DataFrame:
    """All pairs (a, b, distance) of non-empty texts with ``distance * den < num * total length``.

    ``left`` and ``right`` have one column ``text``. Without ``right``, pairs
    are within ``left`` and unordered (each once, a is the shorter or smaller).
    ``strict=False`` turns ``<`` into ``<=``.
    """
    two_sided = right is not None
    texts = left.select("text", F.lit(0).alias("side"))
    if two_sided:
        texts = texts.unionByName(right.select("text", F.lit(1).alias("side")))
    texts = cut_lineage(texts.filter("text != ''").distinct(), spread=True)
    # a pair's budget is small only if both are short; so is the number of such lengths
    short = (SMALL_BUDGET + 2) * den // max(num, 1) + 1
    n = F.length("text")
    seen = texts.agg(F.collect_set(F.when(n <= short, n)).alias("short"), F.coalesce(F.max(n), F.lit(0)).alias("longest")).first()
    parts = []
    near = _near(texts, sorted(seen["short"]), num, den, strict, two_sided)
    if near is not None:
        parts.append(near)
    if 2 * seen["longest"] * num > SMALL_BUDGET * den:
        budget = indel_budget(F.length("a") + F.length("b"), num, den, strict)
        wide = _candidates(texts, num, den, strict, two_sided, refine_rows)
        parts.append(wide.withColumn("distance", indel_distance(F.col("a"), F.col("b"))).filter(F.col("distance") <= budget))
    if not parts:
        return texts.select(F.col("text").alias("a"), F.col("text").alias("b"), F.lit(0).alias("distance")).limit(0)
    pairs = reduce(DataFrame.unionByName, parts)
    if two_sided:
        turned = F.col("side_a") == 1
        pairs = pairs.select(
            F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"),
            F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"), "distance",
        )
    return pairs


def percent(distance: Column, total: Column) -> Column:
    return F.lit(100.0) * (F.lit(1.0) - distance / total)


def best_other_names(
    names: DataFrame, column: str = "name", num: int = 1, den: int = 10,
    scorer: Callable[[Column, Column], Column] | None = None, reach: tuple[int, int] | None = None,
) -> DataFrame:
    """For each name its best other name by token-sort ratio (name, best, score).

    Kept only above ``100 * (1 - num / den)``. Ties go to the smaller name.

    Another ``scorer`` of two names' sorted words (0 to 100) is asked instead about all pairs whose token-sort ratio is above
    ``100 * (1 - reach)``; ``reach`` (a fraction as two whole numbers, by default num and den) says how far below the cut-off
    the ratio of a pair may be that the scorer puts above it, so choose it for the scorer. Equal words in another order score 100.
    """
    keyed = cut_lineage(
        names.select(F.col(column).alias("name")).filter("name != ''").distinct()
        .withColumn("text", token_sort_key("name"))
    )
    groups = keyed.groupBy("text").agg(F.min("name").alias("first"), F.count(F.lit(1)).alias("members"))
    # same words in another order: score 100 with the smallest other name
    twins = keyed.join(never_broadcast(groups.filter("members > 1")), "text")
    second = (
        twins.filter("name != first").groupBy("text").agg(F.min("name").alias("second"))
    )
    permuted = twins.join(never_broadcast(second), "text").select(
        "name",
        F.when(F.col("name") == F.col("first"), F.col("second")).otherwise(F.col("first")).alias("best"),
        F.lit(100.0).alias("score"),
    )
    wide = reach or (num, den)
    pairs = ratio_pairs(groups.select("text"), num=wide[0], den=wide[1], strict=True)
    score = percent(F.col("distance"), F.length("a") + F.length("b")) if scorer is None else scorer(F.col("a"), F.col("b"))
    both = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("a"), F.col("b"), "distance"),
                F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "distance"),
            )
        )
    )
    scored = (
        both.join(never_broadcast(groups.select(F.col("text").alias("b"), "first")), "b")
        .withColumn("score", score)
        .filter(F.lit(True) if scorer is None else F.col("score") * den > 100 * (den - num))
        .groupBy("a")
        .agg(F.min(F.struct((-F.col("score")).alias("rank"), F.col("first").alias("best"))).alias("top"))
    )
    single = (
        groups.filter("members = 1").select(F.col("text").alias("a"), F.col("first").alias("name"))
        .join(never_broadcast(scored), "a")
        .select("name", "top.best", (-F.col("top.rank")).alias("score"))
    )
    return permuted.unionByName(single)


def _token_set_key(text: str) -> Column:
    return F.array_join(F.sort_array(F.array_distinct(tokens(text))), " ")


def _token_pairs(some: DataFrame, other: DataFrame, cutoff: float, df: DataFrame, refine_rows: int) -> DataFrame:
    """Pairs (a, b) whose token-set score may reach the cut-off: rare tokens of one side, all of the other.

    With ``d`` edits between the leftovers, at most ``2 d`` distinct tokens of a
    name lack a twin, so one of its ``2 d + 1`` rarest tokens is shared. A token that more than ``refine_rows``
    names have is not a key by itself: names that share it share another one too, which makes a key of two (of three, where those
    are crowded as well, and so on), or no other, and then what is left of them is within ``d`` edits, so a segment of it makes the key.
    """
    slack = 100 * TOKEN_WEIGHT - cutoff
    reached = lambda total: F.floor(total * slack / (100 * TOKEN_WEIGHT)).cast("int")
    longest = F.length("text") * (1 + LENGTH_RATIO_LIMIT)
    tokened = lambda t: t.select("text", F.array_distinct(tokens("text")).alias("tokens"))
    long_form = lambda t: t.select("text", F.explode("tokens").alias("token"))
    every = long_form(tokened(other)).select(F.col("text").alias("b"), "token")
    any_crowded = not df.filter(F.col("df") > refine_rows).isEmpty()
    # how often a token occurs is asked by every name that has it
    counted = lookup(cut_lineage(long_form(tokened(some))), df, "token", "inner") if any_crowded else long_form(tokened(some)).join(never_broadcast(df), "token")
    ranked = counted.groupBy("text").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("ranked"))
    rare = ranked.select(
        F.col("text").alias("a"), F.explode(F.slice("ranked", F.lit(1), 2 * reached(longest) + 1)).alias("r")
    ).select("a", "r.token", (F.col("r.df") > refine_rows).alias("crowded"))
    la, lb = F.length("a"), F.length("b")
    # leftover tokens without a twin: few enough on one side
    lone = F.least(F.size(F.array_except(tokens("a"), tokens("b"))), F.size(F.array_except(tokens("b"), tokens("a"))))
    fits = (F.greatest(la, lb) < LENGTH_RATIO_LIMIT * F.least(la, lb)) & (lone <= 2 * reached(la + lb))
    if not any_crowded:
        return rare.join(never_broadcast(every), "token").select("a", "b").filter(fits)
    rare = cut_lineage(rare)
    found = [rare.filter("NOT crowded").select("a", "token").join(never_broadcast(every), "token").select("a", "b")]
    left, right = cut_lineage(tokened(some)), cut_lineage(tokened(other))
    common = cut_lineage(rare.filter("crowded").select("a", "token"))
    named = lambda t: t.withColumn("shared", F.array("token")).drop("token")
    one = named(common.join(never_broadcast(left.withColumnRenamed("text", "a")), "a").withColumnRenamed("a", "text"))
    two = named(long_form(right).join(never_broadcast(common.select("token").distinct()), "token", "left_semi").join(never_broadcast(right), "text"))
    while True:
        one, two = cut_lineage(one), cut_lineage(two)
        if one.isEmpty() or two.isEmpty():
            break
        found.append(cut_lineage(_rest_pairs(one, two, slack / (100 * TOKEN_WEIGHT), refine_rows)))
        # names that share one more token; small groups meet, others go on with it
        further = lambda t: t.select("text", "tokens", "shared", F.explode(F.array_except("tokens", "shared")).alias("next")).select(
            "text", "tokens", F.sort_array(F.concat("shared", F.array("next"))).alias("shared")).distinct()
        one, two = further(one), further(two)
        sizes = one.select("shared").unionAll(two.select("shared")).groupBy("shared").agg(F.count(F.lit(1)).alias("rows"))
        crowded = cut_lineage(sizes.filter(F.col("rows") > refine_rows).select("shared"))
        small = one.join(never_broadcast(crowded), "shared", "left_anti").select("shared", F.col("text").alias("a"))
        found.append(cut_lineage(small.join(never_broadcast(two.select("shared", F.col("text").alias("b"))), "shared").select("a", "b")))
        one, two = (t.join(never_broadcast(crowded), "shared", "left_semi") for t in (one, two))
    return reduce(DataFrame.unionByName, found).distinct().filter(fits)


def _rest_pairs(one: DataFrame, two: DataFrame, share: float, refine_rows: int) -> DataFrame:
    """Pairs (a, b) of (text, tokens, shared) that have ``shared`` in common and may score by what is left without it: within ``share``
    of the texts' lengths of each other, or next to nothing on one side."""
    parts = [t.select(
        "text", F.lit(side).alias("side"), F.array_join("shared", " ").alias("token"),
        F.array_join(F.sort_array(F.array_except("tokens", "shared")), " ").alias("rest"),
    ) for side, t in enumerate((one, two))]
    sized = cut_lineage(parts[0].unionByName(parts[1]).withColumn("n", F.length("rest")))
    size = F.length("text")
    reach = lambda total: F.floor(total * share).cast("int")
    shortest, longest = F.floor(size / LENGTH_RATIO_LIMIT).cast("int") + 1, F.ceil(size * LENGTH_RATIO_LIMIT).cast("int") - 1
    # budgets that a name can have with partners in reach of its length; the shorter rest is cut, the longer one searched
    budgets = F.array_distinct(F.transform(F.sequence(F.least(shortest, size), F.greatest(longest, size)), lambda l: reach(size + l)))
    each = sized.filter("n > 0").withColumn("budget", F.explode(budgets))
    base = F.xxhash64("token")
    salted = lambda n: F.xxhash64(base, n)
    cut = each.filter("n > budget").select("text", "side", "rest", "n", (F.col("budget") + 1).alias("m"), salted(F.col("n")).alias("base"))
    searched = (
        each.withColumn("partner", F.explode(F.sequence(F.greatest(F.lit(1), F.col("n") - F.col("budget")), F.col("n"))))
        .filter("partner > budget")
        .select("text", "side", "rest", F.col("partner").alias("n"), (F.col("n") - F.col("partner")).alias("gap"),
                (F.col("budget") + 1).alias("m"), salted(F.col("partner")).alias("base"))
    )
    la, lb = F.length("a"), F.length("b")
    fits = (F.col("side_a") != F.col("side_b")) & (F.greatest(la, lb) < LENGTH_RATIO_LIMIT * F.least(la, lb))
    met = _meet(_index(cut), _probe(searched), fits, refine_rows)
    turned = F.col("side_a") == 1
    pairs = met.select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"))

    def meeting(first: Column, second: Column, near: Column) -> DataFrame:
        x, y = sized.filter("side = 0").filter(first), sized.filter("side = 1").filter(second)
        lx, ly = F.length("x.text"), F.length("y.text")
        close = (F.greatest(lx, ly) < LENGTH_RATIO_LIMIT * F.least(lx, ly)) & near
        return x.alias("x").join(never_broadcast(y).alias("y"), (F.col("x.token") == F.col("y.token")) & close).select(F.col("x.text").alias("a"), F.col("y.text").alias("b"))

    # rests too short to be cut: few different ones, and all of them are nearly within the budget of each other
    n = F.col("n")
    tiny = n <= 2 * reach(size * (1 + LENGTH_RATIO_LIMIT))
    near = F.abs(F.col("x.n") - F.col("y.n")) <= reach(F.length("x.text") + F.length("y.text"))
    # next to nothing left: such a name scores with all that have the shared tokens
    lone = (n == 0) | (n + 1 <= 2 * size * share)
    every = F.lit(True)
    return pairs.unionByName(meeting(tiny, tiny, near)).unionByName(meeting(lone, every, every)).unionByName(meeting(every, lone, every)).distinct()


def weighted_matches(
    left: DataFrame, right: DataFrame, cutoff: float, scorer: Callable[[Column, Column], Column] = weighted_score,
    reach: float | None = None, refine_rows: int = REFINE_ROWS,
) -> DataFrame:
    """All pairs (a, b, score) of comparable texts with weighted ratio >= ``cutoff`` (above 90).

    Another ``scorer`` of two text columns (0 to 100) is asked about all pairs whose weighted ratio may reach
    ``reach`` (above 90, the cut-off by default): a scorer that can exceed the ratio needs a lower one.

    ``left`` and ``right`` have one column ``text``. Beyond the length limit no
    score exceeds 90, so candidates are: plain ratio, token-sort ratio on sorted
    tokens, and shared rare tokens for the token-set score.
    """
    wanted, cutoff = cutoff, cutoff if reach is None else min(cutoff, reach)
    if cutoff <= 90:
        raise ValueError("partial scores are not generated, so the cut-off must exceed 90")
    left = cut_lineage(left.select("text").filter("text != ''").distinct())
    right = cut_lineage(right.select("text").filter("text != ''").distinct())
    forms = F.array("text", token_sort_key("text"), _token_set_key("text"))
    if cutoff > 100 * TOKEN_WEIGHT:
        forms = F.array("text")
    lf = left.select("text", F.explode(F.array_distinct(forms)).alias("form"))
    rf = right.select("text", F.explode(F.array_distinct(forms)).alias("form"))
    # the plain budget is the widest, so one join serves all three forms
    # rounded up, so that the budget only grows; the score decides in the end
    near = ratio_pairs(
        lf.select(F.col("form").alias("text")), rf.select(F.col("form").alias("text")),
        num=math.ceil(round((100 - cutoff) * 1_000, 6)), den=100_000, strict=False, refine_rows=refine_rows,
    )
    pairs = (
        near.select(F.col("a").alias("fa"), F.col("b").alias("fb"))
        .join(never_broadcast(lf.select(F.col("form").alias("fa"), F.col("text").alias("a"))), "fa")
        .join(never_broadcast(rf.select(F.col("form").alias("fb"), F.col("text").alias("b"))), "fb")
        .select("a", "b")
    )
    if cutoff <= 100 * TOKEN_WEIGHT:
        names = left.unionByName(right)
        df = cut_lineage(names.select(F.explode(F.array_distinct(tokens("text"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df")))
        pairs = pairs.unionByName(_token_pairs(left, right, cutoff, df, refine_rows)).unionByName(
            _token_pairs(right, left, cutoff, df, refine_rows).select(F.col("b").alias("a"), F.col("a").alias("b"))
        )
    return (
        pairs.distinct()
        .withColumn("score", scorer(F.col("a"), F.col("b")))
        .filter(F.col("score") >= wanted)
    )


def best_reference(
    names: DataFrame, reference: DataFrame, cutoff: float = 92, scorer: Callable[[Column, Column], Column] = weighted_score,
    reach: float | None = None,
) -> DataFrame:
    """Best reference row for each name: (name, ref_name, ref_domain, score), with ``scorer`` and ``reach`` of ``weighted_matches``.

    ``names`` has column ``name``; ``reference`` has ref_name, ref_domain.
    Ties go to the smallest reference name, then the smallest domain.
    """
    n = names.select("name", comparable("name").alias("a")).distinct()
    r = (
        reference.withColumn("b", comparable("ref_name"))
        .groupBy("b")
        .agg(F.min(F.struct("ref_name", "ref_domain")).alias("ref"))
    )
    scored = weighted_matches(n.select(F.col("a").alias("text")), r.select(F.col("b").alias("text")), cutoff, scorer, reach)
    best = (
        scored.join(never_broadcast(r), "b")
        .groupBy("a")
        .agg(F.min(F.struct((-F.col("score")).alias("rank"), F.col("ref.ref_name"), F.col("ref.ref_domain"))).alias("top"))
    )
    return n.join(never_broadcast(best), "a").select(
        "name", "top.ref_name", "top.ref_domain", (-F.col("top.rank")).alias("score")
    )
