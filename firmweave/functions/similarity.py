"""String scores on verified candidate pairs.

Indel distance is ``len(a) + len(b) - 2 * LCS(a, b)``; a ratio is
``100 * (1 - indel / (len(a) + len(b)))``. Spark has no LCS function, so these
are the only Python kernels. Callers run them after native candidate filters.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

# executors get the kernels with the task, so they need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Weight of the token branches, and the length ratio beyond which
# only partial scores (worth at most 90) are left.
TOKEN_WEIGHT = 0.95
LENGTH_RATIO_LIMIT = 1.5


def indel(a: str, b: str) -> int:
    """Insertions plus deletions that turn ``a`` into ``b`` (bit-parallel LCS)."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) + len(b) - 2 * (len(a) - row.bit_count())


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 * (1 - indel(a, b) / total) if total else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    shared = left & right
    only_l, only_r = " ".join(sorted(left - shared)), " ".join(sorted(right - shared))
    if shared and not (only_l and only_r):
        return 100.0
    base = len(" ".join(sorted(shared)))
    gap = 1 if shared else 0
    with_l, with_r = base + gap + len(only_l), base + gap + len(only_r)
    best = 100.0 * (1 - indel(only_l, only_r) / (with_l + with_r))
    if shared:
        for extra, longer in ((only_l, with_l), (only_r, with_r)):
            best = max(best, 100.0 * (1 - (gap + len(extra)) / (base + longer)))
    return best


def weighted_ratio(a: str, b: str) -> float:
    """Best of plain and token scores. Only valid above 90: beyond the length limit it is 0."""
    if not a or not b:
        return 0.0
    if max(len(a), len(b)) / min(len(a), len(b)) >= LENGTH_RATIO_LIMIT:
        return 0.0
    return max(
        ratio(a, b), TOKEN_WEIGHT * token_sort_ratio(a, b), TOKEN_WEIGHT * token_set_ratio(a, b)
    )


def _pairwise(fn, kind):
    @F.pandas_udf(kind)
    def kernel(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([fn(x, y) for x, y in zip(a, b)])

    return kernel


def indel_distance(a: Column, b: Column) -> Column:
    return _pairwise(indel, "int")(a, b)


def token_sort_score(a: Column, b: Column) -> Column:
    return _pairwise(token_sort_ratio, "double")(a, b)


def weighted_score(a: Column, b: Column) -> Column:
    return _pairwise(weighted_ratio, "double")(a, b)


def indel_budget(total: Column, num: int, den: int, strict: bool) -> Column:
    """Largest indel distance allowed for two texts of ``total`` characters.

    The bound is ``indel * den < num * total`` (``<=`` unless strict), in whole
    numbers. Indel distance always has the parity of ``total``.
    """
    # `-` binds before the floor: (num * total - 1) div den is the strict form
    top = F.floor((total * num - (1 if strict else 0)) / den).cast("int")
    return top - F.pmod(total - top, F.lit(2))


def within_edits(a: Column, b: Column, budget: Column) -> Column:
    """Native prefilter for indel distance: edit distance is never larger."""
    return F.call_function("levenshtein", a, b, budget) >= 0
