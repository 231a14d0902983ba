"""Quality rules: gradient-boosted trees over document statistics.

Every document is measured whole: words, symbols, repeated lines and word windows, letters,
capitals. Trees are boosted on the measures of a bounded sample of labelled documents, over
histograms of the measures; chosen measures may only speak against (or for) a document, whatever
the others say. The trees are then flattened into node arrays, and a batch of documents goes down
all trees at once.

Nulls, empty and long texts, ties, repeats, empty tables, other columns: a null text is an empty one and has zeros throughout; bytes
that are no UTF-8 count as U+FFFD; texts are cut nowhere; repeated rows are measured each; without labels of both
kinds every document scores the same, the share of good labels (1 without any label). Only the named columns are kept.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# labelled documents that trees are fitted on at most, chosen by a hash of their key
TRAIN_ROWS = 20_000
BLOCK_BYTES = 1_000_000
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BARE = re.compile(rb"[^0-9A-Za-z\x80-\xff]+")
_SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# what trees look at; -1: more of it never makes a document better, 1: never worse, 0: either
MEASURES = {
    "words": 0, "word_length": 0, "longest_word": 0, "symbols": -1, "dup_lines": -1, "repeat_words": -1, "word_again": -1, "upper": -1,
    "letters": 1, "digits": 0, "exclamations": -1, "stops": 0, "line_words": 0, "distinct": 0, "common_word": 0, "varied": 0, "bare_words": -1,
}
_LETTER, _UPPER, _DIGIT = 1, 2, 4
_KIND = np.array([
    _LETTER * c.isalpha() | _UPPER * c.isupper() | _DIGIT * c.isdigit() for c in map(chr, range(0x590))
], np.uint8)


def _words(data: bytes) -> Iterator[list[bytes]]:
    """Runs of bytes other than ASCII white space, a block of text at a time."""
    at = 0
    while at < len(data):
        gap = _SPACE.search(data, at + BLOCK_BYTES)
        end = gap.start() if gap else len(data)
        yield data[at:end].split()
        at = end


def _windows(ids: np.ndarray, distinct: int) -> np.ndarray:
    """Which words lie in a window of three that the text has twice or more."""
    covered = np.zeros(len(ids), bool)
    if len(ids) < 4:
        return covered
    pairs = ids[:-2] * distinct + ids[1:-1]
    if distinct >= 1 << 20:  # else a window's number would not fit
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, n = np.unique(pairs * distinct + ids[2:], return_inverse=True, return_counts=True)
    again = n[which] > 1
    for k in range(3):
        covered[k : len(ids) - 2 + k] |= again
    return covered


def measure_text(text: str) -> tuple[list[int], list[float]]:
    """The COUNTS and the MEASURES of a text."""
    data = text.encode("utf-8", "replace")
    known: dict[bytes, int] = {}
    parts = []
    for block in _words(data):
        parts.append(np.fromiter((known.setdefault(w, len(known)) for w in block), np.int64, len(block)))
    ids = np.concatenate(parts) if parts else np.empty(0, np.int64)
    bare = np.fromiter((_BARE.fullmatch(w) is not None for w in known), bool, len(known))
    longest = max(map(len, known), default=0)
    n, distinct = len(ids), len(known)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, _SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    dup_lines = len(lines) - len(set(lines))
    repeats = int(_windows(ids, distinct).sum())
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    low = points < len(_KIND)
    kinds = _KIND[points[low]]
    # what lies beyond the table is taken as letters
    letters = int(np.count_nonzero(kinds & _LETTER)) + int(np.count_nonzero(~low))
    full = ids[: n // 50 * 50].reshape(-1, 50)
    ordered = np.sort(full, axis=1)
    varied = float(((np.diff(ordered, axis=1) != 0).sum(axis=1) + 1).mean() / 50) if len(full) else distinct / max(n, 1)
    of_words, of_chars = max(n, 1), max(chars, 1)
    measures = [
        np.log1p(n), chars / of_words, np.log1p(longest), symbols / of_words, dup_lines / max(len(lines), 1), repeats / of_words,
        float((ids[1:] == ids[:-1]).sum()) / of_words, np.count_nonzero(kinds & _UPPER) / max(letters, 1), letters / of_chars,
        np.count_nonzero(kinds & _DIGIT) / of_chars, text.count("!") / of_words, sum(map(text.count, ".?")) / of_words, n / max(len(lines), 1),
        distinct / of_words, float(np.bincount(ids).max()) / of_words if n else 0.0, varied, float(bare[ids].sum()) / of_words if n else 0.0,
    ]
    return [n, chars, symbols, dup_lines, repeats], [float(x) for x in measures]


def measure(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(keep..., COUNTS, measures) for every row of ``docs``; nothing else about the text is used later."""
    kept = [docs.schema[c] for c in keep]
    schema = T.StructType([*kept, *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("measures", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, measures = [], []
            for value in batch.column(batch.num_columns - 1):
                c, m = measure_text((value.as_py() or b"").decode("utf-8", "replace"))
                counts.append(c)
                measures.append(m)
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *columns, pa.array(measures, pa.list_(pa.float64()))], [*keep, *COUNTS, "measures"])

    return docs.select(*keep, F.col(text).cast("binary").alias("__text")).mapInArrow(run, schema)


@dataclass
class Trees:
    """Flattened trees: inner nodes send a row left where ``measure <= threshold``; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    offset: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of being good for each row of ``x``."""
        total = np.full(len(x), self.offset)
        rows = np.arange(len(x))[:, None]
        if len(self.roots) and len(x):
            at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total = total + self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def fit_trees(
    x: np.ndarray, y: np.ndarray, direction: Sequence[int], trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64,
    leaf_weight: float = 2.0, shrink: float = 1.0, part: float = 0.5,
) -> Trees:
    """Boost ``trees`` trees, each over about ``part`` of the measures, on rows ``x`` with labels ``y`` (0, 1).

    ``direction`` has -1, 0 or 1 for each measure: a split on a measure with a direction must order its sides' values, and
    the mid of the two bounds all values below either side, so no path can turn the order around.
    """
    n, width = x.shape if len(x) else (0, len(direction))
    share = (y.sum() + 1e-6) / (n + 1e-6) if n else 1.0
    offset = float(np.log(share / (1 - share))) if 0 < share < 1 else 30.0
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    if 0 < y.sum() < n:
        # quantiles with all distinct values where these are few
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(width)]
        binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], axis=1)
        # a threshold lies midway to the next value, for documents that fall between
        between = []
        for f in range(width):
            values = np.unique(x[:, f])
            after = np.minimum(np.searchsorted(values, edges[f], side="right"), len(values) - 1)
            between.append((edges[f] + values[after]) / 2)
        raw = np.full(n, offset)
        chance = np.random.default_rng(0)
        for _ in range(trees):
            # each tree sees part of the measures, so several speak where one would do
            seen = np.flatnonzero(chance.random(width) < part)
            p = 1 / (1 + np.exp(-np.clip(raw, -500, 500)))
            gradient, weight = y - p, np.maximum(p * (1 - p), 1e-6)

            def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
                g, h = gradient[rows].sum(), weight[rows].sum()
                value = float(np.clip(g / (h + shrink), low, high))
                node = len(nodes)
                nodes.append([0, 0.0, node, node, rate * value])
                best = (1e-6, -1, 0, 0.0, 0.0)
                for f in seen if level < depth else ():
                    if not len(edges[f]):
                        continue
                    b = binned[rows, f]
                    gl = np.cumsum(np.bincount(b, gradient[rows], len(edges[f]) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b, weight[rows], len(edges[f]) + 1))[:-1]
                    gr, hr = g - gl, h - hl
                    vl, vr = np.clip(gl / (hl + shrink), low, high), np.clip(gr / (hr + shrink), low, high)
                    # what the values, held to their bounds, gain over the node's own
                    gain = gl * vl - (hl + shrink) * vl**2 / 2 + gr * vr - (hr + shrink) * vr**2 / 2 - (g * value - (h + shrink) * value**2 / 2)
                    gain[(hl < leaf_weight) | (hr < leaf_weight) | (direction[f] * (vr - vl) < 0)] = -1
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k, float(vl[k]), float(vr[k]))
                _, f, k, vl, vr = best
                if f >= 0:
                    mid = (vl + vr) / 2
                    to_left = (low, mid) if direction[f] > 0 else (mid, high) if direction[f] < 0 else (low, high)
                    to_right = (mid, high) if direction[f] > 0 else (low, mid) if direction[f] < 0 else (low, high)
                    below = binned[rows, f] <= k
                    nodes[node][:2] = f, float(between[f][k])
                    nodes[node][2] = grow(rows[below], level + 1, *to_left)
                    nodes[node][3] = grow(rows[~below], level + 1, *to_right)
                return node

            first = len(nodes)
            roots.append(grow(np.arange(n), 0, -np.inf, np.inf))
            grown = _flat(nodes[first:], [0], depth, 0.0, first)
            at = np.zeros(n, np.int64)
            for _ in range(depth):
                at = np.where(x[np.arange(n), grown.feature[at]] <= grown.threshold[at], grown.left[at], grown.right[at])
            raw = raw + grown.value[at]
    return _flat(nodes, roots, depth, offset)


def _flat(nodes: list[list[float]], roots: list[int], depth: int, offset: float, first: int = 0) -> Trees:
    columns = list(zip(*nodes)) if nodes else [()] * 5
    whole = lambda c, less=0: np.array(c, np.int64) - less
    return Trees(whole(columns[0]), np.array(columns[1], float), whole(columns[2], first), whole(columns[3], first),
                 np.array(columns[4], float), np.array(roots, np.int64), depth, offset)


def learn(measured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "good", train_rows: int = TRAIN_ROWS) -> Trees:
    """Trees fitted on the rows of ``measured`` that ``labels`` (key, boolean label) covers, ``train_rows`` labels at most."""
    # the label rows with the smallest hashes: a bounded set, whatever the order of the table
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).select(key, F.col(label).cast("double").alias("__y"))
    chosen = known.orderBy(F.xxhash64(F.lit(11), key), key, "__y").limit(train_rows)
    # repeated keys in ``measured`` bring one row: equal documents say nothing new
    found = measured.join(F.broadcast(chosen), key).groupBy(key, "__y").agg(F.min("measures").alias("measures")).orderBy(key, "__y").collect()
    x = np.array([r["measures"] for r in found], float).reshape(len(found), len(MEASURES))
    return fit_trees(x, np.array([r["__y"] for r in found], float), list(MEASURES.values()))


def judge(measured: DataFrame, trees: Trees, out: str = "score") -> DataFrame:
    """``measured`` with the trees' probability of being good in place of the measures."""
    kept = [f for f in measured.schema.fields if f.name != "measures"]
    names, arrays = [f.name for f in kept], dict(vars(trees))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Trees(**arrays)
        for batch in batches:
            x = batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(batch.num_rows, len(MEASURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(model.score(x), pa.float64())], [*names, out])

    return measured.select(*names, "measures").mapInArrow(run, T.StructType([*kept, T.StructField(out, T.DoubleType())]))
