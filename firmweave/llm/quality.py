"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every document. How often each
pattern of votes occurs is counted over all documents; expectation-maximisation
estimates from these counts how far each labeller can be trusted, and so how
likely a document with a pattern is good. These posterior labels train a linear
scorer over hashed features, which then judges every document. No true labels are used.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from firmweave.llm.common import Shared, whole_text
from firmweave.storage import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# documents that the scorer is fitted on at most, chosen by a hash; everything else covers all
TRAIN_ROWS = 4_000
DIM = 1024
LEAST = 0.25  # a document is kept from this score on: a doubtful one stays
WINDOW = 100  # words that are looked at together for their variety
REPEATS = [DIM - 2, DIM - 1]
BLOCK_CHARS = 1_000_000
GOOD, BAD, NONE = 1, 0, 2
FALSE_ALARMS = 0.005  # share of good documents that a labeller may call bad

# classes of characters below U+0250; above it, letters are taken as lower case and the rest as itself
_UPPER, _LOWER, _DIGIT, _SPACE = 1, 2, 3, 4
_CLASS = np.zeros(0x250, np.uint32)
for _i in range(0x250):
    _c = chr(_i)
    _CLASS[_i] = _UPPER if _c.isupper() else _LOWER if _c.isalpha() else _DIGIT if _c.isdigit() else _SPACE if _c.isspace() else _i + 16
_STOPS = np.isin(np.arange(0x250), [ord(c) for c in ".,;:?!'\"()-–\n¿¡«»"])


def classes(points: np.ndarray) -> np.ndarray:
    low = points < 0x250
    out = np.full(len(points), _LOWER, np.uint32)
    out[low] = _CLASS[points[low]]
    return out


def word_hashes(points: np.ndarray, space: np.ndarray) -> np.ndarray:
    """A hash for each run of non-space characters."""
    if not len(points):
        return np.empty(0, np.uint64)
    edge = np.flatnonzero(np.diff(np.r_[True, space, True].astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    at = np.zeros(len(points), np.int64)
    at[starts] = starts
    offset = np.arange(len(points)) - np.maximum.accumulate(at)
    mixed = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ (offset.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed[space] = 0
    total = np.r_[np.uint64(0), np.cumsum(mixed, dtype=np.uint64)]
    return total[ends] - total[starts]


def measures(text: str) -> tuple[dict[str, float], np.ndarray]:
    """Counts the labellers look at, and the features of a whole text."""
    m = dict.fromkeys(("letters", "upper", "odd", "solid", "words", "again", "every_other", "windows", "varied", "marks", "line_chars", "line_again"), 0)
    features = np.zeros(DIM)
    last, seen = np.zeros(2, np.uint64), set()
    for at in range(0, len(text), BLOCK_CHARS):
        points = np.frombuffer(text[at : at + BLOCK_CHARS].encode("utf-32-le", "replace"), np.uint32)
        kind = classes(points)
        space = kind == _SPACE
        words = word_hashes(points, space)
        m["letters"] += int(((kind == _UPPER) | (kind == _LOWER)).sum())
        m["upper"] += int((kind == _UPPER).sum())
        m["solid"] += int((~space).sum())
        low = points < 0x250
        m["odd"] += int(((kind > 16) & ~_STOPS[np.where(low, points, 0)]).sum())
        m["marks"] += int(((points[1:] == 33) & (points[:-1] == 33)).sum())
        m["words"] += len(words)
        run = np.r_[last, words]
        m["again"] += int((words == run[1:-1]).sum())
        m["every_other"] += int((words == run[:-2]).sum())
        last = run[-2:]
        for w in np.array_split(words, max(1, len(words) // WINDOW)) if len(words) >= 20 else ():
            m["windows"] += 1
            m["varied"] += len(np.unique(w)) / len(w)
        if len(kind) >= 3:
            k = kind.astype(np.uint64)
            mixed = (k[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (k[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)) ^ (k[2:] * np.uint64(0x165667B19E3779F9) + np.uint64(2))
            mixed *= np.uint64(0xFF51AFD7ED558CCD)
            features += np.bincount((mixed >> np.uint64(65 - DIM.bit_length())).astype(np.int64), minlength=DIM)
    for line in text.split("\n"):
        m["line_chars"] += len(line)
        h = hash(line) if line.strip() else None
        m["line_again"] += len(line) if h in seen else 0
        if h is not None:
            seen.add(h)
    features[REPEATS] = 0
    features = np.sqrt(features / max(features.sum(), 1))
    # how much of the text repeats, as features of their own
    features[REPEATS] = 3 * m["again"] / max(m["words"], 1), 3 * m["line_again"] / max(m["line_chars"], 1)
    return m, features


def votes(m: dict[str, float]) -> list[int]:
    """Each labeller's vote; together they overlap, and none is right alone."""
    solid, words, letters = max(m["solid"], 1), max(m["words"], 1), max(m["letters"], 1)

    def by(value: float, good_below: float, bad_above: float) -> int:
        return BAD if value > bad_above else GOOD if value < good_below else NONE

    return [
        by(m["upper"] / letters, 0.2, 0.5),
        by(m["odd"] / solid, 0.02, 0.06),
        by(m["marks"] / words, 0.05, 0.2),
        by(m["again"] / words, 0.05, 0.2),
        by(m["every_other"] / words, 0.1, 0.2),
        by(1 - m["varied"] / m["windows"], 0.45, 0.6) if m["windows"] else NONE,
        by(1 - m["letters"] / solid, 0.1, 0.25),
        by(m["line_again"] / max(m["line_chars"], 1), 0.2, 0.5),
        BAD if m["words"] < 2 else GOOD if m["words"] >= 10 else NONE,
        GOOD if 2 <= solid / words <= 12 else BAD if solid / words > 20 else NONE,
    ]


LABELLERS = 10


def pattern_of(given: list[int]) -> int:
    return sum(v * 3**i for i, v in enumerate(given))


def fit_labellers(counts: dict[int, int], steps: int = 200) -> dict[int, float]:
    """Probability of being good for each pattern of votes, from the patterns' counts.

    A labeller is a table of how often its votes are good or bad on good and on bad
    documents; no vote counts for neither. Each looks for one kind of bad text, so it says little when it finds none, but it is built to call a
    good document bad once in 1 / FALSE_ALARMS at most; held to that, the classes cannot change names.
    """
    if not counts:
        return {}
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    v = np.array([[p // 3**i % 3 for i in range(LABELLERS)] for p in patterns])
    one_hot = v[:, :, None] == np.arange(3)
    # a document that any labeller calls bad starts as doubtful
    good = np.where((v == BAD).any(axis=1), 0.3, 0.95)
    prior = np.zeros((2, 3))
    prior[GOOD], prior[BAD] = (0.1, 8.0, 1.9), (2.0, 7.0, 1.0)  # of votes bad, good, nothing
    for _ in range(steps):
        weight = np.stack([n * (1 - good), n * good])
        table = np.einsum("cp,plv->clv", weight, one_hot) + prior[:, None, :]
        # no vote says nothing: a short text gives most labellers too little to go by
        table[:, :, NONE] = 0
        table /= table.sum(axis=2, keepdims=True)
        table[GOOD, :, BAD] = np.minimum(table[GOOD, :, BAD], FALSE_ALARMS)
        table /= table.sum(axis=2, keepdims=True)
        table[:, :, NONE] = 1
        share = (weight.sum(axis=1) + 1) / (n.sum() + 2)
        score = np.log(share)[:, None] + np.einsum("clv,plv->cp", np.log(table), one_hot)
        updated = 1 / (1 + np.exp(np.clip(score[BAD] - score[GOOD], -500, 500)))
        if np.abs(updated - good).max() < 1e-9:
            break
        good = updated
    return dict(zip(patterns, good.tolist()))


def fit_scorer(
    x: np.ndarray, y: np.ndarray, steps: int = 300, rate: float = 8.0, decay: float = 1e-5, n: np.ndarray | None = None
) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic scorer for soft labels, by gradient steps with momentum; ``n`` is how often each row counts."""
    x, y = x.astype(np.float32), y.astype(np.float32)
    part = np.full(len(y), 1 / len(y), np.float32) if n is None else (n / n.sum()).astype(np.float32)
    w, b, pace, pace_b = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(x.shape[1], np.float32), 0.0
    for _ in range(steps):
        error = (1 / (1 + np.exp(-np.clip(x @ w + np.float32(b), -60, 60))) - y) * part
        pace = np.float32(0.9) * pace - np.float32(rate) * (error @ x + np.float32(decay) * w)
        pace_b = 0.9 * pace_b - 0.1 * rate * float(error.sum())
        w, b = w + pace, b + pace_b
    return w, b


class QualityModel:
    """A fitted scorer with what it was fitted from."""

    def __init__(self, weights: np.ndarray, offset: float, posterior: dict[int, float]):
        self.weights, self.offset, self.posterior = weights, offset, posterior

    def score(self, text: str | None) -> float:
        """0 to 1; a text without words scores 0."""
        if not text or not text.strip():
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(measures(text)[1] @ self.weights + self.offset, -500, 500))))

    @classmethod
    def learn(cls, docs: DataFrame, text: str = "text", train_rows: int = TRAIN_ROWS) -> QualityModel:
        """Votes and their counts over all documents with words; the scorer on ``train_rows`` different texts at most, whose features reach the driver.

        These are the texts with the smallest hashes, each weighted by its number of copies, whatever the number of documents.
        """
        used = docs.filter(F.length(F.trim(text)) > 0).select(F.xxhash64(F.lit(7), text).alias("hash"), F.col(text).cast("binary").alias("text"))
        smallest = {r["hash"]: r["n"] for r in used.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).orderBy("hash").limit(train_rows).collect()}
        last = max(smallest, default=-(1 << 63))

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = set()  # of the chosen texts: a task gives each one's features once
            for batch in batches:
                hashes = batch.column(0).to_pylist()
                patterns, kept = [], []
                for h, value in zip(hashes, batch.column(1)):
                    m, features = measures(whole_text(value.as_py()))
                    patterns.append(pattern_of(votes(m)))
                    new = h <= last and h not in known
                    kept.append(features.astype(np.float32).tobytes() if new else None)
                    if new:
                        known.add(h)
                yield pa.RecordBatch.from_arrays([pa.array(patterns, pa.int64()), batch.column(0), pa.array(kept, pa.binary())], ["pattern", "hash", "features"])

        seen = cut_lineage(used.mapInArrow(look, "pattern bigint, hash bigint, features binary"))
        # 3 ** LABELLERS patterns at most
        counts = {r["pattern"]: r["n"] for r in seen.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()}
        posterior = fit_labellers(counts)
        rows = seen.filter("features IS NOT NULL").groupBy("hash").agg(F.first("pattern").alias("pattern"), F.first("features").alias("features")).orderBy("hash").collect()
        if not rows:
            return cls(np.zeros(DIM), 0.0, posterior)
        x = np.array([np.frombuffer(bytes(r["features"]), np.float32) for r in rows])
        weights, offset = fit_scorer(x, np.array([posterior[r["pattern"]] for r in rows]), n=np.array([smallest[r["hash"]] for r in rows], float))
        return cls(weights, offset, posterior)


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", out: str = "quality", keep: list[str] | None = None) -> DataFrame:
    """(keep..., out): every document's score. ``keep`` defaults to all columns but one called ``out``; null and blank texts score 0.

    Bytes that are no UTF-8 count as U+FFFD.
    """
    wanted = [f for f in docs.schema.fields if f.name != out and (keep is None or f.name in keep)]
    shared = Shared(docs.sparkSession, model)  # DIM weights and the patterns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.score(whole_text(v.as_py())) for v in batch.column(len(wanted))]
            columns = [batch.column(i) for i in range(len(wanted))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], [*(f.name for f in wanted), out])

    used = docs.select(*(f.name for f in wanted), F.col(text).cast("binary").alias("__text"))
    return used.mapInArrow(run, T.StructType([*wanted, T.StructField(out, T.DoubleType())]))


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text", least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more; columns stay, whatever their names. Null and blank texts go."""
    columns = docs.columns
    own = [f"c{i}" for i in range(len(columns))]
    scored = score_quality(docs.toDF(*own), model, own[columns.index(text)])
    return scored.filter(F.col("quality") >= least).select(*own).toDF(*columns)
