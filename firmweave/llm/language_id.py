"""Language identification as a mixture of languages.

Learning counts hashed letter n-grams for each language over all learning texts.
A text is then a mixture: expectation-maximisation finds the language proportions
that make its n-grams likeliest. The set of languages is chosen by penalised
likelihood: it starts with all, drops the smallest share step by step, and the set
with the best Bayesian information criterion wins.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from firmweave.llm.common import Shared, whole_text

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 15
# a model has BUCKETS numbers for each language; with more languages than these it no longer fits a task
MAX_LANGUAGES = 500
STEPS = 30
BLOCK_CHARS = 1_000_000
UNDETERMINED = "und"


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def grams(text: str) -> np.ndarray:
    """Counts of the text's hashed letter trigrams; what is no letter counts as one word break.

    Trigrams reach over the edges of words, so short words count by how they begin and end.
    """
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(text), BLOCK_CHARS):
        # a block begins two characters early, so no trigram is lost between blocks
        part = " " + text[at : at + BLOCK_CHARS] + " " if len(text) <= BLOCK_CHARS else text[max(0, at - 2) : at + BLOCK_CHARS]
        points = np.frombuffer(part.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        # letters of Latin text by table, and everything above it as it is
        low = points < 0x250
        letter = ~low
        letter[low] = _LATIN_LETTER[points[low]]
        points[~letter] = 32
        stay = np.ones(len(points), bool)
        stay[1:] = letter[1:] | letter[:-1]
        points = points[stay]
        if len(points) < 3:
            continue
        mixed = (points[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (points[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)) ^ (points[2:] * np.uint64(0x165667B19E3779F9) + np.uint64(2))
        mixed *= np.uint64(0xFF51AFD7ED558CCD)
        counts += np.bincount((mixed >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
    return counts


_LATIN_LETTER = np.array([chr(i).isalpha() for i in range(0x250)])


def gram_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all rows with a text and a language; each task sums up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = grams(whole_text(value.as_py()))
                if language in sums:
                    sums[language] += found
                elif len(sums) < MAX_LANGUAGES:
                    sums[language] = found
                else:
                    raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for language, found in sums.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(at)), pa.array(at), pa.array(found[at])], ["lang", "bucket", "n"])

    used = docs.select(F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    return used.mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class LanguageModel:
    """Smoothed n-gram probabilities of each language; languages in ascending order."""

    def __init__(self, languages: list[str], probabilities: np.ndarray):
        self.languages, self.probabilities = languages, probabilities

    @classmethod
    def learn(cls, docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
        """From all learning rows. What reaches the driver is BUCKETS numbers for each language at most."""
        found: dict[str, np.ndarray] = {}
        for row in gram_counts(docs, text, lang).groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts")).toLocalIterator():
            if len(found) >= MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages")
            pairs = np.array(row["counts"], np.int64)
            found[row["lang"]] = np.zeros(BUCKETS)
            found[row["lang"]][pairs[:, 0]] = pairs[:, 1]
        languages = sorted(found)
        counts = np.array([found[x] for x in languages]).reshape(len(languages), BUCKETS) + 0.5
        return cls(languages, counts / counts.sum(axis=1, keepdims=True))

    def mixture(self, counts: np.ndarray) -> np.ndarray:
        """Proportion of each language; those outside the chosen set are 0."""
        at = np.flatnonzero(counts)
        c, n = counts[at].astype(float), counts.sum()
        likely = self.probabilities[:, at]
        members = np.arange(len(self.languages))
        share = np.full(len(members), 1 / len(members))
        best, chosen = -np.inf, (members, share)
        while len(members):
            p = likely[members]
            for _ in range(STEPS if len(members) > 1 else 0):
                # each n-gram is split over the languages by how likely they make it
                updated = share * (p @ (c / (share @ p))) / n
                moved = np.abs(updated - share).max()
                share = updated
                if moved < 1e-4:
                    break
            fit = 2 * (c @ np.log(share @ p)) - (len(members) - 1) * np.log(n)
            if fit >= best:
                best, chosen = fit, (members, share)
            keep = np.arange(len(members)) != np.argmin(share)
            members, share = members[keep], share[keep]
            if len(members):
                share = share / share.sum() if share.sum() > 0 else np.full(len(members), 1 / len(members))
        out = np.zeros(len(self.languages))
        out[chosen[0]] = chosen[1]
        return out

    def predict(self, text: str | None) -> tuple[str, float, list[float]]:
        """(language of the largest share, its share, all shares); ties go to the first language by name."""
        if not text or not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0, [0.0] * len(self.languages)
        share = self.mixture(grams(text))
        top = int(np.argmax(share))
        return self.languages[top], float(min(1.0, share[top])), share.tolist()


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(keep..., lang_pred, score, languages): ``languages`` maps the chosen set to its shares.

    Bytes that are no UTF-8 count as U+FFFD. Texts that are null or have no letter, and all texts if nothing was learnt, are ``und`` with score 0 and no languages.
    ``keep`` defaults to all columns but the text.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    wanted = [f for f in docs.schema.fields if f.name in keep]
    shared = Shared(docs.sparkSession, model)  # at most MAX_LANGUAGES x BUCKETS numbers
    out = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
           T.StructField("languages", T.MapType(T.StringType(), T.DoubleType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = shared.value.languages
        for batch in batches:
            names = batch.schema.names
            found = [shared.value.predict(whole_text(v.as_py())) for v in batch.column(names.index("__text"))]
            shares = pa.array([[(x, s) for x, s in zip(languages, shares) if s > 0] for _, _, shares in found], pa.map_(pa.string(), pa.float64()))
            made = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), shares]
            columns = [batch.column(names.index(f.name)) for f in wanted]
            yield pa.RecordBatch.from_arrays([*columns, *made], [*(f.name for f in wanted), *(f.name for f in out)])

    used = docs.select(*(f.name for f in wanted), F.col(text).cast("binary").alias("__text"))
    return used.mapInArrow(run, T.StructType([*wanted, *out]))
