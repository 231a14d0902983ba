"""Weak labels: recovered labellers, measures against plain counts, held-out labels, odd texts."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmweave.llm import quality as Q

SMALL = "/root/testdata/sf0.001"


def test_labellers_are_recovered():
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.8
    found = [0.7, 0.5, 0.4, 0.6, 0.3, 0.7, 0.5, 0.2, 0.4, 0.5]  # of the bad ones, by each labeller
    says_bad = [np.where(good, rng.random(len(good)) < 0.003, rng.random(len(good)) < f) for f in found]
    votes = np.stack([np.where(rng.random(len(good)) < 0.1, Q.NONE, np.where(b, Q.BAD, Q.GOOD)) for b in says_bad], axis=1)
    patterns = [Q.pattern_of(v) for v in votes.tolist()]
    counts = {p: patterns.count(p) for p in set(patterns)}
    posterior = Q.fit_labellers(counts)
    called = np.array([posterior[p] > 0.5 for p in patterns])
    assert (called == good).mean() > 0.99
    assert abs(np.mean([posterior[p] for p in patterns]) - good.mean()) < 0.01
    assert Q.fit_labellers({}) == {} and Q.fit_labellers({0: 3}).keys() == {0}


def test_measures(monkeypatch):
    text = "The CAT sat sat on the mat!!\nThe end.\nThe end.\n ## ü Ü ² 日本"
    for block in (1_000_000, 17):
        monkeypatch.setattr(Q, "BLOCK_CHARS", block)
        m, _ = Q.measures(text)
        assert m["letters"] == sum(c.isalpha() for c in text) and m["upper"] == sum(c.isupper() for c in text)
        assert m["solid"] == sum(not c.isspace() for c in text) and m["odd"] == 2
        assert m["line_again"] == len("The end.")
        if block > 100:
            assert m["words"] == len(text.split()) and m["again"] == 1 and m["marks"] == 1


def test_words_hash_by_their_characters():
    points = np.frombuffer("ab ba ab  abc ab".encode("utf-32-le"), np.uint32)
    h = Q.word_hashes(points, points == 32).tolist()
    assert h[0] == h[2] == h[4] and len(set(h)) == 3


def test_scorer_separates():
    rng = np.random.default_rng(0)
    x = rng.random((500, 20))
    y = (x[:, 3] > x[:, 7]).astype(float)
    w, b = Q.fit_scorer(x, y)
    assert (((x @ w + b) > 0) == (y > 0.5)).mean() > 0.95


def corpus():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice(["an", "te", "ro", "mi", "sh", "er"]) for _ in range(rng.randrange(1, 5)))
    prose = lambda n: ". ".join(" ".join(word() for _ in range(9)).capitalize() for _ in range(n)) + "."
    rows = [(i, prose(rng.randrange(1, 20)), 1) for i in range(160)]
    rows += [(200 + i, " ".join(word() + rng.choice(["###", "***"]) for _ in range(90)), 0) for i in range(14)]
    rows += [(300 + i, " ".join(word().upper() + "!!" for _ in range(90)), 0) for i in range(14)]
    rows += [(400 + i, " ".join([word().capitalize()] * 120), 0) for i in range(14)]
    return rows


def test_documents(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x") for r in [*rows, rows[0], (None, rows[3][1], 1), (900, None, 0), (901, " \n", 0), (902, "", 0)]], "doc_id bigint, text string, quality int, features string")
    model = Q.QualityModel.learn(df)
    kept = Q.keep_good(df, model)
    assert kept.columns == df.columns
    got = [(r.doc_id, r.quality) for r in kept.collect()]
    assert all(q == 1 for _, q in got) and len(got) == 162
    scored = Q.score_quality(df, model, out="score", keep=["doc_id"])
    assert scored.columns == ["doc_id", "score"] and scored.count() == df.count()
    few = Q.QualityModel.learn(df, train_rows=60)
    assert np.mean([(few.score(t) >= Q.LEAST) == (q == 1) for _, t, q in rows]) > 0.9


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    model = Q.QualityModel.learn(df)
    assert Q.keep_good(df, model).count() == 0 and model.score("any text") == 0.5


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
def test_true_labels(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = Q.QualityModel.learn(docs)
    rows = Q.score_quality(docs, model, out="score").join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id").select("score", F.col("quality") == 1).collect()
    assert np.mean([(s >= Q.LEAST) == q for s, q in rows]) >= 0.95
