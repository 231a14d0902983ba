"""Document measures against plain counts, trees against plain descent, directions, held-out labels."""

import os
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from firmweave.llm import quality_rules as R

SMALL = "/root/testdata/sf0.01"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    inside = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = (text or "").split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é\n\t#|\x1c　 😀", max_size=60))
def test_counts(text):
    assert R.measure_text(text)[0] == plain(text)


def test_long_texts_and_many_words(monkeypatch):
    rng = random.Random(2)
    text = " ".join(rng.choice(["a", "b", "cd", "é"]) for _ in range(3000)) + "\n" + "x" * 5000
    expected = R.measure_text(text)
    monkeypatch.setattr(R, "BLOCK_BYTES", 7)
    assert R.measure_text(text) == expected and expected[0] == plain(text)
    ids = np.array([5, 1, 2, 3, 9, 1, 2, 3, 4, 1, 2])
    assert R._windows(ids, 1 << 21).tolist() == R._windows(ids, 10).tolist() == [False, True, True, True, False, True, True, True, False, False, False]


def rows(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 4)).round(2)
    y = ((x[:, 0] < 0.6) & (x[:, 1] > 0.2) | (x[:, 2] > 0.9)).astype(float)
    flip = rng.random(n) < 0.03
    return x, np.where(flip, 1 - y, y)


def test_trees_learn_and_keep_directions():
    x, y = rows()
    trees = R.fit_trees(x, y, [-1, 1, 0, 0])
    more, truth = rows(seed=1)
    assert ((trees.score(more) > 0.5) == (truth > 0.5)).mean() > 0.93
    probe = more[:400]
    for f, sign in ((0, -1), (1, 1)):
        scores = []
        for v in np.linspace(-0.1, 1.1, 60):
            moved = probe.copy()
            moved[:, f] = v
            scores.append(trees.score(moved))
        assert (sign * np.diff(np.array(scores), axis=0) >= -1e-12).all()
    # against the grain of the data nothing is learnt from that measure
    wrong = R.fit_trees(x, y, [1, 1, 0, 0])
    assert not (wrong.feature[wrong.left != np.arange(len(wrong.left))] == 0).any() or (np.diff([wrong.score(np.array([[v, 0.5, 0.5, 0.5]]))[0] for v in np.linspace(0, 1, 50)]) >= 0).all()


def test_flattened_descent():
    x, y = rows(400)
    trees = R.fit_trees(x, y, [0] * 4, trees=5)

    def walk(row):
        total = trees.offset
        for at in trees.roots:
            while trees.left[at] != at:
                at = trees.left[at] if row[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
            total += trees.value[at]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(x), [walk(r) for r in x])


def test_one_class_and_no_rows():
    none = np.empty((0, 4))
    assert R.fit_trees(none, np.empty(0), [0] * 4).score(np.ones((2, 4))).min() > 0.99
    assert R.fit_trees(np.ones((3, 4)), np.ones(3), [0] * 4).score(np.ones((1, 4)))[0] > 0.99
    assert R.fit_trees(np.ones((3, 4)), np.zeros(3), [0] * 4).score(np.ones((1, 4)))[0] < 0.01
    assert R.fit_trees(np.ones((4, 4)), np.array([0, 1, 1, 1.0]), [0] * 4).score(np.ones((1, 4)))[0] == pytest.approx(0.75, abs=0.01)


def test_rows_and_columns(spark):
    docs = [(1, "a b a b a b\nx\nx", "s"), (2, None, "s"), (None, "", "s"), (1, "a b a b a b\nx\nx", "s")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, measures string")
    got = sorted(map(repr, ((r.doc_id, [r[c] for c in R.COUNTS]) for r in R.measure(df).collect())))
    assert got == sorted(repr((i, plain(t))) for i, t, _ in docs)
    bad = df.select("doc_id", F.expr("cast(X'61FF20' as string)").alias("text")).limit(1)
    assert R.measure(bad).first().word_chars == 2
    labels = spark.createDataFrame([(1, None), (None, True)], "doc_id bigint, good boolean")
    measured = R.measure(df)
    judged = R.judge(measured, R.learn(measured, labels))
    assert judged.columns == ["doc_id", *R.COUNTS, "score"] and judged.filter("score > 0.9").count() == 4
    assert R.judge(R.measure(df.limit(0)), R.learn(R.measure(df.limit(0)), labels.limit(0))).count() == 0


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
def test_held_out_labels(spark):
    """Half of the labels decide about the other half."""
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", (F.col("quality") > 0).alias("good"), (F.crc32(F.col("doc_id").cast("string")) % 2 == 0).alias("half"))
    measured = R.measure(spark.read.parquet(f"{SMALL}/documents.parquet")).cache()
    trees = R.learn(measured, labels.filter("half").drop("half"))
    seen = R.judge(measured, trees).join(labels.filter("NOT half"), "doc_id").select("good", (F.col("score") >= 0.5).alias("said"), "n_words").collect()
    good = [r.said for r in seen if r.good and r.n_words >= 50]
    bad = [not r.said for r in seen if not r.good and r.n_words >= 50]
    assert np.mean(good) >= 0.98 and np.mean(bad) >= 0.9


def test_query(spark, tmp_path):
    from firmweave.llm.queries import op11_quality_rules

    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(["the", "on", "reed", "than", "ou", "stea"]) + rng.choice(["er", "ing", "a", "ly"]) + str(rng.randrange(40)) for _ in range(n))
    docs = [(i, prose(rng.randrange(40, 200))) for i in range(120)]
    docs += [(200 + i, " ".join(w + "###" for w in prose(100).split())) for i in range(40)]
    docs += [(300, "same words again " * 60), (301, None), (302, " \n "), (303, prose(20_000))]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200)) for i, _ in docs if i % 2], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in op11_quality_rules(spark, str(tmp_path)).collect()}
    for i, text in docs:
        assert [got[i][c] for c in R.COUNTS] == plain(text), i
        n, repeats = plain(text)[0], plain(text)[4]
        assert got[i].base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert got[i].kept == (not got[i].base_failed and not 200 <= i < 300), i
