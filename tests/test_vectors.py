import random

import numpy as np
import pytest

from firmweave.operators import knn, vectors


def test_a_gram_in_every_name(spark):
    """Names of the same few grams: refined as often as needed, keys without vectors."""
    rng = random.Random(3)
    names = sorted({"motor " * rng.randint(1, 2) + rng.choice(["", "works ", "werk "]) + "".join(rng.choice("abc") for _ in range(rng.randint(0, 4))) for _ in range(150)})
    grams = vectors.gram_vectors(spark.createDataFrame([(n,) for n in names], "name string"))
    weights = {r["name"]: {t["gram"]: t["w"] for t in r["terms"]} for r in grams.collect()}
    cosine = lambda a, b: round(sum(w * weights[b].get(g, 0) for g, w in weights[a].items()), 9)
    want = {(a, b) for i, a in enumerate(names) for b in names[i + 1:] if cosine(a, b) >= 0.8}
    for refine_rows in (2000, 10):
        found = vectors.cosine_pairs(grams, 0.8, refine_rows)
        assert {(r.a, r.b) for r in found.collect()} == want
    (one, *_) = vectors._first_keys(vectors._with_tails(grams), 0.8).limit(1).collect()
    assert set(one.asDict()) == {"name", "key", "at", "need", "w", "ws", "after"}


@pytest.mark.parametrize("refine_rows", [2000, 4])
def test_cosine_pairs_equal_brute_force(spark, refine_rows):
    rng = random.Random(2)
    parts = ["auto", "parts", "bosch", "bosh", "motor", "motors", "koza", "teknik", "tek", "north", "south"]
    names = sorted({" ".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(200)})
    grams = vectors.gram_vectors(spark.createDataFrame([(n,) for n in names], "name string"))
    weights = {r["name"]: {t["gram"]: t["w"] for t in r["terms"]} for r in grams.collect()}
    for w in weights.values():
        assert abs(sum(x * x for x in w.values()) - 1) < 1e-9

    def cosine(a, b):
        return round(sum(w * weights[b].get(g, 0) for g, w in weights[a].items()), 9)

    got = {(r.a, r.b): r.cosine for r in vectors.cosine_pairs(grams, 0.7, refine_rows).collect()}
    want = {(a, b) for i, a in enumerate(names) for b in names[i + 1:] if cosine(a, b) >= 0.7}
    assert set(got) == want
    assert all(abs(c - cosine(*p)) < 1e-8 for p, c in got.items())


@pytest.mark.parametrize("block_rows,pivots", [(4096, 1), (40, 12)])
def test_neighbours_equal_brute_force_with_many_copies(spark, monkeypatch, block_rows, pivots):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 6))
    points = centres[rng.integers(0, 12, 200)] + 0.25 * rng.normal(size=(200, 6))
    points = np.concatenate([points, np.repeat(centres[:1], 100, 0)])
    sample = knn._pivots
    monkeypatch.setattr(knn, "_pivots", lambda d, rows: sample(d, (pivots - 1) * 512))
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(points)], "id bigint, v array<double>")
    got = {(r.a, r.rank): r.b for r in knn.neighbours(df, "id", "v", k=5, radius=0.9, block_rows=block_rows).collect()}
    want = {}
    for i, p in enumerate(points):
        d = np.linalg.norm(points - p, axis=1)
        order = sorted((d[j], j) for j in range(len(points)) if j != i and d[j] < 0.9)[:5]
        want |= {(i, n + 1): j for n, (_, j) in enumerate(order)}
    assert got == want


def test_the_own_cell_bounds_the_others(spark, monkeypatch):
    """Clusters well inside the radius: the second pass visits few of the cells that the radius leaves open."""
    rng = np.random.default_rng(4)
    centres = 3 * rng.normal(size=(8, 3))
    points = np.concatenate([c + 0.05 * rng.normal(size=(60, 3)) for c in centres])
    sample, further = knn._pivots, knn._further_visits
    monkeypatch.setattr(knn, "_pivots", lambda d, rows: sample(d, 15 * 512))
    seen = {}

    def counted(placed, near, k, eps):
        visits = further(placed, near, k, eps)
        seen["open"] = placed.selectExpr("sum(size(cells)) - count(*)").first()[0]
        seen["visited"] = visits.count()
        return visits

    monkeypatch.setattr(knn, "_further_visits", counted)
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(points)], "id bigint, v array<double>")
    got = {(r.a, r.rank): r.b for r in knn.neighbours(df, "id", "v", k=4, radius=4.0).collect()}
    want = {}
    for i, p in enumerate(points):
        d = np.linalg.norm(points - p, axis=1)
        want |= {(i, n + 1): j for n, (_, j) in enumerate(sorted((d[j], j) for j in range(len(points)) if j != i and d[j] < 4.0)[:4])}
    assert got == want and seen["visited"] * 3 < seen["open"]


def test_user_vectors_and_unit_length(spark):
    import pandas as pd

    def encode(s: pd.Series) -> pd.Series:
        return s.map(lambda x: [float(len(x)), 1.0])

    df = knn.user_vectors(spark.createDataFrame([("aa",), ("b",)], "name string"), "name", encode)
    rows = knn.unit_vectors(df, "vector").collect()
    assert all(abs(sum(x * x for x in r.vector) - 1) < 1e-9 for r in rows)
    pairs = knn.hybrid_vector_pairs(
        spark.createDataFrame([("koza bilisim", [1.0, 0.0]), ("bilisim koza", [1.0, 0.01]), ("auto", [1.0, 0.0])], "name string, v array<double>"),
        "name", "v", k=2, min_cosine=0.88, lexical=81,
    )
    assert [(r.a, r.b) for r in pairs.collect()] == [("bilisim koza", "koza bilisim")]


def test_a_vector_is_sent_once_to_a_group_of_cells(spark, monkeypatch):
    """Where nothing can be ruled out, a vector is sent on once, not once for each cell it visits."""
    rng = np.random.default_rng(6)
    points = rng.normal(size=(300, 16))
    sample, further = knn._pivots, knn._further_visits
    monkeypatch.setattr(knn, "_pivots", lambda d, rows: sample(d, 31 * 512))
    seen = {}

    def counted(placed, near, k, eps):
        visits = further(placed, near, k, eps)
        seen["open"] = placed.selectExpr("sum(size(cells))").first()[0]
        seen["sent"] = visits.count()
        return visits

    monkeypatch.setattr(knn, "_further_visits", counted)
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(points)], "id bigint, v array<double>")
    got = {(r.a, r.rank): r.b for r in knn.neighbours(df, "id", "v", k=3, radius=9.0).collect()}
    want = {}
    for i, p in enumerate(points):
        d = np.linalg.norm(points - p, axis=1)
        want |= {(i, n + 1): j for n, (_, j) in enumerate(sorted((d[j], j) for j in range(len(points)) if j != i and d[j] < 9.0)[:3])}
    assert got == want and seen["sent"] <= 300 < seen["open"] / 10


def test_no_vectors(spark):
    df = spark.createDataFrame([], "id bigint, v array<double>")
    assert knn.neighbours(df, "id", "v", k=3, radius=1.0).count() == 0


@pytest.mark.parametrize("offset, held", [(0, 50), (0, 10**6), (1e8, 10**6)])
def test_neighbours_far_from_the_origin_and_in_small_stores(spark, monkeypatch, offset, held):
    """What large coordinates leave of a product's digits loses no neighbour, nor does dropping all but the nearest on the way."""
    monkeypatch.setattr(knn, "HELD_PAIRS", held)
    rng = np.random.default_rng(9)
    points = offset + rng.normal(size=(80, 4))
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(points)], "id bigint, v array<double>")
    got = {(r.a, r.rank): r.b for r in knn.neighbours(df, "id", "v", k=5, radius=2.0).collect()}
    want = {}
    for i, p in enumerate(points):
        d = np.linalg.norm(points - p, axis=1)
        want |= {(i, n + 1): j for n, (_, j) in enumerate(sorted((d[j], j) for j in range(len(points)) if j != i and d[j] < 2.0)[:5])}
    assert got == want


def test_close_pairs_of_single_precision():
    rng = np.random.default_rng(10)
    for scale in (1e-3, 1.0, 1e5, 1e20):
        x, y = (scale * rng.normal(size=(n, 32)) for n in (40, 300))
        limit = scale * rng.uniform(5, 8, 40)
        i, j = knn._closeness(y)(x, limit)
        near = np.linalg.norm(x[:, None] - y[None], axis=2) <= limit[:, None]
        assert near[i, j].sum() == near.sum() > 0 and len(i) <= 1.05 * near.sum() + 5
