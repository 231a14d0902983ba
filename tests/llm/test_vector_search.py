"""One-bit codes: bounds hold, most rows are ruled out, results equal brute force."""

import numpy as np
import pytest

from firmweave.llm import vector_search as V


def test_rotation_keeps_lengths():
    turn = V.rotation(10)
    assert turn.shape == (10, 64) and np.allclose(turn @ turn.T, np.eye(10), atol=1e-5)
    assert V.rotation(64).shape == (64, 256)


def test_bounds_and_work():
    rng = np.random.default_rng(1)
    rows, queries = rng.normal(size=(6_000, 64)), rng.normal(size=(20, 64))
    centre, turn = rows[:500].mean(axis=0), V.rotation(64)
    codes, norm, own = V.encode(rows, centre, turn)
    assert codes.shape == (6_000, 32)
    low = V.lower_bounds(codes, norm, own, queries, centre, turn)
    true = ((queries[:, None] - rows[None]) ** 2).sum(axis=2)
    assert (low <= true).mean() > 0.999
    finder = V.Finder(centre, turn, 10, V.ERRORS)
    finder.ask(np.arange(20) + 10_000, queries)
    finder.visit(np.arange(6_000), rows, codes, norm, own)
    for q in range(20):
        assert finder.best[q][1].tolist() == np.argsort(true[q])[:10].tolist()
    assert finder.measured < 0.25 * true.size


def plain(rows, every, k):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i, tuple(v)] = np.array(v, np.float32).astype(float)
    out = []
    for (q, _), a in ok.items():
        if q % every == 0:
            near = sorted((float(np.sqrt(((a - b) ** 2).sum())), i) for (i, _), b in ok.items() if i != q)[:k]
            out += [(q, n + 1, i, round(d, 9)) for n, (d, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("block_queries", [16_384, 3])
def test_search(spark, block_queries):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(-50, 250)]
    same = rows[70][1]
    rows += [(i, same) for i in range(300, 340)]  # ties
    rows += [(400, None), (401, [0.0] * 8), (402, [None] + [1.0] * 7), (403, [float("nan")] + [1.0] * 7), (404, [float("inf")] + [1.0] * 7)]
    rows += [(410, [1.0] * 3), (None, same), rows[60], rows[60], (420, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<float>, id int, rank string")
    got = V.search(df, every=10, k=10, block_queries=block_queries).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got) == plain(rows, 10, 10)


def test_few_rows(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert V.search(spark.createDataFrame([], schema)).count() == 0
    assert V.search(spark.createDataFrame([(100, [1.0, 2.0])], schema)).count() == 0
    got = V.search(spark.createDataFrame([(100, [1.0, 2.0]), (1, [1.0, 5.0])], schema)).collect()
    assert [tuple(r) for r in got] == [(100, 1, 1, 3.0)]
