"""Near words against all pairs: random vocabularies, crowded partitions, forms and roots."""

import random
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from firmweave.llm import spelling as S


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def forms(counts, times=2):
    out = {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v)) if others else None
        form = best if best and counts[best] >= times * n else None
        out[w] = [form, n, len(others), counts[form] if form else None]
    roots = {}
    for w in out:
        r = w
        while out[r][0]:
            r = out[r][0]
        roots[w] = r
    return {(w, f, roots[w], n, k, m) for w, (f, n, k, m) in out.items()}


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abé", min_size=1, max_size=7), max_size=40), st.integers(1, 8))
def test_composition(words, before):
    for length in range(1, 8):
        short, long = (sorted(w for w in words if len(w) == n) for n in (length, length + 1))
        got = [(short[i], (long if longer else short)[j]) for i, j, longer in S.one_edit_pairs(short, long, before)]
        expected = {
            (a, b) for a in short for b in [*(x for x in short if x > a), *long]
            if near(a, b) and next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a)) < before
        }
        assert len(got) == len(set(got)) and set(got) == expected


def test_acceptor_is_minimal():
    machine = S.Acceptor()
    start = machine.add(sorted(a + "ing" for a in "bcdfghk"))
    assert machine.size[start] == 7 and len(machine.arcs) == 5
    assert machine.add([]) is None


def vocabulary(seed, letters="abcdé", n=400):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))): rng.choice([1, 1, 2, 3, 5, 12, 40, 90]) for _ in range(n)}


@pytest.mark.parametrize("limit", [20_000, 4, 1])
def test_forms(spark, limit):
    long = 40_000 if limit > 10 else 60
    counts = vocabulary(limit) | {"x" * long: 4, "x" * (long - 1): 9, "x" * (long // 2) + "y" + "x" * (long // 2 - 1): 2}
    rows = [*((w, n, "a", "b") for w, n in counts.items()), (None, 3, "a", "b"), ("", 3, "a", "b"), ("null", None, "a", "b")]
    df = spark.createDataFrame(rows, "word string, n int, form string, key string").repartition(3)
    got = [tuple(r) for r in S.variant_forms(df, limit=limit).collect()]
    assert len(got) == len(counts) and set(got) == forms(counts)


def test_one_letter_in_one_place(spark):
    words = {f"{a}{b}cdefgh": 2 ** (i % 9) for i, (a, b) in enumerate((a, b) for a in "abcdefghijklmnop" for b in "abcdefghijklmnop")}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    pairs = [tuple(sorted((r.a, r.b))) for r in S.near_pairs(df, limit=10).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(a, b) for a in words for b in words if a < b and near(a, b)}


def test_no_rows(spark):
    df = spark.createDataFrame([], "word string, n bigint")
    assert S.variant_forms(df).collect() == [] and S.vocabulary(df).collect() == []


def plain_runs(docs):
    import re
    from collections import Counter

    found = Counter()
    for doc_id, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def test_query(spark, tmp_path):
    from firmweave.llm.queries import op13_spelling_variants

    rng = random.Random(7)
    base = ["Straße", "ÉTABLIR", "house", "houses", "mouse", "Mouse", "naïveté", "x×÷y", "ab", "color", "colour"]
    docs = [(i, " ".join(rng.choice(base) for _ in range(60)) + "\n1a-2") for i in range(60)]
    docs += [(None, "house house house Mouse"), (70, None), (71, ""), (72, "house " * 30_000), (72, "house " * 30_000)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in op13_spelling_variants(spark, str(tmp_path)).collect()}
    assert got == forms(plain_runs(docs)) and any(r[1] for r in got)
