"""SimHash near-duplicates against all pairs."""

import re

import numpy as np
import pytest
import xxhash

from firmweave.llm import simhash_dedup as S


def plain_fingerprint(text, words=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius=4):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    todo = sorted(root)
    for i, a in enumerate(todo):
        for b in todo[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in root}


def test_fingerprint_of_odd_texts():
    texts = ["", "one", "Two  words", "a b c d", "É Ü a\x0bB c\x1cd e\xa0f g", "x " * 70_000, "The cat sat on the mat " * 30]
    for text in texts:
        assert S.fingerprint(text.encode()) == plain_fingerprint(text)
    assert S.fingerprint(None) == 0


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("crowded", [4_000_000, 3_000])
def test_links_give_the_groups_of_all_pairs(spark, crowded):
    rng = np.random.default_rng(5)
    centres = [int(x) for x in rng.integers(0, 2**64, 30, dtype=np.uint64)] + [0, 2**64 - 1]
    prints = set(centres)
    for c in centres:
        for _ in range(8):
            flipped = c
            for b in rng.choice(64, rng.integers(0, 7), replace=False):
                flipped ^= 1 << int(b)
            prints.add(flipped)
    for _ in range(150):  # one dense group
        prints.add(centres[0] ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)))
    expected = plain_groups(prints)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint bigint")
    got = {r.fingerprint: r.component for r in S.fingerprint_groups(df, crowded=crowded).collect()}
    by_root, by_component = {}, {}
    for p, r in expected.items():
        by_root.setdefault(r, set()).add(signed(p))
    for p, c in got.items():
        by_component.setdefault(c, set()).add(p)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_component.values()))


def test_crowded_blocks_are_split(monkeypatch):
    monkeypatch.setattr(S, "BLOCK_VARIANTS", 5_000)
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 40, 60, dtype=np.uint64))
    made = list(S._split(base, np.arange(len(base)), np.full(len(base), 2), 48, 2))
    assert len(made) > 1
    variants = np.concatenate([v for v, _ in made])
    assert len(variants) == 1177 * len(base)
    seen = [set(v.tolist()) for v, _ in made]
    assert sum(map(len, seen)) == len(set().union(*seen))


def test_documents(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base), (3, base.upper()), (9, base + " tail"), (1, "quite another text of some words"), (7, None), (2, ""), (7, None), (None, base)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, fingerprint string, row int")
    got = {}
    for r in S.near_duplicates(df).collect():
        got.setdefault(r.doc_id, []).append((r.fingerprint, r.component_id))
    groups = plain_groups({plain_fingerprint(t) for _, t in rows})
    for i, t in rows:
        p = plain_fingerprint(t)
        least = min(j for j, u in rows if j is not None and groups[plain_fingerprint(u)] == groups[p])
        assert set(got[i]) == {(f"{p:016x}", least)}
    assert len(got[7]) == 2
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.near_duplicates(df).count() == 0 and S.keep_one(df).count() == 0
