"""Benchmark passages against a plain search of all alignments."""

import random
import re

from firmweave.llm import decontaminate as D


def tokens(text):
    return [w for w in re.split(r"[^a-z0-9éü]+", (text or "").lower()) if w]


def plain(docs, items, window=20, agreement=0.8):
    best, known = {}, {}
    for i, t in items:
        if len(tokens(t)) >= D.LEAST_TOKENS:
            known.setdefault(tuple(tokens(t)), []).append(i)
    for d, text in set(docs):
        a = tokens(text)
        for b, ids in known.items():
            n = min(window, len(b))
            for shift in range(-len(b), len(a)):
                seeded = any(
                    all(a[p + shift + o] == b[p + o] for o in m)
                    for m in D.MASKS for p in range(len(b) - D.SPAN + 1) if p + shift >= 0 and p + shift + D.SPAN <= len(a)
                )
                seeded |= len(b) < D.SPAN and shift >= 0 and a[shift : shift + len(b)] == list(b)
                for s in range(len(b) - n + 1) if seeded else ():
                    if s + shift >= 0 and s + shift + n <= len(a):
                        same = sum(b[s + k] == a[s + shift + k] for k in range(n))
                        if same * 10 >= 8 * n:
                            key = (d, min((x for x in ids if x is not None), default=None), text, b)
                            best[key] = max(best.get(key, (0, 0, 0)), (same, -(s + shift), n))
    return sorted((repr(d), repr(i), -s, m, n) for (d, i, *_), (m, s, n) in best.items())


def cases():
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("ha", "or", "thé", "st", "un", "re") for b in ("on", "in", "er", "at", "ü")]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(text(n))) for i, n in enumerate((12, 18, 25, 40, 60, 9))]
    # repeated and null ids, items of few tokens
    items += [(9, items[3][1].upper()), (10, None), (11, ""), (None, " ".join(text(14))), (None, " ".join(text(30))), (4, " ".join(text(15)))]
    items += [(20, " ".join(text(5))), (21, " ".join(text(4))), (None, items[0][1])]
    docs = [(0, None), (1, ""), (2, "short one")]
    for k in range(40):
        item = tokens(items[k % 6][1])
        part = item if k % 3 else item[: max(12, len(item) - 15)]
        part = [w if rng.random() > (k % 5) * 0.06 else "changed" for w in part]
        docs.append((10 + k, " ".join(text(rng.randrange(30))) + ", " + "  ".join(part) + "\n" + " ".join(text(rng.randrange(30)))))
    docs += [(60 + k, " ".join(text(9)) + " " + items[k][1] + ". " + " ".join(text(9))) for k in range(5, len(items)) if items[k][1]]
    docs += [docs[5], docs[5], (None, docs[6][1]), (docs[7][0], docs[8][1]), (99, items[2][1] + " " + items[4][1]), (100, " ".join(text(5000)))]
    return docs, items


def test_passages(spark, monkeypatch):
    docs, items = cases()
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, item bigint, tokens string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    expected = plain(docs, items)
    assert len(expected) > 20
    for limit in (D.BROADCAST_SEEDS, 0):
        monkeypatch.setattr(D, "BROADCAST_SEEDS", limit)
        got = D.contaminated(df, bench).collect()
        assert sorted((repr(r.doc_id), repr(r.item_id), r.start, r.matched, r.compared) for r in got) == expected
    stay = D.clean(df, bench)
    assert stay.columns == df.columns
    bad = {(d, t) for d, t in docs if (repr(d) in {e[0] for e in expected}) and plain([(d, t)], items)}
    assert sorted(map(repr, ((r.doc_id, r.text) for r in stay.collect()))) == sorted(map(repr, (d for d in docs if d not in bad)))


def test_nothing_to_find(spark):
    df = spark.createDataFrame([(1, "a few words " * 9)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert D.contaminated(df, none).count() == 0 and D.clean(df, none).count() == 1
    assert D.contaminated(df.limit(0), none).count() == 0
