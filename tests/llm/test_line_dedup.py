"""Fuzzy line dedup against a plain version over all pairs."""

import ast
import random
import re
from collections import Counter

import pytest

from firmweave.llm import line_dedup as L


def words(line):
    return re.sub(r"[^a-z0-9éü]+", " ", line.lower()).strip().split(" ")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def alike(a, b):
    return edits(a, b) <= int(max(len(a), len(b)) * (1 - L.SIMILARITY) + 1e-9)


def units(line):
    """What is compared of a line: its words, or its characters if it has few but long ones, or nothing."""
    joined = " ".join(line)
    return line if len(line) >= L.MIN_WORDS else tuple(joined) if len(joined) >= L.MIN_CHARS else ()


def sims(spark, lines):
    """SimHash of each line's neighbouring pairs."""
    pairs = {(len(x) >= L.MIN_WORDS, *p) for x in lines for p in zip(units(x), units(x)[1:])}
    code = "cast(pmod(xxhash64({0}, if(w, 7, 8)), 40960) - 20480 as smallint)"
    rows = spark.createDataFrame(list(pairs), "w boolean, a string, b string").selectExpr("w", "a", "b", f"xxhash64({code.format('a')}, {code.format('b')}) AS h").collect()
    hashes = {(r.w, r.a, r.b): r.h for r in rows}
    out = {}
    for x in lines:
        hs = [hashes[len(x) >= L.MIN_WORDS, a, b] & (2**64 - 1) for a, b in zip(units(x), units(x)[1:])]
        out[x] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    return out


def keys(sim):
    parts = [sim >> first & 0xFFFF for first in L.BLOCKS]
    return {(i, j, parts[i], parts[j]) for i in range(4) for j in range(i)}


def halves(x):
    n = len(x)
    return {k for least in (n, n - 1) for k in ((least, 0, x[: least // 2]), (least, 1, x[n - least + least // 2 :]))}


def plain(spark, docs, crowded):
    """``crowded``: lines that share halves are linked only if they are one edit apart."""
    lines = sorted({tuple(words(x)) for _, t in docs for x in (t or "").split("\n")} - {("",)})
    sim = sims(spark, lines)
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[:i]:
            x, y = units(a), units(b)
            if not x or not y or (len(a) >= L.MIN_WORDS) != (len(b) >= L.MIN_WORDS) or abs(len(x) - len(y)) > 0.2 * max(len(x), len(y)):
                continue
            by_blocks, by_halves = keys(sim[a]) & keys(sim[b]), halves(x) & halves(y)
            if (by_blocks or by_halves) and alike(x, y) and (by_blocks or not crowded or edits(x, y) == 1):
                root[find(a)] = find(b)
    seen, out = {}, {}
    for key, text in sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0)):
        kept = []
        for n, x in enumerate((text or "").split("\n")):
            w = tuple(words(x))
            if w == ("",) or seen.setdefault(find(w), (key, text, n)) == (key, text, n):
                kept.append(x)
        out[key, text] = None if text is None else "\n".join(kept)
    return [(k, out[k, t]) for k, t in docs]


def documents():
    rng = random.Random(11)
    vocabulary = [a + b for a in ("ha", "or", "thé", "st", "un", "re", "lo") for b in ("on", "in", "er", "at", "ü", "is")]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = [line(n) for n in (5, 6, 9, 20, 40, 60, 300, 700)]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            kind, x = rng.randrange(4), rng.choice(base)
            if kind == 0:
                x = x.upper() + " !"
            elif kind == 1:
                w = x.split(" ")
                for _ in range(1 + len(w) // 30):
                    w[rng.randrange(len(w))] = rng.choice(vocabulary)
                x = " ".join(w)
            elif kind == 2:
                x = line(rng.randrange(3, 50))
            parts.append(x)
        docs.append((i, "\n".join(parts)))
    same = docs[4]
    return docs + [same, (None, docs[9][1]), (100, None), (101, ""), (102, "\n\n - \n"), (103, "a b\na b\npage 12 of 345 in all\nPage 99 of 111 in all.")]


@pytest.mark.parametrize("small, broadcast", [(32, 500_000), (1, 0)])
def test_documents(spark, small, broadcast, monkeypatch):
    docs = documents()
    monkeypatch.setattr(L, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(L.line_links, "__defaults__", (small, False))
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, line bigint, drop string")
    got = L.drop_repeated(df)
    assert got.columns == df.columns
    expected = plain(spark, docs, False)
    assert sum(a != b for a, b in zip(docs, expected)) > 20
    got = sorted(map(repr, ((r.doc_id, r.text) for r in got.collect())))
    if small > 1:
        assert got == sorted(map(repr, expected))
        return
    # crowded keys of halves: links to a key's first line and of one edit, no others; each link takes lines away
    count = lambda rows: Counter((i, x) for i, t in rows for x in (t or "").split("\n"))
    kept = count(map(ast.literal_eval, got))
    assert count(expected) <= kept <= count(plain(spark, docs, True))


def test_words_are_runs_of_letters_and_digits(spark):
    marks = "".join(chr(c) for c in [*range(1, 0x250), 0x2019, 0x3001, 0x65E5, 0x1F600, 0x1D7CE] if not 0xD800 <= c < 0xE000)
    df = spark.createDataFrame([(marks, "Ab1 é-Ü_x²½ª·日本、語")], "a string, b string")
    row = df.select(L.words_of(L.F.col("a")).alias("a"), L.words_of(L.F.col("b")).alias("b"), L.F.array_remove(L.F.split(L.F.lower("a"), r"[^\p{L}\p{N}]+"), "").alias("c")).first()
    assert row.a == row.c and row.b == ["ab1", "é", "ü", "x²½ª", "日本", "語"]


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert L.drop_repeated(df).count() == 0


def by_edits(docs):
    """What stays if all lines are compared by edit similarity alone."""
    lines = sorted({tuple(words(x)) for _, t in docs for x in t.split("\n")})
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[:i]:
            if abs(len(a) - len(b)) <= 0.2 * max(len(a), len(b)) and alike(a, b):
                root[find(a)] = find(b)
    seen = {}
    return [(k, "\n".join(x for n, x in enumerate(t.split("\n")) if seen.setdefault(find(tuple(words(x))), (k, n)) == (k, n))) for k, t in docs]


@pytest.mark.parametrize("small", [32, 1])
def test_all_alike_lines_are_found(spark, small, monkeypatch):
    monkeypatch.setattr(L.line_links, "__defaults__", (small, False))
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    docs = []
    for n in [*range(5, 31), 49, 50, 99, 100, 140]:
        base = [rng.choice(vocabulary) for _ in range(n)]
        docs.append((len(docs), " ".join(base)))
        for _ in range(3):
            line, most = list(base), n // 5
            for _ in range(rng.choice([most, most, 1])):
                kind, at = rng.randrange(4), rng.randrange(len(line))
                if kind == 0 and len(line) > max(5, n - most):
                    del line[at]
                elif kind == 1 and len(line) < n:
                    line.insert(at, rng.choice(vocabulary))
                else:
                    line[at] = rng.choice(vocabulary)
            docs.append((len(docs), " ".join(line)))
    # one passage in many lines, alike in part only
    middle = " ".join(vocabulary[:4])
    docs += [(len(docs) + i, " ".join([*rng.sample(vocabulary, 4), middle, *rng.sample(vocabulary, 4)])) for i in range(60)]
    expected = by_edits(docs)
    assert sum(a != b for a, b in zip(docs, expected)) > 80
    got = L.drop_repeated(spark.createDataFrame(docs, "doc_id bigint, text string"), complete=True).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(expected)


@pytest.mark.parametrize("small", [32, 1])
def test_one_edit_is_always_found(spark, small, monkeypatch):
    """Lines of any length, and many lines that share all but their middle word or their first half."""
    monkeypatch.setattr(L.line_links, "__defaults__", (small, False))
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    docs = []
    for n in [*range(5, 40), 100, 101, 260, 261]:
        base = [rng.choice(vocabulary) for _ in range(n)]
        docs.append((len(docs), " ".join(base)))
        for kind in range(3):
            line, at = list(base), rng.randrange(n)
            if kind == 0 and n > 5:
                del line[at]
            else:
                line[at:at + (kind < 2)] = [rng.choice(vocabulary)]
            docs.append((len(docs), " ".join(line)))
    many = [rng.choice(vocabulary) for _ in range(13)]
    docs += [(len(docs) + i, " ".join([*many[:6], f"own{i}", *many[6:]])) for i in range(70)] + [(900, " ".join(many))]
    # one beginning and unlike ends
    docs += [(1000 + i, " ".join([*many[:6], *rng.sample(vocabulary, 6)])) for i in range(70)]
    got = {r.doc_id: r.text for r in L.drop_repeated(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == dict(by_edits(docs))


def test_short_and_unspaced_lines(spark):
    long = "".join(chr(0x4E00 + i) for i in range(40))
    near = long[:9] + "日" + long[10:]
    docs = [(1, f"And ornd.\n\n--\nkept one\n{long}"), (2, f"and ORND\n\n--\nkept two\n{near}"), (3, "日本語\nx\nAnd ornd"), (4, "日本語\nx y")]
    got = {r.doc_id: r.text for r in L.drop_repeated(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == {1: docs[0][1], 2: "\n--\nkept two", 3: "日本語\nx", 4: "x y"}


def test_query_and_pipeline_find_all_alike_lines(spark, tmp_path):
    """Lines with as many edits as likeness allows, few and many of them under one half."""
    import corpus_pipeline
    from firmweave.llm.queries import op9_line_dedup

    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(2000)]
    docs = []
    for n in (10, 20, 60, 100):
        base = [rng.choice(vocabulary) for _ in range(n)]
        docs.append((len(docs), " ".join(base)))
        for _ in range(4):
            line = list(base)
            for at in rng.sample(range(n), n // 5):
                line[at] = rng.choice(vocabulary)
            docs.append((len(docs), " ".join(line)))
    # one half in forty lines, of which pairs are alike by two edits
    half = [rng.choice(vocabulary) for _ in range(6)]
    for _ in range(20):
        rest = [rng.choice(vocabulary) for _ in range(6)]
        docs += [(len(docs) + i, " ".join([*half, *rest[:2], f"x{len(docs) + i}", *rest[2:4], f"y{len(docs) + i}", *rest[4:]])) for i in range(2)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    expected = sorted(by_edits(docs))
    assert sum(t == "" for _, t in expected) > 30
    assert sorted((r.doc_id, r.text) for r in op9_line_dedup(spark, str(tmp_path)).collect()) == expected
    assert sorted((r.doc_id, r.text) for r in corpus_pipeline.fuzzy_lines(spark, df, str(tmp_path)).select("doc_id", "text").collect()) == expected


def test_rounds_deal_each_key_once(spark, monkeypatch):
    """The rounds' keys are apart, none has most of them, and together they are those of one round."""
    rng = random.Random(21)
    docs = [(i, "\n".join(" ".join(f"w{rng.randrange(60)}" for _ in range(n)) for n in (8, 13, 30, 61))) for i in range(40)]
    docs.append((99, " ".join(["same"] * 50)))
    lines = L.line_table(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text", True)
    different = L.different_lines(lines)

    def dealt(rounds):
        monkeypatch.setattr(L, "ROUNDS", rounds)
        _, parts = L._first_triples(different, lines)
        assert len(parts) == rounds
        return [[tuple(r) for r in p.select("bucket", "id", "words").collect()] for p in parts]

    whole, *_ = dealt(1)
    parts = dealt(3)
    assert sorted(whole) == sorted(r for p in parts for r in p) and len(set(whole)) == len(whole)
    assert max(map(len, parts)) < len(whole) / 2
    for i, a in enumerate(parts):
        assert not {r[0] for r in a} & {r[0] for b in parts[:i] for r in b}
    # of 61 words 36 triples, and all that a line has if it has fewer
    count = Counter((r[1], r[2]) for r in whole)
    assert {n for (_, words), n in count.items() if words == 61} == {37} and {n for (_, words), n in count.items() if words == 50} == {1}


def test_groups_of_alike_lines_meet_once(spark, monkeypatch):
    """Of a group of near copies each line is compared with one other; links still connect groups that are chains."""
    rng = random.Random(31)
    vocabulary = [f"w{i}" for i in range(5000)]
    docs, group = [], 12
    for _ in range(5):
        base = [rng.choice(vocabulary) for _ in range(40)]
        for at in range(group):
            docs.append((len(docs), " ".join(base[:at] + [f"x{at}"] + base[at + 1 :])))
    chain = [rng.choice(vocabulary) for _ in range(40)]
    for at in range(0, 40, 5):
        docs.append((len(docs), " ".join(chain)))
        chain[at : at + 5] = [rng.choice(vocabulary) for _ in range(5)]
    asked, compared = [], L._compared

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return compared(pairs, *rest)

    monkeypatch.setattr(L, "_compared", counted)
    got = L.drop_repeated(spark.createDataFrame(docs, "doc_id bigint, text string"), complete=True).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(by_edits(docs))
    assert sum(r.text != "" for r in got) == 6
    assert sum(asked) <= 5 * 2 * group + 28


def test_long_unlike_lines_are_told_apart_without_their_texts(spark, monkeypatch):
    """A passage in many long lines gives them common keys; only pairs that can be alike are compared by their texts."""
    rng = random.Random(41)
    vocabulary = [f"w{i}" for i in range(20_000)]
    passage = rng.sample(vocabulary, 80)
    docs = [(i, " ".join(passage + rng.sample(vocabulary, 90))) for i in range(20)]
    near = docs[3][1].split(" ")
    for at in rng.sample(range(170), 34):
        near[at] = rng.choice(vocabulary)
    # likeness across the length from which lines have wide sketches
    edge = rng.sample(vocabulary, 105)
    docs += [(20, " ".join(near)), (21, " ".join(edge)), (22, " ".join(edge[:95]))]
    asked, compared = [], L._compared

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return compared(pairs, *rest)

    monkeypatch.setattr(L, "_compared", counted)
    got = L.drop_repeated(spark.createDataFrame(docs, "doc_id bigint, text string"), complete=True).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(by_edits(docs))
    assert sum(r.text == "" for r in got) == 2
    assert sum(asked) <= 5
