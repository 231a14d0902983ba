"""Conversation prefixes against a plain trie: hot beginnings, long conversations, nulls, ties, no rows."""

import hashlib
import random
import re
import zlib

import pytest

from firmweave.llm import conversation_trie as C


def plain(convs):
    """convs: id -> list of (role, text)."""
    if not convs:
        return set()
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, out = {}, set()
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[x] for x in children.get(p, ())) or 1
        saved[p] = own + sum(saved[x] for x in children.get(p, ()))
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p))))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, ())), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + v[h:]
    return out


@pytest.mark.parametrize("ids", [4096, 2])
def test_nodes(spark, ids, monkeypatch):
    monkeypatch.setattr(C, "IDS", ids)
    rng = random.Random(ids)
    turn = lambda: (rng.choice(["user", "assistant"]), rng.choice(["a b", "a", "", "ab \t c\x0bd", "Zürich x"]))
    convs = {c: [turn() for _ in range(rng.choice([0, 1, 2, 3, 7, 8, 9]))] for c in range(0, 160, 2)}
    same = [("user", "hello there you")] * 21
    convs |= {1000 + c: same + [turn() for _ in range(rng.randrange(4))] for c in range(80)}
    convs |= {2000 + c: same[: c % 22] for c in range(30)}
    convs[5] = [("user", "x y z")] * 300
    convs[7] = [("userx", " y z")] * 2
    rows = [(c, i, *t, c, "x") for c, v in convs.items() for i, t in enumerate(v)] + [(None, 0, "user", "a", 1, "x")]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string, block bigint, path string").repartition(5)
    known = spark.createDataFrame([(c,) for c in [*convs, None]], "conv_id bigint")
    got = [tuple(r) for r in C.prefix_nodes(turns, known).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(convs)


def test_no_conversations(spark):
    turns = spark.createDataFrame([], "conv_id bigint, turn int, role string, text string")
    assert C.prefix_nodes(turns, turns.select("conv_id")).collect() == []


def test_query(spark, tmp_path):
    from firmweave.llm.queries import op12_conversation_trie

    rng = random.Random(3)
    rows = []
    for c in [*range(0, 90, 3), *range(200, 203), 20, 40]:
        for t in range(rng.choice([1, 2, 3, 5, 12])):
            rows.append((c, t, rng.choice(["user", None]), rng.choice(["a b", "c", None])))
    rows += [(0, None, "user", "first"), (0, 0, "a", "tie"), (0, 0, "a", "tie"), (None, 1, "user", "lost"), (6, 0, "user", "word " * 100_000)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = [tuple(r) for r in op12_conversation_trie(spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rebuilt(rows))
