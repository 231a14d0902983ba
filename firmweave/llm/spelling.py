"""Spelling variants: finite-state composition of a vocabulary with itself.

Two words are near if one inserted, deleted or replaced code point makes them
equal. Near words agree in their first half or in their last half, so every word
joins the partition of its halves (of its own length, and of one less for
partners that are shorter). The words of a partition have read their shared
first half and wait in one state: from there a minimised acceptor of what they
hold besides the shared halves is composed with a transducer that edits once and
with the acceptor again, and the accepted pairs are enumerated. Each pair is
accepted in one partition only. Partitions with too many words are cut by halves
of what is not shared yet, until they are small or one code point is left.

Nulls, empty vocabularies, ties and repeats: a null word or count takes no part; words must
be distinct, as ``vocabulary`` returns them; of near words with equal counts the smallest in
code-point order is the form. Only the named columns are read. Words of any length are compared whole.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from firmweave.storage import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTITION_WORDS = 20_000  # of a partition; larger ones are cut again


class Acceptor:
    """Minimised acyclic automata over one register of states.

    Equal states are one, also between automata. Each state knows how many words it accepts,
    and each arc how many come before it, so a path's sum is its word's place in sorted order.
    """

    def __init__(self):
        self.register: dict[tuple, int] = {}
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.size: list[int] = []
        self.shared: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def _close(self, final: bool, out: list[tuple[str, int]]) -> int:
        signature = (final, tuple(out))
        state = self.register.get(signature)
        if state is None:
            state = self.register[signature] = len(self.arcs)
            arcs, before = {}, int(final)
            for c, target in out:
                arcs[c] = (target, before)
                before += self.size[target]
            self.arcs.append(arcs)
            self.final.append(final)
            self.size.append(before)
        return state

    def add(self, words: list[str]) -> int | None:
        """Start state of the automaton of ``words`` (sorted, distinct); None if there are none."""
        if not words:
            return None
        path: list[list] = [[False, []]]  # states on the way to the last word, still open
        last = ""

        def close_to(depth: int) -> None:
            while len(path) > depth + 1:
                state = self._close(*path.pop())
                path[-1][1].append((last[len(path) - 1], state))

        for word in words:
            same = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                same += 1
            close_to(same)
            path += [[False, []] for _ in range(len(word) - same)]
            path[-1][0] = True
            last = word
        close_to(0)
        return self._close(*path[0])

    def common(self, p: int, q: int) -> list[tuple[int, int]]:
        """Places, seen from ``p`` and from ``q``, of all endings that both accept."""
        if p == q:
            return [(k, k) for k in range(self.size[p])]
        stack = [(p, q)]
        while stack:
            p1, q1 = stack[-1]
            if (p1, q1) in self.shared:
                stack.pop()
                continue
            ways = [(s, t) for c, s in self.arcs[p1].items() if (t := self.arcs[q1].get(c))]
            open_ways = [(s[0], t[0]) for s, t in ways if s[0] != t[0] and (s[0], t[0]) not in self.shared]
            if open_ways:
                stack += open_ways
                continue
            found = [(0, 0)] if self.final[p1] and self.final[q1] else []
            for (s, i), (t, j) in ways:
                ends = self.shared[s, t] if s != t else [(k, k) for k in range(self.size[s])]
                found += [(i + x, j + y) for x, y in ends]
            self.shared[p1, q1] = found
            stack.pop()
        return self.shared[p, q]


def one_edit_pairs(short: list[str], long: list[str], before: int) -> Iterator[tuple[int, int, bool]]:
    """(i, j, longer): ``short[i]`` with one code point replaced is ``short[j]`` (i < j), or with one inserted ``long[j]``.

    Both lists are sorted and distinct; the first code point in which a pair differs is at a place below ``before``.
    """
    machine = Acceptor()
    start, start_long = machine.add(short), machine.add(long)
    if start is None:
        return
    arcs, final, size = machine.arcs, machine.final, machine.size
    # both words in one place of the shared beginning, no edit made yet
    todo: list[tuple[int, int | None, int, int, int]] = [(start, start_long, 0, 0, 0)]
    while todo:
        s, t, i, j, depth = todo.pop()
        if depth >= before or (t is None and size[s] < 2):
            continue
        own = list(arcs[s].items())
        for k, (_, (left, at_left)) in enumerate(own):
            for _, (right, at_right) in own[k + 1 :]:
                for x, y in machine.common(left, right):
                    yield i + at_left + x, i + at_right + y, False
        for c, (target, at) in arcs[t].items() if t is not None else ():
            if final[s] and final[target]:
                yield i, j + at, True
            for e, (left, at_left) in own:
                # inserted before an equal code point is the same as after it
                if e != c and (right := arcs[target].get(e)):
                    for x, y in machine.common(left, right[0]):
                        yield i + at_left + x, j + at + right[1] + y, True
        for c, (target, at) in own:
            other = arcs[t].get(c) if t is not None else None
            todo.append((target, other[0] if other else None, i + at, j + other[1] if other else 0, depth + 1))


def vocabulary(runs: DataFrame, word: str = "word", least_chars: int = 1, least_count: int = 1) -> DataFrame:
    """(word, n): distinct words of ``least_chars`` code points or more that occur ``least_count`` times or more."""
    long_enough = F.char_length(word) >= max(least_chars, 1)
    return (
        runs.filter(long_enough).groupBy(F.col(word).alias("word")).agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= least_count)
    )


def _key() -> Column:
    """Digest of what the words of a partition share: lengths, beginning and ending."""
    return F.unhex(F.md5(F.concat(
        F.concat_ws(",", "least", "lo", "hi"), F.lit(";"), F.expr("substring(word, 1, lo)"), F.expr("substring(word, char_length(word) - hi + 1, hi)")
    )))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row twice: its partition narrowed by the first and by the last half of what is not shared yet.

    ``least`` is the length of the partition's shorter words, ``lo`` and ``hi`` the shared code points at
    either end, ``cap`` the place before which a pair must differ; behind it, the other half finds the pair.
    """
    half = F.expr("(least - lo - hi) div 2")
    part = F.explode(F.array(
        F.struct((F.col("lo") + half).alias("lo"), F.col("hi").alias("hi"), F.col("cap").alias("cap")),
        F.struct(F.col("lo").alias("lo"), (F.col("least") - F.col("lo") - half).alias("hi"), F.least("cap", F.col("lo") + half).alias("cap")),
    ))
    cut = rows.select("word", "n", "least", part.alias("p")).select("word", "n", "least", "p.lo", "p.hi", "p.cap")
    return cut.filter("lo < cap").withColumn("key", _key())


def _with_sizes(rows: DataFrame) -> DataFrame:
    """Rows of partitions that can hold a pair, with the partition's size; the largest are split by Spark's skew join."""
    sizes = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.max((F.char_length("word") == F.col("least")).cast("int")).alias("short")
    )
    return rows.join(sizes.filter("size > 1 AND short = 1").drop("short"), "key")


def _enumerate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of rows that come ordered by partition."""
    schema = pa.schema([("a", pa.string()), ("a_n", pa.int64()), ("b", pa.string()), ("b_n", pa.int64())])

    def pairs(words: list[tuple[str, int]], least: int, lo: int, hi: int, cap: int):
        sides = []
        for length in (least, least + 1):
            side = sorted((w[lo : length - hi], w, n) for w, n in words if len(w) == length)
            sides.append((([x[0] for x in side]), side))
        (short, s), (long, t) = sides
        for i, j, longer in one_edit_pairs(short, long, cap - lo):
            yield s[i][1], s[i][2], *(t if longer else s)[j][1:]

    def groups():
        held, now = [], None
        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in ("key", "least", "lo", "hi", "cap", "word", "n")]
            for key, *shape, word, n in zip(*columns):
                if now and now[0] != key:
                    yield held, *now[1:]
                    held = []
                now = (key, *shape)
                held.append((word, n))
        if held:
            yield held, *now[1:]

    out: list[tuple] = []
    for group in groups():
        for pair in pairs(*group):
            out.append(pair)
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def near_pairs(words: DataFrame, limit: int = PARTITION_WORDS) -> DataFrame:
    """(a, a_n, b, b_n): every pair of words of (word, n) that differ by one code point, once, in either order.

    ``limit``: words that a partition may hold; larger ones are cut by halves, until one code point is left.
    """
    length = F.char_length("word")
    rows = (
        words.filter("word <> '' AND n IS NOT NULL").select("word", F.col("n").cast("bigint").alias("n"), F.explode(F.array(length, length - 1)).alias("least"))
        .filter("least > 0").withColumns({"lo": F.lit(0), "hi": F.lit(0), "cap": F.col("least") + 1})
    )
    found = None
    while True:
        rows = cut_lineage(_with_sizes(_halves(rows)))
        crowded = (F.col("size") > limit) & (F.col("least") - F.col("lo") - F.col("hi") > 1)
        ready = rows.filter(~crowded).drop("size").repartition("key").sortWithinPartitions("key")
        pairs = ready.mapInArrow(_enumerate, "a string, a_n bigint, b string, b_n bigint")
        found = pairs if found is None else found.union(pairs)
        rows = rows.filter(crowded).drop("size", "key")
        if rows.isEmpty():
            return found


def variant_forms(words: DataFrame, times: int = 2, limit: int = PARTITION_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of (word, n).

    ``form`` is the near word with the largest n (ties: the smallest word) if that is ``times`` the word's n or more;
    ``root`` is where following forms ends. Counts grow along forms, so there are no circles.
    """
    pairs = cut_lineage(near_pairs(words, limit))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("m")).union(
        pairs.select(F.col("b"), F.col("a"), F.col("a_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("rank"), F.col("other").alias("other"))).alias("best"))
    enough = -F.col("best.rank") >= times * F.col("n")
    formed = cut_lineage(
        words.filter("word <> '' AND n IS NOT NULL").select("word", F.col("n").cast("bigint").alias("n")).join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.rank")).alias("form_n"),
        )
    )
    # each round doubles the steps that a word has followed; counts double at each step, so six rounds reach any root
    links = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    steps = 1
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = cut_lineage(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        steps *= 2
        if steps >= 64 or links.filter("moved").isEmpty():
            break
        links = links.drop("moved")
    return formed.join(links.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
