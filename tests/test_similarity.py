import random

import pytest
from pyspark.sql import functions as F

from firmweave.functions import similarity as S
from firmweave.operators import fuzzy


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = row[:]
        for j, y in enumerate(b, 1):
            row[j] = prev[j - 1] + 1 if x == y else max(prev[j], row[j - 1])
    return row[-1]


def words(rng, low=1, high=4):
    return " ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(low, high)))


def mutate(rng, text):
    chars = list(text)
    for _ in range(rng.randint(0, 3)):
        at = rng.randrange(len(chars) + 1)
        if rng.random() < 0.5 and at < len(chars):
            chars.pop(at)
        else:
            chars.insert(at, rng.choice("abcde "))
    return " ".join("".join(chars).split())


def texts(spark, items):
    return spark.createDataFrame([(x,) for x in items], "text string")


def test_indel_matches_dynamic_programming():
    rng = random.Random(1)
    for _ in range(500):
        a, b = words(rng), words(rng)
        assert S.indel(a, b) == len(a) + len(b) - 2 * slow_lcs(a, b)


def test_scores():
    assert S.token_sort_ratio("koza bilisim", "bilisim koza") == 100
    assert S.ratio("abcd", "abce") == 75
    assert S.token_set_ratio("auto parts", "parts auto world") == 100
    assert S.weighted_ratio("abc", "abcdefghijkl") == 0


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    base = [words(rng) for _ in range(120)]
    left = sorted({x for x in base + [mutate(rng, b) for b in base] if x})
    right = sorted({x for x in [mutate(rng, b) for b in base for _ in range(2)] if x})
    return left, right


@pytest.mark.parametrize("refine_rows", [1000, 2])
@pytest.mark.parametrize("num,den,strict", [(1, 10, True), (19, 100, True), (6, 100, False)])
def test_ratio_pairs_finds_every_pair(spark, corpus, num, den, strict, refine_rows):
    left, _ = corpus
    found = fuzzy.ratio_pairs(texts(spark, left), num=num, den=den, strict=strict, refine_rows=refine_rows)
    got = sorted(tuple(sorted((r.a, r.b))) for r in found.collect())

    def close(a, b):
        d, total = S.indel(a, b), len(a) + len(b)
        return d * den < num * total if strict else d * den <= num * total

    assert got == [(a, b) for i, a in enumerate(left) for b in left[i + 1:] if close(a, b)]


def test_ratio_pairs_between_two_sides(spark, corpus):
    left, right = corpus
    found = fuzzy.ratio_pairs(texts(spark, left), texts(spark, right), num=1, den=10, strict=True)
    want = {(a, b) for a in left for b in right if S.indel(a, b) * 10 < len(a) + len(b)}
    assert {(r.a, r.b) for r in found.collect()} == want


def test_refinement_goes_down_a_shared_start(spark):
    names = [f"company number {i:03d}" for i in range(60)]
    found = fuzzy.ratio_pairs(texts(spark, names), num=1, den=10, strict=True, refine_rows=20)
    want = {(a, b) for i, a in enumerate(names) for b in names[i + 1:] if S.indel(a, b) * 10 < len(a) + len(b)}
    assert {tuple(sorted((r.a, r.b))) for r in found.collect()} == want


@pytest.mark.parametrize("cutoff", [94, 92])
def test_weighted_matches_equal_brute_force(spark, cutoff):
    rng = random.Random(11)
    base = [words(rng) for _ in range(60)]

    def shuffled(text):
        parts = text.split()
        rng.shuffle(parts)
        if rng.random() < 0.4:
            parts.append(rng.choice("abc"))
        if rng.random() < 0.3:
            parts.append(parts[0])
        return " ".join(parts)

    long = [" ".join(rng.sample(base, rng.choice([2, 4]))) for _ in range(40)]
    left = sorted(set(base + long))
    right = sorted({shuffled(x) for x in base + long} | {mutate(rng, shuffled(x)) for x in long} - {""})
    found = fuzzy.weighted_matches(texts(spark, left), texts(spark, right), cutoff)
    want = {(a, b) for a in left for b in right if S.weighted_ratio(a, b) >= cutoff}
    assert {(r.a, r.b) for r in found.collect()} == want
    assert want


def test_a_token_that_every_name_has(spark, cutoff=92):
    """Names that share a common word with all others: found like any, and not by comparing all of them."""
    rng = random.Random(5)
    base = [words(rng) for _ in range(40)]
    left = sorted({f"motors {x}" for x in base} | {"motors", "motors ab", "motors abc def"})
    near = [mutate(rng, x) for x in base] + ["", "a", "ab", "ba", "abd", "def abc", "def abd"]
    right = sorted({" ".join(rng.sample(parts, len(parts))) for x in near + base for parts in [f"motors {x}".split()]})
    found = fuzzy.weighted_matches(texts(spark, left), texts(spark, right), cutoff, refine_rows=10)
    want = {(a, b) for a in left for b in right if S.weighted_ratio(a, b) >= cutoff}
    assert want and {(r.a, r.b) for r in found.collect()} == want


def test_a_common_token_is_no_key(spark):
    left = texts(spark, [f"motors {chr(97 + i // 26) * 4}{chr(97 + i % 26) * 4}" for i in range(300)])
    df = left.select(F.explode(F.split("text", " ")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    assert fuzzy._token_pairs(left, left, 92, df, 20).count() < 300 * 80


def test_scorers_that_exceed_the_ratio(spark):
    names = texts(spark, ["acme motor", "acme motors", "zeta works", "zeta wurkse"]).withColumnRenamed("text", "name")
    # scorers see the sorted words
    first = lambda a, b: F.when(F.substring(a, 1, 1) == F.substring(b, 1, 1), 99.0).otherwise(0.0)
    assert {r.name for r in fuzzy.best_other_names(names).collect()} == {"acme motor", "acme motors"}
    got = {(r.name, r.best, r.score) for r in fuzzy.best_other_names(names, scorer=first, reach=(1, 4)).collect()}
    assert got == {("acme motor", "acme motors", 99.0), ("acme motors", "acme motor", 99.0), ("zeta works", "zeta wurkse", 99.0), ("zeta wurkse", "zeta works", 99.0)}
    left, right = texts(spark, ["acme motor works"]), texts(spark, ["acme motor wurkx"])
    assert fuzzy.weighted_matches(left, right, 95, first).count() == 0
    (row,) = fuzzy.weighted_matches(left, texts(spark, ["acme motor work"]), 98, first, reach=92).collect()
    assert row.score == 99.0


def test_low_cutoffs_are_refused(spark):
    with pytest.raises(ValueError):
        fuzzy.weighted_matches(texts(spark, ["a"]), texts(spark, ["b"]), 90)


def test_best_other_names(spark):
    names = ["koza bilisim", "bilisim koza", "old bolt works", "cold bolt works", "xyz", ""]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {(r.name, r.best) for r in fuzzy.best_other_names(df).collect()}
    assert got == {
        ("koza bilisim", "bilisim koza"), ("bilisim koza", "koza bilisim"),
        ("old bolt works", "cold bolt works"), ("cold bolt works", "old bolt works"),
    }


def test_cut_off_between_two_decimals(spark):
    from firmweave.operators.fuzzy import weighted_matches

    left = spark.createDataFrame([("abcde",)], "text string")
    right = spark.createDataFrame([("abcdef",)], "text string")
    (row,) = weighted_matches(left, right, 90.905).collect()
    assert round(row.score, 3) == 90.909


def test_own_scorer(spark):
    from firmweave.operators.fuzzy import best_reference

    names = spark.createDataFrame([("acme motors",), ("other works",)], "name string")
    reference = spark.createDataFrame([("ACME MOTORS", "acme.com"), ("Other Worksx", "o.com")], "ref_name string, ref_domain string")
    same = lambda a, b: F.when(a == b, 99.0).otherwise(0.0)
    (row,) = best_reference(names, reference, 92, same).collect()
    assert (row.name, row.ref_domain, row.score) == ("acme motors", "acme.com", 99.0)
    assert best_reference(names, reference, 92).count() == 2


def test_no_table_of_names_is_broadcast(spark):
    # what is exploded from a text is many times what Spark expects from its file
    names = spark.range(200).select(F.format_string("Customer#%09d", "id").alias("name"))
    plan = fuzzy.best_other_names(names)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    both = texts(spark, ["alpha beta gamma", "delta epsilon"])
    plan = fuzzy.weighted_matches(both, both, 92)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
