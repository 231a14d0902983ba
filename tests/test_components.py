import random

import pytest
from pyspark.sql import functions as F

from firmweave.operators import components as C
from firmweave.operators.relational import dense_number, lookup


def union_find(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def solve(spark, edges, **kw):
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    return {r.node: r.component for r in C.connected_components(df, **kw).collect()}


@pytest.mark.parametrize("hub_rows", [1_000_000, 5])
def test_random_graphs(spark, hub_rows):
    rng = random.Random(3)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)]
    edges = [e for e in edges if e[0] != e[1]]
    assert solve(spark, edges, hub_rows=hub_rows) == union_find(edges)


def test_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000 + i, 1000) for i in range(1, 400)]
    got = solve(spark, chain + star, hub_rows=50)
    assert set(got.values()) == {0, 1000}


def test_singletons_labels_and_remap(spark):
    nodes = spark.createDataFrame([(i,) for i in range(1, 8)], "id bigint")
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4)], "src bigint, dst bigint")
    found = C.label_components(nodes, edges, "id")
    assert {r.id: r.component for r in found.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7}
    labels = {r.component: r.label for r in C.numbered_labels(found, "component", "v_").collect()}
    assert labels == {1: "v_000000", 4: "v_000001", 6: "v_000002", 7: "v_000003"}
    moved = C.remap(nodes.withColumn("x", F.lit("a")), found.withColumnRenamed("id", "node"), "id")
    assert sorted(r.id for r in moved.collect()) == [1, 1, 1, 4, 4, 6, 7]


def test_group_edges_link_to_the_smallest_member(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 9), (None, 5)], "k string, id bigint")
    got = {(r.src, r.dst) for r in C.group_edges(df, "k", "id", hub_rows=2).collect()}
    assert got == {(3, 1), (2, 1)}


def test_lookup_spreads_a_hot_key(spark):
    big = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id").repartition(6)
    small = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner"):
        got = sorted((r.k, r.id, r.v if r.v is not None else -1) for r in lookup(big, small, "k", how, hot_rows=50).collect())
        want = sorted((r.k, r.id, r.v if r.v is not None else -1) for r in big.join(small, "k", how).select("k", "id", "v").collect())
        assert got == want


def test_dense_number(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1009).cast("string").alias("k")).repartition(7)
    got = {r.k: r.number for r in dense_number(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(got))}


def test_most_firms_in_one_component(spark, monkeypatch):
    """A component of most names is spread over tasks when names get their cluster back."""
    from firmweave.operators import relational, resolve

    salted = []
    kept = relational.salted_join
    monkeypatch.setattr(relational, "salted_join", lambda big, small, hot, key, how="left": salted.append(hot.collect()) or kept(big, small, hot, key, how))
    monkeypatch.setattr(relational.lookup, "__defaults__", ("left", 10))
    names = [f"chain {i:03d}" for i in range(60)] + ["alone one", "alone two"]
    firms = spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "unique_id string, company_name string")
    pairs = spark.createDataFrame([(f"CHAIN {i:03d}", f"CHAIN {i + 1:03d}") for i in range(59)], "a string, b string")
    got = {r.company_name: r.cluster_id for r in resolve.cluster_firms(firms, pairs=pairs).collect()}
    assert len(set(got.values())) == 3 and len({got[f"chain {i:03d}"] for i in range(60)}) == 1
    assert any(r["salts"] == 6 for rows in salted for r in rows)


def test_one_round_of_edges_is_kept(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from firmweave import storage
    from firmweave.operators.components import connected_components

    monkeypatch.setattr(storage, "shared_dir", lambda session: str(tmp_path))
    chain = spark.range(300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert connected_components(chain).filter("component = 0").count() == 301
    assert len(list(tmp_path.rglob("_SUCCESS"))) == 1
