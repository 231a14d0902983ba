import json

from firmweave.operators import enrich, verify
from firmweave.plans import serve

ENTITY = "canonical_id string, primary_company_name string, aliases array<string>, record_count bigint, operating_countries array<string>, domain string"


def entities(spark):
    return spark.createDataFrame(
        [
            ("e1", "Foo Works", ["f"], 2, ["DE"], None),
            ("e2", "BAR", [], 3, None, ""),
            ("e3", "Baz", ["z"], 1, ["FR"], "bar.com"),
            ("e4", "Foo Works", [], 1, ["DE"], "own.com"),
            ("e5", "Works Foo", [], 1, None, None),
        ],
        ENTITY,
    )


def test_unified_reference_is_unique_and_complete(spark):
    df = spark.createDataFrame(
        [("a", "2.com", "auto"), ("a", "1.com", "x"), ("b", None, "auto"), (None, "c.com", "y"), ("d", "d.com", "Motor trade")],
        "ref_name string, ref_domain string, ref_industry string",
    )
    one = enrich.unified_reference(df, df)
    assert sorted(map(tuple, one.collect())) == [("a", "1.com", "x"), ("d", "d.com", "Motor trade")]
    assert [r.ref_name for r in enrich.automotive(one).collect()] == ["d"]


def test_lookups_fill_only_missing_domains(spark):
    ref = spark.createDataFrame(
        [(" foo works ", "foo.com", "auto"), ("bar", "bar.com", "auto")],
        "ref_name string, ref_domain string, ref_industry string",
    )
    want = {"e1": "foo.com", "e2": "bar.com", "e3": "bar.com", "e4": "own.com", "e5": None}
    for fill in (enrich.fill_exact, enrich.fill_bulk):
        assert {r.canonical_id: r.domain for r in fill(entities(spark), ref).collect()} == want
    fuzzy = {r.canonical_id: r.domain for r in enrich.fill_fuzzy(entities(spark), ref, 94).collect()}
    assert fuzzy == want | {"e5": "foo.com"}


def test_unify_merges_shared_domains(spark):
    ref = spark.createDataFrame([("bar", "bar.com", None)], "ref_name string, ref_domain string, ref_industry string")
    got = {r.canonical_id: r for r in enrich.unify_domains(enrich.fill_exact(entities(spark), ref)).collect()}
    assert set(got) == {"e1", "e2", "e4", "e5"}
    assert got["e2"].record_count == 4 and got["e2"].aliases == ["z"] and got["e2"].domain == "bar.com"
    assert got["e2"].operating_countries == ["FR"]


def test_logo_order_and_gaps(spark):
    df = spark.createDataFrame([("1", "A.com "), ("2", "b.com"), ("3", "Missing"), ("4", None), ("5", "c.com")], "canonical_id string, domain string")
    one, two = enrich.LOGO_TEMPLATES
    status = spark.createDataFrame(
        [(one.format(domain="a.com"), 200), (two.format(domain="a.com"), 200), (one.format(domain="b.com"), 404),
         (two.format(domain="b.com"), 200), (one.format(domain="c.com"), 500)],
        "url string, status int",
    )
    got = {r.canonical_id: r.logo_url for r in enrich.with_logos(df, status).collect()}
    assert got == {"1": one.format(domain="a.com"), "2": two.format(domain="b.com"), "3": None, "4": None, "5": None}


def test_requests_and_responses(spark):
    df = spark.createDataFrame([(f"e{i:02d}", f"name {i}", None if i % 2 else "d.com") for i in range(25)], "canonical_id string, primary_company_name string, domain string")
    requests = verify.request_batches(df)
    rows = {r.batch_id: r for r in requests.collect()}
    assert [rows[i]["size"] for i in range(3)] == [10, 10, 5]
    assert json.loads(rows[0].payload)[1] == {"id": "e01", "name": "name 1", "current_domain": None}
    answer = json.dumps([{"id": i, "verified_domain": f"{i}.com", "description": "d", "is_automotive": False} for i in rows[0].ids])
    texts = spark.createDataFrame([(0, f"```json\n{answer}\n```"), (1, "no idea"), (7, "[]")], "batch_id bigint, text string")
    got = {r.id: r for r in verify.ingest_responses(requests, texts).collect()}
    assert len(got) == 25
    assert got["e03"].verified_domain == "e03.com" and got["e03"].is_automotive is False
    assert got["e12"].verified_domain == "Missing" and got["e24"].description == "Information not found."


def test_fences(spark):
    df = spark.createDataFrame([("```json\n[1]\n```",), (" ```\n[2]\n``` ",), ("[3]",)], "t string")
    assert [r[0] for r in df.select(verify.unfenced("t")).collect()] == ["[1]", "[2]", "[3]"]


def test_master_and_serving(spark):
    df = entities(spark).selectExpr("*", "cast(null as string) as logo_url")
    answers = spark.createDataFrame([("e3", "Missing", "about baz"), ("e1", "new.com", None)], "id string, verified_domain string, description string")
    got = {r.canonical_id: r for r in verify.master_table(df, answers).collect()}
    assert got["e3"].domain == "bar.com" and got["e1"].domain == "new.com"
    assert got["e1"].description == "Information not found."
    assert {r.canonical_id: r.domain for r in verify.master_table(df, answers, strict=True).collect()}["e3"] == "Missing"

    master = verify.master_table(df, answers)
    assert [r.canonical_id for r in serve.search(master, "foo").collect()] == ["e1", "e4", "e5"]
    assert serve.search(master, "%").count() == 0  # taken literally
    assert [r.canonical_id for r in serve.list_all(master, 2).collect()] == ["e1", "e2"]
    fields = {r.field: r.value for r in serve.inspect(master, "e3").collect()}
    assert fields["domain"] == "bar.com" and fields["aliases"] == "z"
    (s,) = serve.stats(spark.createDataFrame([("a",), ("a",), ("b",)], "company_name string"), master).collect()
    assert (s.raw_rows, s.raw_names, s.clusters, s.domains, s.descriptions) == (3, 2, 5, 3, 1)
    assert [r.canonical_id for r in serve.top_entities(master, 2).collect()] == ["e2", "e1"]


def test_words_after_the_array_fail_the_batch(spark):
    requests = spark.createDataFrame([(i, ["x", "y"]) for i in range(5)], "batch_id bigint, ids array<string>")
    one = '[{"id": "x", "verified_domain": "x.com", "description": "d", "is_automotive": true}]'
    texts = [one + " trailing words", one + ' and ["y"]', one + ', "other": [1]', "```json\n" + one + "\n```", one + "]"]
    responses = spark.createDataFrame(list(enumerate(texts)), "batch_id bigint, text string")
    got = verify.ingest_responses(requests, responses).groupBy("verified_domain").count().collect()
    assert {r.verified_domain: r["count"] for r in got} == {"x.com": 1, "Missing": 8}


def test_unify_domains_makes_its_entities_once(spark):
    from pyspark.sql import functions as F

    rows = [("2", "A", ["a"], 1, ["Germany"], "X.com "), ("1", "B", ["b"], 1, None, "x.com"), ("3", "C", ["c"], 1, None, None)]
    made = spark.createDataFrame(rows, "canonical_id string, primary_company_name string, aliases array<string>, record_count bigint, operating_countries array<string>, domain string")
    unified = enrich.unify_domains(made.withColumn("domain", F.regexp_replace(F.lower("domain"), "[ ]+$", "")))
    assert "regexp_replace" not in unified._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.canonical_id, r.aliases, r.record_count) for r in unified.collect()) == [("1", ["a", "b"], 2), ("3", ["c"], 1)]
