from pyspark.sql import Row

from firmweave.operators import golden


def firm(cluster, name, original, country=None, website=None):
    return (cluster, name, original, country, website)


def test_first_pass_modes_sets_and_aliases(spark):
    rows = [
        firm("v1", "bosch", "Bosch", "GERMANY", "bosch.com"),
        firm("v1", "bosch", "Bosch AG", "GERMANY", None),
        firm("v1", "robert bosch gmbh", "Robert Bosch GmbH", "FRANCE", "bosch.de"),
        firm("v1", "bosch", None),
        firm("v2", "x", "X"),
    ]
    df = spark.createDataFrame(rows, "cluster_id string, company_name string, original_name string, country string, website string")
    got = {r.canonical_id: r for r in golden.first_pass_entities(df).collect()}
    one = got["v1"]
    assert one.primary_company_name == "bosch" and one.record_count == 4
    assert one.aliases == ["Robert Bosch GmbH"]  # 'bosch ag' is three edits away, not more
    assert one.operating_countries == ["FRANCE", "GERMANY"]
    assert one.primary_website == "bosch.com"  # tie: smallest
    assert got["v2"].operating_countries is None and got["v2"].aliases == []


def test_refined_names(spark):
    long = "a" * 120
    rows = [
        ("m1", "Acme GmbH", ["ACME", "Acme GmbH", "acme gmbh", " Acme Works ", ""], 3, ["X"], "a.com"),
        ("m2", long, [long + "b", long + "bbbbbb"], 1, None, None),
    ]
    df = spark.createDataFrame(
        rows,
        "canonical_id string, primary_company_name string, all_variations array<string>, record_count bigint, "
        "operating_countries array<string>, domain string",
    )
    got = {r.canonical_id: r for r in golden.refine_names(df).collect()}
    assert got["m1"].primary_company_name == "ACME"
    assert got["m1"].aliases == ["Acme GmbH", "Acme Works"]
    assert got["m2"].aliases == [long + "bbbbbb"]  # one more letter scores above 98


def test_merged_counts_and_arrays(spark):
    rows = [
        ("m", "a", ["x", "y"], 2, ["DE"], "s.com"),
        ("m", "b", None, None, None, None),
        ("m", "a", ["y"], 5, ["FR", "DE"], None),
    ]
    df = spark.createDataFrame(
        rows,
        "master_cluster_id string, primary_company_name string, aliases array<string>, record_count bigint, "
        "operating_countries array<string>, primary_website string",
    )
    (r,) = golden.refined_entities(df).collect()
    assert r == Row(
        canonical_id="m", primary_company_name="a", all_variations=["a", "b", "x", "y"], record_count=7,
        operating_countries=["DE", "FR"], domain="s.com",
    )
    (r,) = golden.refined_entities(df.drop("record_count")).collect()
    assert r.record_count == 3
