import json

import pytest
from pyspark.sql import functions as F

from firmweave.operators import standardize as Z
from firmweave.sources import readers as R


def write(folder, name, data):
    path = folder / name
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def test_csv_files_with_differing_headers(spark, tmp_path):
    write(tmp_path, "a.csv", "name,url\nFoo,foo.com\n\"Bar, Inc\",bar.com\nbroken\n")
    write(tmp_path, "b.csv", "url,name,city\nbaz.com,Baz,Ulm\n")
    df = R.read_raw(spark, str(tmp_path))["csv"]
    assert sorted(map(tuple, df.select("name", "url", "city").collect())) == [
        ("Bar, Inc", "bar.com", None), ("Baz", "baz.com", "Ulm"), ("Foo", "foo.com", None),
    ]
    assert df.count() == 3


def test_csv_quoted_line_break_and_quote(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'name,city\n"Foo\nBar","say ""hi"""\n')
    assert [tuple(r) for r in R.read_csv(spark, [path]).collect()] == [("Foo\nBar", 'say "hi"')]


def test_only_files_with_line_breaks_are_read_whole(spark, tmp_path):
    whole = write(tmp_path, "a b.csv", 'name,city\n"Foo\nBar","x, y"\nA,B\n')
    plain = [write(tmp_path, f"ö{i}.csv", "city,name\n" + f'"u, {i}","say ""hi"""\n' * 40_000) for i in range(2)]
    empty = write(tmp_path, "none.csv", "")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        assert R._with_line_breaks(spark, [whole, *plain]) == {whole}
        df = R.read_csv(spark, [whole, *plain, empty])
        assert df.rdd.getNumPartitions() > 8
        assert sorted(R._by_header(spark, [whole, *plain, empty], '"')) == [(["city", "name"], plain), (["name", "city"], [whole])]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = df.groupBy("name", "city").count().collect()
    assert sorted(map(tuple, got)) == [("A", "B", 1), ("Foo\nBar", "x, y", 1), ('say "hi"', "u, 0", 40_000), ('say "hi"', "u, 1", 40_000)]


def test_header_names():
    assert R._column_names('\ufeffa,,"b, c",A', '"') == ("a0", "_c1", "b, c", "A3")
    assert R._column_names('"a,b', "") == ('"a', "b")


def test_bulk_csv_keeps_every_line(spark, tmp_path):
    data = b'name,website\nun"paired,a.com\nextra,b.com,zzz\nmissing\nbad\xff,c.com\n'
    df = R.read_bulk_csv(spark, [write(tmp_path, "bulk.csv", data)])
    assert sorted(map(tuple, df.collect()), key=str) == sorted(
        [('un"paired', "a.com"), ("extra", "b.com"), ("missing", None), ("bad�", "c.com")], key=str
    )


def test_dispatch(spark, tmp_path):
    with pytest.raises(ValueError):
        R.raw_files(spark, str(tmp_path / "none"))
    write(tmp_path, "x.txt", "nothing")
    with pytest.raises(ValueError):
        R.raw_files(spark, str(tmp_path))
    (tmp_path / "deeper").mkdir()
    write(tmp_path / "deeper", "y.csv", "name\nx\n")
    write(tmp_path, "z.jsonl", '{"name": "x"}\n')
    assert list(R.raw_files(spark, str(tmp_path))) == ["jsonl"]


def test_harmonise_resolves_names_case_and_nested_fields(spark, tmp_path):
    lines = [
        {"Company_Name": "A", "location": {"city": "Ulm", "country": "DE"}, "est_year": 1990, "tags": ["x", "y"]},
        {"Company_Name": "B", "location": {"city": None, "country": "FR"}, "est_year": None, "tags": None},
    ]
    path = write(tmp_path, "a.jsonl", "\n".join(map(json.dumps, lines)))
    rows = Z.harmonise(R.read_jsonl(spark, [path]), "jsonl").orderBy("raw_company_name").collect()
    assert [(r.raw_country, r.raw_city, r.raw_address, r.raw_founded_year, r.raw_source) for r in rows] == [
        ("DE", "Ulm", None, "1990", "jsonl"), ("FR", None, None, None, "jsonl"),
    ]
    assert rows[0].raw_industry == "[x, y]" and rows[0].raw_date is not None


def test_first_existing_column_wins_even_if_empty(spark):
    df = spark.createDataFrame([(None, "b")], "company_name string, name string")
    assert Z.harmonise(df, "csv").first().raw_company_name is None


def test_row_ids_are_stable_and_tell_copies_apart(spark):
    df = spark.createDataFrame([("a", None)] * 7 + [(None, "a"), ("b", "c")], "x string, y string")
    ids = sorted(r.raw_id for r in Z.with_row_ids(df, "csv").collect())
    again = sorted(r.raw_id for r in Z.with_row_ids(df.repartition(5), "csv", copies_per_task=2).collect())
    assert ids == again and len(set(ids)) == 9
    assert set(ids).isdisjoint(r.raw_id for r in Z.with_row_ids(df, "jsonl").collect())


def test_reference_and_domain_columns(spark):
    df = spark.createDataFrame([("n", "d")], "name string, website string")
    assert R.reference_table(df, domain="website", industry=None).first().asDict() == {
        "ref_name": "n", "ref_domain": "d", "ref_industry": None,
    }
    assert R.seed_domain(df).first().domain == "d"
    assert R.seed_domain(df.select("name")).first().domain is None
    assert R.seed_domain(df.withColumn("domain", F.lit("own"))).first().domain == "own"


def parquet(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / f"_{name}"))
    (folder / f"{name}.parquet").write_bytes(next((folder / f"_{name}").glob("*.parquet")).read_bytes())


def test_parquet_files_are_united_by_name(spark, tmp_path):
    parquet(spark, tmp_path, "a", [("Foo", "foo.com")], "name string, url string")
    parquet(spark, tmp_path, "b", [("Bar", "Ulm")], "company_name string, city string")
    df = R.read_raw(spark, str(tmp_path))["parquet"]
    assert sorted(map(tuple, df.select("name", "url", "company_name", "city").collect()), key=str) == sorted(
        [("Foo", "foo.com", None, None), (None, None, "Bar", "Ulm")], key=str
    )
    parquet(spark, tmp_path, "c", [("Baz", 7)], "name string, city int")
    mixed = R.read_raw(spark, str(tmp_path))["parquet"]
    assert sorted(r.city or "" for r in mixed.collect()) == ["", "7", "Ulm"]
