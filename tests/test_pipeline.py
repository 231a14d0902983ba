import json

from pyspark.sql import functions as F

from firmweave.plans.pipeline import run_pipeline
from firmweave.storage import StageTables


def test_raw_files_to_master_and_resume(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    (raw / "a.csv").write_text(
        "name,url,country\nBosch GmbH,https://www.bosch.com,de\nBosch AG,,DE\nKoza Bilisim,koza.com,tr\n,x.com,de\n"
    )
    lines = [
        {"company_name": "Bosch GmbH", "location": {"country": "FR"}},
        {"company_name": "Bilisim Koza Ltd", "location": {"country": "TR"}},
        {"company_name": "Alone Inc", "location": {"country": None}},
    ]
    (raw / "b.jsonl").write_text("\n".join(map(json.dumps, lines)))
    spark.createDataFrame([("Bosch GmbH", "1886"), ("Alone Inc", "x")], "scraped_name string, founded_year string").coalesce(1).write.parquet(str(tmp_path / "p"))
    part = next((tmp_path / "p").glob("*.parquet"))
    (raw / "c.parquet").write_bytes(part.read_bytes())

    ref = spark.createDataFrame([("alone", "alone.com", "auto")], "ref_name string, ref_domain string, ref_industry string")
    master = run_pipeline(spark, str(raw), out, references=[ref], bulk=ref)
    rows = {r.primary_company_name: r for r in master.collect()}
    assert set(rows) == {"BOSCH", "KOZA BILISIM", "ALONE"} or set(rows) == {"BOSCH", "BILISIM KOZA", "ALONE"}
    assert rows["BOSCH"].record_count == 4 and rows["BOSCH"].operating_countries == ["FRANCE", "GERMANY"]
    assert rows["BOSCH"].domain == "bosch.com" and rows["ALONE"].domain == "alone.com"
    assert sum(r.record_count for r in rows.values()) == 8
    assert all(r.description == "Information not found." for r in rows.values())

    (line,) = spark.read.json(f"{out}/metrics").collect()
    assert line.metrics.etl_total_rows == 8 and line.metrics.master_entities == 3 and line.metrics.etl_csv_files == 1

    # a second run reuses every table; answers change only the master table
    before = sorted(p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet"))
    again = run_pipeline(spark, str(raw), out, references=[ref], bulk=ref)
    assert sorted(again.collect()) == sorted(master.collect())
    assert sorted(p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")) == before
    assert spark.read.json(f"{out}/metrics").count() == 2

    answers = again.select(
        F.struct(F.col("canonical_id").alias("id"), F.lit("v.com").alias("verified_domain"), F.lit("text").alias("description"), F.lit(True).alias("is_automotive")).alias("a")
    ).agg(F.to_json(F.collect_list("a")).alias("text")).select(F.lit(0).cast("bigint").alias("batch_id"), "text")
    answered = run_pipeline(spark, str(raw), out, references=[ref], bulk=ref, responses=answers)
    assert {(r.domain, r.description) for r in answered.collect()} == {("v.com", "text")}


def test_stage_key_follows_rows_and_plans(spark, tmp_path):
    def key(df):
        tables = StageTables(spark, str(tmp_path / "s"))
        tables.depends_on(df)
        return tables.key

    a, b = (spark.createDataFrame([(0, t)], "batch_id bigint, text string") for t in ("[]", "[1]"))
    assert key(a) != key(b) and key(a) == key(spark.createDataFrame([(0, "[]")], "batch_id bigint, text string"))
    a.union(b).write.parquet(str(tmp_path / "t"))
    table = lambda: spark.read.parquet(str(tmp_path / "t"))
    assert key(table().filter("text = '[]'")) == key(table().filter("text = '[]'")) != key(table().filter("text = '[1]'"))


def test_stage_keys_tell_inputs_apart(spark, tmp_path):
    """Long lists, wide selects, rows given by the driver, subqueries, user functions: equal keys only for equal inputs."""
    def key(df):
        tables = StageTables(spark, str(tmp_path / "s"))
        tables.depends_on(df)
        return tables.key

    path = str(tmp_path / "t")
    spark.range(300).selectExpr("id", "cast(id as string) AS text").write.parquet(path)
    table = lambda: spark.read.parquet(path)
    listed = lambda last: table().filter(F.col("id").isin([*range(60), last]))
    wide = lambda last: table().select(*[(F.col("id") + i).alias(f"c{i}") for i in range(61)], F.lit(last).alias("last"))
    rows = lambda text: spark.createDataFrame([(1, text)], "id bigint, text string")
    united = lambda text: table().union(rows(text))
    nested = lambda text: table().filter(F.col("id").isin([1, 2])).join(rows(text).select("id"), "id", "left_semi").unionByName(rows(text).limit(0))

    def within(text):
        rows(text).createOrReplaceTempView("asked")
        table().createOrReplaceTempView("held")
        return spark.sql("SELECT * FROM held WHERE text IN (SELECT text FROM asked)")

    def applied(n):
        def run(batches):
            for batch in batches:
                yield batch.slice(0, n)

        return table().mapInArrow(run, "id bigint, text string")

    for make, a, b in [(listed, 100, 200), (wide, 1, 2), (united, "x", "y"), (within, "x", "y"), (applied, 1, 2), (rows, "x", "y")]:
        assert key(make(a)) == key(make(a)), make
        assert key(make(a)) != key(make(b)), make
    assert key(nested("x")) == key(nested("x"))
    assert key(table()) != key(table().withColumnRenamed("text", "name"))
    before = key(table())
    spark.range(5).selectExpr("id", "cast(id as string) AS text").write.mode("append").parquet(path)
    assert key(table()) != before


def test_a_changed_lookup_is_not_answered_from_old_tables(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    (raw / "a.csv").write_text("name,url\nAlone Inc,\nOther AG,\n")
    path = str(tmp_path / "known")
    spark.createDataFrame([("other", "other.com", "auto")], "ref_name string, ref_domain string, ref_industry string").write.parquet(path)

    def domains(domain):
        more = spark.createDataFrame([("alone", domain, "auto")], "ref_name string, ref_domain string, ref_industry string")
        master = run_pipeline(spark, str(raw), out, references=[spark.read.parquet(path).union(more)])
        return {r.primary_company_name: r.domain for r in master.collect()}

    assert domains("a.com") == {"ALONE": "a.com", "OTHER": "other.com"}
    assert domains("b.com") == {"ALONE": "b.com", "OTHER": "other.com"}


def test_serving_table_and_its_counts(spark, tmp_path):
    from firmweave.operators.standardize import harmonise, standardize, with_row_ids
    from firmweave.plans.pipeline import serving_table

    raw = spark.createDataFrame([("Bosch GmbH", "de"), ("Bosch AG", "de"), ("Alone Inc", "us")], "name string, country string")
    firms = standardize(with_row_ids(harmonise(raw, "csv"), "csv"))
    clusters = firms.withColumn("cluster_id", F.when(F.col("company_name").startswith("bosch"), "v_0").otherwise("v_1"))
    out = str(tmp_path / "out")
    golden = serving_table(spark, clusters, out)
    assert golden.count() == 2 and len(golden.columns) == 13
    serving_table(spark, clusters, out)
    lines = spark.read.json(f"{out}/metrics").select("metrics.*").collect()
    assert [(r.serving_input_clusters, r.serving_golden_records) for r in lines] == [(2, 2)] * 2
    assert len(list((tmp_path / "out" / "serving").iterdir())) == 1
