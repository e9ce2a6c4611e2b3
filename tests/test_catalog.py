import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans.pipeline import PipelineError, run_pipeline
from tidemark.sources import fixtures
from tidemark.sources.sinks import list_layer, versions, write_catalog_table, write_table


@pytest.fixture
def schema(spark):
    name = f"tidemark_test_{os.urandom(4).hex()}"
    yield name
    for s in (name, *(f"{name}_{layer}" for layer in ("bronze", "silver", "gold"))):
        spark.sql(f"DROP SCHEMA IF EXISTS {s} CASCADE")


def files_below(path):
    return sorted(n for n in os.listdir(path) if not n.startswith("."))


def test_a_table_is_replaced_by_itself(spark, schema, tmp_path):
    name = f"{schema}.customers"
    assert write_catalog_table(spark.range(10).selectExpr("id", "'a' AS v"), name, path=str(tmp_path), audit_column=None) == (10, 0)
    for k in range(4):
        rows = spark.table(name)
        write_catalog_table(rows.where("id > 0").withColumn("id", F.col("id") - 1), name, path=str(tmp_path), audit_column=None)
        if k == 0:  # a read that began before the refresh goes on with the version that it began with
            assert rows.count() == 10
    assert sorted(r.id for r in spark.table(name).collect()) == [0, 1, 2, 3, 4, 5]
    kept = versions(spark, schema, "customers")
    assert len(kept) == 2 and files_below(tmp_path) == kept and list_layer(spark, schema) == ["customers"]


def test_schema_and_data_change_together(spark, schema, tmp_path):
    name = f"{schema}.t"
    write_catalog_table(spark.range(3).selectExpr("id", "'01' AS mois", "1 AS old"), name, ["mois"], str(tmp_path))
    assert spark.table(name).where("mois = '01'").count() == 3 and dict(spark.table(name).dtypes)["mois"] == "string"
    write_catalog_table(spark.range(2).selectExpr("CAST(id AS string) AS id", "true AS `a b`"), name, path=str(tmp_path), audit_column=None)
    assert spark.table(name).dtypes == [("id", "string"), ("a b", "boolean")]


def test_a_failing_write_leaves_the_old_rows(spark, schema, tmp_path):
    name = f"{schema}.t"
    write_catalog_table(spark.range(5), name, path=str(tmp_path), audit_column=None)
    half = spark.range(0, 1000, 1, 8).selectExpr("id", "assert_true(id < 900) AS x", "1 AS y")  # seven of eight tasks write
    with pytest.raises(Exception):
        write_catalog_table(half, name, path=str(tmp_path), audit_column=None)
    assert sorted(r.id for r in spark.table(name).collect()) == [0, 1, 2, 3, 4] and spark.table(name).columns == ["id"]
    assert len(versions(spark, schema, "t")) == 1 == len(files_below(tmp_path))


def test_a_plain_table_becomes_the_oldest_version(spark, schema, tmp_path):
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{tmp_path}/wh'")
    spark.range(3).write.option("path", f"{tmp_path}/plain").saveAsTable(f"{schema}.t")
    write_catalog_table(spark.table(f"{schema}.t").withColumn("x", F.lit(1)), f"{schema}.t", audit_column=None)
    assert spark.table(f"{schema}.t").columns == ["id", "x"] and spark.table(f"{schema}.t").count() == 3
    assert len(versions(spark, schema, "t")) == 2
    write_catalog_table(spark.table(f"{schema}.t"), f"{schema}.t", audit_column=None)
    assert len(versions(spark, schema, "t")) == 2 and len(files_below(f"{tmp_path}/wh")) == 2 and not os.path.exists(f"{tmp_path}/plain")


def test_ranges_of_files_do_not_overlap(spark, tmp_path):
    days = spark.range(5000).selectExpr("date_add(date'2020-01-01', CAST(id * 7919 % 400 AS int)) AS date", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would make one file
    try:
        assert write_table(days, f"{tmp_path}/t", audit_column=None, range_by="date") == 5000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = (spark.read.parquet(f"{tmp_path}/t").groupBy(F.col("_metadata.file_path")).agg(F.min("date").alias("a"), F.max("date").alias("b"))
             .orderBy("a").collect())
    assert len(files) > 1 and all(x.b < y.a for x, y in zip(files, files[1:]))
    for f in files:
        dates = [r.date for r in spark.read.parquet(f.file_path).collect()]
        assert dates == sorted(dates)


def status_of(report):
    return {(r.layer, r.table_name): r.status for r in report.collect()}


RETURNS = {("bronze", "returns"), ("silver", "returns"), ("gold", "return_rate")}


def test_a_mended_run_builds_only_what_depends_on_it(spark, sf_small, tmp_path):
    out = str(tmp_path)
    bronze = fixtures.bronze_tables(spark, sf_small)
    with pytest.raises(PipelineError) as e:
        run_pipeline(spark, bronze={**bronze, "returns": bronze["returns"].drop("motif")}, out=out)
    first = status_of(e.value.report)
    assert first["silver", "returns"].startswith("failed") and first["gold", "return_rate"] == "skipped: input failed"
    times = {p: os.path.getmtime(p) for p in (f"{out}/{layer}/{t}" for layer, t in first if os.path.exists(f"{out}/{layer}/{t}"))}
    # frames built anew over the same files count as the same input
    second = status_of(run_pipeline(spark, bronze=fixtures.bronze_tables(spark, sf_small), out=out, resume=True))
    assert {k for k, s in second.items() if s == "ok"} == RETURNS and set(second.values()) == {"ok", "kept"}
    written = {p for p, t in times.items() if os.path.getmtime(p) != t}
    assert written == {f"{out}/bronze/returns"}
    third = status_of(run_pipeline(spark, bronze=bronze, out=out, resume=True, as_of="2003-01-01"))
    assert {k for k, s in third.items() if s == "ok"} == {("gold", "customer_basket")}
    assert set(status_of(run_pipeline(spark, bronze=bronze, out=out, as_of="2003-01-01")).values()) == {"ok"}


def test_resume_sees_changed_files_and_lost_tables(spark, sf_small, tmp_path):
    import shutil

    bronze = fixtures.bronze_tables(spark, sf_small)
    path = fixtures.land_csv(spark, bronze["stocks"], f"{tmp_path}/stocks")
    stocks = lambda: spark.read.option("header", True).csv(path)
    out = f"{tmp_path}/out"
    run_pipeline(spark, bronze={**bronze, "stocks": stocks()}, out=out)
    fixtures.land_csv(spark, bronze["stocks"].limit(10), path)
    shutil.rmtree(f"{out}/gold/top_products")
    again = status_of(run_pipeline(spark, bronze={**bronze, "stocks": stocks()}, out=out, resume=True))
    assert {k for k, s in again.items() if s == "ok"} == {("bronze", "stocks"), ("silver", "stocks"), ("gold", "top_products")}


def test_pipeline_between_catalog_tables(spark, sf_small, schema, tmp_path):
    for name, df in fixtures.bronze_tables(spark, sf_small).items():
        write_catalog_table(df, f"{schema}.{name}", path=f"{tmp_path}/raw", audit_column=None)
    tables = {name: f"{schema}.{name}" for name in list_layer(spark, schema)}
    assert len(tables) == 6
    run = lambda **kw: run_pipeline(spark, bronze=tables, out=f"{tmp_path}/out", catalog=f"{schema}_", **kw)
    report = run().collect()
    assert all(r.status == "ok" and r.listed for r in report) and len(report) == 21
    assert spark.table(f"{schema}_gold.sales_daily").count() == next(r.rows for r in report if r.table_name == "sales_daily")
    assert list_layer(spark, f"{schema}_gold") == sorted(r.table_name for r in report if r.layer == "gold")
    spark.sql(f"DROP VIEW {schema}_gold.sales_daily")
    assert {k for k, s in status_of(run(resume=True)).items() if s == "ok"} == {("gold", "sales_daily")}
    # the raw table is replaced: its new version is another file set
    write_catalog_table(spark.table(f"{schema}.returns").limit(5), f"{schema}.returns", path=f"{tmp_path}/raw", audit_column=None)
    assert {k for k, s in status_of(run(resume=True)).items() if s == "ok"} == RETURNS
