"""File sources, sinks and the end-to-end pipeline report."""

import json
import os

import pytest

from tidemark.plans.pipeline import run_pipeline
from tidemark.session import new_run_dir
from tidemark.sources import files
from tidemark.sources.sinks import write_table


def test_csv_ingest_declared_schema(spark):
    d = new_run_dir(spark, "test-csv")
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/channels.csv", "w", encoding="utf-8") as f:
        f.write("id_canal,type,nom,ville,region\n")
        f.write("CH01,magasin,Magasin Centre,Casablanca,Grand Casablanca\n")
        f.write("CH02,web,Site,0612,National\n")
        f.write('CH03,"unterminated\n')
    df = files.ingest_csv(spark, "channels", d)
    rows = {r.id_canal: r for r in df.collect()}
    assert rows["CH02"].ville == "0612"                 # text kept, no inference
    assert rows["CH01"]._source_file.endswith("channels.csv")
    assert "_corrupt_record" in df.columns


def test_json_nested_and_envelope(spark):
    d = new_run_dir(spark, "test-json")
    os.makedirs(f"{d}/a", exist_ok=True)
    os.makedirs(f"{d}/b", exist_ok=True)
    with open(f"{d}/a/feed.json", "w") as f:
        f.write(json.dumps({"id": 1, "title": " T ", "category": " Men ", "price": 9.5,
                            "rating": {"rate": 3.9, "count": 120}, "flag": True, "x": None}) + "\n")
        f.write("{not json\n")
    nested = files.ingest_json(spark, f"{d}/a")
    from tidemark.operators.silver import clean_feed_flat, clean_feed_nested
    rows = clean_feed_nested(nested).collect()
    ok = [r for r in rows if r.id == 1][0]
    assert (ok.title, ok.category, ok.price, ok.rating_rate, ok.rating_count) == ("T", "men", 9.5, 3.9, 120)
    with open(f"{d}/b/page.json", "w") as f:
        json.dump({"products": [{"id": 1, "title": "A", "brand": "B", "price": 1.5, "rating": 4.5, "stock": 3},
                                {"id": 2, "title": "C", "brand": None, "price": 2, "rating": 4, "stock": 0}]}, f)
    flat = clean_feed_flat(files.ingest_json_envelope(spark, f"{d}/b")).collect()
    assert sorted((r.id, r.price, r.stock) for r in flat) == [(1, 1.5, 3), (2, 2.0, 0)]


def test_write_table_counts_once(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS annee", "id % 3 AS mois")
    path = new_run_dir(spark, "test-sink")
    assert write_table(df, path, partition_by=["annee", "mois"]) == 1000
    back = spark.read.parquet(path)
    assert back.count() == 1000 and set(back.columns) >= {"annee", "mois", "_updated_at"}


def test_pipeline_report(spark, sf_small):
    report = {(r.layer, r.table_name): r for r in run_pipeline(spark, sf_small, as_of="2002-01-01").collect()}
    assert len(report) == 25 and all(r.status == "ok" for r in report.values())
    assert report[("silver", "channels")].rows == 10
    assert report[("bronze", "sales")].rows == 6000 and report[("bronze", "feed_flat")].corrupt_rows == 0
    assert report[("silver", "sales_enriched")].rows == report[("silver", "sales")].rows


def test_landing_stream_exactly_once(spark):
    from tidemark.streaming import run_landing_once

    root = new_run_dir(spark, "test-stream")
    os.makedirs(f"{root}/in", exist_ok=True)
    hdr = "id_canal,type,nom,ville,region\n"
    with open(f"{root}/in/a.csv", "w") as f:
        f.write(hdr + "CH01,web,A,X,Y\nCH02,web,B,X,Y\n")
    assert run_landing_once(spark, "channels", f"{root}/in", f"{root}/out", f"{root}/ck") == 2
    assert run_landing_once(spark, "channels", f"{root}/in", f"{root}/out", f"{root}/ck") == 0
    with open(f"{root}/in/b.csv", "w") as f:
        f.write(hdr + "CH03,magasin,C,X,Y\n")
    assert run_landing_once(spark, "channels", f"{root}/in", f"{root}/out", f"{root}/ck") == 1
    out = spark.read.parquet(f"{root}/out")
    assert sorted(r.id_canal for r in out.collect()) == ["CH01", "CH02", "CH03"]


def test_golden_sample_rows_through_csv_and_silver(spark):
    """A few sample catalogue / channel rows, as shipped with the original data."""
    from decimal import ROUND_HALF_UP, Decimal

    from tidemark.operators.silver import clean_channels, clean_products

    d = new_run_dir(spark, "test-golden")
    os.makedirs(f"{d}/products", exist_ok=True)
    os.makedirs(f"{d}/channels", exist_ok=True)
    products = [
        ("PRD0001", "Smartphone Samsung", "Électronique", "Samsung", "3673.01", "1576.41", "7.62", "281"),
        ("PRD0002", "Smartphone Apple", "Électronique", "Apple", "4055.79", "2258.85", "1.34", "375"),
        ("PRD0003", "Smartphone Lenovo", "Électronique", "Lenovo", "502.43", "311.13", "14.14", "185"),
        ("PRD0004", "Smartphone Sony", "Électronique", "Sony", "310.6", "178.61", "1.7", "443"),
    ]
    with open(f"{d}/products/products.csv", "w", encoding="utf-8") as f:
        f.write("id_produit,nom_produit,categorie,marque,prix,prix_achat,poids_kg,stock_initial\n")
        f.writelines(",".join(r) + "\n" for r in products)
    with open(f"{d}/channels/channels.csv", "w", encoding="utf-8") as f:
        f.write("id_canal,type,nom,ville,region\n")
        f.write("CH01,magasin,Magasin Centre-Ville,Casablanca,Grand Casablanca\n")
        f.write("CH03,magasin,Magasin Hay Riad,Rabat,Rabat-Salé-Kénitra\n")
        f.write("CH04,web,Site E-commerce,N/A,National\n")

    got = {r.id_produit: r for r in clean_products(files.ingest_csv(spark, "products", f"{d}/products")).collect()}
    for pid, _, cat, brand, prix, achat, _, stock in products:
        p, a = Decimal(prix), Decimal(achat)
        pct = ((p - a) / p * 100).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        band = "Bas" if p < 100 else "Moyen" if p < 500 else "Haut" if p < 2000 else "Premium"
        r = got[pid]
        assert (r.categorie, r.marque, r.stock_initial) == (cat, brand, int(stock))
        assert r.marge == float(p - a) and r.marge_pct == float(pct) and r.taux_marge_pct == float(pct)
        assert r.tranche_prix == band
    ch = {r.id_canal: r for r in clean_channels(files.ingest_csv(spark, "channels", f"{d}/channels")).collect()}
    assert ch["CH03"].region == "Rabat-Salé-Kénitra" and ch["CH04"].type == "web" and ch["CH04"].ville == "N/A"


def _bronze_as_text(spark, sf_dir, name):
    from pyspark.sql import functions as F

    from tidemark.sources import fixtures

    b = fixtures.BRONZE_BUILDERS[name](spark, sf_dir)
    return b.select(*[F.col(c).cast("string").alias(c) for c in b.columns])


def test_csv_ingest_queries_keep_every_value(spark, sf_small):
    from tidemark.plans.catalog import QUERIES

    expected = _bronze_as_text(spark, sf_small, "sales")
    for key in ("ingest_csv", "ingest_csv_incremental"):
        got = QUERIES[key](spark, sf_small).select(*expected.columns)
        assert got.count() == expected.count()
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_repair_mojibake_matches_python_redecode(spark, sf_small):
    from tidemark.plans.catalog import QUERIES

    def brute(s):
        if s is None:
            return None
        try:
            raw = s.encode("cp1252")
        except UnicodeEncodeError:
            try:
                raw = s.encode("latin-1")
            except UnicodeEncodeError:
                return s
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return s

    rows = QUERIES["repair_mojibake"](spark, sf_small).select("motif", "motif_repare").distinct().collect()
    assert len(rows) == 2
    for r in rows:
        assert r.motif_repare == brute(r.motif)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_columns_bind_by_name(spark, tmp_path):
    from tidemark.sources import schemas

    _write(f"{tmp_path}/a/x.csv", "ville,nom,extra,id_canal\nRabat,Site,9,CH01\n")
    row = files.ingest_csv(spark, "channels", f"{tmp_path}/a").first()
    assert (row.id_canal, row.nom, row.ville, row.type, row.region) == ("CH01", "Site", "Rabat", None, None)
    assert row._corrupt_record is None
    found = files.csv_columns(spark, f"{tmp_path}/a")
    assert files.header_difference(found, schemas.CHANNELS) == (["type", "region"], ["extra"])


def test_csv_files_of_one_folder_in_another_order_fail_loudly(spark, tmp_path):
    _write(f"{tmp_path}/x.csv", "id_canal,type,nom,ville,region\n1,2,3,4,5\n")
    _write(f"{tmp_path}/y.csv", "id_canal,nom,type,ville,region\n1,3,2,4,5\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.ingest_csv(spark, "channels", str(tmp_path)).collect()


def test_corrupt_lines_and_documents_are_kept_counted_and_left_out(spark, tmp_path, sf_small):
    from tidemark.operators.silver import clean_channels, clean_feed_flat
    from tidemark.sources import fixtures
    from tidemark.sources.sinks import write_counted

    _write(f"{tmp_path}/c/x.csv", "id_canal,type,nom,ville,region\nCH01,web,a,b,c\nCH02,short\nCH03,web,a,b,c,long\n")
    bronze = files.ingest_csv(spark, "channels", f"{tmp_path}/c")
    assert write_counted(bronze, f"{tmp_path}/out/channels", audit_column=None) == (3, 2)
    assert [r.id_canal for r in clean_channels(bronze).collect()] == ["CH01"]
    good = json.dumps({"products": [{"id": 1, "title": "A"}, {"id": 2, "title": "B"}]})
    _write(f"{tmp_path}/f/good.json", good)
    _write(f"{tmp_path}/f/bad.json", '{"products": [{"id": 3,')
    _write(f"{tmp_path}/f/none.json", '{"products": []}')
    feed = files.ingest_json_envelope(spark, f"{tmp_path}/f")
    rows = feed.collect()
    assert sorted((r.id or "", bool(r._corrupt_record)) for r in rows) == [("", True), ("1", False), ("2", False)]
    assert sorted(r.id for r in clean_feed_flat(feed).collect()) == [1, 2]
    tables = {**fixtures.bronze_tables(spark, sf_small), "channels": bronze, "feed_flat": feed}
    report = {(r.layer, r.table_name): r for r in run_pipeline(spark, bronze=tables, out=f"{tmp_path}/p").collect()}
    assert report["bronze", "channels"].corrupt_rows == 2 and report["bronze", "feed_flat"].corrupt_rows == 1
    assert report["silver", "channels"].rows == 1 and report["silver", "feed_flat"].rows == 2


def test_failing_rewrite_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_table(spark.range(5), path)
    bad = spark.range(9).selectExpr("id", "assert_true(id < 7) AS x", "1 AS y")
    with pytest.raises(Exception):
        write_table(bad, path)
    assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_path) == ["t"]
    write_table(spark.range(6), path)
    assert spark.read.parquet(path).count() == 6 and os.listdir(tmp_path) == ["t"]


def test_failed_tables_are_reported_with_their_message(spark, sf_small, tmp_path):
    from tidemark.plans.pipeline import PipelineError
    from tidemark.sources import fixtures

    bronze = fixtures.bronze_tables(spark, sf_small)
    bronze["channels"] = bronze["channels"].drop("nom")
    with pytest.raises(PipelineError) as e:
        run_pipeline(spark, bronze=bronze, out=str(tmp_path))
    status = {(r.layer, r.table_name): r.status for r in e.value.report.collect()}
    assert "nom" in status["silver", "channels"] and status["gold", "sales_daily"].startswith("skipped")
    assert status["silver", "sales"] == "ok" and status["gold", "top_products"] == "ok"


def test_catalog_tables(spark, tmp_path):
    from tidemark.sources.sinks import list_layer, write_catalog_table

    df = spark.range(10).selectExpr("id", "id % 2 AS annee")
    for n in (10, 4):
        write_catalog_table(df.limit(n), "tidemark_test.sales", ["annee"], path=f"{tmp_path}/sales")
    try:
        assert spark.table("tidemark_test.sales").count() == 4 and list_layer(spark, "tidemark_test") == ["sales"]
    finally:
        spark.sql("DROP SCHEMA tidemark_test CASCADE")


def test_landing_checkpoints_by_source_and_target(spark, tmp_path):
    from tidemark.streaming.landing import run_landing_once

    _write(f"{tmp_path}/in/a.csv", "nom,id_canal\nx,1\ny,2\n")
    assert run_landing_once(spark, "channels", f"{tmp_path}/in", f"{tmp_path}/one") == 2
    assert run_landing_once(spark, "channels", f"{tmp_path}/in", f"{tmp_path}/two") == 2
    _write(f"{tmp_path}/in/b.csv", "nom,id_canal\nz,3\n")
    assert run_landing_once(spark, "channels", f"{tmp_path}/in", f"{tmp_path}/one") == 1
    assert {r.nom for r in spark.read.parquet(f"{tmp_path}/one").collect()} == {"x", "y", "z"}


def test_scratch_folder_on_a_plain_session(spark, monkeypatch):
    from tidemark import session

    class Plain:  # a session without the setting
        def __init__(self, master):
            self.sparkContext = self
            self.master, self.dir = master, None

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    assert os.path.isdir(session.scratch_dir(Plain("local[2]")))
    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        with pytest.raises(RuntimeError, match="checkpoint"):
            session.scratch_dir(Plain(master))


def test_lineage_folder_without_a_pattern(spark):
    """The folder of each file; a pattern that ends in [^/]+$ was tried from every character of the path."""
    from tidemark.plans.catalog import _lineage

    paths = ["file:/a/b/sales/part-0.csv", "hdfs://h/x/products/y.csv", "file:/top/z"]
    df = spark.createDataFrame([(p, 0) for p in paths], "_source_file string, _ingested_at int")
    got = _lineage(df)
    assert [r.source for r in got.collect()] == [r[0] for r in df.selectExpr("regexp_extract(_source_file, '([^/]+)/[^/]+$', 1)").collect()]
    assert "regexp" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_tables_dealt_once_are_those_dealt_by_month(spark, tmp_path, monkeypatch):
    """Odd sales (no date, no channel, an unknown one, all of one day) with few channels, and as if there were many."""
    from tidemark.plans import pipeline
    from tidemark.sources import schemas

    day = lambda i: None if i % 13 == 0 else "2024-03-05" if i % 3 == 0 else f"2023-{i % 12 + 1:02}-{i % 28 + 1:02}"
    sales = [(str(i % 380), f"c{i % 7}", f"p{i % 5}", None if i % 11 == 0 else f"k{i % 6}", day(i), str(i % 4), "2.50",
              None if i % 2 else "10", f"{i % 9}.25", "livré") for i in range(400)]
    channels = [(f"k{i}", "web", f"n{i}", None, "r") for i in range(5)] + [(None, "web", "none", "v", "r")]
    bronze = {name: spark.createDataFrame({"sales": sales, "channels": channels}.get(name, []), schema)
              for name, schema in schemas.BRONZE.items()}
    tables, files = {}, {}
    for limit in (pipeline.BROADCAST_BYTES, 0):
        monkeypatch.setattr(pipeline, "BROADCAST_BYTES", limit)
        out = f"{tmp_path}/{limit}"
        run_pipeline(spark, bronze=bronze, out=out, as_of="2024-06-01")
        for name in ("gold/sales_daily", "silver/sales_enriched"):
            df = spark.read.parquet(f"{out}/{name}").drop("_updated_at")
            tables[limit, name] = (df.columns, sorted(map(str, df.collect())))
            files[limit, name] = len(df.inputFiles())
    for name in ("gold/sales_daily", "silver/sales_enriched"):
        (few, many), months = (tables[x, name] for x in sorted({k[0] for k in tables})), 14
        assert few == many and len(few[1]) > 50
        assert all(n <= months + spark.sparkContext.defaultParallelism for (_, table), n in files.items() if table == name)


def test_pipeline_leaves_no_shuffle_files(spark, tmp_path):
    """Shuffle files are deleted with the query that made them, not when the driver happens to collect its garbage."""
    import time

    from tidemark.session import CLEANUP_CONF
    from tidemark.sources import schemas

    def shuffles():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {os.path.basename(f) for f in found.split("\n") if "shuffle_" in f}

    sales = [(str(i), f"c{i % 7}", f"p{i % 5}", f"k{i % 3}", f"2023-{i % 12 + 1:02}-03", "2", "2.50", None, "5.00", "livré") for i in range(200)]
    bronze = {name: spark.createDataFrame(sales if name == "sales" else [], schema) for name, schema in schemas.BRONZE.items()}
    before, conf = shuffles(), spark.conf.get(CLEANUP_CONF, None)
    run_pipeline(spark, bronze=bronze, out=str(tmp_path), as_of="2024-06-01")
    until = time.time() + 10
    while shuffles() - before and time.time() < until:  # deleted in the background
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(CLEANUP_CONF, None) == conf
