"""Dedup and silver cleaning on tiny in-memory bronze frames."""

import datetime as dt

from tidemark.operators import silver
from tidemark.operators.dedup import keep_first
from tidemark.sources import schemas


def _bronze(spark, table, rows):
    return spark.createDataFrame(rows, schemas.BRONZE[table])


def test_keep_first_is_deterministic(spark):
    df = spark.createDataFrame(
        [(1, None, "b"), (1, 2, "a"), (1, 2, None), (2, 3, "x"), (None, 1, "n"), (None, 0, "m")],
        "k int, a int, b string")
    got = sorted(keep_first(df, ["k"]).collect(), key=lambda r: (r.k is None, r.k))
    # ascending, NULLs last: a=2 wins over a=NULL; among a=2, b='a' wins over NULL
    assert [tuple(r) for r in got] == [(1, 2, "a"), (2, 3, "x"), (None, 0, "m")]


def test_keep_first_plans_partial_limit(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = keep_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


SALE = ["V1", "C1", "P1", "CH1", "2024-03-05", "2", "10.00", "10", "18.00", " Livré "]


def test_clean_sales_strict(spark):
    rows = [
        SALE,
        ["V1", "C1", "P1", "CH1", "2024-03-05", "2", "10.00", "10", "17.00", "LivrÃ©"],  # dup id
        ["V2", "C1", None, "CH1", "2024-03-05", "1", "5", "0", "5", "x"],               # null product
        ["V3", "C2", "P1", "CH1", "2024-03-06", "0", "5", "0", "5", "x"],               # qty 0
        ["V4", "C2", "P1", "CH1", "bad-date", "1", "5", None, "5", "EN COURS"],         # bad date kept
        ["V5", "C2", "P1", "CH1", "2024-03-06", "1", "5", "0", "-1", "x"],              # negative amount
        ["V6", "C2", "P1", "CH1", "2024-03-06", "x", "5", "0", "5", "x"],               # bad quantity
    ]
    out = {r.id_vente: r for r in silver.clean_sales(_bronze(spark, "sales", rows)).collect()}
    assert sorted(out) == ["V1", "V4"]
    v1 = out["V1"]
    assert v1.montant == 17.0 and v1.statut == "livré"          # smallest amount survives
    assert v1.montant_calc == 18.0 and v1.date == dt.date(2024, 3, 5)
    assert (v1.annee, v1.mois, v1.semaine, v1.trimestre) == (2024, 3, 10, 1)
    assert out["V4"].date is None and out["V4"].montant_calc is None


def test_clean_sales_basic(spark):
    rows = [SALE, ["V2", "C1", None, "CH1", "2024-03-05", "0", "5", None, "-5", "X"]]
    out = {r.id_vente: r for r in silver.clean_sales(_bronze(spark, "sales", rows), "basic").collect()}
    assert sorted(out) == ["V1", "V2"]
    assert out["V2"].remise_pct == 0.0 and out["V2"].statut == "x"
    assert "trimestre" not in silver.clean_sales(_bronze(spark, "sales", rows), "basic").columns


def test_clean_customers(spark):
    rows = [
        ["C1", " jean-pierre ", "ana maria", " A@B.COM ", "06 12 34", "MarrakÃ©ch", " Souss ", " vip ", " f ", "2020-01-02", "30"],
        ["C2", "x", "y", None, None, "Rabat", "R", "standard", "m", None, "40"],   # null email
        ["C3", "x", "y", "c@d", None, "FÃ\"s", "R", "Gold", "m", None, "15"],     # under 16
        ["C4", "x", "y", "e@f", None, "Rabat", "R", "PREMIUM", "m", None, None],    # age unknown
    ]
    out = {r.id_client: r for r in silver.clean_customers(_bronze(spark, "customers", rows)).collect()}
    assert sorted(out) == ["C1", "C4"]
    c1 = out["C1"]
    assert (c1.nom, c1.prenom, c1.email, c1.telephone) == ("Jean-pierre", "Ana Maria", "a@b.com", "061234")
    assert (c1.ville, c1.region, c1.segment, c1.genre, c1.age) == ("Marrakech", "Souss", "VIP", "F", 30)
    assert out["C4"].segment == "Premium"
    basic = silver.clean_customers(_bronze(spark, "customers", rows), "basic")
    assert basic.count() == 4


def test_clean_products(spark):
    rows = [
        ["P1", " Phone ", "Ã©lectronique", " Sam ", "1000.00", "600.00", "1.5", "10"],
        ["P2", "Mug", "Maison", "X", "0", "1", None, "1"],          # zero price: strict drops
        ["P3", "Pen", "A%olectronique", "Y", "99.99", "120.00", None, None],
    ]
    out = {r.id_produit: r for r in silver.clean_products(_bronze(spark, "products", rows)).collect()}
    assert sorted(out) == ["P1", "P3"]
    p1 = out["P1"]
    assert (p1.categorie, p1.nom_produit, p1.marque) == ("Électronique", "Phone", "Sam")
    assert (p1.marge, p1.marge_pct, p1.taux_marge_pct, p1.tranche_prix) == (400.0, 40.0, 40.0, "Haut")
    p3 = out["P3"]
    assert p3.marge_pct == -20.01 and p3.tranche_prix == "Bas"
    basic = {r.id_produit: r for r in silver.clean_products(_bronze(spark, "products", rows), "basic").collect()}
    assert basic["P2"].marge_pct is None  # division by a zero price gives NULL, not an error


def test_clean_returns_stocks_channels(spark):
    r = silver.clean_returns(_bronze(spark, "returns", [
        ["R1", "P1", "2024-01-02", "1", "9.5", "ArrivÃ© endommagÃ© ", "remboursÃ©"],
        [None, "P1", "2024-01-02", "1", "9.5", "x", "y"]])).collect()
    assert len(r) == 1 and r[0].motif == "Arrivé endommagé" and r[0].statut_retour == "remboursé"
    s = silver.clean_stocks(_bronze(spark, "stocks", [
        ["S1", "P1", "MarrakÃ©ch", "5", "5", "20", "2024-01-01"],
        ["S2", "P2", "Rabat", "50", "10", "20", "2024-01-01"],
        ["S3", None, "Rabat", "1", "0", "1", None]])).collect()
    flags = {x.id_stock: (x.depot, x.stock_net, x.en_rupture, x.sous_seuil) for x in s}
    assert flags == {"S1": ("Marrakech", 0, True, True), "S2": ("Rabat", 40, False, False)}
    c = silver.clean_channels(_bronze(spark, "channels", [
        ["CH1", " Magasin ", " Centre ", "FÃ\"s", "Nord"], ["CH1", "web", "Site", "N/A", "National"]])).collect()
    assert len(c) == 1 and c[0].type == "magasin" and c[0].nom == "Centre" and c[0].ville == "Fès"


def test_keep_first_with_a_hot_key(spark):
    """A third of the rows are copies of one key: one survivor, the first in order."""
    from pyspark.sql import functions as F

    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 1000).alias("v"), F.col("id").alias("seq")).repartition(8)
    out = keep_first(df, ["k"])
    rows = {r.k: r for r in out.collect()}
    assert len(rows) == 1 + (n - n // 3)
    hot = rows["HOT"]
    assert (hot.v, hot.seq) == (0, 0)  # smallest v, then smallest seq, among the copies
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
