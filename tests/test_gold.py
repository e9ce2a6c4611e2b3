"""Gold queries: invariants on the fixture tables and hand-checked small cases."""

from pyspark.sql import functions as F

from tidemark.functions.money import cents
from tidemark.operators import gold, silver
from tidemark.sources import fixtures, schemas


def _silver(spark, d):
    b = fixtures.bronze_tables(spark, d)
    return silver.silver_tables(b)


def _cents_total(df, col):
    return df.agg(F.sum(cents(col))).first()[0]


def test_revenue_invariant_across_gold(spark, sf_small):
    s = _silver(spark, sf_small)
    total = _cents_total(s["sales"], "montant")
    assert total > 0
    for df in [gold.sales_daily(s["sales"], s["channels"]),
               gold.sales_by_channel(s["sales"], s["channels"]),
               gold.sales_by_region(s["sales"], s["customers"]),
               gold.top_products(s["sales"], s["products"]),
               gold.sales_by_category(s["sales"], s["products"]),
               gold.customer_segments(s["sales"], s["customers"], s["channels"])]:
        assert _cents_total(df, "chiffre_affaires") == total


def test_share_rank_and_counts(spark, sf_small):
    s = _silver(spark, sf_small)
    share = gold.sales_by_channel(s["sales"], s["channels"]).groupBy("annee", "mois").agg(
        F.sum("part_ca_pct").alias("t")).collect()
    assert all(abs(r.t - 100) < 0.01 * 50 for r in share)
    tp = gold.top_products(s["sales"], s["products"])
    months = tp.select("annee", "mois").distinct().count()
    assert tp.filter("rang_ca = 1").select("annee", "mois").distinct().count() == months
    rr = gold.return_rate(s["sales"], s["returns"], s["products"])
    assert rr.agg(F.sum("nb_ventes")).first()[0] == s["sales"].count()


def _sales(spark, rows):
    b = spark.createDataFrame(rows, schemas.SALES)
    return silver.clean_sales(b)


def test_rank_ties_and_growth_gaps(spark):
    rows = [
        ["1", "C1", "A", "X", "2024-01-10", "1", "10", "0", "10", "x"],
        ["2", "C1", "B", "X", "2024-01-11", "2", "5", "0", "10", "x"],
        ["3", "C2", "C", "X", "2024-01-12", "1", "4", "0", "4", "x"],
        ["4", "C1", "A", "X", "2024-02-10", "1", "20", "0", "20", "x"],
        ["5", "C1", "A", "X", "2024-04-10", "1", "30", "0", "30", "x"],
    ]
    s = _sales(spark, rows)
    p = silver.clean_products(spark.createDataFrame(
        [["A", "a", "cat", "m", "10", "5", None, None], ["B", "b", "cat", "n", "10", "5", None, None]],
        schemas.PRODUCTS))
    tp = {(r.id_produit, r.mois): (r.rang_ca, r.rang_quantite) for r in gold.top_products(s, p).collect()}
    assert tp[("A", 1)] == (1, 2) and tp[("B", 1)] == (1, 1) and tp[("C", 1)] == (3, 2)
    g = {r.mois: r for r in gold.category_growth(s, p).filter("categorie = 'cat'").collect()}
    assert g[2].ca_mois_prec == 20.0 and g[2].croissance_mom_pct == 0.0
    assert g[4].ca_mois_prec == 20.0 and g[4].croissance_mom_pct == 50.0
    cal = {r.mois: r for r in gold.category_growth(s, p, calendar=True).filter("categorie = 'cat'").collect()}
    assert cal[2].croissance_mom_pct == 0.0 and cal[4].ca_mois_prec is None and cal[4].croissance_mom_pct is None
    # product C is not in the catalogue: its sales form a NULL-category group
    assert gold.category_growth(s, p).filter("categorie IS NULL").count() == 1


def test_customer_basket_recency_and_bands(spark):
    rows = [[str(i), "C1", "A", "X", f"2024-01-{i:02d}", "1", "10", "0", "10", "x"] for i in range(1, 11)]
    rows.append(["99", "C2", "A", "X", "2024-12-31", "1", "10", "0", "10", "x"])
    s = _sales(spark, rows)
    cu = silver.clean_customers(spark.createDataFrame(
        [["C1", "n", "p", "e@x", None, "Rabat", "R", "vip", "f", None, "30"]], schemas.CUSTOMERS))
    out = {r.id_client: r for r in gold.customer_basket(s, cu, as_of="2025-01-01").collect()}
    assert out["C1"].frequence_cat == "Très fréquent" and out["C1"].recence_jours == 357
    assert out["C1"].segment == "VIP" and out["C2"].segment is None and out["C2"].frequence_cat == "Unique"


def test_bucketed_rank_matches_window(spark, sf_small):
    from pyspark.sql import Window

    s = _silver(spark, sf_small)
    small = gold.top_products(s["sales"], s["products"], buckets=7)
    w = Window.partitionBy("annee", "mois")
    ref = gold._product_month(s["sales"], s["products"]).withColumns({
        "r1": F.rank().over(w.orderBy(F.col("chiffre_affaires").desc_nulls_last())),
        "r2": F.rank().over(w.orderBy(F.col("total_quantite_vendue").desc_nulls_last()))})
    key = ["id_produit", "annee", "mois"]
    joined = small.join(ref.select(*key, "r1", "r2"), key)
    assert joined.count() == ref.count()
    assert joined.filter("rang_ca <> r1 OR rang_quantite <> r2").count() == 0


def test_approx_distinct_close_to_exact(spark, sf_small):
    s = _silver(spark, sf_small)["sales"]
    exact = {(r.annee, r.mois): r.clients_uniques for r in gold.distinct_customers(s).collect()}
    approx = {(r.annee, r.mois): r.clients_uniques for r in gold.distinct_customers(s, 0.01).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= max(2, 0.05 * exact[k]) for k in exact)


def test_bucketed_rank_with_heavy_ties(spark):
    from pyspark.sql import Window

    from tidemark.operators.ranking import group_rank

    # two thirds of a group share a value
    rows = [(m, m * 1000 + i, float(1 if i % 3 else i % 7), None if i == 5 else i % 4)
            for m in (1, 2) for i in range(300)]
    rows += [(None, 5000 + i, float(i % 5), i) for i in range(20)]
    df = spark.createDataFrame(rows, "m int, id int, x double, y int")
    got = group_rank(df, ["m"], {"rx": "x", "ry": "y"}, buckets=10).alias("g")
    w = Window.partitionBy("m")
    ref = df.withColumns({"ex": F.rank().over(w.orderBy(F.col("x").desc_nulls_last())),
                          "ey": F.rank().over(w.orderBy(F.col("y").desc_nulls_last()))}).alias("r")
    j = got.join(ref, F.col("g.id") == F.col("r.id")).select("g.rx", "g.ry", "r.ex", "r.ey")
    assert j.count() == df.count()
    assert j.filter("rx <> ex OR ry <> ey").count() == 0


def test_empty_input_gives_empty_results(spark):
    empty = silver.clean_sales(spark.createDataFrame([], schemas.SALES))
    ch = silver.clean_channels(spark.createDataFrame([], schemas.CHANNELS))
    pr = silver.clean_products(spark.createDataFrame([], schemas.PRODUCTS))
    assert gold.sales_by_channel(empty, ch).count() == 0
    assert gold.top_products(empty, pr).count() == 0
    assert gold.category_growth(empty, pr).count() == 0


def test_null_amounts_in_basic_profile(spark):
    rows = [["1", "C1", "A", "X", "2024-01-10", "1", "10", None, "10.00", "x"],
            ["2", "C1", "A", "X", "2024-01-11", "1", "10", None, None, "x"],
            ["3", "C1", "A", "X", "2024-01-12", "1", "10", None, "abc", "x"]]
    s = silver.clean_sales(spark.createDataFrame(rows, schemas.SALES), "basic")
    s = s.withColumn("trimestre", F.quarter("date"))
    ch = silver.clean_channels(spark.createDataFrame([["X", "web", "n", "v", "r"]], schemas.CHANNELS))
    r = gold.sales_by_channel(s, ch).first()
    # three orders, one amount: the basket average is over the known amount only
    assert (r.nb_commandes, r.chiffre_affaires, r.panier_moyen, r.part_ca_pct) == (3, 10.0, 10.0, 100.0)


def test_basic_profile_pipeline_fails_loudly(spark, sf_small):
    import pytest

    from tidemark.plans.pipeline import PipelineError, run_pipeline

    # basic products carry no price band, so the product ranking cannot be
    # built; the calendar columns are derived from the date by gold itself
    with pytest.raises(PipelineError) as err:
        run_pipeline(spark, sf_small, profile="basic", as_of="2002-01-01")
    assert err.value.failed == ["gold.top_products"]
    report = {r.table_name: r.status for r in err.value.report.collect()}
    assert report["sales_daily"] == "ok" and report["top_products"].startswith("failed")


def test_sales_daily_ordered(spark, sf_small):
    s = _silver(spark, sf_small)
    rows = gold.sales_daily(s["sales"], s["channels"], ordered=True).select("date", "id_canal").collect()
    key = [(r.date is not None, r.date, r.id_canal) for r in rows]
    assert len(rows) > 100 and key == sorted(key)


def test_dealt_measures_count_what_is_there(spark):
    """Missing ids, amounts and keys, and amounts beyond a bigint of cents (counted, but of no cents)."""
    rows = [("1", "a", "p", "k", 2, 10.0), (None, "a", "p", "k", None, None), ("3", "a", None, "k", 3, 1e20),
            ("4", None, "q", None, 1, 2.5), (None, None, "q", None, 1, 2.0)]
    sales = spark.createDataFrame(rows, "id_vente string, id_client string, id_produit string, id_canal string, quantite int, montant double")
    sales = sales.selectExpr("*", "date'2024-03-01' date", "2024 annee", "3 mois")
    for frame, keys in ((gold._measured(sales, "id_canal", "annee", "mois"), ["id_canal", "annee", "mois"]),
                        (gold._measured(sales, "id_client", "annee"), ["id_client", "annee"])):
        got = frame.groupBy(*keys).agg(*gold._dealt_measures())
        plain = sales.groupBy(*keys).agg(*gold._partial_measures())
        assert got.schema == plain.schema and sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    customers = spark.createDataFrame([("a", "VIP", "v", "r")], "id_client string, segment string, ville string, region string")
    for tasks in (None, 3):
        got = {r.id_client: r for r in gold.customer_basket(sales, customers, "2024-04-01", tasks).collect()}
        a, none = got["a"], got[None]
        assert (a.nb_commandes, a.nb_produits_distincts, a.total_articles, a.total_depenses) == (2, 1, 5, 10.0)
        assert (a.min_commande, a.max_commande, a.segment, a.recence_jours) == (10.0, 10.0, "VIP", 31)
        assert (none.nb_commandes, none.nb_produits_distincts, none.total_depenses, none.segment) == (1, 1, 4.5, None)


def test_counted_sales_make_the_same_days(spark, sf_small):
    s = _silver(spark, sf_small)
    plain, counted = (gold.sales_daily(x, s["channels"]) for x in (s["sales"], gold.counted(s["sales"])))
    assert plain.schema == counted.schema and sorted(map(str, plain.collect())) == sorted(map(str, counted.collect()))
