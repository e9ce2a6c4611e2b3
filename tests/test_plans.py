"""Plan-shape guarantees the scale design relies on."""

import os
import re

from tidemark.operators import gold, silver
from tidemark.sources import fixtures


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _silver(spark, d, *names):
    return [silver.CLEANERS[n](fixtures.BRONZE_BUILDERS[n](spark, d)) for n in names]


def test_month_share_is_aggregate_not_window(spark, sf_small):
    sales, channels = _silver(spark, sf_small, "sales", "channels")
    plan = _physical(gold.sales_by_channel(sales, channels))
    window_lines = [line for line in plan.splitlines() if re.search(r"\bWindow \[", line)]
    assert not any("sum(" in line for line in window_lines)
    assert "BroadcastExchange" in plan or "BroadcastHashJoin" in plan


def test_sales_pre_aggregated_before_dimension_joins(spark, sf_small):
    sales, customers, channels = _silver(spark, sf_small, "sales", "customers", "channels")
    plan = _optimized(gold.sales_by_region(sales, customers))
    assert re.search(r"Aggregate \[id_client#\d+, annee#\d+, mois#\d+\]", plan)
    plan = _optimized(gold.customer_segments(sales, customers, channels))
    assert re.search(r"Aggregate \[id_client#\d+, type#\d+, annee#\d+, mois#\d+\]", plan)
    # no pre-aggregate that keeps nearly every row
    assert not re.search(r"Aggregate \[id_client#\d+, id_canal#\d+, annee#\d+, mois#\d+\]", plan)


def test_category_aggregates_after_the_join(spark, sf_small):
    sales, products = _silver(spark, sf_small, "sales", "products")
    plan = _optimized(gold.category_growth(sales, products))
    assert not re.search(r"Aggregate \[id_produit#\d+, id_client#\d+", plan)
    assert re.search(r"Aggregate \[categorie#\d+, annee#\d+, mois#\d+, id_client#\d+\]", plan)


def test_ranks_never_window_a_whole_month(spark, sf_small):
    sales, products = _silver(spark, sf_small, "sales", "products")
    plan = _physical(gold.top_products(sales, products))
    assert "BroadcastExchange" not in "".join(re.findall(r".*\bHint.*", plan))
    assert not re.search(r"rank\(", plan)
    assert re.search(r"hashpartitioning\(annee#\d+, mois#\d+, _bk#\d+", plan)


def test_ranking_does_not_carry_the_products(spark, sf_small, monkeypatch):
    ranked = []
    monkeypatch.setattr(gold, "group_rank", lambda df, *a, rank=gold.group_rank: ranked.append(df.columns) or rank(df, *a))
    out = gold.top_products(*_silver(spark, sf_small, "sales", "products"))
    assert ranked and not {"nom_produit", "categorie", "marque", "tranche_prix"} & set(ranked[0])
    assert out.columns == ["id_produit", "nom_produit", "categorie", "marque", "tranche_prix", "annee", "mois", "nb_commandes", "total_quantite_vendue",
                           "chiffre_affaires", "panier_moyen", "rang_ca", "rang_quantite"]


def test_distinct_customers_without_expand(spark, sf_small):
    (sales,) = _silver(spark, sf_small, "sales")
    assert "Expand" not in _optimized(gold.distinct_customers(sales))


def test_validation_reads_sales_once(spark, sf_small):
    from tidemark.operators import quality

    plan = _optimized(quality.validate_layers(fixtures.bronze_tables(spark, sf_small)))
    # lineitem feeds three tables (sales, returns, stocks), each read once
    assert len(re.findall(r"Relation \[l_orderkey#", plan)) == 3 and len(re.findall(r"Relation \[o_orderkey#", plan)) == 1


def test_validation_does_not_join_the_counted_values(spark, sf_small):
    from tidemark.operators import quality

    plan = _optimized(quality.validate_layers(fixtures.bronze_tables(spark, sf_small)))
    assert not re.search(r"Join .*\bvalue#", plan)


def test_tasks_of_line_items_follow_the_size_of_the_files(spark, sf_small, monkeypatch):
    monkeypatch.setattr(fixtures, "TASK_BYTES", 10_000)
    size = {t: os.path.getsize(f"{sf_small}/{t}.parquet") for t in ("lineitem", "orders")}
    both, lines = -(-sum(size.values()) // 10_000), -(-size["lineitem"] // 10_000)
    plan = _physical(fixtures.bronze_sales(spark, sf_small))
    assert len(re.findall(rf"hashpartitioning\([lo]_orderkey#\d+L, {both}\)", plan)) == 2 == plan.count("hashpartitioning")
    plan = _physical(fixtures.bronze_stocks(spark, sf_small))
    assert re.search(rf"hashpartitioning\(l_partkey#\d+L, l_suppkey#\d+L, {lines}\)", plan) and plan.count("hashpartitioning") == 1


def test_scans_are_pruned_and_filtered(spark, sf_small):
    (sales,) = _silver(spark, sf_small, "sales")
    scans = [line for line in _physical(sales).splitlines() if "FileScan parquet" in line]
    lineitem = [s for s in scans if "lineitem" in s][0]
    assert "l_tax" not in lineitem and "l_shipdate" not in lineitem
    assert "PushedFilters: [IsNotNull(l_orderkey)" in lineitem


def test_dimension_joins_carry_no_broadcast_hint(spark, sf_small):
    sales, products = _silver(spark, sf_small, "sales", "products")
    plan = gold.sales_by_category(sales, products)._jdf.queryExecution().analyzed().toString()
    assert "BROADCAST" not in plan.upper().replace("BROADCASTHASHJOIN", "")


def test_hot_key_row_join_is_split_by_aqe(spark):
    """A fact key holding a third of the rows: AQE splits the skewed join partition."""
    from pyspark.sql import functions as F

    from tidemark.operators.enrich import enrich_sales

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        sales = spark.range(n).select(
            F.col("id").cast("string").alias("id_vente"),
            F.when(F.col("id") % 3 == 0, F.lit("HOT"))
            .otherwise((F.col("id") % 997).cast("string")).alias("id_canal"),
            F.lit(1.0).alias("montant"))
        channels = spark.range(997).select(
            F.col("id").cast("string").alias("id_canal"), F.lit("web").alias("type"),
            F.lit("n").alias("nom"), F.lit("v").alias("ville"), F.lit("r").alias("region"))
        channels = channels.unionByName(channels.limit(1).withColumn("id_canal", F.lit("HOT")))
        out = enrich_sales(sales, channels)
        rows = out.collect()  # runs this plan, so its adaptive plan is final
        assert len(rows) == n and sum(r.type == "web" for r in rows) == n
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_daily_and_enriched_sales_are_dealt_once(spark, sf_small, monkeypatch):
    from pyspark.sql import functions as F

    from tidemark.operators.enrich import enrich_sales
    from tidemark.plans.pipeline import DEALS
    from tidemark.sources.sinks import _prepared, materialize

    monkeypatch.setattr(fixtures, "TASK_BYTES", 10_000)
    sales, channels = (materialize(df, "dealt") for df in _silver(spark, sf_small, "sales", "channels"))
    for name, build, deal in (("sales_daily", gold.sales_daily, "rangepartitioning(date"),
                              ("sales_enriched", enrich_sales, "hashpartitioning(annee")):
        made = build(DEALS[name](sales), F.broadcast(channels))
        plan = _physical(_prepared(made, ["annee", "mois"], "_updated_at", dealt=True))
        assert len(re.findall(r"(?<!Broadcast)Exchange ", plan)) == 1 and deal in plan, plan


def test_distinct_counts_deal_the_sales_once(spark, sf_small, monkeypatch):
    from pyspark.sql import functions as F

    from tidemark.sources.sinks import materialize

    monkeypatch.setattr(gold, "materialize", lambda df, label: made.append(df) or materialize(df, label))
    made = []
    sales, channels, customers = (materialize(df, "dealt") for df in _silver(spark, sf_small, "sales", "channels", "customers"))
    for tasks, kind in ((None, r"\d+\), REPARTITION_BY_COL"), (5, r"5\), REPARTITION_BY_NUM")):
        gold.sales_by_channel(sales, channels, tasks=tasks)
        basket = gold.customer_basket(sales, F.broadcast(customers), "2024-06-01", tasks=tasks)
        for plan, keys in ((_physical(made[-1]), r"id_canal#\d+, annee#\d+, mois#\d+"), (_physical(basket), r"id_client#\d+, annee#\d+")):
            assert re.search(rf"hashpartitioning\({keys}, {kind}", plan), plan
            assert plan.count("hashpartitioning") == 1, plan


def test_cleaned_sales_are_dealt_before_columns_are_derived(spark, sf_small):
    from tidemark.operators.silver import clean_sales
    from tidemark.plans.pipeline import CLEAN_DEALS
    from tidemark.sources.sinks import _prepared, materialize

    bronze = materialize(fixtures.bronze_sales(spark, sf_small), "dealt")
    plain, dealt = clean_sales(bronze), clean_sales(bronze, deal=CLEAN_DEALS["sales"])
    assert dealt.schema == plain.schema and sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    plan = _optimized(_prepared(dealt, ["annee", "mois"], "_updated_at", dealt=True))
    assert plan.count("RebalancePartitions") == 1 and plan.index("montant_calc") < plan.index("RebalancePartitions")
    assert "montant_calc" not in plan[plan.index("RebalancePartitions"):] and "Sort [annee" in plan


def test_every_table_has_its_place_in_the_order(spark):
    from tidemark.plans.pipeline import DEAL_THEMSELVES, GOLD_TABLES, LARGEST_FIRST

    assert sorted(LARGEST_FIRST) == sorted([*GOLD_TABLES, "sales_enriched"]) and set(DEAL_THEMSELVES) < set(GOLD_TABLES)
