"""Registry of runnable queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the test tables of ``sf_dir`` through the fixture adapter
(``sources.fixtures``), cleans them (silver, strict profile unless the key
says ``_basic``) and applies one operator over the whole input tables.  Most
frames are lazy plans.  ``sales_by_channel``, ``revenue_share`` and
``top_products`` write an intermediate when they are built, and queries about
ingestion, sinks and the pipeline write the files that they are about.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.calendar import typed_column
from tidemark.functions.text import SEGMENT_CANONICAL, canonical_segment, fix_encoding, repair_mojibake, repair_mojibake_runs
from tidemark.operators import enrich, gold, quality, rules, silver, sketches
from tidemark.operators.dedup import keep_first
from tidemark.plans.pipeline import run_pipeline
from tidemark.session import new_run_dir, shuffles_freed
from tidemark.sources import files, fixtures, inference
from tidemark.sources.sinks import list_layer, materialize, write_catalog_table, write_table
from tidemark.streaming.landing import run_landing_once

# Fixed recency reference day for repeatable customer-basket results.
AS_OF = "2002-01-01"

Query = Callable[[SparkSession, str], DataFrame]


def _bronze(spark, d, name):
    return fixtures.BRONZE_BUILDERS[name](spark, d)


def _silver(spark, d, *names, profile="strict") -> list[DataFrame]:
    return [silver.CLEANERS[n](_bronze(spark, d, n), profile) for n in names]


def _gold(fn, *names, **kw) -> Query:
    """Query applying ``fn`` to the strict silver tables ``names``, in order."""
    def query(spark, d):
        return fn(*_silver(spark, d, *names), **kw)
    return query


def _clean(name, profile) -> Query:
    def query(spark, d):
        return _silver(spark, d, name, profile=profile)[0]
    return query


# ── sources: land files derived from the test tables, then ingest them ──

def _land_csv(spark, d, names, text=False) -> dict[str, str]:
    root = new_run_dir(spark, "landing-csv")
    return {n: fixtures.land_csv(spark, fixtures.as_text(n, _bronze(spark, d, n)) if text else _bronze(spark, d, n),
                                 f"{root}/{n}") for n in names}


def _lineage(df, pattern=None):
    """Load times and absolute paths differ by run: keep the part of the path that doesn't (by default the file's folder)."""
    # the folder is cut out at its slashes: a pattern anchored at the end starts anew at every character of the path
    source = (F.regexp_extract("_source_file", pattern, 1) if pattern
              else F.substring_index(F.substring_index("_source_file", "/", -2), "/", 1))
    return df.withColumn("source", source).drop("_ingested_at", "_source_file")


def q_ingest_csv(spark, d):
    return _lineage(files.ingest_csv(spark, "sales", _land_csv(spark, d, ["sales"])["sales"]))


def _clean_from_text(name) -> Query:
    """Bronze landed as text CSV with its columns in another order, ingested, then cleaned."""
    def query(spark, d):
        return silver.CLEANERS[name](files.ingest_csv(spark, name, _land_csv(spark, d, [name], text=True)[name]))
    return query


def q_ingest_all(spark, d):
    frames = files.ingest_all(spark, _land_csv(spark, d, list(fixtures.BRONZE_BUILDERS)))
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows")
             for t, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_ingest_csv_incremental(spark, d):
    """Land sales in two drops (by order year) and ingest each drop incrementally.

    Each run of the stream picks up only the files landed since the previous
    run; the bronze table ends with every landed row exactly once.
    """
    root = new_run_dir(spark, "landing-stream")
    bronze = _bronze(spark, d, "sales")
    early = F.col("date") < F.lit("1998-01-01")
    for i, part in enumerate([bronze.filter(early), bronze.filter(~early | F.col("date").isNull())]):
        fixtures.land_csv(spark, part, f"{root}/landing/drop={i}")
        run_landing_once(spark, "sales", f"{root}/landing/drop=*", f"{root}/bronze", f"{root}/checkpoint")
    return _lineage(spark.read.parquet(f"{root}/bronze"), "drop=([0-9])")


def q_ingest_json(spark, d):
    df = _lineage(fixtures.feed_nested(spark, d), "(landing-feed-nested)")
    return df.select("*", F.col("rating.rate").alias("rating_rate"), F.col("rating.count").alias("rating_count")).drop("rating")


def q_ingest_json_envelope(spark, d):
    return _lineage(fixtures.feed_flat(spark, d), "(landing-feed-envelope)")


def q_ingest_csv_inferred(spark, d):
    """The types that the landed bronze folders have, found without a schema."""
    out = None
    for name, path in _land_csv(spark, d, list(fixtures.BRONZE_BUILDERS)).items():
        types = inference.infer_csv(spark, path).select(F.lit(name).alias("table_name"), "*")
        out = types if out is None else out.unionByName(types)
    return out


def q_ingest_products_inferred(spark, d):
    df = _lineage(inference.ingest_csv_inferred(spark, _land_csv(spark, d, ["products"])["products"]))
    # the digits of a decimal depend on the data
    return df.select(*(F.col(c).cast("double").alias(c) if t.startswith("decimal") else c for c, t in df.dtypes))


def q_ingest_json_inferred(spark, d):
    """Records with fields that only some have, typed by the schema that all have together."""
    df = inference.ingest_json_inferred(spark, fixtures.land_feed_mixed(spark, d))
    return df.select("id", "title", "price", F.col("rating.rate").alias("rating_rate"), F.col("rating.count").alias("rating_count"),
                     F.array_join("tags", "|").alias("tags"), F.col("dims.w").alias("dims_w"), F.col("dims.h.cm").alias("dims_h_cm"),
                     files.CORRUPT)


def q_clean_feed_nested(spark, d):
    return silver.clean_feed_nested(fixtures.feed_nested(spark, d))


def q_clean_feed_flat(spark, d):
    return silver.clean_feed_flat(fixtures.feed_flat(spark, d))


# ── sinks ────────────────────────────────────────────────────────────────

def q_sink_roundtrip(spark, d):
    path = new_run_dir(spark, "sink-roundtrip")
    write_table(_silver(spark, d, "sales")[0], path, audit_column=None)
    return spark.read.parquet(path)


def q_sink_partitioned(spark, d):
    path = new_run_dir(spark, "sink-partitioned")
    write_table(gold.sales_daily(*_silver(spark, d, "sales", "channels")), path,
                partition_by=["annee", "mois"], audit_column=None)
    return spark.read.parquet(path)


def q_sink_ranges(spark, d):
    """Daily sales in files of disjoint date ranges, read back."""
    path = new_run_dir(spark, "sink-ranges")
    write_table(gold.sales_daily(*_silver(spark, d, "sales", "channels")), path, audit_column=None, range_by="date")
    return spark.read.parquet(path)


def q_load_report(spark, d):
    return run_pipeline(spark, d, as_of=AS_OF)


def _schema(label: str) -> str:
    return f"tidemark_{label}_{uuid.uuid4().hex[:8]}"


def q_catalog_refresh(spark, d):
    """Customers written to the catalog, then twice read, mended and replaced by themselves, the second time with a new column."""
    name, path = f"{_schema('refresh')}.customers", new_run_dir(spark, "catalog-refresh")
    write_catalog_table(_bronze(spark, d, "customers").select("id_client", "ville", "segment"), name, path=path, audit_column=None)
    for step in ({"ville": fix_encoding("ville")},
                 {"segment": canonical_segment(F.trim("segment")), "segment_brut": F.col("segment")}):
        write_catalog_table(spark.table(name).withColumns(step), name, path=path, audit_column=None)
    return spark.table(name)


def _catalog_bronze(spark, d) -> dict[str, str]:
    """The raw tables and feeds as tables of the catalog."""
    schema, path = _schema("raw"), new_run_dir(spark, "catalog-raw")
    with shuffles_freed(spark):
        frames = {**fixtures.bronze_tables(spark, d), "feed_nested": fixtures.feed_nested(spark, d), "feed_flat": fixtures.feed_flat(spark, d)}
        for name, df in frames.items():
            write_catalog_table(df, f"{schema}.{name}", path=path, audit_column=None)
    return {name: f"{schema}.{name}" for name in list_layer(spark, schema)}


def q_load_report_catalog(spark, d):
    """The pipeline from catalog tables to catalog tables, with the layers' listing."""
    return run_pipeline(spark, bronze=_catalog_bronze(spark, d), as_of=AS_OF, catalog=_schema("lake") + "_")


def q_load_report_resumed(spark, d):
    """A second run after the returns have changed: only what depends on them is built."""
    out = new_run_dir(spark, "pipeline-resumed")
    bronze = fixtures.bronze_tables(spark, d)
    part = {**bronze, "returns": bronze["returns"].where(F.col("date_retour") < "1996-01-01")}
    run_pipeline(spark, bronze=part, out=out, as_of=AS_OF)
    return run_pipeline(spark, bronze=bronze, out=out, as_of=AS_OF, resume=True)


# ── row-level primitives ─────────────────────────────────────────────────

def q_filter_not_null(spark, d):
    b = _bronze(spark, d, "customers")
    return b.filter(F.col("id_client").isNotNull() & F.col("email").isNotNull()).select(
        "id_client", "email")


def q_filter_positive(spark, d):
    b = _bronze(spark, d, "products")
    t = b.select(typed_column(b, "id_produit", "string").alias("id_produit"),
                 typed_column(b, "prix", "double").alias("prix"))
    return t.filter(F.col("prix") > 0)


def q_filter_range_or_null(spark, d):
    b = _bronze(spark, d, "customers")
    t = b.select("id_client", typed_column(b, "age", "int").alias("age"))
    return t.filter((F.col("age") >= 16) | F.col("age").isNull())


def q_segment_canonical(spark, d):
    b = _bronze(spark, d, "customers")
    return b.select("id_client", F.col("segment").alias("segment_brut"),
                    canonical_segment(F.trim("segment")).alias("segment"))


def q_fix_encoding(spark, d):
    b = _bronze(spark, d, "customers")
    return b.select("id_client", "ville", fix_encoding("ville").alias("ville_reparee"))


def q_repair_mojibake(spark, d):
    b = _bronze(spark, d, "returns")
    return b.select("id_retour", "motif", repair_mojibake("motif").alias("motif_repare"))


def q_repair_mojibake_runs(spark, d):
    """Values of sound and broken parts: a word before and one after a broken reason."""
    b = _bronze(spark, d, "returns")
    mixed = F.concat(F.lit("Fès “œuvre” 日本 "), "motif", F.lit(" Ã‰tÃ© déjà Å“uf Ã"))
    return b.select("id_retour", mixed.alias("motif_mixte"), repair_mojibake_runs(mixed).alias("motif_repare"))


def _segment_rules(spark):
    return spark.createDataFrame(SEGMENT_CANONICAL, "key string, value string")


def q_segment_by_rules(spark, d):
    out = rules.canonicalise(_bronze(spark, d, "customers").select("id_client", "segment"), "segment", _segment_rules(spark))
    return out.withColumnRenamed("_matched", "matched")


def q_segment_unmatched(spark, d):
    return rules.unmatched(_bronze(spark, d, "customers"), "segment", _segment_rules(spark))


def q_distinct_customers_sketch(spark, d):
    """Customers by month and channel from stored daily sketches, beside the exact count."""
    sales = materialize(_silver(spark, d, "sales")[0].select("date", "annee", "mois", "id_canal", "id_client"), "sketch-sales")
    stored = materialize(sketches.daily_sketches(sales), "sketches")
    keys = ["annee", "mois", "id_canal"]
    rolled = sketches.rolled_up(stored, keys, annee=F.year("date"), mois=F.month("date"))
    exact = sales.groupBy(*keys).agg(F.countDistinct("id_client").alias("clients_uniques"))
    joined = rolled.join(exact, [rolled[k].eqNullSafe(exact[k]) for k in keys])
    return joined.select(*(rolled[k] for k in keys), F.col("n").alias("nb_ventes"), "clients_uniques",
                         sketches.within_bound(F.col("distinct_estimate"), F.col("clients_uniques")).alias("dans_la_borne"))


def q_dedup_single_key(spark, d):
    b = _bronze(spark, d, "sales")
    t = b.select(*[typed_column(b, c, t).alias(c) for c, t in silver.SALES_TYPES.items()], "statut")
    return keep_first(t, ["id_vente"])


def q_dedup_composite_key(spark, d):
    return keep_first(_bronze(spark, d, "stocks"), ["id_produit", "depot"])


def q_price_band(spark, d):
    return _silver(spark, d, "products")[0].select("id_produit", "prix", "tranche_prix")


def q_margin_pct(spark, d):
    return _silver(spark, d, "products")[0].select("id_produit", "prix", "prix_achat", "marge_pct")


def q_stock_flags(spark, d):
    return _silver(spark, d, "stocks")[0].select("id_stock", "stock_net", "en_rupture", "sous_seuil")


def q_frequency_band(spark, d):
    return gold.customer_basket(*_silver(spark, d, "sales", "customers"), as_of=AS_OF).select(
        "id_client", "annee", "nb_commandes", "frequence_cat")


def q_return_band(spark, d):
    return gold.return_rate(*_silver(spark, d, "sales", "returns", "products")).select(
        "id_produit", "annee", "mois", "taux_retour_pct", "niveau_retour")


def q_validate_layers(spark, d):
    return quality.validate_layers(fixtures.bronze_tables(spark, d))


QUERIES: dict[str, Query] = {
    # sources
    "ingest_csv": q_ingest_csv,
    "ingest_all": q_ingest_all,
    "ingest_csv_incremental": q_ingest_csv_incremental,
    "ingest_json": q_ingest_json,
    "ingest_json_envelope": q_ingest_json_envelope,
    "ingest_csv_inferred": q_ingest_csv_inferred,
    "ingest_products_inferred": q_ingest_products_inferred,
    "ingest_json_inferred": q_ingest_json_inferred,
    # sinks
    "sink_roundtrip": q_sink_roundtrip,
    "sink_partitioned": q_sink_partitioned,
    "sink_ranges": q_sink_ranges,
    "catalog_refresh": q_catalog_refresh,
    "load_report": q_load_report,
    "load_report_catalog": q_load_report_catalog,
    "load_report_resumed": q_load_report_resumed,
    # silver
    **{f"clean_{n}": _clean(n, "strict") for n in silver.CLEANERS},
    **{f"clean_{n}_basic": _clean(n, "basic") for n in silver.CLEANERS},
    **{f"clean_{n}_from_text": _clean_from_text(n) for n in ("sales", "customers", "products")},
    "clean_feed_nested": q_clean_feed_nested,
    "clean_feed_flat": q_clean_feed_flat,
    "sales_enriched": _gold(enrich.enrich_sales, "sales", "channels"),
    # primitives
    "filter_not_null": q_filter_not_null,
    "filter_positive": q_filter_positive,
    "filter_range_or_null": q_filter_range_or_null,
    "price_band": q_price_band,
    "frequency_band": q_frequency_band,
    "return_band": q_return_band,
    "segment_canonical": q_segment_canonical,
    "margin_pct": q_margin_pct,
    "stock_flags": q_stock_flags,
    "discount_total": _gold(gold.discount_total, "sales"),
    "fix_encoding": q_fix_encoding,
    "repair_mojibake": q_repair_mojibake,
    "repair_mojibake_runs": q_repair_mojibake_runs,
    "segment_by_rules": q_segment_by_rules,
    "segment_unmatched": q_segment_unmatched,
    # dedup
    "dedup_single_key": q_dedup_single_key,
    "dedup_composite_key": q_dedup_composite_key,
    # joins
    "join_sales_channels": _gold(enrich.join_sales_channels, "sales", "channels"),
    "join_sales_customers": _gold(enrich.join_sales_customers, "sales", "customers"),
    "join_sales_products": _gold(enrich.join_sales_products, "sales", "products"),
    # aggregates and windows
    "distinct_customers": _gold(gold.distinct_customers, "sales"),
    "distinct_customers_sketch": q_distinct_customers_sketch,
    "revenue_share": _gold(gold.revenue_share, "sales", "channels"),
    "top_products_k": _gold(gold.top_products_k, "sales", "products"),
    "category_growth": _gold(gold.category_growth, "sales", "products"),
    "category_growth_calendar": _gold(gold.category_growth, "sales", "products", calendar=True),
    # gold
    "sales_daily": _gold(gold.sales_daily, "sales", "channels"),
    "sales_by_channel": _gold(gold.sales_by_channel, "sales", "channels"),
    "sales_by_region": _gold(gold.sales_by_region, "sales", "customers"),
    "top_products": _gold(gold.top_products, "sales", "products"),
    "customer_basket": _gold(gold.customer_basket, "sales", "customers", as_of=AS_OF),
    "return_rate": _gold(gold.return_rate, "sales", "returns", "products"),
    "return_rate_full": _gold(gold.return_rate_full, "sales", "returns", "products"),
    "sales_by_category": _gold(gold.sales_by_category, "sales", "products"),
    "customer_segments": _gold(gold.customer_segments, "sales", "customers", "channels"),
    "stock_alerts": _gold(gold.stock_alerts, "stocks", "products"),
    "product_margin": _gold(gold.product_margin, "products"),
    "amount_check": _gold(gold.amount_check, "sales"),
    "validate_layers": q_validate_layers,
}

FLAGSHIP = "sales_by_channel"
