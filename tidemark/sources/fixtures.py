"""Retail bronze tables derived from the TPC-H-style test tables.

The mapping (documented in FIXTURES.md) turns ``lineitem``/``orders`` into
sales and returns, ``supplier`` into channels, ``customer`` into customers,
``part`` into products and a (part, supplier) aggregate of ``lineitem``
into stock levels, injecting the kinds of dirt the cleaning layer exists
for: padded and mis-encoded text, NULL keys and attributes, zero prices and
duplicate ids.  Money is derived in integer cents so that every engine
produces the same values.

All frames are lazy; Catalyst prunes the unused columns of each source and
pushes filters into the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.money import cents, idiv
from tidemark.session import new_run_dir
from tidemark.sources import files
from tidemark.sources.sinks import file_bytes

# Bytes of parquet files per task where line items are dealt by key.  Without a number of its own such a step takes
# what AQE merges (64 MB of shuffled data), which is a large task to sort, join and count by key in.
TASK_BYTES = 8 << 20

# Declared layout of the test tables (FIXTURES.md §2).  Reading with a
# declared schema skips the footer-reading job that schema inference runs for
# every ``spark.read.parquet`` call.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
}
TABLES = tuple(TABLE_SCHEMAS)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def tasks(*tables: DataFrame) -> int:
    """A number of tasks that grows with the tables' files; of small ones, a task a core and at least 1 MB each."""
    spark = tables[0].sparkSession
    size = sum(file_bytes(spark, t.inputFiles()) for t in tables)
    return max(1, -(-size // TASK_BYTES), min(spark.sparkContext.defaultParallelism, size >> 20))


def _str(c) -> F.Column:
    return c.cast("string")


def _money(cents_col) -> F.Column:
    return cents_col.cast("double") / 100


def bronze_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    # Both sides are fact-sized (orders grows with lineitem), so this is a
    # sort-merge join at every real scale; the hint keeps a small test size
    # from broadcasting orders and funnelling all per-row work into the scan
    # tasks of lineitem.
    n = tasks(li, o)
    li, o = li.repartition(n, "l_orderkey"), o.repartition(n, "o_orderkey")
    j = li.join(o.hint("merge"), li.l_orderkey == o.o_orderkey, "inner")
    qty = F.col("l_quantity").cast("bigint")
    ext = cents("l_extendedprice")
    disc = F.round(F.col("l_discount") * 100).cast("int")
    order = F.col("l_orderkey")
    return j.select(
        F.when(order % 1009 != 0, _str(order * 10 + F.col("l_linenumber"))).alias("id_vente"),
        F.when(order % 97 != 0, _str(F.col("o_custkey"))).alias("id_client"),
        F.when(order % 101 != 0, _str(F.col("l_partkey"))).alias("id_produit"),
        _str(F.col("l_suppkey")).alias("id_canal"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.when(order % 89 == 0, -F.col("l_quantity").cast("int")).otherwise(F.col("l_quantity").cast("int")).alias("quantite"),
        _money(F.when(qty > 0, idiv(ext, qty))).alias("prix_unitaire"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("int"))
        .otherwise(disc).alias("remise_pct"),
        _money(F.when(order % 83 == 0, F.lit(0).cast("bigint"))
               .otherwise(idiv(ext * 2 * (100 - disc) + 100, F.lit(200)))).alias("montant"),
        F.when(F.col("o_orderstatus") == "F", " Livré ")
        .when(F.col("o_orderstatus") == "P", "LivrÃ©")
        .otherwise("EN COURS").alias("statut"),
    )


def bronze_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select(
        _str(F.col("s_suppkey")).alias("id_canal"),
        F.concat(F.lit(" "), F.col("r_name"), F.lit(" ")).alias("type"),
        F.col("s_name").alias("nom"),
        F.col("n_name").alias("ville"),
        F.col("r_name").alias("region"),
    )


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    key = F.col("c_custkey")
    return j.select(
        _str(key).alias("id_client"),
        F.col("c_name").alias("nom"),
        F.concat(F.lit(" "), F.lower("c_name")).alias("prenom"),
        F.when(key % 50 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" "), F.upper("c_name"), F.lit("@EX.COM ")))
        .alias("email"),
        F.concat(F.lit("06 12  "), _str(key), F.lit(" ")).alias("telephone"),
        F.when(key % 13 == 0, 'FÃ"s').when(key % 13 == 1, "MarrakÃ©ch").when(key % 13 == 2, "KhÃ©misset")
        .when(key % 13 == 3, "LÃ -bas").otherwise(F.col("n_name")).alias("ville"),
        F.col("r_name").alias("region"),
        F.when(key % 7 == 0, " PREMIUM").when(key % 7 == 1, "vip").when(key % 7 == 2, "Standard ")
        .otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(key % 3 == 0, " f").when(key % 3 == 1, "M ").alias("genre"),
        F.date_add(F.lit("2015-01-01").cast("date"), (key % 3000).cast("int")).alias("date_inscription"),
        F.when(key % 11 == 0, F.lit(None).cast("int"))
        .otherwise((key % 80 + 10).cast("int")).alias("age"),
    )


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    scaled = idiv(cents("p_retailprice") * F.col("p_size"), F.lit(20))
    return p.select(
        _str(F.col("p_partkey")).alias("id_produit"),
        F.col("p_name").alias("nom_produit"),
        F.when(F.col("p_partkey") % 17 == 0, "A%olectronique").when(F.col("p_partkey") % 17 == 1, "Ã©lectronique")
        .otherwise(F.col("p_type")).alias("categorie"),
        F.col("p_brand").alias("marque"),
        _money(F.when(F.col("p_size") == 50, F.lit(0).cast("bigint")).otherwise(scaled)).alias("prix"),
        _money(idiv(scaled * (F.col("p_size") + 40), F.lit(100))).alias("prix_achat"),
        (F.col("p_size").cast("double") / 10).alias("poids_kg"),
        (F.col("p_size") * 10).cast("int").alias("stock_initial"),
    )


def bronze_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    return li.select(
        _str(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_retour"),
        _str(F.col("l_partkey")).alias("id_produit"),
        F.col("l_shipdate").cast("date").alias("date_retour"),
        F.col("l_quantity").cast("int").alias("quantite_retournee"),
        _money(cents("l_extendedprice")).alias("montant_rembourse"),
        F.when(F.col("l_linestatus") == "F", "ArrivÃ© endommagÃ©")
        .otherwise(" Mauvais produit ").alias("motif"),
        F.when(F.col("l_linenumber") % 4 == 0, "remboursÃ©").when(F.col("l_linenumber") % 4 == 1, "remboursÃ@")
        .when(F.col("l_linenumber") % 4 == 2, "refusÃ").alias("statut_retour"),
    )


def bronze_stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity")
    # nearly every line is a pair of its own: lines are dealt as they are, not counted before
    lines = li.select(
        "l_partkey", "l_suppkey",
        F.when(F.col("l_linestatus") == "F", q).otherwise(0).alias("dispo"),
        F.when(F.col("l_linestatus") == "O", q).otherwise(0).alias("reserve"),
        F.col("l_shipdate").cast("date").alias("date_maj"),
    ).repartition(tasks(li), "l_partkey", "l_suppkey")
    agg = lines.groupBy("l_partkey", "l_suppkey").agg(
        F.sum("dispo").alias("dispo"), F.sum("reserve").alias("reserve"), F.max("date_maj").alias("date_maj"))
    return agg.select(
        _str(F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("id_stock"),
        _str(F.col("l_partkey")).alias("id_produit"),
        _str(F.col("l_suppkey")).alias("depot"),
        F.col("dispo").cast("int").alias("quantite_disponible"),
        F.col("reserve").cast("int").alias("quantite_reservee"),
        F.lit(20).alias("seuil_reappro"),
        F.col("date_maj"),
    )


BRONZE_BUILDERS = {
    "sales": bronze_sales,
    "customers": bronze_customers,
    "products": bronze_products,
    "stocks": bronze_stocks,
    "returns": bronze_returns,
    "channels": bronze_channels,
}


# ── the same tables as landed text: columns in another order, numbers and dates as careless exports write them ──

def as_text(name: str, df: DataFrame) -> DataFrame:
    """``df`` as all text, columns reversed, with values that typing has to mend or reject."""
    out = df.select(*[_str(F.col(c)).alias(c) for c in reversed(df.columns)])
    key = F.col(df.columns[0]).cast("bigint")
    if name == "sales":
        return out.withColumns({
            "quantite": F.concat("quantite", F.lit(".0")),
            "date": F.when(key % 29 == 0, "2020-13-45").otherwise(F.col("date")),
            "montant": F.when(key % 31 == 0, "NaN").otherwise(F.col("montant"))})
    if name == "customers":
        return out.withColumns({
            "age": F.concat("age", F.lit(".0")),
            "date_inscription": F.when(key % 19 == 0, "n/a").otherwise(F.col("date_inscription"))})
    if name == "products":
        return out.withColumn("prix", F.when(key % 23 == 0, "Infinity").when(key % 23 == 1, "1e20").otherwise(F.col("prix")))
    return out


def land_csv(spark: SparkSession, df: DataFrame, path: str) -> str:
    """Write ``df`` as CSV files with a header, values as they are."""
    (df.select(*[_str(F.col(c)).alias(c) for c in df.columns]).write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


# ── product feeds, landed as JSON ────────────────────────────────────────

def _feed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("title"),
        F.upper("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
        F.struct((F.col("p_size") % 50 / 10).alias("rate"),
                 (F.col("p_size") * 7).alias("count")).alias("rating"),
        (F.col("p_size") * 10).alias("stock"),
    )


def feed_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed whose rating is a record, landed and read back."""
    path = new_run_dir(spark, "landing-feed-nested")
    _feed_records(spark, sf_dir).drop("brand", "stock").write.mode("overwrite").json(path)
    return files.ingest_json(spark, path)


def feed_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in envelopes: one ``{"products": [...]}`` document per 100 consecutive product ids."""
    path = new_run_dir(spark, "landing-feed-envelope")
    rec = _feed_records(spark, sf_dir).withColumn("rating", F.col("rating.rate"))
    docs = rec.groupBy(F.floor(F.col("id") / 100).alias("_doc")).agg(
        F.collect_list(F.struct(*[c for c in rec.columns])).alias("products"))
    docs.select("products").write.mode("overwrite").json(path)
    return files.ingest_json_envelope(spark, path, multi_line=False)


def land_feed_mixed(spark: SparkSession, sf_dir: str) -> str:
    """A feed whose records differ: fields that only some have, whole and fractional numbers, an id that is a number or text."""
    p = read_table(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    title, price = F.col("p_name").alias("title"), F.col("p_retailprice")
    whole = F.to_json(F.struct(key.alias("id"), title, F.floor(price).alias("price"),
                               F.struct((size % 50 / 10).alias("rate"), (size * 7).alias("count")).alias("rating")))
    tagged = F.to_json(F.struct(key.alias("id"), title, price.alias("price"), F.struct((size % 5).alias("rate")).alias("rating"),
                                F.array(F.col("p_brand"), F.col("p_type")).alias("tags")))
    sized = F.to_json(F.struct(F.concat(F.lit("P"), key.cast("string")).alias("id"), title,
                               F.struct(size.alias("w"), F.struct((size / 4).alias("cm")).alias("h")).alias("dims")))
    path = new_run_dir(spark, "landing-feed-mixed")
    kind = key % 3
    (p.select(F.when(kind == 0, whole).when(kind == 1, tagged).when(key % 2 == 0, sized).otherwise(F.concat(F.lit("{cut "), title)).alias("value"))
     .write.mode("overwrite").text(path))
    return path


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in BRONZE_BUILDERS.items()}
