"""Gold layer: business aggregates over the silver tables.

Plan shape shared by the queries:

* Where the grain of a foreign key is much coarser than the sales (channel-day,
  customer-month, product-month), sales are first aggregated to it: exact,
  because dimension keys are unique after silver dedup, and a customer or
  product with a third of all sales leaves each map task as one row per period.
* Where such a grain also needs a distinct count (``sales_by_channel``,
  ``customer_basket``), narrow rows are dealt by the grain once instead: the
  two aggregates of a distinct count would deal nearly every row, and wider.
  A hot channel is spread over its months, a hot customer over its years.
* Where a query needs distinct customers per attribute of another dimension
  (``sales_by_category``, ``customer_segments``), such a pre-aggregate would
  keep nearly every row.  There the narrow dimension is joined to the sales
  first (a hot key is left to AQE's skew splitting), and one aggregate by
  (attribute, period, customer) follows, which also spreads a hot attribute.
* Dimension joins carry no broadcast hints: Spark broadcasts a dimension
  only when its (runtime, with AQE) size is under
  ``autoBroadcastJoinThreshold`` and falls back to a sort-merge join
  otherwise.  Explicit broadcasts are limited to tables whose size is bounded
  by the calendar, not by data volume: the month totals of
  ``sales_by_channel`` / ``revenue_share``.
* ``sales_by_channel``, ``revenue_share`` and ``top_products`` write one
  intermediate to the scratch folder while their plan is built (see
  ``sources.sinks.materialize``); all other queries are lazy.
* Calendar columns that are functions of the grouping date or month are
  derived after aggregating instead of being carried through the shuffle.
* Money is summed in integer cents; rounded outputs use the integer half-up
  formula of ``functions.money`` (exact and independent of summation order).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.bands import frequency_band, return_band
from tidemark.operators.ranking import BUCKETS, group_rank
from tidemark.sources.sinks import materialize
from tidemark.functions.calendar import calendar_columns
from tidemark.functions.money import (
    basis_points,
    cents,
    idiv,
    from_cents,
    half_up_signed,
    pct_of,
)

# ── shared measures ──────────────────────────────────────────────────────


def _partial_measures() -> list[Column]:
    """Additive sales measures, safe to pre-aggregate and re-sum."""
    return [
        F.count("id_vente").alias("_n"),
        F.sum("quantite").alias("_qty"),
        F.sum(cents("montant")).alias("_ca"),
        F.count("montant").alias("_nm"),
    ]


def _measured(sales: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of the sales and what ``_dealt_measures`` needs: cents and marks, which are fewer bytes to deal than amounts and ids."""
    return sales.select(*columns, _mark("id_vente").alias("_n"), "quantite", cents("montant").alias("_ca"),
                        _mark("montant").alias("_nm"))


def _dealt_measures() -> list[Column]:
    """``_partial_measures`` of ``_measured`` sales."""
    return [F.count("_n").alias("_n"), F.sum("quantite").alias("_qty"), F.sum("_ca").alias("_ca"), F.count("_nm").alias("_nm")]


def _mark(name: str) -> Column:
    """A column that is only counted: true, or NULL where the column is."""
    return F.when(F.col(name).isNotNull(), F.lit(True))


def _dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to so many tasks, by default to as many as adaptive execution makes of them."""
    return df.repartition(tasks, *keys) if tasks else df.repartition(*keys)


def counted(sales: DataFrame) -> DataFrame:
    """Sales with marks for their own ids, which no measure but their number needs."""
    return sales.withColumn("id_vente", _mark("id_vente"))


def _resum() -> list[Column]:
    return [F.sum("_n").alias("_n"), F.sum("_qty").alias("_qty"),
            F.sum("_ca").alias("_ca"), F.sum("_nm").alias("_nm")]


def _final_measures(qty_name: str = "total_quantite") -> list[Column]:
    return [
        F.col("_n").alias("nb_commandes"),
        F.col("_qty").alias(qty_name),
        from_cents("_ca").alias("chiffre_affaires"),
        from_cents(half_up_signed("_ca", "_nm")).alias("panier_moyen"),
    ]


def _dim(df: DataFrame, key: str, cols: dict[str, str]) -> DataFrame:
    """Project a dimension to its key and renamed attributes (pruned scan)."""
    return df.select(key, *[F.col(src).alias(dst) for dst, src in cols.items()])


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return left.join(right, cond, how).select(left["*"], *[right[c] for c in right.columns if c not in keys])


# ── G1 daily sales by channel ────────────────────────────────────────────

DAILY_KEYS = ["date", "annee", "mois", "semaine", "trimestre", "id_canal"]  # output grain


def sales_daily(sales: DataFrame, channels: DataFrame, ordered: bool = False) -> DataFrame:
    """Per day and channel: orders, units, revenue, basket, customers, discounts.

    ``total_remises`` applies the discount rate to the (already discounted)
    line amount, as the original report does; ``total_remises_brut`` applies
    it to the gross amount quantity x unit price.  ``ordered`` sorts the
    result by date (then channel), for display; files are sorted by the writer.
    """
    bp = basis_points(F.coalesce(F.col("remise_pct"), F.lit(0.0)))
    gross = cents("prix_unitaire") * F.col("quantite").cast("bigint")
    # year / month / week / quarter are functions of the date: group (and
    # shuffle) on the date alone and derive them after the aggregation
    pre = sales.groupBy("date", "id_canal").agg(
        *_partial_measures(),
        F.countDistinct("id_client").alias("clients_uniques"),
        F.sum((cents("montant") * bp).cast("decimal(38,0)")).alias("_rem"),
        F.sum((gross * bp).cast("decimal(38,0)")).alias("_rem_brut"),
    ).withColumns(calendar_columns("date"))
    ch = _dim(channels, "id_canal", {"type": "type", "canal_nom": "nom"})
    out = pre.join(ch, "id_canal", "left").select(
        *DAILY_KEYS[:-1], "id_canal", "type", "canal_nom",
        *_final_measures(), "clients_uniques",
        from_cents(half_up_signed("_rem", F.lit(10000))).alias("total_remises"),
        from_cents(half_up_signed("_rem_brut", F.lit(10000))).alias("total_remises_brut"),
    )
    return out.orderBy("date", "id_canal") if ordered else out


# ── G2 monthly sales by channel, with share of the month ─────────────────

def sales_by_channel(sales: DataFrame, channels: DataFrame, tasks: int | None = None) -> DataFrame:
    """Monthly measures per channel and the channel's share of month revenue.

    The month total is an aggregate joined back (one row per calendar month,
    broadcast), not a window over the month: a window would put every
    channel of a month into one task.  The channel-month table feeds both
    sides, so it is written once (``materialize``) instead of recomputing
    the sales pipeline for each side.
    """
    keys = ["id_canal", "annee", "mois"]
    # dealt by the keys first: the distinct count would deal nearly every row by channel, month and customer, and once more
    dealt = _dealt(_measured(sales, *keys, "id_client"), tasks, *keys)
    # consumed twice (rows and month totals): written once, not recomputed
    pre = materialize(dealt.groupBy(*keys).agg(*_dealt_measures(),
                                               F.countDistinct("id_client").alias("clients_uniques")),
                      "channel-month")
    months = pre.groupBy("annee", "mois").agg(F.sum("_ca").alias("_month_ca"))
    ch = _dim(channels, "id_canal", {"type": "type", "canal_nom": "nom"})
    joined = _null_safe_join(pre, F.broadcast(months), ["annee", "mois"])
    share = F.when(F.col("_month_ca") != 0, pct_of("_ca", "_month_ca")).otherwise(F.lit(0.0))
    return joined.join(ch, "id_canal", "left").select(
        "id_canal", "type", "canal_nom", "annee", "mois",
        *_final_measures(), "clients_uniques", share.alias("part_ca_pct"),
    )


def revenue_share(sales: DataFrame, channels: DataFrame) -> DataFrame:
    """Monthly revenue per channel type and its share of the month."""
    ch = _dim(channels, "id_canal", {"type": "type"})
    pre = sales.groupBy("id_canal", "annee", "mois").agg(F.sum(cents("montant")).alias("_ca"))
    typed = materialize(pre.join(ch, "id_canal", "left").groupBy("type", "annee", "mois").agg(
        F.sum("_ca").alias("_ca")), "type-month")
    months = typed.groupBy("annee", "mois").agg(F.sum("_ca").alias("_month_ca"))
    joined = _null_safe_join(typed, F.broadcast(months), ["annee", "mois"])
    share = F.when(F.col("_month_ca") != 0, pct_of("_ca", "_month_ca")).otherwise(F.lit(0.0))
    return joined.select("type", "annee", "mois", from_cents("_ca").alias("chiffre_affaires"),
                         share.alias("part_ca_pct"))


# ── G3 monthly sales by city / region / segment ──────────────────────────

def sales_by_region(sales: DataFrame, customers: DataFrame) -> DataFrame:
    pre = sales.groupBy("id_client", "annee", "mois").agg(*_partial_measures())
    cu = _dim(customers, "id_client", {"ville": "ville", "region": "region", "segment": "segment"})
    g = pre.join(cu, "id_client", "left").groupBy("ville", "region", "segment", "annee", "mois").agg(
        *_resum(),
        # one pre-aggregated row per (client, month): counting rows counts clients
        F.count("id_client").alias("clients_uniques"),
    )
    return g.select("ville", "region", "segment", "annee", "mois", *_final_measures(),
                    "clients_uniques")


# ── G4 top products per month ────────────────────────────────────────────

_PRODUCT_COLUMNS = ("nom_produit", "categorie", "marque", "tranche_prix")


def _product_measures(sales: DataFrame) -> DataFrame:
    pre = sales.groupBy("id_produit", "annee", "mois").agg(*_partial_measures())
    return pre.select("id_produit", "annee", "mois", *_final_measures("total_quantite_vendue"))


def _with_product(measures: DataFrame, products: DataFrame) -> DataFrame:
    pr = _dim(products, "id_produit", {c: c for c in _PRODUCT_COLUMNS})
    rest = [c for c in measures.columns if c != "id_produit"]
    return measures.join(pr, "id_produit", "left").select("id_produit", *_PRODUCT_COLUMNS, *rest)


def _product_month(sales: DataFrame, products: DataFrame) -> DataFrame:
    return _with_product(_product_measures(sales), products)


def top_products(sales: DataFrame, products: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Product-month measures ranked by revenue and by units within the month.

    ``rank``: ties share a rank and the next rank skips.  A month holds one
    row per product sold; ``group_rank`` splits it into ``buckets`` ranges of values.
    The products' columns (one row per key after silver) join last: ranking
    writes and shuffles its rows several times.
    """
    ranked = group_rank(_product_measures(sales), ["annee", "mois"], {
        "rang_ca": "chiffre_affaires",
        "rang_quantite": "total_quantite_vendue",
    }, buckets)
    return _with_product(ranked, products)


def top_products_k(sales: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """The k best products by revenue per month (ties included).

    Catalyst turns ``rank() <= k`` into a ``WindowGroupLimit`` on both sides
    of the shuffle, so each map task sends at most k(+ties) rows per month.
    """
    g = _product_month(sales, products)
    w = Window.partitionBy("annee", "mois").orderBy(F.col("chiffre_affaires").desc_nulls_last())
    return g.withColumn("rang_ca", F.rank().over(w)).filter(F.col("rang_ca") <= k)


# ── G5 customer basket (simplified RFM) ──────────────────────────────────

def customer_basket(sales: DataFrame, customers: DataFrame, as_of=None, tasks: int | None = None) -> DataFrame:
    """Per customer and year: frequency, spend, basket extremes, recency.

    ``as_of`` (date or ISO string) fixes the recency reference day; the
    default is the current date, as in the original report.
    """
    ref = F.current_date() if as_of is None else F.lit(_as_date(as_of))
    # dealt by the keys first: the distinct count would deal nearly every row by customer, year and product, and once more
    dealt = _dealt(_measured(sales, "id_client", "annee", "id_produit", "date"), tasks, "id_client", "annee")
    pre = dealt.groupBy("id_client", "annee").agg(
        *_dealt_measures(),
        F.countDistinct("id_produit").alias("nb_produits_distincts"),
        F.min("_ca").alias("_min"),
        F.max("_ca").alias("_max"),
        F.min("date").alias("premiere_commande"),
        F.max("date").alias("derniere_commande"),
    )
    cu = _dim(customers, "id_client", {"segment": "segment", "ville": "ville", "region": "region"})
    return pre.join(cu, "id_client", "left").select(
        "id_client", "segment", "ville", "region", "annee",
        F.col("_n").alias("nb_commandes"),
        "nb_produits_distincts",
        F.col("_qty").alias("total_articles"),
        from_cents("_ca").alias("total_depenses"),
        from_cents(half_up_signed("_ca", "_nm")).alias("panier_moyen"),
        from_cents("_min").alias("min_commande"),
        from_cents("_max").alias("max_commande"),
        "premiere_commande", "derniere_commande",
        F.datediff(ref, F.col("derniere_commande")).alias("recence_jours"),
        frequency_band(F.col("_n")).alias("frequence_cat"),
    )


def _as_date(v) -> _dt.date:
    return v if isinstance(v, _dt.date) else _dt.date.fromisoformat(str(v))


# ── G6 return rate per product-month ─────────────────────────────────────

def _returns_by_month(returns: DataFrame) -> DataFrame:
    r = returns.select("id_produit", "id_retour", "quantite_retournee",
                       F.year("date_retour").alias("annee"), F.month("date_retour").alias("mois"))
    return r.groupBy("id_produit", "annee", "mois").agg(
        F.sum("quantite_retournee").alias("qte_retournee"),
        F.count("id_retour").alias("nb_retours"),
    )


def _sales_by_product_month(sales: DataFrame) -> DataFrame:
    return sales.groupBy("id_produit", "annee", "mois").agg(
        F.sum("quantite").alias("qte_vendue"),
        F.count("id_vente").alias("nb_ventes"),
    )


def _with_rate(df: DataFrame) -> DataFrame:
    rate = F.when(F.col("qte_vendue") > 0, pct_of("qte_retournee", "qte_vendue")).otherwise(F.lit(0.0))
    return df.withColumn("taux_retour_pct", rate).withColumn(
        "niveau_retour", return_band("taux_retour_pct"))


def return_rate(sales: DataFrame, returns: DataFrame, products: DataFrame) -> DataFrame:
    """Units returned / units sold per product and month of the return.

    Returns are matched on the month they were *returned*; product-months
    with returns but no sales are dropped (left join), as in the original
    report — ``return_rate_full`` keeps them.
    """
    keys = ["id_produit", "annee", "mois"]
    pr = _dim(products, "id_produit", {c: c for c in ("nom_produit", "categorie", "marque")})
    g = (_sales_by_product_month(sales)
         .join(_returns_by_month(returns), keys, "left")
         .join(pr, "id_produit", "left")
         .fillna(0, subset=["qte_retournee", "nb_retours"]))
    return _with_rate(g)


def return_rate_full(sales: DataFrame, returns: DataFrame, products: DataFrame) -> DataFrame:
    """As ``return_rate`` but with a full outer join: no product-month is lost."""
    keys = ["id_produit", "annee", "mois"]
    pr = _dim(products, "id_produit", {c: c for c in ("nom_produit", "categorie", "marque")})
    g = (_sales_by_product_month(sales)
         .join(_returns_by_month(returns), keys, "full")
         .join(pr, "id_produit", "left")
         .fillna(0, subset=["qte_vendue", "nb_ventes", "qte_retournee", "nb_retours"]))
    return _with_rate(g)


# ── G7 category evolution with month-over-month growth ──────────────────

def _growth(df: DataFrame, partition: list[str], calendar: bool = False) -> DataFrame:
    """Previous period revenue and growth % within ``partition`` by (annee, mois).

    The partition plus (annee, mois) is the grain, so the order has no ties.
    With ``calendar`` the previous row only counts when it is exactly the
    previous calendar month.
    """
    w = Window.partitionBy(*partition).orderBy(F.col("annee").asc_nulls_first(),
                                              F.col("mois").asc_nulls_first())
    prev = F.lag("_ca", 1).over(w)
    if calendar:
        idx = F.col("annee") * 12 + F.col("mois")
        prev = F.when(F.lag(idx, 1).over(w) == idx - 1, prev)
    out = df.withColumn("_prev", prev)
    growth = F.when(F.col("_prev").isNotNull() & (F.col("_prev") != 0),
                    pct_of(F.col("_ca") - F.col("_prev"), "_prev"))
    return out.withColumns({
        "ca_mois_prec": from_cents("_prev"),
        "croissance_mom_pct": growth,
    })


def _by_customer(sales: DataFrame, keys: list[str]) -> DataFrame:
    """Measures by ``keys`` and month, with the number of distinct customers: one row per customer, then its count."""
    pre = sales.groupBy(*keys, "annee", "mois", "id_client").agg(*_partial_measures())
    return pre.groupBy(*keys, "annee", "mois").agg(*_resum(), F.count("id_client").alias("clients_uniques"))


def _category_months(sales: DataFrame, products: DataFrame, keys: list[str]) -> DataFrame:
    pr = _dim(products, "id_produit", {"categorie": "categorie", "marque": "marque"})
    narrow = sales.select("id_produit", "id_client", "annee", "mois", "id_vente", "quantite", "montant")
    g = _by_customer(narrow.join(pr, "id_produit", "left"), keys)
    # the quarter is a function of the month, derived after grouping
    return g.withColumn("trimestre", idiv(F.col("mois") + 2, F.lit(3)).cast("int"))


def sales_by_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Monthly measures per (category, brand) and growth within the brand."""
    keys = ["categorie", "marque"]
    g = _growth(_category_months(sales, products, keys), keys)
    return g.select(*keys, "annee", "mois", "trimestre", *_final_measures(), "clients_uniques",
                    "ca_mois_prec", "croissance_mom_pct")


def category_growth(sales: DataFrame, products: DataFrame, calendar: bool = False) -> DataFrame:
    """Monthly measures per category and month-over-month growth.

    ``calendar=True``: growth only against the immediately preceding month.
    """
    g = _growth(_category_months(sales, products, ["categorie"]), ["categorie"], calendar)
    return g.select("categorie", "annee", "mois", "trimestre", *_final_measures(),
                    "clients_uniques", "ca_mois_prec", "croissance_mom_pct")


# ── G8 customer segments by channel type ─────────────────────────────────

def customer_segments(sales: DataFrame, customers: DataFrame, channels: DataFrame) -> DataFrame:
    # channels become their type first: (client, type, month) is far coarser than (client, channel, month)
    ch = _dim(channels, "id_canal", {"type": "type"})
    cu = _dim(customers, "id_client", {"segment": "segment"})
    narrow = sales.select("id_canal", "id_client", "annee", "mois", "id_vente", "quantite", "montant")
    pre = narrow.join(ch, "id_canal", "left").groupBy("id_client", "type", "annee", "mois").agg(*_partial_measures())
    # one row per client: counting rows counts clients
    g = (pre.join(cu, "id_client", "left").groupBy("segment", "type", "annee", "mois")
         .agg(*_resum(), F.count("id_client").alias("nb_clients")))
    return g.select(
        "segment", "type", "annee", "mois", "nb_clients",
        F.col("_n").alias("nb_commandes"),
        from_cents("_ca").alias("chiffre_affaires"),
        from_cents(half_up_signed("_ca", "_nm")).alias("panier_moyen"),
        from_cents(F.when(F.col("nb_clients") > 0, half_up_signed("_ca", "nb_clients")))
        .alias("ca_par_client"),
    )


# ── G9 / G10 stock alerts and product margins ────────────────────────────

def stock_alerts(stocks: DataFrame, products: DataFrame) -> DataFrame:
    """Stock lines that are out of stock or under their reorder threshold."""
    pr = _dim(products, "id_produit", {"nom_produit": "nom_produit"})
    alerts = stocks.filter(F.col("en_rupture") | F.col("sous_seuil"))
    return alerts.join(pr, "id_produit", "left").select(
        "id_stock", "id_produit", "nom_produit", "depot", "quantite_disponible",
        "quantite_reservee", "seuil_reappro", "stock_net", "en_rupture", "sous_seuil")


def product_margin(products: DataFrame) -> DataFrame:
    return products.select("id_produit", "nom_produit", "categorie", "marque", "prix",
                           "prix_achat", "marge", "marge_pct", "taux_marge_pct", "tranche_prix")


# ── smaller analytics ────────────────────────────────────────────────────

def distinct_customers(sales: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """Unique customers and products per month.

    Exact by default.  ``approx_rsd`` (e.g. 0.01) switches to HyperLogLog++
    sketches (``approx_count_distinct``): fixed-size partial aggregates and no
    shuffle of the distinct values, for very large inputs where an estimate
    is acceptable.
    """
    if approx_rsd is not None:
        return sales.groupBy("annee", "mois").agg(
            F.approx_count_distinct("id_client", approx_rsd).alias("clients_uniques"),
            F.approx_count_distinct("id_produit", approx_rsd).alias("produits_distincts"),
        )
    # two single counts joined on the month: both in one aggregate would double every row first (Expand)
    clients, produits = (
        sales.groupBy("annee", "mois").agg(F.countDistinct(c).alias(name))
        for c, name in (("id_client", "clients_uniques"), ("id_produit", "produits_distincts")))
    return _null_safe_join(clients, produits, ["annee", "mois"])


def discount_total(sales: DataFrame) -> DataFrame:
    """Monthly discount totals (net-based, as reported, and gross-based)."""
    bp = basis_points(F.coalesce(F.col("remise_pct"), F.lit(0.0)))
    gross = cents("prix_unitaire") * F.col("quantite").cast("bigint")
    g = sales.groupBy("annee", "mois").agg(
        F.sum((cents("montant") * bp).cast("decimal(38,0)")).alias("_rem"),
        F.sum((gross * bp).cast("decimal(38,0)")).alias("_rem_brut"),
    )
    return g.select("annee", "mois",
                    from_cents(half_up_signed("_rem", F.lit(10000))).alias("total_remises"),
                    from_cents(half_up_signed("_rem_brut", F.lit(10000))).alias("total_remises_brut"))


def amount_check(sales: DataFrame) -> DataFrame:
    """Sales whose stored amount differs from quantity x price x discount by > 1 cent."""
    diff = F.abs(cents("montant") - cents("montant_calc"))
    return sales.filter(diff > 1).select(
        "id_vente", "quantite", "prix_unitaire", "remise_pct", "montant", "montant_calc",
        from_cents(cents("montant") - cents("montant_calc")).alias("ecart"))
