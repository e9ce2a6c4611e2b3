"""Silver layer: typed, validated, normalised and deduplicated tables.

Two profiles share one code path:

* ``strict`` (default) — the richer cleaning: validity filters, mojibake
  repair, canonical segments, margins and price bands, stock flags, plus
  the extra trims of the lighter variant.
* ``basic`` — the lighter variant kept for parity (fewer filters, discount
  NULL -> 0, no quarter / price band / recomputed amount).

Every function validates *before* deduplicating, then keeps the first row
per key under a total order (see ``dedup.keep_first``), so the survivor does
not depend on scheduling.  Audit columns (load timestamps) are added by the
writers in ``sources.sinks``, keeping these functions deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.bands import price_band
from tidemark.functions.calendar import calendar_columns, typed_column
from tidemark.functions.money import (
    basis_points,
    cents,
    from_cents,
    half_up_ratio,
    pct_of,
)
from tidemark.functions.text import (
    canonical_segment,
    fix_category,
    fix_encoding,
    fix_reason,
    fix_refund_status,
    fix_sale_status,
    strip_spaces,
)
from tidemark.operators.dedup import keep_first
from tidemark.sources.files import well_formed

PROFILES = ("strict", "basic")


def _check(profile: str) -> None:
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}; expected one of {PROFILES}")


def _typed(df: DataFrame, spec: dict[str, str]) -> list:
    return [typed_column(df, name, t).alias(name) for name, t in spec.items()]


# ── sales ────────────────────────────────────────────────────────────────

SALES_TYPES = {
    "id_vente": "string", "id_client": "string", "id_produit": "string",
    "id_canal": "string", "date": "date", "quantite": "int",
    "prix_unitaire": "double", "remise_pct": "double", "montant": "double",
}


def amount_calc(quantity="quantite", unit_price="prix_unitaire", discount="remise_pct"):
    """quantity * unit price * (1 - discount/100), rounded half-up to cents.

    Evaluated exactly in integer cents and basis points; NULL when any input
    is NULL.
    """
    q = F.col(quantity).cast("bigint")
    keep = 10000 - basis_points(discount)
    fast = F.try_multiply(F.try_multiply(cents(unit_price), q), keep)
    wide = cents(unit_price).cast("decimal(38,0)") * q * keep
    return from_cents(half_up_ratio(fast, F.lit(10000), wide))


def clean_sales(bronze: DataFrame, profile: str = "strict", deal=None) -> DataFrame:
    """``deal`` lays out the rows that stay, before more columns are derived from them: fewer bytes to deal."""
    _check(profile)
    bronze = well_formed(bronze)
    cols = _typed(bronze, SALES_TYPES)
    if profile == "strict":
        statut = fix_sale_status("statut")
    else:
        statut = F.lower(F.trim(F.col("statut")))
        remise = typed_column(bronze, "remise_pct", "double")
        cols[7] = F.coalesce(remise, F.lit(0.0)).alias("remise_pct")
    typed = bronze.select(*cols, statut.alias("statut"))
    valid = F.col("id_vente").isNotNull() & F.col("id_client").isNotNull()
    if profile == "strict":
        valid = (valid & F.col("id_produit").isNotNull()
                 & (F.col("quantite") > 0) & (F.col("montant") > 0))
    out = keep_first(typed.filter(valid), ["id_vente"])
    if deal is not None:
        out = deal(out)
    derived = calendar_columns("date", with_quarter=(profile == "strict"))
    if profile == "strict":
        derived = {"montant_calc": amount_calc(), **derived}
    return out.withColumns(derived)


# ── customers ────────────────────────────────────────────────────────────

CUSTOMER_TYPES = {"id_client": "string", "date_inscription": "date", "age": "int"}


def clean_customers(bronze: DataFrame, profile: str = "strict") -> DataFrame:
    _check(profile)
    bronze = well_formed(bronze)
    c = F.col
    if profile == "strict":
        text = [
            F.initcap(F.trim(c("nom"))).alias("nom"),
            F.initcap(F.trim(c("prenom"))).alias("prenom"),
            F.lower(F.trim(c("email"))).alias("email"),
            strip_spaces("telephone").alias("telephone"),
            fix_encoding(F.trim(c("ville"))).alias("ville"),
            fix_encoding(F.trim(c("region"))).alias("region"),
            canonical_segment(F.trim(c("segment"))).alias("segment"),
            F.upper(F.trim(c("genre"))).alias("genre"),
        ]
    else:
        text = [
            c("nom").cast("string").alias("nom"),
            c("prenom").cast("string").alias("prenom"),
            F.lower(F.trim(c("email"))).alias("email"),
            strip_spaces("telephone").alias("telephone"),
            F.initcap(F.trim(c("ville"))).alias("ville"),
            F.trim(c("region")).alias("region"),
            F.trim(c("segment")).alias("segment"),
            c("genre").cast("string").alias("genre"),
        ]
    t = _typed(bronze, CUSTOMER_TYPES)
    typed = bronze.select(t[0], *text, t[1], t[2])
    valid = F.col("id_client").isNotNull()
    if profile == "strict":
        valid = (valid & F.col("email").isNotNull()
                 & ((F.col("age") >= 16) | F.col("age").isNull()))
    return keep_first(typed.filter(valid), ["id_client"])


# ── products ─────────────────────────────────────────────────────────────

PRODUCT_TYPES = {
    "prix": "double", "prix_achat": "double", "poids_kg": "double",
    "stock_initial": "int",
}


def margin_pct(price="prix", cost="prix_achat"):
    """(price - cost) / price * 100, half-up to 2 decimals; NULL if price is 0."""
    return pct_of(cents(price) - cents(cost), cents(price))


def clean_products(bronze: DataFrame, profile: str = "strict") -> DataFrame:
    _check(profile)
    bronze = well_formed(bronze)
    c = F.col
    categorie = fix_category(F.trim(c("categorie"))) if profile == "strict" else F.trim(c("categorie"))
    typed = bronze.select(
        typed_column(bronze, "id_produit", "string").alias("id_produit"),
        F.trim(c("nom_produit")).alias("nom_produit") if profile == "strict"
        else c("nom_produit").cast("string").alias("nom_produit"),
        categorie.alias("categorie"),
        F.trim(c("marque")).alias("marque"),
        *_typed(bronze, PRODUCT_TYPES),
    )
    valid = F.col("id_produit").isNotNull()
    if profile == "strict":
        valid = valid & (F.col("prix") > 0)
    out = keep_first(typed.filter(valid), ["id_produit"])
    if profile == "basic":
        return out.withColumn("marge_pct", margin_pct())
    marge_cents = cents("prix") - cents("prix_achat")
    return out.withColumns({
        "marge_pct": margin_pct(),
        "tranche_prix": price_band("prix"),
        "marge": from_cents(marge_cents),
        "taux_marge_pct": pct_of(marge_cents, cents("prix")),
    })


# ── returns ──────────────────────────────────────────────────────────────

RETURN_TYPES = {
    "id_retour": "string", "id_produit": "string", "date_retour": "date",
    "quantite_retournee": "int", "montant_rembourse": "double",
}


def clean_returns(bronze: DataFrame, profile: str = "strict") -> DataFrame:
    _check(profile)
    bronze = well_formed(bronze)
    c = F.col
    if profile == "strict":
        motif = F.trim(fix_reason(c("motif")))
        statut = fix_refund_status(c("statut_retour"))
    else:
        motif = F.trim(c("motif"))
        statut = c("statut_retour").cast("string")
    typed = bronze.select(*_typed(bronze, RETURN_TYPES), motif.alias("motif"),
                          statut.alias("statut_retour"))
    return keep_first(typed.filter(F.col("id_retour").isNotNull()), ["id_retour"])


# ── stocks ───────────────────────────────────────────────────────────────

STOCK_TYPES = {
    "id_stock": "string", "id_produit": "string", "quantite_disponible": "int",
    "quantite_reservee": "int", "seuil_reappro": "int", "date_maj": "date",
}


def stock_flags(net="stock_net", threshold="seuil_reappro") -> dict:
    return {
        "en_rupture": F.col(net) <= 0,
        "sous_seuil": F.col(net) <= F.col(threshold),
    }


def clean_stocks(bronze: DataFrame, profile: str = "strict") -> DataFrame:
    _check(profile)
    bronze = well_formed(bronze)
    if profile == "basic":
        # the lighter variant types one column and dedups on (product, depot)
        typed = bronze.withColumn("quantite_disponible",
                                  typed_column(bronze, "quantite_disponible", "int"))
        return keep_first(typed, ["id_produit", "depot"])
    typed = bronze.select(
        *_typed(bronze, STOCK_TYPES),
        fix_encoding(F.col("depot").cast("string")).alias("depot"),
    )
    out = keep_first(typed.filter(F.col("id_produit").isNotNull()), ["id_stock"])
    out = out.withColumn("stock_net", F.col("quantite_disponible") - F.col("quantite_reservee"))
    return out.withColumns(stock_flags())


# ── channels ─────────────────────────────────────────────────────────────

def clean_channels(bronze: DataFrame, profile: str = "strict") -> DataFrame:
    _check(profile)
    bronze = well_formed(bronze)
    c = F.col
    if profile == "strict":
        text = [fix_encoding(F.trim(c("nom"))), fix_encoding(c("ville")), fix_encoding(c("region"))]
    else:
        text = [F.trim(c("nom")), c("ville").cast("string"), c("region").cast("string")]
    typed = bronze.select(
        typed_column(bronze, "id_canal", "string").alias("id_canal"),
        F.lower(F.trim(c("type"))).alias("type"),
        text[0].alias("nom"), text[1].alias("ville"), text[2].alias("region"),
    )
    return keep_first(typed, ["id_canal"])


# ── product feeds ────────────────────────────────────────────────────────

def clean_feed_nested(bronze: DataFrame) -> DataFrame:
    """Feed whose ``rating`` is a record {rate, count}: flatten and type it."""
    typed = well_formed(bronze).select(
        F.col("id").try_cast("bigint").alias("id"),
        F.trim("title").alias("title"),
        F.lower(F.trim("category")).alias("category"),
        F.col("price").try_cast("double").alias("price"),
        F.col("rating.rate").try_cast("double").alias("rating_rate"),
        F.col("rating.count").try_cast("int").alias("rating_count"),
    )
    return keep_first(typed, ["id"])


def clean_feed_flat(bronze: DataFrame) -> DataFrame:
    """Feed with scalar fields (rating is a number)."""
    typed = well_formed(bronze).select(
        F.col("id").try_cast("bigint").alias("id"),
        F.trim("title").alias("title"),
        F.lower(F.trim("category")).alias("category"),
        F.trim("brand").alias("brand"),
        F.col("price").try_cast("double").alias("price"),
        F.col("rating").try_cast("double").alias("rating"),
        F.col("stock").try_cast("int").alias("stock"),
    )
    return keep_first(typed, ["id"])


CLEANERS = {
    "sales": clean_sales,
    "customers": clean_customers,
    "products": clean_products,
    "returns": clean_returns,
    "stocks": clean_stocks,
    "channels": clean_channels,
}


def silver_tables(bronze: dict[str, DataFrame], profile: str = "strict") -> dict[str, DataFrame]:
    return {name: CLEANERS[name](bronze[name], profile) for name in CLEANERS}
