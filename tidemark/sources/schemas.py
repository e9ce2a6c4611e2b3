"""Declared bronze schemas.

Bronze keeps the raw text of every field (all ``string``); silver types the
columns with ``try_cast`` / ``try_to_date``.  Declaring the schema avoids the
extra full scan of schema inference and the lossy guesses it makes (a phone
number such as 0612345678 inferred as int loses its leading zero).
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


SALES = _strings(
    "id_vente", "id_client", "id_produit", "id_canal", "date", "quantite",
    "prix_unitaire", "remise_pct", "montant", "statut",
)
CUSTOMERS = _strings(
    "id_client", "nom", "prenom", "email", "telephone", "ville", "region",
    "segment", "genre", "date_inscription", "age",
)
PRODUCTS = _strings(
    "id_produit", "nom_produit", "categorie", "marque", "prix", "prix_achat",
    "poids_kg", "stock_initial",
)
STOCKS = _strings(
    "id_stock", "id_produit", "depot", "quantite_disponible",
    "quantite_reservee", "seuil_reappro", "date_maj",
)
RETURNS = _strings(
    "id_retour", "id_produit", "date_retour", "quantite_retournee",
    "montant_rembourse", "motif", "statut_retour",
)
CHANNELS = _strings("id_canal", "type", "nom", "ville", "region")

BRONZE = {
    "sales": SALES,
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "stocks": STOCKS,
    "returns": RETURNS,
    "channels": CHANNELS,
}

# Product feed with a nested rating record.
FEED_NESTED = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("rating", T.StructType([
        T.StructField("rate", T.StringType()),
        T.StructField("count", T.StringType()),
    ])),
])

# Product feed with flat fields, delivered inside a {"products": [...]} envelope.
FEED_FLAT_RECORD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("stock", T.StringType()),
])
