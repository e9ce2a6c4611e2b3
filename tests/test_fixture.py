"""The fixture's dirt: every cleaning rule has rows to work on at the smallest scale."""

from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.sources import fixtures


def _hits(spark, d, table, conditions):
    row = fixtures.BRONZE_BUILDERS[table](spark, d).agg(*(
        F.count(F.when(c, 1)).alias(f"c{k}") for k, c in enumerate(conditions.values()))).first()
    return {name: row[f"c{k}"] for k, name in enumerate(conditions)}


def test_every_rule_changes_a_row(spark, sf_small):
    c = F.col
    contains = lambda col, rules: {f"{col}: {broken}": c(col).contains(broken) for broken, _ in rules}
    matches = lambda col, rules: {f"{col}: {p}": col_.rlike(p) for p, _ in rules for col_ in (c(col),)}
    tables = {
        "customers": {**contains("ville", text.ENCODING_RULES),
                      **{k: (F.lower(F.trim("segment")) == k) & (c("segment") != v) for k, v in text.SEGMENT_CANONICAL},
                      "phone": c("telephone").rlike(r"\s"), "no email": c("email").isNull(), "young": c("age") < 16,
                      "no age": c("age").isNull(), "genre": c("genre") != F.upper(F.trim("genre"))},
        "products": {**matches("categorie", text.CATEGORY_RULES), "price": c("prix") <= 0},
        "returns": {**matches("motif", text.REASON_RULES), **matches("statut_retour", text.REFUND_STATUS_RULES)},
        "sales": {"status": F.lower(F.trim("statut")).rlike(text.SALE_STATUS_RULES[0][0]), "quantity": c("quantite") <= 0,
                  "amount": c("montant") <= 0, "no discount": c("remise_pct").isNull(),
                  **{k: c(k).isNull() for k in ("id_vente", "id_client", "id_produit")}},
    }
    for table, conditions in tables.items():
        hits = _hits(spark, sf_small, table, conditions)
        assert all(hits.values()), (table, hits)
