"""DuckDB twins of the registered queries (the correctness oracle).

Each entry is one self-contained SQL statement over the pre-registered test
tables.  The SQL is written independently of the Spark plans — joins first,
window functions where the Spark side uses aggregate-then-join — so a match
checks the semantics, not a transcription.  Integer cents and the integer
half-up formula make rounded money identical in both engines; result types
are cast to what Spark returns (int / bigint / double).
"""

from __future__ import annotations

AS_OF = "2002-01-01"


# ── expression helpers (SQL text) ────────────────────────────────────────

def cents(x: str) -> str:
    return f"TRY_CAST(round(({x}) * 100) AS BIGINT)"


def bp(x: str) -> str:
    return f"CAST(round(({x}) * 100) AS BIGINT)"


def hu(n: str, d: str) -> str:
    """Half-up n/d for n >= 0; NULL unless d > 0."""
    return (f"(CASE WHEN ({d}) > 0 THEN CAST((2 * CAST({n} AS HUGEINT) + ({d})) "
            f"// (2 * CAST({d} AS HUGEINT)) AS BIGINT) END)")


def hus(n: str, d: str) -> str:
    """Half-up (away from zero) n/d for any signs; NULL if d = 0."""
    q = hu(f"abs({n})", f"abs({d})")
    return f"(CASE WHEN (({n}) < 0) <> (({d}) < 0) THEN -{q} ELSE {q} END)"


def fc(x: str) -> str:
    return f"(CAST({x} AS DOUBLE) / 100)"


def pct(part: str, whole: str) -> str:
    return f"(CAST({hus(f'CAST({part} AS HUGEINT) * 10000', whole)} AS DOUBLE) / 100)"


def fix_enc(x: str) -> str:
    return (f"replace(replace(replace(replace({x}, 'FÃ\"s', 'Fès'), 'MarrakÃ©ch', 'Marrakech'), "
            f"'Ã©', 'é'), 'Ã ', 'à')")


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def rx(x: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{repl}', 'g')"


def order_by(cols: list[str]) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in cols)


def i(x: str) -> str:
    return f"CAST({x} AS INTEGER)"


def b(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


# ── bronze: the fixture mapping ──────────────────────────────────────────

EXT = cents("l.l_extendedprice")
DISC = f"CAST(round(l.l_discount * 100) AS INTEGER)"

BRONZE = {
    "bronze_sales": f"""
SELECT CASE WHEN l.l_orderkey % 1009 <> 0 THEN CAST(l.l_orderkey * 10 + l.l_linenumber AS VARCHAR) END AS id_vente,
       CASE WHEN l.l_orderkey % 97 <> 0 THEN CAST(o.o_custkey AS VARCHAR) END AS id_client,
       CASE WHEN l.l_orderkey % 101 <> 0 THEN CAST(l.l_partkey AS VARCHAR) END AS id_produit,
       CAST(l.l_suppkey AS VARCHAR) AS id_canal,
       CAST(o.o_orderdate AS DATE) AS date,
       CASE WHEN l.l_orderkey % 89 = 0 THEN -CAST(l.l_quantity AS INTEGER) ELSE CAST(l.l_quantity AS INTEGER) END AS quantite,
       CAST(CASE WHEN CAST(l.l_quantity AS BIGINT) > 0
                 THEN {EXT} // CAST(l.l_quantity AS BIGINT) END AS DOUBLE) / 100 AS prix_unitaire,
       CASE WHEN l.l_linenumber = 7 THEN NULL ELSE {DISC} END AS remise_pct,
       CAST(CASE WHEN l.l_orderkey % 83 = 0 THEN 0 ELSE (2 * {EXT} * (100 - {DISC}) + 100) // 200 END AS DOUBLE) / 100 AS montant,
       CASE o.o_orderstatus WHEN 'F' THEN ' Livré ' WHEN 'P' THEN 'LivrÃ©' ELSE 'EN COURS' END AS statut
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "bronze_channels": """
SELECT CAST(s.s_suppkey AS VARCHAR) AS id_canal, ' ' || r.r_name || ' ' AS type,
       s.s_name AS nom, n.n_name AS ville, r.r_name AS region
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "bronze_customers": """
SELECT CAST(c.c_custkey AS VARCHAR) AS id_client, c.c_name AS nom, ' ' || lower(c.c_name) AS prenom,
       CASE WHEN c.c_custkey % 50 = 0 THEN NULL ELSE ' ' || upper(c.c_name) || '@EX.COM ' END AS email,
       '06 12  ' || CAST(c.c_custkey AS VARCHAR) || ' ' AS telephone,
       CASE c.c_custkey % 13 WHEN 0 THEN 'FÃ"s' WHEN 1 THEN 'MarrakÃ©ch' WHEN 2 THEN 'KhÃ©misset' WHEN 3 THEN 'LÃ -bas'
            ELSE n.n_name END AS ville, r.r_name AS region,
       CASE c.c_custkey % 7 WHEN 0 THEN ' PREMIUM' WHEN 1 THEN 'vip' WHEN 2 THEN 'Standard '
            ELSE c.c_mktsegment END AS segment,
       CASE c.c_custkey % 3 WHEN 0 THEN ' f' WHEN 1 THEN 'M ' END AS genre,
       DATE '2015-01-01' + CAST(c.c_custkey % 3000 AS INTEGER) AS date_inscription,
       CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE CAST(c.c_custkey % 80 + 10 AS INTEGER) END AS age
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "bronze_products": f"""
SELECT CAST(p_partkey AS VARCHAR) AS id_produit, p_name AS nom_produit,
       CASE p_partkey % 17 WHEN 0 THEN 'A%olectronique' WHEN 1 THEN 'Ã©lectronique' ELSE p_type END AS categorie,
       p_brand AS marque,
       CAST(CASE WHEN p_size = 50 THEN 0 ELSE ({cents('p_retailprice')} * p_size) // 20 END AS DOUBLE) / 100 AS prix,
       CAST((({cents('p_retailprice')} * p_size) // 20 * (p_size + 40)) // 100 AS DOUBLE) / 100 AS prix_achat,
       CAST(p_size AS DOUBLE) / 10 AS poids_kg, CAST(p_size * 10 AS INTEGER) AS stock_initial
FROM part""",
    "bronze_returns": f"""
SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id_retour,
       CAST(l_partkey AS VARCHAR) AS id_produit, CAST(l_shipdate AS DATE) AS date_retour,
       CAST(l_quantity AS INTEGER) AS quantite_retournee,
       CAST({cents('l_extendedprice')} AS DOUBLE) / 100 AS montant_rembourse,
       CASE WHEN l_linestatus = 'F' THEN 'ArrivÃ© endommagÃ©' ELSE ' Mauvais produit ' END AS motif,
       CASE l_linenumber % 4 WHEN 0 THEN 'remboursÃ©' WHEN 1 THEN 'remboursÃ@' WHEN 2 THEN 'refusÃ' END AS statut_retour
FROM lineitem WHERE l_returnflag = 'R'""",
    "bronze_stocks": """
SELECT CAST(l_partkey * 1000000 + l_suppkey AS VARCHAR) AS id_stock,
       CAST(l_partkey AS VARCHAR) AS id_produit, CAST(l_suppkey AS VARCHAR) AS depot,
       CAST(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS INTEGER) AS quantite_disponible,
       CAST(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS INTEGER) AS quantite_reservee,
       20 AS seuil_reappro, max(CAST(l_shipdate AS DATE)) AS date_maj
FROM lineitem GROUP BY l_partkey, l_suppkey""",
}


# what typing makes of the landed text (``fixtures.as_text``)
TEXT = {
    "text_sales": """
SELECT * REPLACE (CASE WHEN CAST(id_vente AS BIGINT) % 29 = 0 THEN NULL ELSE date END AS date,
                  CASE WHEN CAST(id_vente AS BIGINT) % 31 = 0 THEN NULL ELSE montant END AS montant) FROM bronze_sales""",
    "text_customers": """
SELECT * REPLACE (CASE WHEN CAST(id_client AS BIGINT) % 19 = 0 THEN NULL ELSE date_inscription END AS date_inscription)
FROM bronze_customers""",
    "text_products": """
SELECT * REPLACE (CASE CAST(id_produit AS BIGINT) % 23 WHEN 0 THEN NULL WHEN 1 THEN 1e20 ELSE prix END AS prix)
FROM bronze_products""",
}


# ── silver ───────────────────────────────────────────────────────────────

def _dedup(src: str, key: list[str], cols: list[str], where: str = "TRUE") -> str:
    rest = [c for c in cols if c not in key]
    return (f"SELECT {', '.join(cols)} FROM {src} WHERE {where} "
            f"QUALIFY row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY {order_by(rest)}) = 1")


SALES_COLS = ["id_vente", "id_client", "id_produit", "id_canal", "date", "quantite",
              "prix_unitaire", "remise_pct", "montant", "statut"]
CUSTOMER_COLS = ["id_client", "nom", "prenom", "email", "telephone", "ville", "region", "segment",
                 "genre", "date_inscription", "age"]
PRODUCT_COLS = ["id_produit", "nom_produit", "categorie", "marque", "prix", "prix_achat",
                "poids_kg", "stock_initial"]
RETURN_COLS = ["id_retour", "id_produit", "date_retour", "quantite_retournee", "montant_rembourse",
               "motif", "statut_retour"]
STOCK_COLS = ["id_stock", "id_produit", "quantite_disponible", "quantite_reservee",
              "seuil_reappro", "date_maj", "depot"]
CHANNEL_COLS = ["id_canal", "type", "nom", "ville", "region"]

CALENDAR = (f"{i('year(date)')} AS annee, {i('month(date)')} AS mois, "
            f"{i('weekofyear(date)')} AS semaine")

MONTANT_CALC = fc(hus(f"{cents('prix_unitaire')} * CAST(quantite AS BIGINT) * (10000 - {bp('remise_pct')})",
                      "10000"))

SEGMENT = ("CASE WHEN lower(trim(segment)) = 'premium' THEN 'Premium' "
           "WHEN lower(trim(segment)) = 'standard' THEN 'Standard' "
           "WHEN lower(trim(segment)) = 'vip' THEN 'VIP' ELSE trim(segment) END")

PRICE_BAND = ("CASE WHEN prix < 100 THEN 'Bas' WHEN prix < 500 THEN 'Moyen' "
              "WHEN prix < 2000 THEN 'Haut' ELSE 'Premium' END")

MARGIN = f"{cents('prix')} - {cents('prix_achat')}"

SILVER = {
    # strict
    "t_sales": f"""
SELECT id_vente, id_client, id_produit, id_canal, date, quantite, CAST(prix_unitaire AS DOUBLE) AS prix_unitaire,
       CAST(remise_pct AS DOUBLE) AS remise_pct, CAST(montant AS DOUBLE) AS montant,
       {rx('lower(trim(statut))', 'livrã©|livrã@|livrÃ©', 'livré')} AS statut
FROM bronze_sales""",
    "d_sales": _dedup("t_sales", ["id_vente"], SALES_COLS,
                      "id_vente IS NOT NULL AND id_client IS NOT NULL AND id_produit IS NOT NULL "
                      "AND quantite > 0 AND montant > 0"),
    "silver_sales": f"""
SELECT *, {MONTANT_CALC} AS montant_calc, {CALENDAR}, {i('quarter(date)')} AS trimestre FROM d_sales""",
    "t_customers": f"""
SELECT id_client, {initcap('trim(nom)')} AS nom, {initcap('trim(prenom)')} AS prenom,
       lower(trim(email)) AS email, regexp_replace(telephone, '\\s+', '', 'g') AS telephone,
       {fix_enc('trim(ville)')} AS ville, {fix_enc('trim(region)')} AS region, {SEGMENT} AS segment,
       upper(trim(genre)) AS genre, date_inscription, age
FROM bronze_customers""",
    "silver_customers": _dedup("t_customers", ["id_client"], CUSTOMER_COLS,
                               "id_client IS NOT NULL AND email IS NOT NULL AND (age >= 16 OR age IS NULL)"),
    "t_products": f"""
SELECT id_produit, trim(nom_produit) AS nom_produit,
       {rx(rx('trim(categorie)', 'A%olectronique', 'Électronique'), 'Ã©lectronique', 'Électronique')} AS categorie,
       trim(marque) AS marque, prix, prix_achat, poids_kg, stock_initial
FROM bronze_products""",
    "d_products": _dedup("t_products", ["id_produit"], PRODUCT_COLS,
                         "id_produit IS NOT NULL AND prix > 0"),
    "silver_products": f"""
SELECT *, {pct(MARGIN, cents('prix'))} AS marge_pct, {PRICE_BAND} AS tranche_prix,
       {fc(MARGIN)} AS marge, {pct(MARGIN, cents('prix'))} AS taux_marge_pct
FROM d_products""",
    "t_returns": f"""
SELECT id_retour, id_produit, date_retour, quantite_retournee, montant_rembourse,
       trim({rx(rx('motif', 'ArrivÃ©|ArrivÃ@', 'Arrivé'), 'endommagÃ©|endommagÃ@', 'endommagé')}) AS motif,
       {rx(rx('statut_retour', 'remboursÃ©|remboursÃ@', 'remboursé'), 'Ã', '')} AS statut_retour
FROM bronze_returns""",
    "silver_returns": _dedup("t_returns", ["id_retour"], RETURN_COLS, "id_retour IS NOT NULL"),
    "t_stocks": f"""
SELECT id_stock, id_produit, quantite_disponible, quantite_reservee, seuil_reappro, date_maj,
       {fix_enc('depot')} AS depot
FROM bronze_stocks""",
    "d_stocks": _dedup("t_stocks", ["id_stock"], STOCK_COLS, "id_produit IS NOT NULL"),
    "silver_stocks": """
SELECT *, quantite_disponible - quantite_reservee AS stock_net,
       quantite_disponible - quantite_reservee <= 0 AS en_rupture,
       quantite_disponible - quantite_reservee <= seuil_reappro AS sous_seuil
FROM d_stocks""",
    "t_channels": f"""
SELECT id_canal, lower(trim(type)) AS type, {fix_enc('trim(nom)')} AS nom, {fix_enc('ville')} AS ville,
       {fix_enc('region')} AS region
FROM bronze_channels""",
    "silver_channels": _dedup("t_channels", ["id_canal"], CHANNEL_COLS),
    # basic
    "tb_sales": """
SELECT id_vente, id_client, id_produit, id_canal, date, quantite, CAST(prix_unitaire AS DOUBLE) AS prix_unitaire,
       coalesce(CAST(remise_pct AS DOUBLE), 0.0) AS remise_pct, CAST(montant AS DOUBLE) AS montant,
       lower(trim(statut)) AS statut
FROM bronze_sales""",
    "db_sales": _dedup("tb_sales", ["id_vente"], SALES_COLS,
                       "id_vente IS NOT NULL AND id_client IS NOT NULL"),
    "basic_sales": f"SELECT *, {CALENDAR} FROM db_sales",
    "tb_customers": f"""
SELECT id_client, nom, prenom, lower(trim(email)) AS email, regexp_replace(telephone, '\\s+', '', 'g') AS telephone,
       {initcap('trim(ville)')} AS ville, trim(region) AS region, trim(segment) AS segment, genre,
       date_inscription, age
FROM bronze_customers""",
    "basic_customers": _dedup("tb_customers", ["id_client"], CUSTOMER_COLS, "id_client IS NOT NULL"),
    "tb_products": """
SELECT id_produit, nom_produit, trim(categorie) AS categorie, trim(marque) AS marque, prix, prix_achat,
       poids_kg, stock_initial
FROM bronze_products""",
    "db_products": _dedup("tb_products", ["id_produit"], PRODUCT_COLS, "id_produit IS NOT NULL"),
    "basic_products": f"SELECT *, {pct(MARGIN, cents('prix'))} AS marge_pct FROM db_products",
    "tb_returns": f"""
SELECT {', '.join(RETURN_COLS[:5])}, trim(motif) AS motif, statut_retour FROM bronze_returns""",
    "basic_returns": _dedup("tb_returns", ["id_retour"], RETURN_COLS, "id_retour IS NOT NULL"),
    "basic_stocks": _dedup("bronze_stocks", ["id_produit", "depot"],
                           ["id_stock", "id_produit", "depot", "quantite_disponible", "quantite_reservee",
                            "seuil_reappro", "date_maj"]),
    "tb_channels": """
SELECT id_canal, lower(trim(type)) AS type, trim(nom) AS nom, ville, region FROM bronze_channels""",
    "basic_channels": _dedup("tb_channels", ["id_canal"], CHANNEL_COLS),
}


# the strict silver tables again, over the landed text
for _t in ("sales", "customers", "products"):
    for _level in ("t", "d", "silver"):
        if f"{_level}_{_t}" in SILVER:
            _sql = SILVER[f"{_level}_{_t}"]
            for _below in (f"bronze_{_t}", f"t_{_t}", f"d_{_t}"):
                _sql = _sql.replace(f"FROM {_below}", f"FROM text_{_t}" if _below[0] == "b" else f"FROM x{_below}")
            TEXT[f"x{_level}_{_t}"] = _sql


# ── gold ─────────────────────────────────────────────────────────────────

def measures(qty: str = "total_quantite", alias: str = "s") -> str:
    return (f"count({alias}.id_vente) AS nb_commandes, {b(f'sum({alias}.quantite)')} AS {qty}, "
            f"{fc(f'sum({cents(alias + '.montant')})')} AS chiffre_affaires, "
            f"{fc(hus(f'sum({cents(alias + '.montant')})', f'count({alias}.montant)'))} AS panier_moyen")


REM = hus(f"sum(CAST({cents('s.montant')} * {bp('coalesce(s.remise_pct, 0.0)')} AS HUGEINT))", "10000")
REM_BRUT = hus(f"sum(CAST({cents('s.prix_unitaire')} * CAST(s.quantite AS BIGINT) * "
               f"{bp('coalesce(s.remise_pct, 0.0)')} AS HUGEINT))", "10000")

GOLD = {
    "g_sales_daily": f"""
SELECT s.date, s.annee, s.mois, s.semaine, s.trimestre, s.id_canal, c.type, c.nom AS canal_nom,
       {measures()}, count(DISTINCT s.id_client) AS clients_uniques,
       {fc(REM)} AS total_remises, {fc(REM_BRUT)} AS total_remises_brut
FROM silver_sales s LEFT JOIN silver_channels c ON s.id_canal = c.id_canal
GROUP BY s.date, s.annee, s.mois, s.semaine, s.trimestre, s.id_canal, c.type, c.nom""",
    "g_channel_month": f"""
SELECT s.id_canal, c.type, c.nom AS canal_nom, s.annee, s.mois, {measures()},
       count(DISTINCT s.id_client) AS clients_uniques, sum({cents('s.montant')}) AS _ca
FROM silver_sales s LEFT JOIN silver_channels c ON s.id_canal = c.id_canal
GROUP BY s.id_canal, c.type, c.nom, s.annee, s.mois""",
    "g_sales_by_channel": f"""
SELECT id_canal, type, canal_nom, annee, mois, nb_commandes, total_quantite, chiffre_affaires,
       panier_moyen, clients_uniques,
       CASE WHEN sum(_ca) OVER (PARTITION BY annee, mois) <> 0
            THEN {pct('_ca', 'sum(_ca) OVER (PARTITION BY annee, mois)')} ELSE 0.0 END AS part_ca_pct
FROM g_channel_month""",
    "g_sales_by_region": f"""
SELECT c.ville, c.region, c.segment, s.annee, s.mois, {measures()},
       count(DISTINCT s.id_client) AS clients_uniques
FROM silver_sales s LEFT JOIN silver_customers c ON s.id_client = c.id_client
GROUP BY c.ville, c.region, c.segment, s.annee, s.mois""",
    "g_product_month": f"""
SELECT s.id_produit, p.nom_produit, p.categorie, p.marque, p.tranche_prix, s.annee, s.mois,
       {measures('total_quantite_vendue')}
FROM silver_sales s LEFT JOIN silver_products p ON s.id_produit = p.id_produit
GROUP BY s.id_produit, p.nom_produit, p.categorie, p.marque, p.tranche_prix, s.annee, s.mois""",
    "g_top_products": """
SELECT *,
       CAST(rank() OVER (PARTITION BY annee, mois ORDER BY chiffre_affaires DESC NULLS LAST) AS INTEGER) AS rang_ca,
       CAST(rank() OVER (PARTITION BY annee, mois ORDER BY total_quantite_vendue DESC NULLS LAST) AS INTEGER)
         AS rang_quantite
FROM g_product_month""",
    "g_customer_basket": f"""
SELECT s.id_client, c.segment, c.ville, c.region, s.annee, count(s.id_vente) AS nb_commandes,
       count(DISTINCT s.id_produit) AS nb_produits_distincts, {b('sum(s.quantite)')} AS total_articles,
       {fc(f"sum({cents('s.montant')})")} AS total_depenses,
       {fc(hus(f"sum({cents('s.montant')})", 'count(s.montant)'))} AS panier_moyen,
       {fc(f"min({cents('s.montant')})")} AS min_commande, {fc(f"max({cents('s.montant')})")} AS max_commande,
       min(s.date) AS premiere_commande, max(s.date) AS derniere_commande,
       {i(f"date_diff('day', max(s.date), DATE '{AS_OF}')")} AS recence_jours,
       CASE WHEN count(s.id_vente) >= 10 THEN 'Très fréquent' WHEN count(s.id_vente) >= 5 THEN 'Fréquent'
            WHEN count(s.id_vente) >= 2 THEN 'Occasionnel' ELSE 'Unique' END AS frequence_cat
FROM silver_sales s LEFT JOIN silver_customers c ON s.id_client = c.id_client
GROUP BY s.id_client, c.segment, c.ville, c.region, s.annee""",
    "g_ventes": f"""
SELECT id_produit, annee, mois, {b('sum(quantite)')} AS qte_vendue, count(id_vente) AS nb_ventes
FROM silver_sales GROUP BY id_produit, annee, mois""",
    "g_retours": f"""
SELECT id_produit, {i('year(date_retour)')} AS annee, {i('month(date_retour)')} AS mois,
       {b('sum(quantite_retournee)')} AS qte_retournee, count(id_retour) AS nb_retours
FROM silver_returns GROUP BY ALL""",
    "g_return_joined": """
SELECT v.id_produit, v.annee, v.mois, v.qte_vendue, v.nb_ventes,
       coalesce(r.qte_retournee, 0) AS qte_retournee, coalesce(r.nb_retours, 0) AS nb_retours,
       p.nom_produit, p.categorie, p.marque
FROM g_ventes v LEFT JOIN g_retours r ON v.id_produit = r.id_produit AND v.annee = r.annee AND v.mois = r.mois
LEFT JOIN silver_products p ON v.id_produit = p.id_produit""",
    "g_return_full_joined": """
SELECT coalesce(v.id_produit, r.id_produit) AS id_produit, coalesce(v.annee, r.annee) AS annee,
       coalesce(v.mois, r.mois) AS mois, coalesce(v.qte_vendue, 0) AS qte_vendue,
       coalesce(v.nb_ventes, 0) AS nb_ventes, coalesce(r.qte_retournee, 0) AS qte_retournee,
       coalesce(r.nb_retours, 0) AS nb_retours, p.nom_produit, p.categorie, p.marque
FROM g_ventes v FULL JOIN g_retours r
  ON v.id_produit = r.id_produit AND v.annee = r.annee AND v.mois = r.mois
LEFT JOIN silver_products p ON coalesce(v.id_produit, r.id_produit) = p.id_produit""",
    "g_category_brand": f"""
SELECT p.categorie, p.marque, s.annee, s.mois, s.trimestre, {measures()},
       count(DISTINCT s.id_client) AS clients_uniques, sum({cents('s.montant')}) AS _ca
FROM silver_sales s LEFT JOIN silver_products p ON s.id_produit = p.id_produit
GROUP BY p.categorie, p.marque, s.annee, s.mois, s.trimestre""",
    "g_category": f"""
SELECT p.categorie, s.annee, s.mois, s.trimestre, {measures()},
       count(DISTINCT s.id_client) AS clients_uniques, sum({cents('s.montant')}) AS _ca
FROM silver_sales s LEFT JOIN silver_products p ON s.id_produit = p.id_produit
GROUP BY p.categorie, s.annee, s.mois, s.trimestre""",
    "g_customer_segments": f"""
SELECT cu.segment, ch.type, s.annee, s.mois, count(DISTINCT s.id_client) AS nb_clients,
       count(s.id_vente) AS nb_commandes, {fc(f"sum({cents('s.montant')})")} AS chiffre_affaires,
       {fc(hus(f"sum({cents('s.montant')})", 'count(s.montant)'))} AS panier_moyen,
       {fc(hus(f"sum({cents('s.montant')})", 'count(DISTINCT s.id_client)'))} AS ca_par_client
FROM silver_sales s LEFT JOIN silver_customers cu ON s.id_client = cu.id_client
LEFT JOIN silver_channels ch ON s.id_canal = ch.id_canal
GROUP BY cu.segment, ch.type, s.annee, s.mois""",
}


def with_rate(src: str) -> str:
    rate = f"CASE WHEN qte_vendue > 0 THEN {pct('qte_retournee', 'qte_vendue')} ELSE 0.0 END"
    return f"""
SELECT *, {rate} AS taux_retour_pct,
       CASE WHEN {rate} > 20 THEN 'Critique' WHEN {rate} > 10 THEN 'Élevé'
            WHEN {rate} > 5 THEN 'Normal' ELSE 'Faible' END AS niveau_retour
FROM {src}"""


def growth(src: str, keys: list[str], calendar: bool = False) -> str:
    w = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY annee ASC NULLS FIRST, mois ASC NULLS FIRST)"
    prev = f"lag(_ca, 1) {w}"
    if calendar:
        prev = f"CASE WHEN lag(annee * 12 + mois, 1) {w} = annee * 12 + mois - 1 THEN {prev} END"
    cols = ", ".join(keys)
    return f"""
SELECT {cols}, annee, mois, trimestre, nb_commandes, total_quantite, chiffre_affaires, panier_moyen,
       clients_uniques, {fc('_prev')} AS ca_mois_prec,
       CASE WHEN _prev IS NOT NULL AND _prev <> 0 THEN {pct('_ca - _prev', '_prev')} END AS croissance_mom_pct
FROM (SELECT *, {prev} AS _prev FROM {src})"""


CTES = {**BRONZE, **SILVER, **TEXT, **GOLD}


def sql(select: str) -> str:
    """Wrap a final SELECT with every CTE (DuckDB skips the unreferenced ones)."""
    body = ",\n".join(f"{name} AS ({text.strip()})" for name, text in CTES.items())
    return f"WITH {body}\n{select.strip()}"


def _cols(*names: str) -> str:
    return ", ".join(names)


DAILY_COLS = ("date, annee, mois, semaine, trimestre, id_canal, type, canal_nom, nb_commandes, total_quantite, "
              "chiffre_affaires, panier_moyen, clients_uniques, total_remises, total_remises_brut")

BRONZE_TABLES = ("sales", "customers", "products", "stocks", "returns", "channels")
FEEDS = ("feed_nested", "feed_flat")
LOAD_TABLES = [("bronze", t) for t in (*BRONZE_TABLES, *FEEDS)] + [("silver", t) for t in (*FEEDS, "sales_enriched")] + [
    ("silver", t) for t in ("sales", "customers", "products", "returns", "stocks", "channels")] + [
    ("gold", t) for t in ("sales_daily", "sales_by_channel", "sales_by_region", "top_products",
                          "customer_basket", "return_rate", "sales_by_category", "customer_segments")]


SALES_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in SALES_COLS)


def _load_report(tables=None, status=lambda layer, t: "ok", more: str = "") -> str:
    parts = []
    for layer, t in tables or LOAD_TABLES:
        src = f"{layer}_{t}" if layer != "gold" else f"g_{t}"
        if t in FEEDS:
            src = "part"
        if t == "sales_enriched":
            src = "silver_sales"
        if t == "return_rate":
            src = "g_return_joined"
        if t == "sales_by_category":
            src = "g_category_brand"
        parts.append(f"SELECT '{layer}' AS layer, '{t}' AS table_name, count(*) AS rows, '{status(layer, t)}' AS status, "
                     f"CAST(0 AS BIGINT) AS corrupt_rows{more} FROM {src}")
    return "\nUNION ALL\n".join(parts)


_DOUBLES = ("prix_unitaire", "montant", "prix", "prix_achat", "poids_kg", "montant_rembourse")


def _inferred() -> str:
    """The type of each bronze column from its text, doubles beyond plain notation being written with an exponent."""
    whole, digits = "'[+-]?(0|[1-9][0-9]*)'", "length(regexp_replace(v, '[^0-9]', '', 'g'))"
    parts = []
    for t, cols in (("sales", [*SALES_COLS]), ("customers", CUSTOMER_COLS), ("products", PRODUCT_COLS), ("returns", RETURN_COLS),
                    ("stocks", STOCK_COLS), ("channels", CHANNEL_COLS)):
        for c in cols:
            text = f"CAST({c} AS VARCHAR)"
            if c in _DOUBLES:
                text = f"CASE WHEN abs({c}) >= 1e7 OR {c} <> 0 AND abs({c}) < 1e-3 THEN '1E9' ELSE {text} END"
            fraction = "length(regexp_extract(v, '\\.([0-9]+)$', 1))"
            parts.append(f"""
SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS rows, count(*) FILTER (v IS NULL) AS empty,
  CASE WHEN count(v) = 0 THEN 'void'
    WHEN bool_and(regexp_full_match(v, {whole}) AND TRY_CAST(v AS INTEGER) IS NOT NULL) FILTER (v IS NOT NULL) THEN 'int'
    WHEN bool_and(regexp_full_match(v, {whole}) AND TRY_CAST(v AS BIGINT) IS NOT NULL) FILTER (v IS NOT NULL) THEN 'bigint'
    WHEN bool_and(regexp_full_match(v, '[+-]?(0|[1-9][0-9]*)(\\.[0-9]+)?'))
      THEN 'decimal(' || max({digits} - {fraction}) + max({fraction}) || ',' || max({fraction}) || ')'
    WHEN bool_and(TRY_CAST(v AS DOUBLE) IS NOT NULL AND NOT regexp_full_match(v, '[+-]?0[0-9]+.*')) FILTER (v IS NOT NULL) THEN 'double'
    WHEN bool_and(regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND TRY_CAST(v AS DATE) IS NOT NULL)
      FILTER (v IS NOT NULL) THEN 'date'
    ELSE 'string' END AS type_name
FROM (SELECT nullif(trim({text}), '') AS v FROM bronze_{t})""")
    return "\nUNION ALL\n".join(parts)


def _validate_layers() -> str:
    keys = {"sales": "id_vente", "customers": "id_client", "products": "id_produit",
            "stocks": "id_stock", "returns": "id_retour", "channels": "id_canal"}
    parts = []
    for t, k in keys.items():
        src = f"bronze_{t}"
        parts.append(f"SELECT '{t}' AS table_name, 'rows' AS check_name, count(*) AS value FROM {src}")
        parts.append(f"SELECT '{t}', 'null_keys', count(*) FILTER (WHERE {k} IS NULL) FROM {src}")
        parts.append(f"SELECT '{t}', 'duplicate_keys', count({k}) - count(DISTINCT {k}) FROM {src}")
    refs = [("sales", "id_client", "customers"), ("sales", "id_produit", "products"),
            ("sales", "id_canal", "channels"), ("returns", "id_produit", "products"),
            ("stocks", "id_produit", "products")]
    for fact, fk, dim in refs:
        parts.append(
            f"SELECT '{fact}', 'orphan_{fk}', count(*) FROM bronze_{fact} f WHERE f.{fk} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM bronze_{dim} d WHERE d.{keys[dim]} = f.{fk})")
    return "\nUNION ALL\n".join(parts)


FINAL = {
    "ingest_all": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows FROM bronze_{t}"
        for t in ("sales", "customers", "products", "stocks", "returns", "channels")),
    "sink_roundtrip": "SELECT * FROM silver_sales",
    "sink_partitioned": f"SELECT {DAILY_COLS} FROM g_sales_daily",
    "sink_ranges": f"SELECT {DAILY_COLS} FROM g_sales_daily",
    "load_report": _load_report(),
    "load_report_catalog": _load_report(more=", TRUE AS listed"),
    "load_report_resumed": _load_report([x for x in LOAD_TABLES if x[1] not in FEEDS],
                                        lambda layer, t: "ok" if t in ("returns", "return_rate") else "kept"),
    "catalog_refresh": f"""
SELECT id_client, {fix_enc('ville')} AS ville, {SEGMENT} AS segment, segment AS segment_brut FROM bronze_customers""",
    "ingest_csv_inferred": _inferred(),
    "ingest_products_inferred": """
SELECT CAST(id_produit AS INTEGER) AS id_produit, nom_produit, categorie, marque, prix, prix_achat, poids_kg, stock_initial,
       CAST(NULL AS VARCHAR) AS _corrupt_record, 'products' AS source FROM bronze_products""",
    "ingest_json_inferred": """
SELECT CASE WHEN p_partkey % 3 < 2 THEN CAST(p_partkey AS VARCHAR) WHEN p_partkey % 2 = 0 THEN 'P' || p_partkey END AS id,
       CASE WHEN p_partkey % 3 < 2 OR p_partkey % 2 = 0 THEN p_name END AS title,
       CASE p_partkey % 3 WHEN 0 THEN floor(p_retailprice) WHEN 1 THEN p_retailprice END AS price,
       CASE p_partkey % 3 WHEN 0 THEN (p_size % 50) / 10 WHEN 1 THEN CAST(p_size % 5 AS DOUBLE) END AS rating_rate,
       CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size * 7 AS BIGINT) END AS rating_count,
       CASE WHEN p_partkey % 3 = 1 THEN p_brand || '|' || p_type END AS tags,
       CASE WHEN p_partkey % 3 = 2 AND p_partkey % 2 = 0 THEN CAST(p_size AS BIGINT) END AS dims_w,
       CASE WHEN p_partkey % 3 = 2 AND p_partkey % 2 = 0 THEN p_size / 4 END AS dims_h_cm,
       CASE WHEN p_partkey % 3 = 2 AND p_partkey % 2 = 1 THEN '{cut ' || p_name END AS _corrupt_record
FROM part""",
    "repair_mojibake_runs": """
SELECT id_retour, 'Fès “œuvre” 日本 ' || motif || ' Ã‰tÃ© déjà Å“uf Ã' AS motif_mixte,
       'Fès “œuvre” 日本 ' || replace(motif, 'Ã©', 'é') || ' Été déjà œuf Ã' AS motif_repare FROM bronze_returns""",
    "segment_by_rules": f"""
SELECT id_client, {SEGMENT} AS segment, lower(trim(segment)) IN ('premium', 'standard', 'vip') AS matched FROM bronze_customers""",
    "segment_unmatched": """
SELECT segment AS value, count(*) AS rows FROM bronze_customers
WHERE lower(trim(segment)) NOT IN ('premium', 'standard', 'vip') GROUP BY segment""",
    "distinct_customers_sketch": """
SELECT annee, mois, id_canal, count(*) AS nb_ventes, count(DISTINCT id_client) AS clients_uniques, TRUE AS dans_la_borne
FROM silver_sales GROUP BY annee, mois, id_canal""",
    **{f"clean_{t}": f"SELECT * FROM silver_{t}"
       for t in ("sales", "customers", "products", "returns", "stocks", "channels")},
    **{f"clean_{t}_basic": f"SELECT * FROM basic_{t}"
       for t in ("sales", "customers", "products", "returns", "stocks", "channels")},
    "sales_enriched": """
SELECT s.*, c.type, c.nom AS canal_nom, c.ville AS canal_ville, c.region AS canal_region
FROM silver_sales s LEFT JOIN silver_channels c ON s.id_canal = c.id_canal""",
    "filter_not_null": "SELECT id_client, email FROM bronze_customers WHERE id_client IS NOT NULL AND email IS NOT NULL",
    "filter_positive": "SELECT id_produit, prix FROM bronze_products WHERE prix > 0",
    "filter_range_or_null": "SELECT id_client, age FROM bronze_customers WHERE age >= 16 OR age IS NULL",
    "price_band": "SELECT id_produit, prix, tranche_prix FROM silver_products",
    "margin_pct": "SELECT id_produit, prix, prix_achat, marge_pct FROM silver_products",
    "stock_flags": "SELECT id_stock, stock_net, en_rupture, sous_seuil FROM silver_stocks",
    "frequency_band": "SELECT id_client, annee, nb_commandes, frequence_cat FROM g_customer_basket",
    "return_band": f"SELECT id_produit, annee, mois, taux_retour_pct, niveau_retour FROM ({with_rate('g_return_joined')})",
    "segment_canonical": f"SELECT id_client, segment AS segment_brut, {SEGMENT} AS segment FROM bronze_customers",
    "discount_total": f"""
SELECT s.annee, s.mois, {fc(REM)} AS total_remises, {fc(REM_BRUT)} AS total_remises_brut
FROM silver_sales s GROUP BY s.annee, s.mois""",
    "fix_encoding": f"SELECT id_client, ville, {fix_enc('ville')} AS ville_reparee FROM bronze_customers",
    # code points below 256 are the bytes that the text was decoded from
    "repair_mojibake": """
SELECT id_retour, motif, CASE WHEN regexp_matches(motif, '[Â-ô][\u0080-¿]')
  THEN coalesce(try(decode(unhex(array_to_string(list_transform(string_split(motif, ''), lambda c: printf('%02X', unicode(c))), '')))), motif)
  ELSE motif END AS motif_repare
FROM bronze_returns""",
    **{name: f"SELECT {SALES_TEXT}, CAST(NULL AS VARCHAR) AS _corrupt_record, {source} AS source FROM bronze_sales"
       for name, source in (("ingest_csv", "'sales'"),
                            ("ingest_csv_incremental", "CASE WHEN date < DATE '1998-01-01' THEN '0' ELSE '1' END"))},
    **{name: f"""
SELECT CAST(p_partkey AS VARCHAR) AS id, ' ' || p_name || ' ' AS title, upper(p_type) AS category,
       CAST(p_retailprice AS VARCHAR) AS price, CAST(NULL AS VARCHAR) AS _corrupt_record, {more}
FROM part""" for name, more in (
        ("ingest_json", "CAST((p_size % 50) / 10 AS VARCHAR) AS rating_rate, CAST(p_size * 7 AS VARCHAR) AS rating_count, "
                        "'landing-feed-nested' AS source"),
        ("ingest_json_envelope", "p_brand AS brand, CAST((p_size % 50) / 10 AS VARCHAR) AS rating, "
                                 "CAST(p_size * 10 AS VARCHAR) AS stock, 'landing-feed-envelope' AS source"))},
    **{f"clean_{t}_from_text": f"SELECT * FROM xsilver_{t}" for t in ("sales", "customers", "products")},
    # the feeds are landed as JSON derived from `part`; cleaned values only
    # depend on it (JSON keeps doubles exact through their shortest text)
    "clean_feed_nested": """
SELECT p_partkey AS id, p_name AS title, lower(p_type) AS category, p_retailprice AS price,
       (p_size % 50) / 10 AS rating_rate, CAST(p_size * 7 AS INTEGER) AS rating_count
FROM part""",
    "clean_feed_flat": """
SELECT p_partkey AS id, p_name AS title, lower(p_type) AS category, trim(p_brand) AS brand,
       p_retailprice AS price, (p_size % 50) / 10 AS rating, CAST(p_size * 10 AS INTEGER) AS stock
FROM part""",
    "dedup_single_key": _dedup(
        "(SELECT id_vente, id_client, id_produit, id_canal, date, quantite, prix_unitaire, "
        "CAST(remise_pct AS DOUBLE) AS remise_pct, montant, statut FROM bronze_sales)",
        ["id_vente"], SALES_COLS),
    "dedup_composite_key": "SELECT * FROM basic_stocks",
    "join_sales_channels": """
SELECT s.id_canal, s.id_vente, s.date, s.montant, c.type, c.nom AS canal_nom
FROM silver_sales s LEFT JOIN silver_channels c ON s.id_canal = c.id_canal""",
    "join_sales_customers": """
SELECT s.id_client, s.id_vente, s.date, s.montant, c.ville, c.region, c.segment
FROM silver_sales s LEFT JOIN silver_customers c ON s.id_client = c.id_client""",
    "join_sales_products": """
SELECT s.id_produit, s.id_vente, s.date, s.montant, p.nom_produit, p.categorie, p.marque, p.tranche_prix
FROM silver_sales s LEFT JOIN silver_products p ON s.id_produit = p.id_produit""",
    "distinct_customers": """
SELECT annee, mois, count(DISTINCT id_client) AS clients_uniques, count(DISTINCT id_produit) AS produits_distincts
FROM silver_sales GROUP BY annee, mois""",
    "revenue_share": f"""
SELECT type, annee, mois, {fc('_ca')} AS chiffre_affaires,
       CASE WHEN sum(_ca) OVER (PARTITION BY annee, mois) <> 0
            THEN {pct('_ca', 'sum(_ca) OVER (PARTITION BY annee, mois)')} ELSE 0.0 END AS part_ca_pct
FROM (SELECT c.type, s.annee, s.mois, sum({cents('s.montant')}) AS _ca
      FROM silver_sales s LEFT JOIN silver_channels c ON s.id_canal = c.id_canal
      GROUP BY c.type, s.annee, s.mois)""",
    "top_products_k": """
SELECT id_produit, nom_produit, categorie, marque, tranche_prix, annee, mois, nb_commandes,
       total_quantite_vendue, chiffre_affaires, panier_moyen, rang_ca
FROM g_top_products WHERE rang_ca <= 10""",
    "category_growth": growth("g_category", ["categorie"]),
    "category_growth_calendar": growth("g_category", ["categorie"], calendar=True),
    "sales_daily": f"SELECT {DAILY_COLS} FROM g_sales_daily",
    "sales_by_channel": "SELECT * FROM g_sales_by_channel",
    "sales_by_region": "SELECT * FROM g_sales_by_region",
    "top_products": "SELECT * FROM g_top_products",
    "customer_basket": "SELECT * FROM g_customer_basket",
    "return_rate": with_rate("g_return_joined"),
    "return_rate_full": with_rate("g_return_full_joined"),
    "sales_by_category": growth("g_category_brand", ["categorie", "marque"]),
    "customer_segments": "SELECT * FROM g_customer_segments",
    "stock_alerts": """
SELECT st.id_stock, st.id_produit, p.nom_produit, st.depot, st.quantite_disponible, st.quantite_reservee,
       st.seuil_reappro, st.stock_net, st.en_rupture, st.sous_seuil
FROM silver_stocks st LEFT JOIN silver_products p ON st.id_produit = p.id_produit
WHERE st.en_rupture OR st.sous_seuil""",
    "product_margin": """
SELECT id_produit, nom_produit, categorie, marque, prix, prix_achat, marge, marge_pct, taux_marge_pct,
       tranche_prix FROM silver_products""",
    "amount_check": f"""
SELECT id_vente, quantite, prix_unitaire, remise_pct, montant, montant_calc,
       {fc(f"{cents('montant')} - {cents('montant_calc')}")} AS ecart
FROM silver_sales WHERE abs({cents('montant')} - {cents('montant_calc')}) > 1""",
    "validate_layers": _validate_layers(),
}


def oracle_sql() -> dict[str, str]:
    return {name: sql(select) for name, select in FINAL.items()}
