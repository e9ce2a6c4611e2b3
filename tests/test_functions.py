"""Column helpers: exact rounding, text repair, bands, typing."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import (
    canonical_segment,
    cents,
    fix_category,
    fix_encoding,
    fix_reason,
    fix_refund_status,
    fix_sale_status,
    frequency_band,
    half_up,
    half_up_signed,
    pct_of,
    price_band,
    repair_mojibake,
    return_band,
    strip_spaces,
    typed_column,
)


def _one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_half_up_ties_and_signs(spark):
    rows = [(5, 2), (-5, 2), (7, 2), (-7, 2), (4, 3), (-4, 3), (5, 3), (-5, 3), (0, 7),
            (5, -2), (-5, -2), (3, 0), (None, 2)]
    got = _one(spark, half_up_signed("n", "d"), "n long, d long", rows)
    assert got == [3, -3, 4, -4, 1, -1, 2, -2, 0, -3, 3, None, None]
    assert _one(spark, half_up("n", "d"), "n long, d long", [(5, 2), (1, 0), (1, -1)]) == [3, None, None]


def test_pct_of_is_exact(spark):
    # 1/3 = 33.333.. -> 33.33 ; 2/3 -> 66.67 ; 1/8 = 12.5 exactly ; -1/8 -> -12.5
    rows = [(1, 3), (2, 3), (1, 8), (-1, 8), (1, 0), (1, 200000)]
    got = _one(spark, pct_of("p", "w"), "p long, w long", rows)
    assert got == [33.33, 66.67, 12.5, -12.5, None, 0.0]
    # 1/200000 = 0.0005 % -> 0.0 at 2 decimals; 1/20000 = 0.005 % -> 0.01 (half-up)
    assert _one(spark, pct_of("p", "w"), "p long, w long", [(1, 20000)]) == [0.01]


def test_cents_rounds_half_up(spark):
    # 0.125 and -0.375 are exact binary halves of a cent; 12.34 has two decimals
    got = _one(spark, cents("x"), "x double", [(12.34,), (0.125,), (-0.375,), (-1.5,), (None,)])
    assert got == [1234, 13, -38, -150, None]


def test_cents_as_round_without_going_through_text(spark):
    values = [0.125, -0.375, 2.675, 1.005, -1.005, 0.145, 0.285, 4.35, 0.0049999999999999, -0.0049999999999999, 0.005, -0.005, -0.0, 45035996273704.955, 92233720368547758.0,
              -92233720368547758.0, 1e17, 1e300, float("nan"), float("inf"), float("-inf"), 12345678901234.565, 5e-324, None]
    df = spark.createDataFrame([(v,) for v in values], "x double").union(spark.range(-20000, 20000).selectExpr("id / 800D"))
    got = df.select("x", cents("x").alias("c"), F.round(F.col("x") * 100).try_cast("bigint").alias("want"))
    assert got.filter("NOT (c <=> want)").collect() == []
    assert "round(" not in got.select("c")._jdf.queryExecution().optimizedPlan().toString()


def test_fix_encoding_rule_table(spark):
    rows = [('FÃ"s',), ("MarrakÃ©ch",), ("CafÃ©",), ("Ã la",), ("Fès",), (None,)]
    got = _one(spark, fix_encoding("s"), "s string", rows)
    assert got == ["Fès", "Marrakech", "Café", "àla", "Fès", None]


def test_column_rules(spark):
    assert _one(spark, fix_category("s"), "s string",
                [("A%olectronique",), ("Ã©lectronique",), ("Mode",)]) == ["Électronique"] * 2 + ["Mode"]
    assert _one(spark, fix_sale_status("s"), "s string",
                [(" Livré ",), ("LivrÃ©",), ("livrã@",), ("EN COURS",)]) == ["livré"] * 3 + ["en cours"]
    assert _one(spark, fix_reason("s"), "s string",
                [("ArrivÃ© endommagÃ©",), ("ArrivÃ@ endommagÃ@",)]) == ["Arrivé endommagé"] * 2
    assert _one(spark, fix_refund_status("s"), "s string",
                [("remboursÃ©",), ("en Ãcours",)]) == ["remboursé", "en cours"]


def test_repair_mojibake(spark):
    rows = [("FÃ¨s",), ("Ã‰lectronique",), ("VÃªtements",), ("Ã  la",), ("Fès",),
            ("日本 Ã©",), ("😀",), ("œuvre “ok”",), (None,), ("",), ("Fès Ã©",)]
    got = _one(spark, repair_mojibake("s"), "s string", rows)
    assert got == ["Fès", "Électronique", "Vêtements", "à la", "Fès", "日本 Ã©", "😀",
                   "œuvre “ok”", None, "", "Fès Ã©"]


def test_segment_and_spaces(spark):
    assert _one(spark, canonical_segment("s"), "s string",
                [("premium",), ("VIP",), ("Standard",), ("Gold",), (None,)]) == [
        "Premium", "VIP", "Standard", "Gold", None]
    assert _one(spark, strip_spaces("s"), "s string", [("06 12 34\t56 78",)]) == ["0612345678"]


def test_bands_at_thresholds(spark):
    assert _one(spark, price_band("p"), "p double",
                [(99.99,), (100.0,), (499.99,), (500.0,), (1999.99,), (2000.0,)]) == [
        "Bas", "Moyen", "Moyen", "Haut", "Haut", "Premium"]
    assert _one(spark, frequency_band("n"), "n long", [(1,), (2,), (4,), (5,), (9,), (10,)]) == [
        "Unique", "Occasionnel", "Occasionnel", "Fréquent", "Fréquent", "Très fréquent"]
    assert _one(spark, return_band("r"), "r double",
                [(5.0,), (5.01,), (10.0,), (10.01,), (20.0,), (20.01,)]) == [
        "Faible", "Normal", "Normal", "Élevé", "Élevé", "Critique"]


def test_typed_column_never_raises(spark):
    df = spark.createDataFrame([("2024-02-30", "12x", "3.5"), ("2027-01-01", "7", None)],
                               "d string, i string, x string")
    out = df.select(typed_column(df, "d", "date").alias("d"), typed_column(df, "i", "int").alias("i"),
                    typed_column(df, "x", "double").alias("x"),
                    F.weekofyear(typed_column(df, "d", "date")).alias("w")).collect()
    assert out[0]["d"] is None and out[0]["i"] is None and out[0]["x"] == 3.5
    assert out[1]["d"] == dt.date(2027, 1, 1) and out[1]["i"] == 7 and out[1]["w"] == 53


def test_typed_column_keeps_whole_numbers_and_drops_non_finite(spark):
    df = spark.createDataFrame([("3.0", "NaN"), ("2.7", "Infinity"), ("-4", "1e20"), ("1e99", "12.5"), (None, None)], "i string, x string")
    out = df.select(typed_column(df, "i", "int").alias("i"), typed_column(df, "x", "double").alias("x"),
                    cents(typed_column(df, "x", "double")).alias("c")).collect()
    assert [tuple(r) for r in out] == [(3, None, None), (2, None, None), (-4, 1e20, None), (None, 12.5, 1250), (None, None, None)]
    df = spark.createDataFrame([(float("nan"), 2.0), (float("inf"), float("nan"))], "x double, i double")
    out = df.select(typed_column(df, "x", "double").alias("x"), typed_column(df, "i", "int").alias("i"), cents("x").alias("c")).collect()
    assert [tuple(r) for r in out] == [(None, 2, None), (None, None, None)]


def test_integers_written_as_fractions_are_not_cast_in_vain(spark):
    texts = ["3.0", "-2.7", " 12 ", "+7\n", "1e3", "2147483648", "-2147483648", "", "n/a", "٣", "0x1F", "NaN", "1 2", None, "\x7f5\x01", "9007199254740993"]
    df = spark.createDataFrame([(s,) for s in texts], "i string")
    plain = F.coalesce(F.col("i").try_cast("int"), F.when(F.abs(F.col("i").try_cast("double")) < float("inf"), F.col("i").try_cast("double")).try_cast("int"))
    wide = F.coalesce(F.col("i").try_cast("bigint"), F.col("i").try_cast("double").try_cast("bigint"))
    got = df.select("i", typed_column(df, "i", "int").alias("g"), plain.alias("p"), typed_column(df, "i", "bigint").alias("b"), wide.alias("w")).collect()
    assert [(r.i, r.g) for r in got] == [(r.i, r.p) for r in got]
    assert [r.b for r in got if r.i != "NaN"] == [r.w for r in got if r.i != "NaN"]
    plan = df.select(typed_column(df, "i", "int"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan.upper()  # a failing text cast throws inside Spark: only tried where it can succeed


def test_sizing_conf_scales_with_input():
    from tidemark.session import sizing_conf

    small = sizing_conf(10 << 20, cores=8)
    big = sizing_conf(100 << 40, cores=8000)   # 100 TiB on 8000 cores
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_rounding_falls_back_to_decimal_on_overflow(spark):
    from decimal import Decimal

    big = Decimal(9_000_000_000_000_000_001)  # 2*n overflows a bigint
    got = _one(spark, half_up_signed("n", "d"), "n decimal(38,0), d long",
               [(big, 2), (-big, 2), (big, -3)])
    assert got == [4_500_000_000_000_000_001, -4_500_000_000_000_000_001, -3_000_000_000_000_000_000]
    # part * 10000 overflows a bigint: 1e16 / 3e16 -> 33.33 %
    assert _one(spark, pct_of("p", "w"), "p long, w long", [(10**16, 3 * 10**16)]) == [33.33]
