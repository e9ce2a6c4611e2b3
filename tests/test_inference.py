import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import SEGMENT_CANONICAL, repair_mojibake_runs
from tidemark.operators import rules, sketches
from tidemark.sources import inference


def types(spark, **columns):
    rows = list(zip(*columns.values()))
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))
    return {r.column_name: (r.type_name, r.empty) for r in inference.column_types(df).collect()}


@pytest.mark.parametrize("values, want", [
    (["1", "-2", "+3"], "int"), (["1", "2147483648", "0"], "bigint"), (["1", "9223372036854775808", "0"], "decimal(19,0)"),
    (["1", "2.50", "-10"], "decimal(4,2)"), (["1", "2.5", "1e3"], "double"), ([".5", "1", "2"], "double"), (["NaN", "1", "-Infinity"], "double"),
    (["9" * 39, "1", "2"], "double"), (["2020-01-31", "1999-12-01", "2000-02-29"], "date"), (["2020-02-30", "2020-01-01", "2020-01-02"], "string"),
    (["2020-01-31", "1", "2"], "string"), (["0612345678", "0611111111", "1"], "string"), (["0", "0.5", "00.5"], "string"), (["a", "1", "2"], "string"),
    ([" 7 ", "8", "9"], "int"), (["1", "2", "٣"], "string"), (["true", "false", "true"], "string"), (["1-", "2", "3"], "string")])
def test_least_type_of_all_values(spark, values, want):
    assert types(spark, c=values) == {"c": (want, 0)}


def test_values_beside_the_common_ones(spark):
    got = types(spark, a=["12\n", "3", None], b=["12\u0085", "3", None], c=["-2147483648", "2147483648", None], d=["9" * 38, "-1", None], e=["-9223372036854775808", "1", ""],
                f=["1.50\n", "-22", None], g=["2020-01-01\n", "2020-01-02", "1"], h=["+1e5", "1.", "3"])
    assert got == {"a": ("int", 1), "b": ("decimal(2,0)", 1), "c": ("bigint", 1), "d": ("decimal(38,0)", 1), "e": ("bigint", 1), "f": ("decimal(4,2)", 1),
                   "g": ("string", 0), "h": ("double", 0)}


def test_the_code_for_a_value_does_not_grow_with_the_columns(spark):
    """Patterns are matched in code for one value: repeated for every column, it was too long to be compiled."""
    def patterns(n):
        plan = inference.column_types(spark.createDataFrame([], ", ".join(f"c{k} string" for k in range(n))))
        return plan._jdf.queryExecution().optimizedPlan().toString().count("RLIKE")

    assert 0 < patterns(30) == patterns(2)


def test_empty_values_and_tables(spark):
    got = types(spark, **{"all null": [None, None, None], "blank": ["", "  ", None], "some": ["5", None, ""], "filled": ["x", "y", "z"],
                          "rows": ["1", "2", "3"], "c1": ["1", "2", "x"]})
    assert got == {"all null": ("void", 3), "blank": ("void", 3), "some": ("int", 2), "filled": ("string", 0), "rows": ("int", 0), "c1": ("string", 0)}
    none = spark.createDataFrame([], "a string, b string")
    assert [tuple(r) for r in inference.column_types(none).collect()] == [("a", "void", 0, 0), ("b", "void", 0, 0)]


def test_an_unknown_csv_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,when,amount,tél,note\n1,2020-01-01,1.5,0612,x\n2,2020-01-02,2,0613,\n")
    (tmp_path / "in" / "b.csv").write_text("id,when,amount,tél,note\n3,2020-01-03,10.25,0614,\"a,b\"\n4,2020\n")
    df = inference.ingest_csv_inferred(spark, f"{tmp_path}/in")
    assert dict(df.dtypes) | {"_ingested_at": 0} == {"id": "int", "when": "date", "amount": "decimal(4,2)", "tél": "string", "note": "string",
                                                      "_corrupt_record": "string", "_ingested_at": 0, "_source_file": "string"}
    rows = {r.id: r for r in df.collect()}
    assert str(rows[3].amount) == "10.25" and rows[3].note == "a,b" and rows[1]["tél"] == "0612" and rows[2].note is None
    assert rows[4]._corrupt_record == "4,2020" and rows[4].when is None and rows[1]._source_file.endswith("a.csv")


def land(tmp_path, *records):
    (tmp_path / "feed.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")
    return f"{tmp_path}/feed.json"


def test_records_of_different_fields(spark, tmp_path):
    path = land(tmp_path, {"id": 1, "price": 10, "rating": {"rate": 4, "n": 3}}, {"id": 2, "price": 10.5, "tags": ["a", "b"], "big": 2 ** 70},
                {"rating": {"by": {"name": "x"}, "rate": 4.25}, "id": "three", "price": None, "my `odd` VOID: key": True}, "{cut", "[1, 2]", "", "7",
                {"tags": [], "z": None, "o": [{"a": 1}, {"b": "s"}]}, {"price": 1e300})
    df = inference.ingest_json_inferred(spark, path)
    kinds = dict(df.dtypes)
    assert kinds["id"] == "string" and kinds["price"] == "double" and kinds["rating"] == "struct<by:struct<name:string>,n:bigint,rate:double>"
    assert kinds["tags"] == "array<string>" and kinds["o"] == "array<struct<a:bigint,b:string>>" and kinds["z"] == "string"
    assert kinds["big"].startswith("decimal") and kinds["my `odd` VOID: key"] == "boolean"
    rows = df.collect()
    assert [r.id for r in rows if r.id] == ["1", "2", "three"] and [r.price for r in rows] == [10.0, 10.5, None, None, None, None, None, 1e300]
    assert rows[1].big == 2 ** 70 and rows[2].rating.by.name == "x" and rows[2].rating.rate == 4.25 and rows[0].rating.rate == 4.0
    assert [r._corrupt_record for r in rows if r._corrupt_record] == ["{cut", "[1, 2]", "7"]


def test_feeds_without_a_record(spark, tmp_path):
    rows = inference.ingest_json_inferred(spark, land(tmp_path, "nope", "[]"))
    assert rows.columns == ["_corrupt_record", "_ingested_at", "_source_file"] and rows.count() == 2
    assert inference.ingest_json_inferred(spark, land(tmp_path, "", " ")).count() == 0
    whole = land(tmp_path, '{"a":\n 1, "b": {"c": [1.5]}}')
    assert [(r.a, r.b.c) for r in inference.ingest_json_inferred(spark, whole, multi_line=True).collect()] == [(1, [1.5])]


@pytest.mark.parametrize("text, want", [
    ("Fès Ã©", "Fès é"), ("日本 Ã© 😀", "日本 é 😀"), ("œuvre “ok” Å“uf", "œuvre “ok” œuf"), ("Ã©Ã¨é", "éèé"), ("Ã", "Ã"), ("Ã  Ã ", "Ã  à"),
    ("â‚¬ et €", "€ et €"), ("ðŸ˜€!", "😀!"), ("déjà vu", "déjà vu"), ("Ã­", "í"), ("à\u0080\u0080", "à\u0080\u0080"), ("", ""), (None, None),
    ("Ã©\nÃ©", "é\né"), ("í \u0080", "í \u0080"), ("FÃ¨s", "Fès")])
def test_broken_parts_are_mended(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(repair_mojibake_runs("t")).first()[0] == want


def test_mending_equals_a_plain_loop(spark):
    import random
    import re

    high = dict(zip("€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ", [*range(0x80, 0x81), *range(0x82, 0x8D), 0x8E, *range(0x91, 0x9D), 0x9E, 0x9F]))
    more = "[\u0080-¿" + "".join(high) + "]"
    broken = re.compile(f"[Â-ß]{more}|[à-ï]{more}{{2}}|[ð-ô]{more}{{3}}")

    def mend(m):
        try:
            return bytes(high.get(c, ord(c)) for c in m[0]).decode()
        except UnicodeDecodeError:
            return m[0]

    rng = random.Random(4)
    letters = "aé ÃÂâðíôœ€“\u0080\u0093 ¿©¨日"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", repair_mojibake_runs("t").alias("r")).collect()
    assert all(r.r == broken.sub(mend, r.t) for r in got)


def test_rules(spark):
    table = spark.createDataFrame([("VIP ", "VIP"), ("premium", "Premium")], "key string, value string")
    df = spark.createDataFrame([(1, " vip"), (2, "Premium"), (3, "other "), (4, None), (5, "")], "id int, segment string")
    got = {r.id: (r.segment, r._matched) for r in rules.canonicalise(df, "segment", table).collect()}
    assert got == {1: ("VIP", True), 2: ("Premium", True), 3: ("other", False), 4: (None, None), 5: ("", False)}
    assert {r.id: r.segment for r in rules.canonicalise(df, "segment", table, keep_unknown=False).collect()} == {1: "VIP", 2: "Premium", 3: None, 4: None, 5: None}
    assert {(r.value, r.rows) for r in rules.unmatched(df, "segment", table).collect()} == {("other ", 1), ("", 1)}
    for bad in ([("a", "x"), ("A ", "y")], [(None, "x")], [(" ", "x")]):
        with pytest.raises(ValueError, match="unique"):
            rules.canonicalise(df, "segment", spark.createDataFrame(bad, "key string, value string"))
    assert len(SEGMENT_CANONICAL) == 3


def test_sketches_roll_up_within_the_bound(spark):
    sales = spark.range(200_000).selectExpr("date_add(date'2020-01-01', CAST(id % 60 AS int)) AS date", "CAST(id % 3 AS string) AS id_canal",
                                            "CAST(pmod(xxhash64(id), 30000) AS string) AS id_client")
    stored = sketches.daily_sketches(sales)
    assert dict(stored.dtypes)["sketch"] == "binary" and stored.count() == 60
    for keys in (["mois"], ["id_canal"], ["mois", "id_canal"], ["date"]):
        derived = {"mois": F.month("date")} if "mois" in keys else {}
        exact = sales.withColumns(derived).groupBy(*keys).agg(F.countDistinct("id_client").alias("exact"), F.count(F.lit(1)).alias("rows"))
        rows = sketches.rolled_up(stored, keys, **derived).join(exact, keys).withColumn(
            "ok", sketches.within_bound(F.col("distinct_estimate"), F.col("exact"))).collect()
        assert rows and all(r.ok and r.n == r.rows for r in rows)
    assert not spark.range(1).select(sketches.within_bound(F.lit(1200), F.lit(1000))).first()[0]
