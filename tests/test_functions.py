from datetime import date

from pyspark.sql import functions as F

from tallyline import functions as fn


def one(spark, expression, **values):
    schema = ", ".join(f"{k} string" for k in values) or "x string"
    row = spark.createDataFrame([tuple(values.values()) or ("",)], schema)
    return row.select(expression.alias("v")).first()["v"]


def test_text_and_token_forms(spark):
    assert one(spark, fn.normalize_text("a"), a="  Acme \t Bio\n ") == "ACME BIO"
    assert one(spark, fn.normalize_token("a"), a=" p-1001 ") == "P1001"
    assert one(spark, fn.normalize_token("a"), a="Acme Bio!") == "ACMEBIO"
    assert one(spark, fn.normalize_text("a"), a=None) is None
    assert one(spark, fn.normalize_token("a", null_as_blank=True), a=None) == ""


def test_business_key_keeps_the_place_of_missing_parts(spark):
    a = one(spark, fn.business_key("a", "b"), a="x", b=None)
    b = one(spark, fn.business_key("a", "b"), a=None, b="x")
    assert (a, b) == ("x|", "|x")


def test_reasons_are_joined(spark):
    rules = {"first": F.lit(True), "second": F.lit(None).cast("boolean"), "third": F.lit(True)}
    assert one(spark, fn.join_reasons(rules)) == "first|third"
    assert one(spark, fn.join_reasons({"first": F.lit(False)})) == ""


def test_batch_date(spark):
    assert one(spark, fn.batch_date_from_path("p"), p="/x/batch_date=2026-01-15/a.csv") == "2026-01-15"
    assert one(spark, fn.batch_date_from_path("p"), p="/x/a.csv") == ""


def test_similarity(spark):
    assert one(spark, fn.similarity("a", "b"), a="", b="") == 1.0
    assert one(spark, fn.similarity("a", "b"), a="ABCD", b="ABXD") == 0.75
    assert one(spark, fn.similarity("a", "b"), a="ABC", b="") == 0.0
    assert one(spark, F.expr(fn.similarity_sql("a", "b")), a="IMMUNO-440", b="LUNG-101") == 0.3


def test_bad_dates_and_amounts_are_null(spark):
    assert one(spark, fn.safe_date("a"), a="2026-02-03") == date(2026, 2, 3)
    assert one(spark, fn.safe_date("a"), a="zz") is None
    assert one(spark, fn.currency("a"), a="2.675") == 2.68
    assert one(spark, fn.currency("a"), a="x") is None
    assert one(spark, fn.outstanding(F.col("a").cast("double"), F.col("b").cast("double")), a="0.3", b="0.1") == 0.2


def test_weighted_score(spark):
    df = spark.createDataFrame([(1.0, 0.3, None), (None, None, None)], "a double, b double, c double")
    parts = [("a", 0.45), ("b", 0.25), ("c", 0.30)]
    fair = [r.v for r in df.select(fn.weighted_score(parts).alias("v")).collect()]
    plain = [r.v for r in df.select(fn.weighted_score(parts, renormalize=False).alias("v")).collect()]
    assert fair == [0.75, 0.0]
    assert plain == [0.525, 0.0]


def test_record_hash(spark):
    value = one(spark, fn.record_hash(["a", "b"]), a="x", b="y")
    assert len(value) == 64
    assert one(spark, fn.record_hash(["a", "b"]), a="x", b=None) == one(spark, fn.record_hash(["a", "b"]), a="x", b="")
