from decimal import Decimal

from pyspark.sql import functions as F

from brasa.functions.columns import band, clean_text, pct, ratio, round_dec, safe_number, surrogate_key, trim_null
from brasa.plans.staging import post_category


def _one(spark, col, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col.alias("y")).collect()]


def test_clean_text(spark):
    got = _one(spark, clean_text("x"), [("  IDA ",), ("   ",), (None,), ("Festivo Víspera",)])
    assert got == ["ida", None, None, "festivo víspera"]


def test_trim_null_keeps_case(spark):
    assert _one(spark, trim_null("x"), [(" Brigada A ",), ("",)]) == ["Brigada A", None]


def test_safe_number(spark):
    got = _one(spark, safe_number("x"), [("12",), (" 12 ",), ("12.7",), ("",), ("x",), (None,)])
    assert got == [Decimal(12), Decimal(12), Decimal(13), None, None, None]


def test_surrogate_key_null_safe(spark):
    df = spark.createDataFrame([(1, None)], "a bigint, b string")
    got = df.select(surrogate_key("a", "b").alias("k"), F.md5(F.lit("1-_dbt_utils_surrogate_key_null_")).alias("e")).first()
    assert got["k"] == got["e"]


def test_ratio_zero_and_null_denominator(spark):
    df = spark.createDataFrame([(1, 0), (None, None), (1, 8)], "a bigint, b bigint")
    got = [r[0] for r in df.select(pct("a", "b")).collect()]
    assert got == [None, None, Decimal("12.50")]


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("2.675"),), (Decimal("-2.675"),)], "x decimal(10,3)")
    assert [r[0] for r in df.select(round_dec("x", 2)).collect()] == [Decimal("2.68"), Decimal("-2.68")]


def test_ratio_is_exact_decimal(spark):
    df = spark.createDataFrame([(1, 3)], "a bigint, b bigint")
    assert df.select(ratio("a", "b")).first()[0] == Decimal("0.333333")


def test_post_classification_fixture(spark):
    """The reference's unit test: seven posts -> categories."""
    posts = [("Conductor",), ("Operador",), ("Bombero",), ("Subinspector",), ("Oficial",), (None,), ("Coordinador",)]
    got = _one(spark, post_category(clean_text("x")), posts)
    assert got == ["Tropa", "Tropa", "Tropa", "Mando", "Mando", "Administrativo", "Desconocido"]


def test_band(spark):
    got = _one(spark, band(F.col("x"), [(7, "a"), (30, "b")], "c"), [(7,), (8,), (31,), (None,)], "x int")
    assert got == ["a", "b", "c", "c"]
