import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.functions import numeric
from tallyloom.functions import text as tx
from tallyloom.operators import aggregates


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("(2018)", "2018"), ("[I] 2018", "2018"), ("2015–2022", "2015–2022"), ("(2018– )", "2018–"), ("２０１８", "2018"),
        ("（２０１８）", "2018"), ("", "Unknown"), ("TBA", "Unknown"), (" <> ", "Unknown"), (None, "Unknown"),
    ],
)
def test_tidy_year(spark, raw, clean):
    assert one(spark, raw, tx.tidy_year) == clean


@pytest.mark.parametrize(
    ("year", "series"), [("2015–2022", True), ("2018–", True), ("2015-2022", True), ("2018", False), ("Unknown", False)]
)
def test_is_year_range(spark, year, series):
    assert one(spark, year, tx.is_year_range) is series


def test_tidy_list(spark):
    cell = "Stars:| Ann Lee,Bo Ek ,, 'Ann Lee'|"
    assert one(spark, cell, tx.tidy_list) == "Ann Lee, Bo Ek , , Ann Lee"
    assert one(spark, cell, tx.tidy_list_distinct) == "Ann Lee, Bo Ek"


def test_digits(spark):
    assert one(spark, "1,234", tx.digits_value) == 1234
    assert one(spark, "none", tx.digits_value) is None
    assert one(spark, "9" * 30, tx.digits_value) is None


def test_words_drop_empty_tokens(spark):
    def found(text, **options):
        df = spark.createDataFrame([(text,)], "x string")
        return [r.word for r in aggregates.word_rows(df, tx.words(F.col("x")), **options).collect()]

    assert found("  Big  big\tCAT ") == ["big", "big", "cat"]
    assert found("   ") == []
    assert found("to be long", min_length=3) == ["long"]
    assert found("The cat", drop=tx.STOP_WORDS) == ["cat"]


def test_plain_words_split_on_accents(spark):
    assert one(spark, "Été 2_a!", lambda c: tx.plain_words(c)) == ["", "t", "2_a", ""]


def test_number_text_is_anchored(spark):
    assert one(spark, ' "8.5"', tx.number_text) == 8.5
    assert one(spark, "8.5x", tx.number_text) is None
    assert one(spark, "", tx.number_text) is None


def test_percent_truncates_and_guards(spark):
    rows = spark.createDataFrame([(-4, 7), (1, 0), (1, None), (5, 3)], "a bigint, b bigint")
    got = [r[0] for r in rows.select(numeric.percent_of(F.col("a"), F.col("b"))).collect()]
    assert got == [-57, None, None, 166]


def test_row_mean_skips_nulls(spark):
    rows = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    got = [r[0] for r in rows.select(numeric.row_mean([F.col(c) for c in "abc"])).collect()]
    assert got == [2.0, None]


def test_strict_and_lenient_parsing(spark):
    bad = spark.createDataFrame([("x",)], "v string")
    assert bad.select(F.col("v").try_cast("int")).first()[0] is None
    with pytest.raises(PySparkException):
        bad.select(F.col("v").cast("int")).collect()
    assert bad.select(F.try_to_date(F.lit("2024-13-01"), "yyyy-MM-dd")).first()[0] is None
    assert bad.select(F.try_to_date(F.lit("2024-12-01"), "yyyy-MM-dd")).first()[0] == datetime.date(2024, 12, 1)
