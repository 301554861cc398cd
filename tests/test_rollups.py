"""Distinct counts merged from stored sketches against exact ones."""

from pyspark.sql import functions as F

from tallyloom.operators import rollups
from tallyloom.queries import REGISTRY


def test_weekdays_and_years_from_daily_sketches(spark):
    folder = "/root/testdata/sf0.1"
    got = {(r.level, r.part): r for r in REGISTRY["distinct_rollup"].run(spark, folder).collect()}
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    exact = {}
    for level, part in (("weekday", F.date_format("o_orderdate", "EEEE")), ("year", F.year("o_orderdate").cast("string"))):
        for r in orders.groupBy(part.alias("p")).agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("d")).collect():
            exact[level, r.p] = (r.n, r.d)
    assert got.keys() == exact.keys()
    for key, (n, distinct) in exact.items():
        assert got[key].n == n
        assert abs(got[key].customers - distinct) <= 4 * rollups.standard_error() * distinct


def test_nulls_empty_tables_and_a_heavy_group(spark):
    frame = spark.range(30_000).select(
        (F.col("id") % 3 == 0).alias("day"), F.when(F.col("id") % 5 > 0, F.col("id") % 7_000).alias("v")
    ).unionByName(spark.createDataFrame([(None, None)], "day boolean, v long"))
    stored = rollups.distinct_sketches(frame, {"day": F.col("day")}, "v")
    whole = rollups.rolled_up(stored, {"all": F.lit(1)}).first()
    exact = frame.agg(F.countDistinct("v")).first()[0]
    assert whole.n == 30_001 and abs(whole.distinct - exact) <= 4 * rollups.standard_error() * exact
    by_day = {r.day: r for r in rollups.rolled_up(stored, {"day": F.col("day")}).collect()}
    assert by_day[None].n == 1 and by_day[None].distinct == 0
    assert rollups.rolled_up(rollups.distinct_sketches(frame.where("false"), {"day": F.col("day")}, "v"), {"day": F.col("day")}).count() == 0
