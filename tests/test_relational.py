"""Edge cases of the relational operators on small literal frames."""

import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators import aggregates, compare, distributions, evaluation, pairs, quantify, ranking
from tallyloom.plans.durable import scratch_path, written
from tallyloom.sources import readers, writers
from tallyloom.sources.calendar import calendar


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_top_k_keeps_equal_totals(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "app string, total bigint")
    assert rows(ranking.top_k(df, [F.desc("total"), F.col("app")], 3)) == [("c", 9), ("a", 5), ("b", 5)]


def test_arg_max_tie_goes_to_smallest_key_and_underscores_are_safe(spark):
    df = spark.createDataFrame([("d", "b_1", 3), ("d", "a_2", 3), ("e", "x", 1), ("e", "y", -2)], "day string, app string, n bigint")
    assert rows(ranking.arg_max_per_group(df, ["day"], "n", "app"), "day") == [("d", "a_2", 3), ("e", "x", 1)]


def test_nth_largest_marks_ties_and_short_input(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 4.0), (3, 4.0), (4, 1.0)], "id int, v double")
    assert [r[0] for r in ranking.at_or_above_nth(df, "v", 2).where("selected").orderBy("id").collect()] == [1, 2, 3]
    assert ranking.at_or_above_nth(df, "v", 100).where("selected").count() == 4


def test_top_and_bottom_on_short_input(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    assert ranking.top_and_bottom(df, "v", "k", 3).count() == 4


def test_period_change_first_year_zero_and_negative(spark):
    df = spark.createDataFrame([("s", 1, 7), ("s", 2, 3), ("s", 3, 0), ("s", 4, 5), ("t", 2, 1)], "s string, y int, n bigint")
    got = {(r.s, r.y): r.change for r in compare.period_change(df, ["s"], "y", "n").collect()}
    assert got == {("s", 1): None, ("s", 2): "-57%", ("s", 3): "-100%", ("s", 4): None, ("t", 2): None}


def test_class_summary_of_an_absent_class_is_zero(spark):
    df = spark.createDataFrame([(True, 2.0, 3), (True, None, 5)], "s boolean, v double, w bigint")
    assert rows(compare.class_summary(df, "s", "v", "w"), "s") == [(False, 0.0, 0, 0), (True, 1.0, 8, 2)]


def test_blank_keys_are_left_out(spark):
    df = spark.createDataFrame([("R", 2.0), ("R", 4.0), ("", 9.0), (" ", 9.0), (None, 9.0)], "c string, v double")
    assert rows(aggregates.stats_by(df, "c", "v")) == [("R", 2, 6.0, 3.0)]


def test_unknown_brand_fails_all_match_but_not_only_match(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (2, "x"), (3, "y"), (4, None)], "k int, brand string")
    hit = F.col("brand") == "x"
    assert rows(quantify.all_match(df, ["k"], hit)) == [(2,)]
    assert rows(quantify.only_match(df, ["k"], hit), "k") == [(1,), (2,)]
    assert rows(quantify.only_match_anti(df, ["k"], hit), "k") == [(1,), (2,)]


def test_table_functions(spark):
    lines = spark.createDataFrame([(1, 10, "x"), (1, 11, "y"), (2, 12, "x"), (3, 13, None)], "customer bigint, order_key bigint, brand string")
    lines.createOrReplaceTempView("test_lines")
    quantify.register_table_functions(spark, "test_lines")
    assert rows(spark.sql("SELECT * FROM customers_of_one_brand('x')")) == [(2,)]
    assert sorted(rows(spark.sql("SELECT * FROM orders_of_one_brand('x')"))) == [(10,), (12,)]


def test_pairs_counts_and_repeated_titles(spark):
    df = spark.createDataFrame(
        [(1, "T", "b"), (1, "T", "a"), (1, "T", "a"), (2, "T", "a"), (2, "T", "b"), (3, "U", "a"), (4, "V", "a"), (4, "V", "c")],
        "id int, title string, who string",
    )
    assert rows(pairs.pair_counts(df, "id", "who"), "a", "b") == [("a", "b", 2), ("a", "c", 1)]
    listed = {(r.a, r.b): list(r.title_list) for r in pairs.pair_titles(df, "id", "who", "title").collect()}
    assert listed == {("a", "b"): ["T", "T"], ("a", "c"): ["V"]}


def test_null_profile_and_indicators(spark):
    df = spark.createDataFrame([(1, None, 1, 0), (None, None, 1, 1)], "a int, b string, s_x int, `s_y.z` int")
    assert rows(aggregates.null_profile(df.select("a", "b")), "column") == [("a", "int", 1, 1), ("b", "string", 0, 2)]
    assert rows(aggregates.indicator_totals(df, "s_"), "indicator") == [("s_x", 2), ("s_y.z", 1)]


def test_calendar_counts_working_days(spark):
    df = spark.createDataFrame([(datetime.date(2024, 8, 30),), (datetime.date(2024, 9, 2),)], "d date")
    got = rows(calendar(df, "d"), "day")
    assert [(r[1], r[2]) for r in got] == [("Friday", True), ("Saturday", False), ("Sunday", False), ("Monday", True)]
    assert calendar(df.where("false"), "d").count() == 0


def test_box_stats_match_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    data = [("a", float(x)) for x in rng.normal(size=501)] + [("b", 7.0)] * 40 + [("b", 1000.0), ("b", None)] + [("c", 1.0)]
    got = {r.k: r for r in distributions.box_stats(spark.createDataFrame(data, "k string, v double"), "k", "v").collect()}
    for k in "abc":
        v = np.array([x for key, x in data if key == k and x is not None])
        q = np.quantile(v, [0.25, 0.5, 0.75])
        assert np.allclose([got[k].q1, got[k].median, got[k].q3], q)
        inside = v[(v >= q[0] - 1.5 * (q[2] - q[0])) & (v <= q[2] + 1.5 * (q[2] - q[0]))]
        assert (got[k].whisker_low, got[k].whisker_high, got[k].outliers) == (inside.min(), inside.max(), len(v) - len(inside))


def test_histogram_has_area_one_per_class(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(11)] + [("b", 10.0)], "k string, v double")
    bins = distributions.density_histogram(df, "k", "v", 5)
    area = bins.groupBy("k").agg(F.round(F.sum(F.col("density") * 2.0), 9).alias("area"))
    assert {r.k: r.area for r in area.collect()} == {"a": 1.0, "b": 1.0}
    assert bins.agg(F.max("bin")).first()[0] == 4


def test_adjusted_rand(spark):
    df = spark.createDataFrame([(i, i % 3, (i % 3) * 10, i % 2) for i in range(60)], "id int, a int, b int, c int")
    assert evaluation.adjusted_rand(df, "a", "b").first()[0] == 1.0
    assert abs(evaluation.adjusted_rand(df, "a", "c").first()[0]) < 0.05


def test_report_covers_classes_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "b")], "y string, p string")
    got = {r["class"]: (r.precision, r.recall, r.support) for r in evaluation.classification_report(df, "y", "p").collect()}
    assert got["a"] == (1.0, 0.5, 2) and got["b"] == (0.0, 0.0, 0) and got["c"] == (0.0, 0.0, 1)
    assert abs(got["accuracy"][0] - 1 / 3) < 1e-12


def test_elbow(spark):
    bend = [100.0, 40.0, 15.0, 10.0, 8.0, 7.0, 6.5, 6.2, 6.0]
    df = spark.createDataFrame([("bend", k + 2, c) for k, c in enumerate(bend)] + [("line", k, 10.0 - k) for k in range(9)], "c string, k int, cost double")
    assert rows(evaluation.elbow(df, "c", "k", "cost")) == [("bend", 4)]


def test_best_config_prefers_the_earlier_of_equals(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.9), (2, 0.9)], "position int, score double")
    assert evaluation.best_config(df, "score", ["position"]).first()["position"] == 1


def test_csv_typed_drops_bad_lines_whole(spark, tmp_path):
    path = tmp_path / "usage.csv"
    path.write_text(
        'Date,App,Usage,Opened\n2024-08-01,"A, B",5,7\n2024-08-02,C,x,1\n2024-08-02,C\nnope,C,1,1\n'
        '2024-08-03,"D ""q""",3,4\n\n2024-08-03,E_F,3,\n',
        encoding="utf-8",
    )
    schema = T.StructType([
        T.StructField("day", T.DateType()), T.StructField("app", T.StringType()),
        T.StructField("usage", T.IntegerType()), T.StructField("opened", T.IntegerType()),
    ])
    got = rows(readers.read_typed_csv(spark, str(path), schema), "day", "app")
    assert [(r[1], r[2], r[3]) for r in got] == [("A, B", 5, 7), ('D "q"', 3, 4), ("E_F", 3, None)]
    assert readers.read_inferred_csv(spark, str(path)).columns == ["Date", "App", "Usage", "Opened"]


def test_csv_multi_line_record(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('a,b\n"x\ny",1\n', encoding="utf-8")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    assert rows(readers.read_typed_csv(spark, str(path), schema, multi_line=True)) == [("x\ny", 1)]


def test_parse_csv_column_quotes_and_trailing_empties(spark):
    df = spark.createDataFrame([(1, 'T,"Action, Crime",,8.5,'), (2, "U,Drama,x,,")], "id int, line string")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("t", "g", "c")] + [T.StructField("r", T.DoubleType()), T.StructField("z", T.StringType())])
    got = rows(readers.parse_csv_column(df, "line", schema), "id")
    assert got[0][1:5] == ("T", "Action, Crime", None, 8.5)
    assert got[1][4] is None


def test_pairs_round_trip_and_written(spark):
    df = spark.createDataFrame([("a", 1), ("é", 2)], "k string, v bigint")
    path = scratch_path(spark, "kv")
    writers.write_pairs(df, "k", "v", path)
    back = writers.read_pairs(spark, path, T.StructField("k", T.StringType()), T.StructField("v", T.LongType()))
    assert rows(back, "k") == [("a", 1), ("é", 2)]
    assert rows(written(df, "copy"), "k") == [("a", 1), ("é", 2)]
