"""Cases that once went wrong."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import text as tx
from tallyloom.operators import clustering, distributions, pairs, splits
from tallyloom.plans import skew
from tallyloom.sources.readers import read_typed_csv


def test_typed_csv_can_be_counted(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,x\nbad,y\n3,z\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    rows = read_typed_csv(spark, str(tmp_path), schema)
    assert rows.count() == 2 and [tuple(r) for r in rows.orderBy("a").collect()] == [(1, "x"), (3, "z")]
    assert rows.agg(F.count(F.lit(1))).first()[0] == 2


def test_year_ranges_with_a_hyphen_stay(spark):
    df = spark.createDataFrame([("(2015-2022)",), ("2015–2022",), ("(I) 2018",), ("2018 -",), ("x",)], "y string")
    got = df.select(tx.tidy_year(F.col("y")).alias("y")).select("y", tx.is_year_range(F.col("y")).alias("r")).collect()
    assert [tuple(r) for r in got] == [("2015-2022", True), ("2015–2022", True), ("2018", False), ("2018 -", True), ("Unknown", False)]


def test_inner_empty_items_stay(spark):
    df = spark.createDataFrame([("Stars:a,,b , |c,,",), (",a",), ("",), (", ,",)], "c string")
    assert [r[0] for r in df.select(tx.tidy_list(F.col("c"))).collect()] == ["a, , b , c", ", a", "", ""]


def test_rows_without_label_are_split_too(spark):
    df = spark.range(1000).withColumn("label", F.when(F.col("id") % 2 == 0, F.lit("a")))
    got = splits.stratified_split(df, "id", "label", [("train", 80), ("test", 100)])
    counts = {(r.label, r.part): r["count"] for r in got.groupBy("label", "part").count().collect()}
    assert counts == {("a", "train"): 400, ("a", "test"): 100, (None, "train"): 400, (None, "test"): 100}
    assert got.columns == ["id", "label", "part"]


def test_every_heavy_key_is_spread(spark):
    fact = spark.range(30_000).select((F.col("id") % 1_500).alias("k"), "id")
    assert skew.heavy_keys(fact, ["k"], 15).count() == 1_500
    nulls = fact.withColumn("k", F.when(F.col("k") > 700, F.col("k")))
    heavy = skew.heavy_keys(nulls, ["k"], 15)
    assert skew.salted(nulls, heavy, ["k"], ["id"]).where("k IS NULL").select(skew.SALT).distinct().count() > 100
    dim = spark.range(1_500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = skew.spread_join(nulls, dim, ["k"], "left", 15)
    assert joined.count() == 30_000 and joined.where("v IS NULL").count() == nulls.where("k IS NULL").count()


def test_many_groups_over_the_block_size(spark):
    df = spark.range(1_500 * 6).select((F.col("id") % 1_500).alias("g"), F.col("id").alias("m"))
    assert pairs.member_pairs(df, "g", "m", block=4).count() == 1_500 * 15


def test_a_tiny_cluster_seeds_a_centre(spark):
    r = np.random.RandomState(0)
    x = np.concatenate([r.standard_normal((7_990, 3)), 400 + r.standard_normal((4, 3)), -400 + r.standard_normal((6, 3))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    model = clustering.best_kmeans(clustering.fit_kmeans(df, "id", "v", [(3, s) for s in range(3)]))
    assert sorted(np.round(model.centres[:, 0] / 400).tolist()) == [-1.0, 0.0, 1.0]


@pytest.mark.parametrize("offset", [0.0, 1e8])
def test_a_common_offset_changes_nothing(spark, offset):
    r = np.random.RandomState(1)
    x = np.concatenate([r.standard_normal((60, 2)), 8 + r.standard_normal((60, 2))])
    df = spark.createDataFrame([(i, (v + offset).tolist(), int(i >= 60)) for i, v in enumerate(x)], "id long, v array<double>, c int")
    model = clustering.best_kmeans(clustering.fit_kmeans(df, "id", "v", [(2, s) for s in range(3)]))
    cost = sum(((x[k * 60 : k * 60 + 60] - x[k * 60 : k * 60 + 60].mean(0)) ** 2).sum() for k in range(2))
    assert abs(model.cost - cost) < 1e-4 * cost
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    own = np.arange(120) < 60
    same = own[:, None] == own[None]
    a, b = (d * same).sum(1) / 59, (d * ~same).sum(1) / 60
    expected = ((b - a) / np.maximum(a, b)).mean()
    rows = clustering.silhouette_rows(df, "id", "v", ["c"], block=50)
    assert abs(rows.agg(F.avg("silhouette_c")).first()[0] - expected) < 1e-6
    q = d**2
    a, b = (q * same).sum(1) / 59, (q * ~same).sum(1) / 60
    assert abs(clustering.silhouette_squared(df, "v", "c").first()[0] - ((b - a) / np.maximum(a, b)).mean()) < 1e-6


def test_correlation_leaves_missing_cells_out_pair_by_pair(spark):
    r = np.random.RandomState(2)
    x = r.standard_normal((300, 4)) + 1e6
    x[:, 3] = 5.0
    known = r.rand(300, 4) < 0.8
    df = spark.createDataFrame(
        [[float(v) if k else None for v, k in zip(a, b, strict=True)] for a, b in zip(x, known, strict=True)],
        "a double, b double, c double, d double",
    )
    got = {(r.a, r.b): r.r for r in distributions.correlation_matrix(df, list("abcd")).collect()}
    for i, p in enumerate("abc"):
        for j, q in enumerate("abc"):
            both = known[:, i] & known[:, j]
            assert abs(got[p, q] - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-9
    assert got["a", "d"] is None and got["d", "d"] == 1.0
