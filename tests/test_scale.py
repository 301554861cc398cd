"""Heavy keys, blocks and plans: results stay whole however the work is cut up."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import aggregates, clustering, distributions, neighbours, pairs, quantify, ranking, splits
from tallyloom.plans import skew
from tallyloom.plans.sizing import Summary, broadcast_limit, lookup_join, plan_bytes
from tallyloom.queries import REGISTRY


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark):
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).cast("int").alias("k"), F.col("id").alias("v")
    )
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(40)] + [(7, "again")], "k int, name string")
    return fact, dim


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_join(skewed, how):
    fact, dim = skewed
    spread = skew.spread_join(fact, dim, ["k"], how, heavy_rows=100)
    plain = fact.join(dim, ["k"], how).select(*spread.columns)
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def test_heavy_key_is_dealt_to_many_salts(skewed):
    fact, _ = skewed
    heavy = skew.heavy_keys(fact, ["k"], 100)
    assert [r["k"] for r in heavy.collect()] == [7]
    salts = skew.salted(fact, heavy, ["k"], ["v"]).where("k = 7").groupBy(skew.SALT).count().collect()
    assert len(salts) > 5 and max(r["count"] for r in salts) < 250


def test_lookup_join_broadcasts_only_what_fits(spark, skewed):
    fact, dim = skewed
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert broadcast_limit(dim) == 0 and plan_bytes(dim) > 0
        spread = lookup_join(fact, dim, ["k"], spread=True).count()
        assert lookup_join(fact, dim, ["k"]).count() == spread
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert broadcast_limit(dim) == 10 * 1024 * 1024
    assert spread == fact.join(dim, "k").count()


def test_summary_too_large_to_broadcast(skewed):
    fact, dim = skewed
    names = dim.dropDuplicates(["k"])
    small, large = Summary(names), Summary(names, max_rows=5)
    assert small.small and not large.small
    assert sorted(map(str, small.join_to(fact, ["k"]).collect())) == sorted(map(str, large.join_to(fact, ["k"]).collect()))


def test_pairs_of_a_group_cut_into_blocks(spark):
    members = [(1, m) for m in range(60)] + [(2, m) for m in range(5)]
    df = spark.createDataFrame(members, "g int, m int")
    got = sorted((r.g, r.a, r.b) for r in pairs.member_pairs(df, "g", "m", block=10).collect())
    want = sorted((g, a, b) for g, n in ((1, 60), (2, 5)) for a, b in itertools.combinations(range(n), 2))
    assert got == want


def test_pages_hold_every_value_of_a_heavy_key(spark, monkeypatch):
    monkeypatch.setattr(skew.heavy_keys, "__defaults__", (100,))
    df = spark.createDataFrame([(1, i) for i in range(1000)] + [(2, 5), (2, 3)], "k int, v int")
    pages = aggregates.collect_pages(df, ["k"], "v", page=30).collect()
    assert max(len(r.v_list) for r in pages) <= 30
    assert len({(r.k, r.part) for r in pages}) == len(pages)
    assert sorted(v for r in pages if r.k == 1 for v in r.v_list) == list(range(1000))
    assert [list(r.v_list) for r in pages if r.k == 2] == [[3, 5]]


def test_stratified_split_is_exact_and_complete(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("label"))
    cuts = [("train", 80), ("validation", 90), ("test", 100)]
    split = splits.stratified_split(df, "id", "label", cuts)
    assert split.count() == 5000 and split.select("id").distinct().count() == 5000
    sizes = {(r.label, r.part): r["count"] for r in split.groupBy("label", "part").count().collect()}
    for label, n in ((r.label, r["count"]) for r in df.groupBy("label").count().collect()):
        assert sizes[label, "train"] == n * 80 // 100
        assert sizes[label, "train"] + sizes[label, "validation"] == n * 90 // 100
    tiny = spark.createDataFrame([(1, "x"), (2, None), (3, None)], "id int, label string")
    assert splits.stratified_split(tiny, "id", "label", cuts).count() == 3
    again = splits.stratified_split(df.repartition(13), "id", "label", cuts)
    assert again.join(split, ["id", "label", "part"]).count() == 5000


def vectors(spark, n, d=6, seed=1, copies=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, d)), 3)
    x[:copies] = x[0]
    rows = [(int(i), int(i % 3), [float(v) for v in x[i]]) for i in range(n)]
    return x, spark.createDataFrame(rows, "id bigint, label int, v array<double>").repartition(5)


@pytest.mark.parametrize(("k", "block", "copies"), [(3, 16_384, 0), (5, 40, 0), (4, 25, 100), (400, 64, 0)])
def test_nearest_equals_brute_force(spark, k, block, copies):
    x, df = vectors(spark, 300, copies=copies)
    queries, base = df.where("id % 5 = 0"), df.where("id % 5 <> 0")
    found = neighbours.nearest(queries, base, "id", "v", "label", k, cells=8, block=block)
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
        assert r["label"] == r["neighbour"] % 3
    ids = [i for i in range(300) if i % 5]
    for q in range(0, 300, 5):
        d = np.round(np.sqrt(((x[ids] - x[q]) ** 2).sum(1)), 9)
        want = [i for _, i in sorted(zip(d, ids, strict=True))][:k]
        assert got[q] == want


def test_vote_rules(spark):
    rows = [(1, 1, 0.0, 9), (1, 2, 0.1, 4), (1, 3, 0.1, 4), (2, 1, 0.1, 8), (2, 2, 1.0, 3), (2, 3, 1.0, 3)]
    near = spark.createDataFrame([(i, r, d, r, lab) for i, r, d, lab in rows], "id int, rank int, distance double, neighbour int, label int")
    got = {(r.id, r.k, r.weights): r.predicted for r in neighbours.vote(near, "id", "label", [2, 3], ["uniform", "distance"]).collect()}
    assert got[1, 3, "uniform"] == 4 and got[1, 3, "distance"] == 9
    assert got[1, 2, "uniform"] == 4 and got[2, 3, "distance"] == 8 and got[2, 3, "uniform"] == 3


def test_silhouettes_equal_brute_force(spark):
    x, df = vectors(spark, 90)
    label = np.array([i % 3 for i in range(90)])

    def brute(distance):
        scores = []
        for i in range(90):
            own = (label == label[i]) & (np.arange(90) != i)
            a = distance[i, own].mean()
            b = min(distance[i, label == c].mean() for c in range(3) if c != label[i])
            scores.append((b - a) / max(a, b))
        return np.array(scores)

    squared = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    both = df.withColumn("one", F.lit(1))
    got = clustering.silhouette_rows(both, "id", "v", ["label", "one"], block=17).orderBy("id").collect()
    assert np.allclose([r.silhouette_label for r in got], brute(np.sqrt(squared)))
    assert {r.silhouette_one for r in got} == {0.0}
    assert np.isclose(clustering.silhouette_squared(df, "v", "label").first()[0], brute(squared).mean())


def test_quantiles_of_a_heavy_class(spark):
    df = spark.range(9001).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 5).alias("k"), (F.col("id") * F.col("id")).cast("double").alias("v"))
    exact = {r.k: (r.q0, r.q1) for r in distributions.exact_quantiles(df, "k", "v", [0.1, 0.5]).collect()}
    want = df.groupBy("k").agg(F.percentile("v", 0.1).alias("a"), F.percentile("v", 0.5).alias("b")).collect()
    for r in want:
        assert np.allclose(exact[r.k], (r.a, r.b))


@pytest.mark.parametrize("limit", [0, 10_000])
def test_running_total(spark, limit):
    df = spark.range(500).select("id", (F.col("id") % 3).cast("double").alias("v")).repartition(6)
    got = [r.running for r in ranking.running_total(df, ["v", "id"], "v", max_rows=limit).orderBy("v", "id").collect()]
    assert got == list(np.cumsum(sorted(i % 3 for i in range(500))))


def test_plans(spark, sf_dir):
    # A top-k per group is limited before and after the shuffle.
    assert plan(REGISTRY["topk_per_group"].run(spark, sf_dir)).count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(REGISTRY["top_products_by_qty"].run(spark, sf_dir))
    assert "LeftAnti" in plan(REGISTRY["orders_only_match_anti"].run(spark, sf_dir))
    # Aggregation by product happens before the product table is joined.
    text = plan(REGISTRY["top_products_by_qty"].run(spark, sf_dir))
    assert text.index("BroadcastHashJoin") < text.index("HashAggregate")
    # Only the named columns are read.
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in REGISTRY["top_products_by_qty"].run(
        spark, sf_dir)._jdf.queryExecution().toString()


RELATIONAL = [n for n, q in REGISTRY.items() if q.run and q.sql and not n.startswith(("knn", "gmm", "silhouette", "box", "split", "drop_c"))]


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_python_no_cross_join(spark, sf_dir, name):
    text = plan(REGISTRY[name].run(spark, sf_dir))
    for forbidden in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert forbidden not in text


def test_only_match_needs_one_exchange(spark):
    lines = spark.range(100).select((F.col("id") % 10).alias("o"), F.lit("x").alias("b"))
    text = plan(quantify.only_match(lines, ["o"], F.col("b") == "x"))
    assert text.count("Exchange") == 1


def test_top_k_per_group_of_a_heavy_group(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("g"), "id")
    got = ranking.top_k_per_group(df, ["g"], [F.desc("id")], 2).where("g = 0").orderBy("rank")
    assert [r["id"] for r in got.collect()] == [1999, 1997]


def test_a_pass_sends_the_driver_one_total(spark, monkeypatch):
    from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

    from tallyloom.operators.passes import sums_by_slot

    x = np.random.default_rng(1).random((400, 40))
    rows = spark.createDataFrame([(v,) for v in x.tolist()], StructType([StructField("v", ArrayType(DoubleType()))])).repartition(20).persist()
    received, collect = [], type(rows).toArrow

    def counted(frame):
        table = collect(frame)
        received.append(table.nbytes)
        return table

    monkeypatch.setattr(type(rows), "toArrow", counted)
    for slots in (3, 300):
        got = sums_by_slot(rows, lambda blocks, n=slots: np.outer(np.arange(n), sum(b.sum(0) for (b,) in blocks)), (slots, 40), 20)
        assert np.allclose(got, np.outer(np.arange(slots), x.sum(0)))
    rows.unpersist()
    # Twenty partitions of 300 x 40 numbers would be 1.9 MB.
    assert received[1] < 300 * 40 * 8 * 1.2


def test_pairs_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    from tallyloom.operators import pairs

    rows = spark.range(900).selectExpr("id % 90 AS g", "id AS m")
    want = sorted(pairs.pair_counts(rows, "g", "m").collect())
    monkeypatch.setattr(pairs, "TASK_MEMBERS", 40)
    assert pairs.member_pairs(rows, "g", "m").rdd.getNumPartitions() == 23
    assert sorted(pairs.pair_counts(rows, "g", "m").collect()) == want


def test_positions_need_no_shuffle_of_rows_for_their_start(spark):
    from tallyloom.plans.ranks import ordered_rank

    rows = spark.range(4_000).selectExpr("id % 3 AS k", "id AS v").where("k < 2")
    placed = ordered_rank(rows, ["k"], ["v"], "place")
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and "strategy=broadcast" in plan
    assert placed.where("place <> v div 3").count() == 0
