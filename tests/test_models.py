"""Invariants of trained models on data with known structure."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import classifiers, clustering, components, evaluation, features, linear, passes, splits
from tallyloom.operators.classifiers import ForestSpec


@pytest.fixture(scope="module")
def blobs(spark):
    """Three well separated groups in five dimensions, two of them noise."""
    rng = np.random.default_rng(11)
    centres = np.array([[0, 0, 0], [6, 6, 0], [0, 6, 6]], dtype=float)
    rows, x = [], []
    for i in range(300):
        v = np.concatenate([centres[i % 3] + rng.normal(scale=0.5, size=3), rng.normal(scale=0.5, size=2)])
        x.append(v)
        rows.append((i, i % 3, [float(f) for f in v]))
    return np.array(x), spark.createDataFrame(rows, "id bigint, label int, v array<double>").repartition(4).persist()


@pytest.mark.parametrize("limit", [0, 1 << 25])
def test_kmeans_finds_the_groups(blobs, monkeypatch, limit):
    monkeypatch.setattr(passes, "DIRECT_BYTES", limit)
    x, df = blobs
    models = clustering.fit_kmeans(df, "id", "v", [(3, s) for s in range(4)] + [(k, 0) for k in (1, 2, 4)])
    best = clustering.best_kmeans(models[:4])
    assigned = clustering.assign_nearest(df, "v", best.centres)
    assert evaluation.adjusted_rand(assigned, "label", "cluster").first()[0] == 1.0
    cost = sum(((x[np.arange(300) % 3 == c] - x[np.arange(300) % 3 == c].mean(0)) ** 2).sum() for c in range(3))
    assert np.isclose(best.cost, cost)
    assert models[4].cost > models[5].cost > best.cost
    prefix = np.minimum.accumulate([m.cost for m in models[:4]])
    assert (np.diff(prefix) <= 0).all()


def test_mixture_finds_the_groups(blobs):
    x, df = blobs
    models = clustering.fit_mixtures(df, "id", "v", [(3, s) for s in range(3)] + [(2, 0)])
    best = clustering.best_mixture(models[:3])
    scored = clustering.mixture_responsibilities(df, "v", best)
    assert evaluation.adjusted_rand(scored, "label", "cluster").first()[0] == 1.0
    total = scored.select(F.abs(F.aggregate("responsibility", F.lit(0.0), lambda a, b: a + b) - 1).alias("e"))
    assert total.agg(F.max("e")).first()[0] < 1e-9
    assert np.isclose(best.weights.sum(), 1.0) and np.allclose(np.sort(best.weights), 1 / 3, atol=1e-3)
    assert best.score > models[3].score
    first = x[np.arange(300) % 3 == 0]
    nearest = np.abs(best.means - first.mean(0)).sum(1).argmin()
    assert np.allclose(best.variances[nearest], first.var(0), atol=1e-3)


def test_linear_svm_reaches_the_minimum(blobs):
    x, df = blobs
    fitted = linear.fit_linear_svm(df, "v", "label", [0.1, 10.0], tol=1e-5)
    ones = np.hstack([x, np.ones((300, 1))])
    for c, cost in enumerate(fitted.costs):
        for k in range(3):
            w, y = fitted.weights[c, k], np.where(np.arange(300) % 3 == k, 1.0, -1.0)
            slack = np.maximum(0.0, 1 - y * (ones @ w))
            gradient = w - 2 * cost * (y * slack) @ ones
            start = -2 * cost * y @ ones
            assert np.linalg.norm(gradient) < 1e-4 * np.linalg.norm(start)
    scored = linear.predict(df, "v", fitted).withColumn("guess", F.col("predictions")[1])
    assert evaluation.accuracy(scored, "label", "guess").first()[0] > 0.99


def test_components_match_numpy(blobs):
    x, df = blobs
    fitted = components.fit_components(df, "v")
    z = (x - x.mean(0)) / x.std(0)
    values = np.sort(np.linalg.eigvalsh(np.cov(z.T)))[::-1]
    assert np.allclose(fitted.share, values / values.sum())
    n = fitted.kept(0.80)
    assert fitted.share[:n].sum() >= 0.80 > fitted.share[:n - 1].sum()
    scores = np.array([r.scores for r in components.project(df, "v", fitted).orderBy("id").collect()])
    assert np.allclose(scores, z @ fitted.axes) and np.allclose(scores.mean(0), 0.0)
    loads = components.loadings(df.sparkSession, fitted, 5).agg(F.sum("score")).first()[0]
    assert np.isclose(loads, 5.0)


def test_outliers_far_from_the_training_centre(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 20 == 1, [float(v) for v in rng.normal(size=4) * (12 if i % 20 == 1 else 1)]) for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, odd boolean, v array<double>")
    marked = components.distance_outliers(df, "v", (F.col("id") % 5) != 1, top=20)
    scores = evaluation.binary_scores(marked, F.col("odd"), F.col("outlier")).first()
    assert marked.count() == 80 and scores.tp + scores.fp == 20 and scores.recall > 0.8


def test_forest_grid_and_folds(blobs):
    _, df = blobs
    rows = features.as_vectors(splits.stratified_split(df, "id", "label", [("train", 80), ("test", 100)]), "v")
    train, test = (classifiers.part(rows, p) for p in ("train", "test"))
    grid = classifiers.forest_grid(train, test, "label", [ForestSpec(5, 3), ForestSpec(10, None, 5)])
    assert [(r.trees, r.depth) for r in grid.orderBy("position").collect()] == [(5, "3"), (10, "None")]
    assert grid.agg(F.min("accuracy")).first()[0] > 0.9
    folded = train.withColumn("fold", splits.fold_number("id"))
    assert folded.select("fold").distinct().count() == 3
    scores, model = classifiers.cross_validated_forest(folded, "label", "fold", [ForestSpec(5, 2), ForestSpec(8, 4)])
    assert scores.count() == 2 and model.getNumTrees in (5, 8)
    weights = classifiers.importances(df.sparkSession, model)
    assert np.isclose(weights.agg(F.sum("importance")).first()[0], 1.0)


def test_reduced_features_drop_noise_and_twins(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        a, b = rng.normal(), rng.normal()
        rows.append((i, float(a + b > 0), [float(a), float(b), float(2 * a + 1e-3 * rng.normal()), 0.0]))
    df = spark.createDataFrame(rows, "id bigint, label double, v array<double>")
    vectors = features.as_vectors(df, "v")
    assert [tuple(r) for r in features.correlated_dimensions(vectors).collect()] == [(2, 0)]
    result = classifiers.full_against_reduced(df.where("id < 300"), df.where("id >= 300"), "v", "label", ForestSpec(20, 5))
    full, small = result.orderBy("features").collect()
    assert (full.n_features, small.n_features, small.unimportant, small.correlated) == (4, 2, 1, 1)
    assert abs(full.f1 - small.f1) < 0.1


def test_standardise(spark):
    df = spark.createDataFrame([(1.0, 5.0, "a"), (3.0, 5.0, "a"), (100.0, 5.0, "b")], "x double, c double, part string")
    got = features.standardise(df, ["x", "c"], fit_on=F.col("part") == "a").orderBy("x").collect()
    assert [(r.x, r.c) for r in got] == [(-1.0, 0.0), (1.0, 0.0), (98.0, 0.0)]
    whole = features.standardise(df, ["x"]).agg(F.avg("x"), F.stddev_pop("x")).first()
    assert abs(whole[0]) < 1e-12 and np.isclose(whole[1], 1.0)


def test_drop_lowest_share(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([5.0, 1.0, 1.0, 3.0, 10.0])], "f int, s double")
    dropped = features.drop_lowest_share(df, "f", "s", 0.25).where("dropped").orderBy("f")
    assert [r.f for r in dropped.collect()] == [1, 2, 3]
    flat = spark.createDataFrame([(i, 1.0) for i in range(10)], "f int, s double")
    assert [r.f for r in features.drop_lowest_share(flat, "f", "s", 0.2).where("dropped").orderBy("f").collect()] == [0, 1]
