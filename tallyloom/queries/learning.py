"""Classifiers and principal components on the vectors. Tests check invariants of the trained models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import classifiers, components, evaluation, features, linear, neighbours, ranking, splits
from tallyloom.operators.classifiers import ForestSpec
from tallyloom.plans.durable import written
from tallyloom.queries.registry import query
from tallyloom.queries.vectors import CUTS_TWO, PARTS_SQL, REPORT_SQL, stored_split, vectors
from tallyloom.sources.readers import Tables


def _parts(t: Tables, *names: str) -> list[DataFrame]:
    rows = features.as_vectors(stored_split(t), "embedding")
    return [classifiers.part(rows, name) for name in names]


@query()
def rf_grid(t: Tables) -> DataFrame:
    train, check = _parts(t, "train", "validation")
    specs = [ForestSpec(n, d) for n in (50, 100, 150) for d in (10, 20, None)]
    return classifiers.forest_grid(train, check, "label", specs)


@query()
def rf_grid_min_split(t: Tables) -> DataFrame:
    train, check = _parts(t, "train", "validation")
    specs = [ForestSpec(n, d, s) for n in (50, 100, 150) for d in (10, 15, 20) for s in (2, 5)]
    return classifiers.forest_grid(train, check, "label", specs)


@query()
def rf_report(t: Tables) -> DataFrame:
    """Per-class report of a forest on the test part."""
    train, test = _parts(t, "train", "test")
    scored = ForestSpec(100).fit(train, "label").transform(test)
    return evaluation.classification_report(scored.withColumn("guess", F.col("prediction").cast("int")), "label", "guess")


def _best_k(train: DataFrame, check: DataFrame, ks: range = range(1, 16)) -> int:
    """The number of neighbours that does best on the validation part."""
    found = neighbours.nearest(check, train, "vec_id", "embedding", "label", max(ks))
    voted = neighbours.vote(found, "vec_id", "label", ks)
    actual = check.select("vec_id", F.col("label").alias("actual"))
    sweep = evaluation.accuracy(voted.join(actual, "vec_id"), "actual", "predicted", ["k"])
    return evaluation.best_config(sweep, "accuracy", ["k"]).first()["k"]


def _voted(train: DataFrame, test: DataFrame, k: int) -> DataFrame:
    """Test rows with the vote of their k nearest neighbours."""
    found = neighbours.nearest(test, train, "vec_id", "embedding", "label", k)
    return neighbours.vote(found, "vec_id", "label", [k]).join(test.select("vec_id", "label"), "vec_id")


@query(f"""WITH {PARTS_SQL}, dist AS (SELECT q.vec_id, q.part, q.label AS actual, b.label AS label, b.vec_id AS neighbour,
  round(sqrt(list_sum(list_transform(list_zip(q.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))), 9) AS d
  FROM parts q JOIN parts b ON q.part <> 'train' AND b.part = 'train'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbour) AS rank FROM dist), ks AS (SELECT unnest(range(1, 16)) AS k),
votes AS (SELECT vec_id, part, actual, k, label, count(*) AS n FROM ranked, ks WHERE rank <= k GROUP BY 1, 2, 3, 4, 5),
best AS (SELECT vec_id, part, actual, k, arg_max(label, (n, -label)) AS guess FROM votes GROUP BY 1, 2, 3, 4),
chosen AS (SELECT k FROM best WHERE part = 'validation' GROUP BY k ORDER BY count(CASE WHEN guess = actual THEN 1 END) DESC, k LIMIT 1),
guessed AS (SELECT actual, guess FROM best WHERE part = 'test' AND k = (SELECT k FROM chosen)), {REPORT_SQL}""")
def knn_report(t: Tables) -> DataFrame:
    """Per-class report on the test part of the neighbour vote with the best k."""
    train, check, test = _parts(t, "train", "validation", "test")
    report = evaluation.classification_report(_voted(train, test, _best_k(train, check)), "label", "predicted")
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


COSTS = [0.01, 0.1, 1, 10, 100]


def _best_svm(train: DataFrame, check: DataFrame) -> linear.LinearSvm:
    """The machine whose cost does best on the validation part."""
    sweep = classifiers.svm_sweep(train, check, "embedding", "label", COSTS)
    c = evaluation.best_config(sweep, "accuracy", ["c"]).first()["c"]
    return linear.fit_linear_svm(train, "embedding", "label", [c])


@query()
def svm_report(t: Tables) -> DataFrame:
    """Per-class report on the test part of the linear machine with the best cost."""
    train, check, test = _parts(t, "train", "validation", "test")
    guessed = linear.predict(test, "embedding", _best_svm(train, check)).withColumn("guess", F.col("predictions")[0])
    return evaluation.classification_report(guessed, "label", "guess")


@query()
def best_models_on_test(t: Tables) -> DataFrame:
    """Test accuracy of the best neighbour vote, forest and linear machine, each chosen on the validation part."""
    train, check, test = _parts(t, "train", "validation", "test")
    specs = [ForestSpec(n, d) for n in (50, 100, 150) for d in (10, 20, None)]
    grid = classifiers.forest_grid(train, check, "label", specs)
    best = specs[evaluation.best_config(grid, "accuracy", ["position"]).first()["position"]]
    forest = best.fit(train, "label").transform(test)
    k, machine = _best_k(train, check), _best_svm(train, check)
    guessed = linear.predict(test, "embedding", machine).withColumn("guess", F.col("predictions")[0])
    lines = [
        ("knn", f"k={k}", evaluation.accuracy(_voted(train, test, k), "label", "predicted").first()[0]),
        ("forest", f"trees={best.trees} depth={best.depth}", classifiers.score_of(forest, "label")),
        ("svm", f"c={machine.costs[0]:g}", evaluation.accuracy(guessed, "label", "guess").first()[0]),
    ]
    rows = [(m, p, float(a)) for m, p, a in lines]
    return t.embeddings.sparkSession.createDataFrame(rows, "model string, parameters string, accuracy double")


@query()
def svm_c_sweep(t: Tables) -> DataFrame:
    train, check = _parts(t, "train", "validation")
    return classifiers.svm_sweep(train, check, "embedding", "label", COSTS)


@query()
def cv_grid(t: Tables) -> DataFrame:
    train = _parts(t, "train")[0].withColumn("fold", splits.fold_number("vec_id"))
    return classifiers.cross_validated_forest(train, "label", "fold", [ForestSpec(100, 15, 5)])[0]


def knn_folds(rows: DataFrame, array: str, ks: list[int], weights: list[str], folds: int = 3) -> DataFrame:
    """Cross-validated accuracy of every k and weighting: one neighbour search per fold serves them all."""
    tagged = rows.withColumn("fold", splits.fold_number("vec_id", folds))
    actual = rows.select("vec_id", F.col("label").alias("actual"))
    votes = None
    for fold in range(folds):
        inside, outside = tagged.where(F.col("fold") == fold), tagged.where(F.col("fold") != fold)
        found = neighbours.nearest(inside, outside, "vec_id", array, "label", max(ks))
        voted = neighbours.vote(found, "vec_id", "label", ks, weights).withColumn("fold", F.lit(fold))
        votes = voted if votes is None else votes.unionByName(voted)
    per_fold = evaluation.accuracy(votes.join(actual, "vec_id"), "actual", "predicted", ["k", "weights", "fold"])
    return per_fold.groupBy("k", "weights").agg(F.avg("accuracy").alias("accuracy"))


@query(f"""WITH {PARTS_SQL},
folded AS (SELECT vec_id, label, v, CAST(('0x' || substr(md5('fold-' || vec_id || '-42'), 1, 8)) AS BIGINT) % 3 AS fold
  FROM parts WHERE part = 'train'),
dist AS (SELECT q.vec_id, q.fold, q.label AS actual, b.label AS label, b.vec_id AS neighbour,
  round(sqrt(list_sum(list_transform(list_zip(q.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))), 9) AS d
  FROM folded q JOIN folded b ON q.fold <> b.fold),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbour) AS rank FROM dist),
ks AS (SELECT unnest([3, 5, 7]) AS k), ws AS (SELECT unnest(['uniform', 'distance']) AS weights),
votes AS (SELECT vec_id, fold, actual, k, weights, label, count(CASE WHEN d = 0 AND weights = 'distance' THEN 1 END) AS hits,
  round(sum(CASE WHEN weights = 'uniform' THEN 1.0::DOUBLE WHEN d > 0 THEN 1 / d ELSE 0 END), 6) AS w
  FROM ranked, ks, ws WHERE rank <= k GROUP BY 1, 2, 3, 4, 5, 6),
best AS (SELECT vec_id, fold, actual, k, weights, arg_max(label, (hits, w, -label)) AS predicted FROM votes GROUP BY 1, 2, 3, 4, 5),
folds AS (SELECT k, weights, fold, avg(CASE WHEN predicted = actual THEN 1.0::DOUBLE ELSE 0 END) AS a FROM best GROUP BY 1, 2, 3)
SELECT CAST(k AS INTEGER) AS k, weights, round(avg(a), 6) AS accuracy FROM folds GROUP BY k, weights""")
def knn_cv_grid(t: Tables) -> DataFrame:
    rows = stored_split(t).where(F.col("part") == "train").drop("part")
    grid = knn_folds(rows, "embedding", [3, 5, 7], ["uniform", "distance"])
    return grid.withColumn("accuracy", F.round("accuracy", 6))


def _data_variants(rows: DataFrame) -> dict[str, DataFrame]:
    """Original, on components, without the least loaded features, and both; all fitted on the training part."""
    train = rows.where(F.col("part") == "train")
    fitted = components.fit_components(train, "embedding", scale=False)
    n = fitted.kept(0.80)
    kept = _kept_by_loading(rows, fitted, n)
    narrow = features.keep_dimensions(rows, "embedding", kept)
    narrow_fit = components.fit_components(narrow.where(F.col("part") == "train"), "embedding", scale=False)
    return {
        "original": rows,
        "pca": components.project(rows, "embedding", fitted.first(n), "embedding"),
        "drop": narrow,
        "drop+pca": components.project(narrow, "embedding", narrow_fit.first(min(n, len(kept))), "embedding"),
    }


def _kept_by_loading(rows: DataFrame, fitted: components.Components, n: int) -> list[int]:
    marked = features.drop_lowest_share(components.loadings(rows.sparkSession, fitted, n), "feature", "score", 0.20)
    return [r["feature"] for r in marked.where("NOT dropped").orderBy("feature").collect()]


@query()
def model_matrix(t: Tables) -> DataFrame:
    """Accuracy and seconds of a forest and of nearest neighbours on four variants of the data."""
    spark = t.embeddings.sparkSession
    rows = written(splits.stratified_split(vectors(t), "vec_id", "label", CUTS_TWO), "split")
    lines = []
    for setup, frame in _data_variants(rows).items():
        frame = frame.persist()
        train, test = (frame.where(F.col("part") == p) for p in ("train", "test"))
        as_train = features.as_vectors(train, "embedding").withColumn("fold", splits.fold_number("vec_id"))
        (_, model), fit_s = classifiers.timed(
            lambda: classifiers.cross_validated_forest(as_train, "label", "fold", [ForestSpec(100, 15, 5)])
        )
        score, use_s = classifiers.timed(
            lambda: classifiers.score_of(model.transform(features.as_vectors(test, "embedding")), "label")
        )
        lines.append((setup, "forest", float(score), fit_s, use_s))
        grid, fit_s = classifiers.timed(lambda: evaluation.best_config(
            knn_folds(train, "embedding", [3, 5, 7], ["uniform", "distance"]), "accuracy", ["k", "weights"]).first())
        score, use_s = classifiers.timed(lambda: _knn_score(train, test, grid["k"], grid["weights"]))
        lines.append((setup, "knn", float(score), fit_s, use_s))
        frame.unpersist()
    schema = "setup string, model string, accuracy double, train_seconds double, test_seconds double"
    return spark.createDataFrame(lines, schema)


def _knn_score(train: DataFrame, test: DataFrame, k: int, weights: str) -> float:
    found = neighbours.nearest(test, train, "vec_id", "embedding", "label", k)
    voted = neighbours.vote(found, "vec_id", "label", [k], [weights])
    actual = test.select("vec_id", F.col("label").alias("actual"))
    return evaluation.accuracy(voted.join(actual, "vec_id"), "actual", "predicted").first()[0]


def _binary(t: Tables) -> DataFrame:
    return stored_split(t).withColumn("label", (F.col("label") % 2).cast("double"))


def _binary_forest(t: Tables):
    train = _binary(t).where(F.col("part") == "train")
    return ForestSpec(100).fit(features.as_vectors(train, "embedding"), "label")


@query()
def feature_importance(t: Tables) -> DataFrame:
    ranked = classifiers.importances(t.embeddings.sparkSession, _binary_forest(t))
    return ranking.top_and_bottom(ranked, "importance", "feature", 15)


@query()
def select_by_importance(t: Tables) -> DataFrame:
    ranked = classifiers.importances(t.embeddings.sparkSession, _binary_forest(t))
    return ranked.where(F.col("importance") >= 0.005)


@query()
def reduced_vs_full(t: Tables) -> DataFrame:
    rows = _binary(t)
    return classifiers.full_against_reduced(
        rows.where(F.col("part") == "train"), rows.where(F.col("part") == "test"), "embedding", "label", ForestSpec(100)
    )


@query()
def pca_variance(t: Tables) -> DataFrame:
    """Variance share of every component and whether it is needed to reach 80 %."""
    fitted = components.fit_components(vectors(t), "embedding")
    n, total = fitted.kept(0.80), 0.0
    lines = []
    for i, share in enumerate(fitted.share):
        total += float(share)
        lines.append((i + 1, float(share), total, i < n))
    return t.embeddings.sparkSession.createDataFrame(lines, "component int, share double, cumulative double, kept boolean")


@query()
def pca_project(t: Tables) -> DataFrame:
    rows = vectors(t)
    fitted = components.fit_components(rows, "embedding").first(2)
    scored = components.project(rows, "embedding", fitted)
    return scored.select("vec_id", "label", F.col("scores")[0].alias("pc1"), F.col("scores")[1].alias("pc2"))


@query()
def pca_loading_drop(t: Tables) -> DataFrame:
    fitted = components.fit_components(vectors(t), "embedding", scale=False)
    scores = components.loadings(t.embeddings.sparkSession, fitted, fitted.kept(0.80))
    return features.drop_lowest_share(scores, "feature", "score", 0.20).select("feature", "score", "dropped")


@query()
def pca_outliers(t: Tables) -> DataFrame:
    """Accuracy, precision and recall of distance outliers against far points put among the vectors."""
    far = F.pmod(F.xxhash64("vec_id"), F.lit(20)) == 0
    moved = F.transform("embedding", lambda x: F.when(F.col("is_outlier"), x * 8).otherwise(x))
    rows = vectors(t).withColumn("is_outlier", far).withColumn("embedding", moved)
    train = splits.hashed_part("vec_id", [("train", 0.8), ("test", 1.0)]) == "train"
    marked = components.distance_outliers(rows, "embedding", train, top=100)
    return evaluation.binary_scores(marked, F.col("is_outlier"), F.col("outlier"))


@query()
def pca_classify(t: Tables) -> DataFrame:
    """Test accuracy of three classifiers before and after reduction to 80 % of the variance."""
    spark = t.embeddings.sparkSession
    rows = stored_split(t)
    fitted = components.fit_components(rows.where(F.col("part") == "train"), "embedding")
    after = components.project(rows, "embedding", fitted.first(fitted.kept(0.80)), "embedding")
    lines = []
    for name, frame in (("before", rows), ("after", after)):
        train, check, test = (frame.where(F.col("part") == p) for p in ("train", "validation", "test"))
        found = neighbours.nearest(check, train, "vec_id", "embedding", "label", 15)
        voted = neighbours.vote(found, "vec_id", "label", range(1, 16))
        actual = check.select("vec_id", F.col("label").alias("actual"))
        sweep = evaluation.accuracy(voted.join(actual, "vec_id"), "actual", "predicted", ["k"])
        k = evaluation.best_config(sweep, "accuracy", ["k"]).first()["k"]
        lines.append((name, "knn", float(_knn_score(train, test, k, "uniform"))))
        fit_on, score_on = (features.as_vectors(x, "embedding") for x in (train, test))
        forest = ForestSpec(100).fit(fit_on, "label")
        lines.append((name, "forest", float(classifiers.score_of(forest.transform(score_on), "label"))))
        machine = linear.fit_linear_svm(train, "embedding", "label", [1.0])
        guessed = linear.predict(test, "embedding", machine).withColumn("guess", F.col("predictions")[0])
        lines.append((name, "svm", float(evaluation.accuracy(guessed, "label", "guess").first()[0])))
    return spark.createDataFrame(lines, "data string, model string, accuracy double")


@query()
def pca_leading(t: Tables) -> DataFrame:
    """Shares of the variance and loadings of the first components, found without the covariance matrix."""
    fitted = components.leading_components(t.embeddings.select("embedding"), "embedding", 8, extra=40)
    found = [(i, j, float(share), float(x)) for i, share in enumerate(fitted.share) for j, x in enumerate(fitted.axes[:, i])]
    rows = t.embeddings.sparkSession.createDataFrame(found, "component int, feature int, share double, loading double")
    return rows.withColumns({c: F.round(c, 6) for c in ("share", "loading")})
