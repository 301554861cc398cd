import pytest

import __spark_entry__ as driver

from tallyloom.queries import REGISTRY


def test_entry_runs(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 10 and rows[0].quantity >= rows[-1].quantity


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries()) and set(REGISTRY) <= set(driver.queries())


def test_trained_queries_keep_their_invariants(spark, sf_dir):
    def run(name):
        return REGISTRY[name].run(spark, sf_dir).collect()

    costs = [r.cost for r in sorted(run("kmeans_ninit"))]
    assert costs == sorted(costs, reverse=True)
    curve = sorted(run("kmeans_elbow_reduced"))
    assert [r.k for r in curve] == list(range(2, 11)) and sum(r.is_elbow for r in curve) <= 1
    assert all(a.cost > b.cost for a, b in zip(curve, curve[1:], strict=False))
    shares = sorted(run("pca_variance"))
    kept = [r for r in shares if r.kept]
    assert kept[-1].cumulative >= 0.80 > kept[-2].cumulative and abs(shares[-1].cumulative - 1) < 1e-9
    assert all(0 <= r.probability <= 1 for r in run("gmm_assign"))
    mixtures = run("gmm_diag_reduced")
    assert sum(r.is_best for r in mixtures) == 1 and all(-1 <= r.silhouette <= 1 for r in mixtures)
    assert all(0 <= r.accuracy <= 1 for r in run("svm_c_sweep"))
    assert len(run("feature_importance")) == 30
    outliers = run("pca_outliers")[0]
    assert outliers.recall > 0.5


@pytest.mark.parametrize("name", ["knn_report", "svm_report", "best_models_on_test", "kmeans_scores_reduced", "gmm_scores_reduced"])
def test_model_summaries(spark, sf_dir, name):
    rows = REGISTRY[name].run(spark, sf_dir).collect()
    assert rows and all(v is not None for r in rows for v in r)
