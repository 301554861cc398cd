"""Clustering of the vectors. Trained models have no SQL counterpart; tests check their invariants."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import clustering, components, evaluation
from tallyloom.plans.durable import written
from tallyloom.queries.registry import query
from tallyloom.queries.vectors import vectors
from tallyloom.sources.readers import Tables

RESTARTS = [1, 5, 10, 20, 30]
K_RANGE = range(2, 11)
MIXTURE_RANGE = range(2, 7)
SEEDS = 10


def reduced(t: Tables, variance: float = 0.80) -> DataFrame:
    """The vectors on the components that hold 80 % of the variance, stored: a task that reads them needs no second
    Python process for the projection."""
    rows = vectors(t)
    fitted = components.fit_components(rows, "embedding")
    return written(components.project(rows, "embedding", fitted.first(fitted.kept(variance)), "embedding"), "reduced")


def restart_costs(rows: DataFrame, k: int = 3) -> DataFrame:
    """Cost against the number of restarts. More restarts extend the same list of seeds, so one training
    of the longest list answers every length."""
    models = clustering.fit_kmeans(rows, "vec_id", "embedding", [(k, s) for s in range(max(RESTARTS))])
    costs = [(n, float(min(m.cost for m in models[:n]))) for n in RESTARTS]
    return rows.sparkSession.createDataFrame(costs, "n_init int, cost double")


def cost_curve(rows: DataFrame) -> tuple[DataFrame, dict[int, clustering.KMeansModel]]:
    """Best cost for every k."""
    models = clustering.fit_kmeans(rows, "vec_id", "embedding", [(k, s) for k in K_RANGE for s in range(SEEDS)])
    best = {k: clustering.best_kmeans(m for m in models if m.k == k) for k in K_RANGE}
    frame = rows.sparkSession.createDataFrame([(k, float(m.cost)) for k, m in best.items()], "k int, cost double")
    return frame, best


def with_elbow(curve: DataFrame) -> DataFrame:
    named = curve.withColumn("curve", F.lit("wcss"))
    found = evaluation.elbow(named, "curve", "k", "cost").select("elbow").scalar()
    return curve.withColumn("is_elbow", F.coalesce(F.col("k") == found, F.lit(False)))


@query()
def kmeans_ninit(t: Tables) -> DataFrame:
    return restart_costs(vectors(t))


@query()
def kmeans_ninit_reduced(t: Tables) -> DataFrame:
    return restart_costs(reduced(t))


@query()
def kmeans_elbow(t: Tables) -> DataFrame:
    return with_elbow(cost_curve(vectors(t))[0])


@query()
def kmeans_elbow_reduced(t: Tables) -> DataFrame:
    return with_elbow(cost_curve(reduced(t))[0])


def _lloyd_sql(steps: int) -> str:
    """Assignments and means in turns; the first centres are the vectors with the three smallest ids."""
    parts = ["""x AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), d AS (SELECT unnest(range(1, 65)) AS i),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cluster, v AS c FROM x ORDER BY vec_id LIMIT 3)"""]
    for s in range(steps):
        parts.append(f"""a{s} AS (SELECT vec_id, any_value(v) AS v, arg_min(cluster, (e, cluster)) AS cluster, min(e) AS e FROM (
  SELECT vec_id, v, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS e FROM x, c{s}) GROUP BY vec_id)""")
        parts.append(f"""c{s + 1} AS (SELECT cluster, list(m ORDER BY i) AS c FROM (
  SELECT cluster, i, avg(v[i]) AS m FROM a{s}, d GROUP BY 1, 2) GROUP BY cluster)""")
    return f"WITH {', '.join(parts)} SELECT cluster, count(*) AS n, round(sum(e), 5) AS cost FROM a{steps - 1} GROUP BY cluster"


@query(_lloyd_sql(4))
def kmeans_lloyd(t: Tables) -> DataFrame:
    """Four steps of K-Means from stated centres, as the fits take them."""
    rows = vectors(t)
    starts = np.array([r.embedding for r in rows.orderBy("vec_id").limit(3).select("embedding").collect()])
    lines = clustering.lloyd(rows, "vec_id", "embedding", starts, 4)
    return rows.sparkSession.createDataFrame([(i, n, round(c, 5)) for i, n, c in lines if n], "cluster int, n long, cost double")


def _final_kmeans(rows: DataFrame) -> DataFrame:
    """Clusters of the best model at the elbow of the cost curve (the last k if it has none)."""
    curve, best = cost_curve(rows)
    elbow = with_elbow(curve).where("is_elbow").first()
    return clustering.assign_nearest(rows, "embedding", best[elbow["k"] if elbow else max(K_RANGE)].centres)


def _agreement(assigned: DataFrame) -> DataFrame:
    """Adjusted Rand index with the classes, and the silhouette by squared distances, whose cost is linear."""
    rand = evaluation.adjusted_rand(assigned, "label", "cluster")
    return rand.withColumn("silhouette", clustering.silhouette_squared(assigned, "embedding", "cluster").scalar())


@query()
def kmeans_assign(t: Tables) -> DataFrame:
    return _final_kmeans(vectors(t)).select("vec_id", "label", "cluster")


@query()
def kmeans_scores(t: Tables) -> DataFrame:
    """Agreement with the classes and silhouette of the final K-Means."""
    return _agreement(_final_kmeans(vectors(t)))


@query()
def kmeans_scores_reduced(t: Tables) -> DataFrame:
    """As kmeans_scores, on the components that hold 80 % of the variance."""
    return _agreement(_final_kmeans(reduced(t)))


def _mixtures(rows: DataFrame) -> dict[int, clustering.MixtureModel]:
    """The best of five restarts for every k."""
    models = clustering.fit_mixtures(rows, "vec_id", "embedding", [(k, s) for k in MIXTURE_RANGE for s in range(5)])
    return {k: clustering.best_mixture(m for m in models if m.k == k) for k in MIXTURE_RANGE}


def mixture_sweep(rows: DataFrame, best: dict[int, clustering.MixtureModel]) -> DataFrame:
    """Likelihood and plain-distance silhouette for every k; the largest silhouette is marked.

    The silhouettes are those of the rows whose id is divisible by 100 against all rows, for all k in one pass.
    """
    assigned = rows.select("vec_id", "embedding")
    for k, model in best.items():
        scored = clustering.mixture_responsibilities(assigned, "embedding", model)
        assigned = scored.drop("responsibility").withColumnRenamed("cluster", f"k{k}")
    names = [f"k{k}" for k in best]
    found = clustering.silhouette_estimate(written(assigned, "assigned"), "vec_id", "embedding", names, F.col("vec_id") % 100 == 0)
    scores = {r["clustering"]: (r["silhouette"], r["error"]) for r in found.collect()}
    lines = [(k, float(m.score), m.iterations, *scores.get(f"k{k}", (None, None))) for k, m in best.items()]
    top = max(lines, key=lambda x: (-1.0 if x[3] is None else x[3], -x[0]))
    return rows.sparkSession.createDataFrame(
        [(*x, x[0] == top[0]) for x in lines],
        "k int, log_likelihood double, iterations int, silhouette double, silhouette_error double, is_best boolean",
    )


@query()
def gmm_diag(t: Tables) -> DataFrame:
    rows = vectors(t)
    return mixture_sweep(rows, _mixtures(rows))


@query()
def gmm_diag_reduced(t: Tables) -> DataFrame:
    rows = reduced(t)
    return mixture_sweep(rows, _mixtures(rows))


def _final_mixture(rows: DataFrame) -> DataFrame:
    """Responsibilities and clusters under the mixture whose k has the largest silhouette."""
    best = _mixtures(rows)
    k = mixture_sweep(rows, best).where("is_best").first()["k"]
    return clustering.mixture_responsibilities(rows, "embedding", best[k])


@query()
def gmm_assign(t: Tables) -> DataFrame:
    scored = _final_mixture(vectors(t))
    return scored.select("vec_id", "label", "cluster", F.array_max("responsibility").alias("probability"))


@query()
def gmm_scores(t: Tables) -> DataFrame:
    """Agreement with the classes and silhouette of the final mixture."""
    return _agreement(_final_mixture(vectors(t)))


@query()
def gmm_scores_reduced(t: Tables) -> DataFrame:
    """As gmm_scores, on the components that hold 80 % of the variance."""
    return _agreement(_final_mixture(reduced(t)))


@query(f"""WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
dist AS (SELECT a.vec_id, a.label, b.label AS other, list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
  FROM v a, v b),
sums AS (SELECT vec_id, label, other, sum(d) AS total, count(*) AS n FROM dist GROUP BY 1, 2, 3),
ab AS (SELECT vec_id, label, max(CASE WHEN other = label THEN total / nullif(n - 1, 0) END) AS a, min(CASE WHEN other <> label THEN total / n END) AS b,
  max(CASE WHEN other = label THEN n END) AS size FROM sums GROUP BY 1, 2)
SELECT round(avg(CASE WHEN size > 1 THEN (b - a) / greatest(a, b) ELSE 0 END), 6) AS silhouette FROM ab""")
def silhouette(t: Tables) -> DataFrame:
    score = clustering.silhouette_squared(vectors(t), "embedding", "label")
    return score.select(F.round("silhouette", 6).alias("silhouette"))
