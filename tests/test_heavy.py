"""Most frequent values from summaries, and components without the covariance matrix."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import components, heavy


def test_heavy_values_are_exact_and_proven(spark):
    # Value v occurs about 1 / v as often as value 1; a third of all rows is one value.
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 > 0, F.concat(F.lit("v"), F.floor(1 / F.rand(4)).cast("string")))
        .alias("w")
    ).persist()
    exact = rows.where("w IS NOT NULL").groupBy("w").count().orderBy(F.desc("count"), "w").limit(12).collect()
    got = heavy.heavy_values(rows, "w", 12, tracked=3_000).collect()
    assert [(r.w, r.n) for r in got] == [tuple(r) for r in exact] and all(r.proven for r in got)
    rows.unpersist()


def test_flat_counts_are_reported_as_unproven(spark):
    rows = spark.range(100_000).select((F.col("id") % 50_000).alias("w"))
    got = heavy.heavy_values(rows, "w", 5, tracked=100).collect()
    assert not any(r.proven for r in got) and all(r.n == 2 for r in got)
    assert heavy.heavy_values(rows.where("false"), "w", 5).count() == 0
    assert heavy.heavy_values(rows.select(F.lit(None).cast("string").alias("w")), "w", 5).count() == 0


def wide(spark, rows, d, rank, seed=2):
    """Rows with ``rank`` strong directions and a little noise, made in the tasks."""
    rng = np.random.default_rng(seed)
    plane = np.linalg.qr(rng.standard_normal((d, rank)))[0].T * np.linspace(9, 3, rank)[:, None]

    def make(batches):
        for batch in batches:
            ids = batch["id"].to_numpy()
            found = [np.random.default_rng(int(i)) for i in ids]
            x = np.stack([r.standard_normal(rank) @ plane + 0.05 * r.standard_normal(d) + 1 for r in found])
            yield batch.assign(x=list(x))

    return spark.range(rows, numPartitions=8).mapInPandas(make, "id long, x array<double>").persist()


@pytest.mark.parametrize("scale", [False, True])
def test_leading_components_equal_numpy(spark, scale):
    rows = wide(spark, 600, 300, 4)
    x = np.array([r.x for r in rows.collect()])
    x = x - x.mean(0)
    if scale:
        x /= x.std(0)
    _, s, axes = np.linalg.svd(x, full_matrices=False)
    got = components.leading_components(rows, "x", 4, scale=scale)
    rows.unpersist()
    assert np.linalg.norm(axes[:4].T - got.axes @ (got.axes.T @ axes[:4].T), 2) < 1e-6
    assert np.allclose(got.share, (s**2 / (s**2).sum())[:4], rtol=1e-9)


def test_five_thousand_columns(spark):
    rows = wide(spark, 400, 5_000, 3)
    got = components.leading_components(rows, "x", 3, scale=False)
    x = np.array([r.x for r in rows.collect()])
    rows.unpersist()
    axes = np.linalg.svd(x - x.mean(0), full_matrices=False)[2][:3].T
    assert got.axes.shape == (5_000, 3) and np.linalg.norm(axes - got.axes @ (got.axes.T @ axes), 2) < 1e-6


def test_equal_shares_fail_instead_of_guessing(spark):
    rows = wide(spark, 200, 40, 4).select(F.col("x"))
    with pytest.raises(RuntimeError, match="still turn"):
        components.leading_components(rows, "x", 2, scale=False, extra=0, rounds=2)


def test_leading_shares_of_the_vectors(spark, sf_dir):
    from tallyloom.queries import REGISTRY

    got = {(r.component, r.feature): r for r in REGISTRY["pca_leading"].run(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    exact = components.fit_components(rows, "embedding").first(8)
    assert len(got) == 8 * 64
    for (i, j), r in got.items():
        assert abs(r.share - exact.share[i]) < 2e-6 and abs(r.loading - exact.axes[j, i]) < 1e-5


def test_leading_components_of_flat_spectra(spark):
    # Noise alone: neighbouring shares are so close that plain power iteration does not end.
    x = np.random.default_rng(3).standard_normal((3_000, 64))
    rows = spark.createDataFrame([(v,) for v in x.tolist()], "x array<double>")
    exact = components.fit_components(rows, "x").first(8)
    for extra in (10, 40):
        got = components.leading_components(rows, "x", 8, extra=extra)
        assert np.allclose(got.share, exact.share, rtol=1e-9)
        assert np.linalg.norm(exact.axes - got.axes @ (got.axes.T @ exact.axes), 2) < 1e-6
