"""Approximate neighbours against the exact search, heavy copies, and silhouettes of some rows against all."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import approximate, clustering
from tallyloom.operators.approximate import Projections, nearest_approximate
from tallyloom.operators.neighbours import nearest
from tallyloom.queries import REGISTRY
from tallyloom.queries.vectors import vectors
from tallyloom.sources.readers import Tables

COLUMNS = ["vec_id", "rank", "distance", "neighbour", "label"]


def rows_of(found):
    return {tuple(r) for r in found.select(*COLUMNS).collect()}


@pytest.mark.parametrize("spec", [Projections(), Projections(tables=24, probes=12, limit=64)])
def test_recall_against_the_exact_search(spark, spec):
    rows = vectors(Tables(spark, "/root/testdata/sf0.1"))
    asked = rows.where("vec_id % 100 = 0")
    exact = rows_of(nearest(asked, rows, "vec_id", "embedding", "label", 10))
    got = rows_of(nearest_approximate(asked, rows, "vec_id", "embedding", "label", 10, spec))
    pairs = {(r[0], r[3]) for r in exact}
    assert len(got) == len(exact) == 200
    assert len({(r[0], r[3]) for r in got} & pairs) >= 0.9 * len(pairs)


def test_query_ranks_true_distances(spark):
    found = REGISTRY["knn_lsh"].run(spark, "/root/testdata/sf0.001").collect()
    base = {r.vec_id: np.array(r.embedding) for r in vectors(Tables(spark, "/root/testdata/sf0.001")).collect()}
    assert {r.vec_id for r in found} == {i for i in base if i % 100 == 0}
    for r in found:
        assert abs(np.linalg.norm(base[r.vec_id] - base[r.neighbour]) - r.distance) < 1e-8
    first = [r for r in found if r["rank"] == 1]
    assert all(r.neighbour == r.vec_id and r.distance == 0 for r in first)


def heavy(spark):
    """Exact copies, copies that differ a little, and others, each a third of 900 rows."""
    r = np.random.default_rng(3)
    x = r.standard_normal((900, 8))
    x[:300] = x[0]
    x[300:600] = x[300] + 1e-7 * r.standard_normal((300, 8))
    lines = [(i, i % 4, v.tolist()) for i, v in enumerate(x)]
    return x, spark.createDataFrame([*lines, (None, 0, lines[5][2]), (2000, 1, None)], "vec_id long, label int, embedding array<double>")


def test_heavy_copies(spark):
    x, rows = heavy(spark)
    spec = Projections(tables=8, probes=8, limit=40, block=50)
    asked = rows.where("vec_id % 50 = 0")
    got = rows_of(nearest_approximate(asked, rows, "vec_id", "embedding", "label", 5, spec))
    exact = rows_of(nearest(asked.where("embedding is not null"), rows.where("vec_id < 900"), "vec_id", "embedding", "label", 5))
    # All exact copies have the five smallest ids as neighbours; near copies are found among themselves.
    assert {r for r in got if r[0] < 300} == {(i, k + 1, 0.0, k, k % 4) for i in range(0, 300, 50) for k in range(5)}
    close = {r[:1] + r[3:4] for r in exact if r[0] < 600}
    assert len({r[:1] + r[3:4] for r in got if r[0] < 600} & close) >= 0.9 * len(close)
    assert {r[0] for r in got} == set(range(0, 900, 50))


def test_buckets_stay_within_their_limit(spark):
    r = np.random.default_rng(4)
    codes = [(i, i % 2, int(c)) for i, c in enumerate(r.integers(0, 1 << 60, 2_000))] + [(9_000 + i, 0, 7) for i in range(100)]
    frame = spark.createDataFrame(codes, "g long, tab int, code long")
    at_rest, buckets = approximate._leaves(frame, 64)
    assert sum(part.count() for part in at_rest) == len(codes)
    for level, part in enumerate(at_rest):
        sizes = part.groupBy("tab", "prefix").count().collect()
        if level + 1 < approximate.BITS // approximate.STEP:
            assert all(s["count"] <= 64 for s in sizes)
        else:
            # Equal signatures cannot be split; the comparison cuts them into blocks.
            assert [s["count"] for s in sizes] == [100]
    assert len(buckets) == len(at_rest) == 15


def test_empty_sides(spark):
    _, rows = heavy(spark)
    none = rows.where("false")
    assert nearest_approximate(none, rows, "vec_id", "embedding", "label", 3).count() == 0
    assert nearest_approximate(rows, none, "vec_id", "embedding", "label", 3).count() == 0


def test_silhouettes_of_some_rows(spark):
    r = np.random.default_rng(8)
    x = r.standard_normal((120, 3))
    x[:60] += 4
    frame = spark.createDataFrame([(i, i // 60, i % 3, v.tolist()) for i, v in enumerate(x)], "id long, a int, b int, v array<double>")
    whole = {row.id: row for row in clustering.silhouette_rows(frame, "id", "v", ["a", "b"]).collect()}
    got = {row.clustering: row for row in clustering.silhouette_estimate(
        frame, "id", "v", ["a", "b"], F.col("id") % 10 == 0, block=7).collect()}
    for name in ("a", "b"):
        some = np.array([whole[i][f"silhouette_{name}"] for i in range(0, 120, 10)])
        assert np.isclose(got[name].silhouette, some.mean()) and got[name].n == 12
        assert np.isclose(got[name].error, some.std(ddof=1) / np.sqrt(12))
    assert clustering.silhouette_estimate(frame, "id", "v", ["a"], F.col("id") < 0).count() == 0
