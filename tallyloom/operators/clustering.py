"""K-Means and diagonal Gaussian mixtures, many models per scan, and cluster quality.

A sweep over cluster counts and restarts trains all its models together: each iteration is one pass over
the data that returns the sufficient statistics of every model still moving. Thirty restarts thus cost
one scan per iteration, not thirty. Only statistics (clusters x dimensions) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tallyloom.functions.numeric import squared_distance, stable_hash
from tallyloom.operators.blocks import BLOCK_ROWS, matrix, squared_distances, strips
from tallyloom.operators.passes import matrices, sums_by_slot


@dataclass
class KMeansModel:
    k: int
    seed: int
    centres: np.ndarray
    cost: float = np.inf
    iterations: int = 0


@dataclass
class MixtureModel:
    k: int
    seed: int
    weights: np.ndarray
    means: np.ndarray
    variances: np.ndarray
    score: float = -np.inf
    iterations: int = 0


@dataclass
class _Centred:
    """The vectors less their mean, persisted for the passes of a fit, each with a hash of its id."""

    rows: DataFrame
    partitions: int
    mean: np.ndarray
    variance: float
    count: int


def _centred(df: DataFrame, id_col: str, array: str) -> _Centred:
    """Distances are taken about the mean, so a large common offset of the data costs no precision."""
    rows = df.select(F.col(array).cast("array<double>").alias("v"), stable_hash(7, F.col(id_col)).cast("bigint").alias("h"))
    rows = rows.where(F.col("v").isNotNull())
    summary = Summarizer.metrics("count", "mean", "variance").summary(array_to_vector("v"))
    found = rows.agg(summary.alias("s")).select("s.*").first()
    mean, n = found["mean"].toArray(), found["count"]

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(0)
            moved = v.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) - mean
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * moved.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(offsets, pa.array(moved.reshape(-1))), batch.column(1)], names=["v", "h"]
            )

    data = rows.mapInArrow(shift, "v array<double>, h bigint").persist()
    variance = float(found["variance"].toArray().mean()) * (n - 1) / max(n, 1)
    return _Centred(data, data.rdd.getNumPartitions(), mean, variance, n)


def _gumbel(h: np.ndarray, seed: int, step: int) -> np.ndarray:
    """Independent draws that depend on row, seed and step alone."""
    x = h.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + step + 1) * 0x2545F4914F6CDD1D % 2**64)
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    u = ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53
    return -np.log(-np.log(u))


def _starts(data: _Centred, specs: Sequence[tuple[int, int]]) -> list[np.ndarray]:
    """k-means++ seeding (Arthur and Vassilvitskii, 2007) over all rows, all models in the same passes.

    A row is drawn with a chance in proportion to its squared distance from the centres so far: the row with
    the largest log distance plus Gumbel noise, a maximum that partitions find on their own.
    """
    centres = [np.zeros((0, data.mean.size)) for _ in specs]
    for step in range(max(k for k, _ in specs)):
        wanted = [i for i, (k, _) in enumerate(specs) if step < k]

        def draw(batches: Iterator[pa.RecordBatch], step: int = step, wanted: Sequence[int] = wanted) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple[float, np.ndarray]] = {}
            for x, h in matrices(batches):
                for i in wanted:
                    d2 = squared_distances(x, centres[i]).min(1) if step else np.ones(len(x))
                    with np.errstate(divide="ignore"):
                        score = np.maximum(np.log(d2), -1e9) + _gumbel(h, specs[i][1], step)
                    at = int(score.argmax())
                    if i not in best or score[at] > best[i][0]:
                        best[i] = (float(score[at]), x[at])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(best), pa.int32()), pa.array([s for s, _ in best.values()], pa.float64()),
                    pa.array([v for _, v in best.values()], pa.list_(pa.float64())),
                ],
                names=["model", "score", "v"],
            )

        found = data.rows.mapInArrow(draw, "model int, score double, v array<double>")
        for r in found.groupBy("model").agg(F.max(F.struct("score", "v")).alias("best")).collect():
            centres[r["model"]] = np.vstack([centres[r["model"]], r["best"]["v"]])
    return centres


def _kmeans_pass(rows: DataFrame, partitions: int, models: Sequence[KMeansModel]) -> list[np.ndarray]:
    """Assign every row under every model; per centre the row count, the cost and the coordinate sums."""
    stacked = np.concatenate([m.centres for m in models])
    offsets = np.cumsum([0] + [m.k for m in models])
    shape = (len(stacked), stacked.shape[1] + 2)

    def partial(blocks: Iterator[list[np.ndarray]]) -> np.ndarray:
        sums = np.zeros(shape)
        for x, _ in blocks:
            for strip in strips(len(x), len(stacked)):
                part = x[strip]
                d2 = squared_distances(part, stacked)
                at = np.arange(len(part))
                for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                    own = d2[:, a:b].argmin(1)
                    member = np.zeros((len(part), b - a))
                    member[at, own] = 1.0
                    sums[a:b, 0] += member.sum(0)
                    sums[a:b, 1] += member.T @ d2[at, a + own]
                    sums[a:b, 2:] += member.T @ part
        return sums

    found = sums_by_slot(rows, partial, shape, partitions)
    return [found[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def fit_kmeans(
    df: DataFrame, id_col: str, array: str, specs: Iterable[tuple[int, int]], max_iter: int = 300, tol: float = 1e-4
) -> list[KMeansModel]:
    """One model per ``(k, seed)``; ``cost`` is the within-cluster sum of squares.

    ``tol`` bounds the squared movement of the centres relative to the mean variance of the data.
    """
    specs = list(specs)
    centred = _centred(df, id_col, array)
    data, partitions = centred.rows, centred.partitions
    limit = tol * centred.variance
    try:
        models = [KMeansModel(k, seed, c) for (k, seed), c in zip(specs, _starts(centred, specs), strict=True)]
        moving = list(models)
        for step in range(1, max_iter + 1):
            still = []
            for model, stats in zip(moving, _kmeans_pass(data, partitions, moving), strict=True):
                model.cost, model.iterations = float(stats[:, 1].sum()), step
                filled = stats[:, :1] > 0
                centres = np.where(filled, stats[:, 2:] / np.maximum(stats[:, :1], 1.0), model.centres)
                shift = float(((centres - model.centres) ** 2).sum())
                model.centres = centres
                if shift > limit:
                    still.append(model)
            moving = still
            if not moving:
                break
        for model, stats in zip(models, _kmeans_pass(data, partitions, models), strict=True):
            model.cost = float(stats[:, 1].sum())
            model.centres = model.centres + centred.mean
    finally:
        data.unpersist()
    return models


def lloyd(df: DataFrame, id_col: str, array: str, centres: np.ndarray, steps: int) -> list[tuple[int, int, float]]:
    """(cluster, rows, cost) of the last of ``steps`` assignments, each but the first to the means of the one before."""
    centred = _centred(df, id_col, array)
    model = KMeansModel(len(centres), 0, np.asarray(centres, dtype=np.float64) - centred.mean)
    try:
        for step in range(steps):
            if step:
                filled = stats[:, :1] > 0
                model.centres = np.where(filled, stats[:, 2:] / np.maximum(stats[:, :1], 1.0), model.centres)
            (stats,) = _kmeans_pass(centred.rows, centred.partitions, [model])
    finally:
        centred.rows.unpersist()
    return [(i, int(s[0]), float(s[1])) for i, s in enumerate(stats)]


def best_kmeans(models: Iterable[KMeansModel]) -> KMeansModel:
    """Lowest cost; the earliest restart among equals."""
    return min(models, key=lambda m: (m.cost, m.seed))


def assign_nearest(df: DataFrame, array: str, centres: np.ndarray, out: str = "cluster") -> DataFrame:
    """Index of the nearest centre of every row; the lowest index among equals."""
    shift = np.asarray(centres, dtype=np.float64).mean(axis=0)
    fixed = np.asarray(centres, dtype=np.float64) - shift

    @pandas_udf("int")
    def pick(v: pd.Series) -> pd.Series:
        return pd.Series(squared_distances(matrix(v) - shift, fixed).argmin(1).astype(np.int32) if len(v) else [], dtype="int32")

    return df.withColumn(out, pick(F.col(array).cast("array<double>")))


def nearest_centroid(df: DataFrame, array: str, centres: DataFrame, centre_id: str, centre: str) -> DataFrame:
    """As :func:`assign_nearest` with the centres given as a frame of at most a few thousand rows.

    The centres travel as one array-valued scalar, so the rows are neither joined nor shuffled.
    """
    packed = centres.agg(
        F.sort_array(F.collect_list(F.struct(F.col(centre_id).alias("i"), F.col(centre).alias("c")))).alias("all")
    ).scalar()
    x = F.col(array).cast("array<double>")
    ranked = F.transform(F.col("_centres"), lambda s: F.struct(
        F.round(squared_distance(x, s["c"]), 9).alias("d"), s["i"].alias("i")))
    best = F.array_min(ranked)
    return (
        df.withColumn("_centres", packed).withColumn("_best", best)
        .withColumn("cluster", F.col("_best.i")).withColumn("d2", F.col("_best.d")).drop("_centres", "_best")
    )


def _log_density(x: np.ndarray, model: MixtureModel) -> np.ndarray:
    """Log of weight times density of every row under every component."""
    precision = 1.0 / model.variances
    shift = model.means.mean(axis=0)
    x, means = x - shift, model.means - shift
    quadratic = (x * x) @ precision.T - 2.0 * x @ (means * precision).T + (means ** 2 * precision).sum(1)
    constant = x.shape[1] * np.log(2 * np.pi) + np.log(model.variances).sum(1)
    return np.log(np.maximum(model.weights, 1e-300)) - 0.5 * (constant + quadratic)


def _responsibilities(x: np.ndarray, model: MixtureModel) -> tuple[np.ndarray, np.ndarray]:
    log_p = _log_density(x, model)
    top = log_p.max(1, keepdims=True)
    total = top[:, 0] + np.log(np.exp(log_p - top).sum(1))
    return np.exp(log_p - total[:, None]), total


def _mixture_pass(rows: DataFrame, partitions: int, models: Sequence[MixtureModel]) -> list[np.ndarray]:
    """E-step under every model; per component its mass, log likelihood, and first and second moments."""
    offsets = np.cumsum([0] + [m.k for m in models])
    d = models[0].means.shape[1]
    shape = (int(offsets[-1]), 2 * d + 2)

    def partial(blocks: Iterator[list[np.ndarray]]) -> np.ndarray:
        sums = np.zeros(shape)
        for x, _ in blocks:
            for strip in strips(len(x), 64):
                part = x[strip]
                for model, a, b in zip(models, offsets[:-1], offsets[1:], strict=True):
                    r, total = _responsibilities(part, model)
                    sums[a:b, 0] += r.sum(0)
                    sums[a, 1] += total.sum()
                    sums[a:b, 2:d + 2] += r.T @ part
                    sums[a:b, d + 2:] += r.T @ (part * part)
        return sums

    found = sums_by_slot(rows, partial, shape, partitions)
    return [found[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _moments_to_model(model: MixtureModel, stats: np.ndarray, floor: float) -> None:
    d = model.means.shape[1]
    mass = stats[:, 0]
    safe = np.maximum(mass, 1e-10)[:, None]
    first, second = stats[:, 2:d + 2] / safe, stats[:, d + 2:] / safe
    model.weights, model.means = mass / mass.sum(), first
    model.variances = np.maximum(second - first ** 2, 0.0) + floor


def fit_mixtures(
    df: DataFrame, id_col: str, array: str, specs: Iterable[tuple[int, int]], max_iter: int = 100,
    tol: float = 1e-3, floor: float = 1e-6,
) -> list[MixtureModel]:
    """Diagonal-covariance mixtures by expectation maximisation, one per ``(k, seed)``.

    Each starts from a short K-Means run. ``score`` is the mean log likelihood; a model stops when it
    changes by less than ``tol``.
    """
    starts = fit_kmeans(df, id_col, array, specs, max_iter=10)
    centred = _centred(df, id_col, array)
    data, partitions = centred.rows, centred.partitions
    try:
        d = starts[0].centres.shape[1]
        spread = max(float(np.mean([m.cost for m in starts])) / max(1, centred.count) / d, floor)
        models = [
            MixtureModel(m.k, m.seed, np.full(m.k, 1.0 / m.k), m.centres - centred.mean, np.full_like(m.centres, spread))
            for m in starts
        ]
        moving = list(models)
        for step in range(1, max_iter + 1):
            still = []
            for model, stats in zip(moving, _mixture_pass(data, partitions, moving), strict=True):
                score = float(stats[:, 1].sum()) / max(float(stats[:, 0].sum()), 1.0)
                settled = abs(score - model.score) < tol
                model.score, model.iterations = score, step
                if not settled:
                    _moments_to_model(model, stats, floor)
                    still.append(model)
            moving = still
            if not moving:
                break
        for model in models:
            model.means = model.means + centred.mean
    finally:
        data.unpersist()
    return models


def best_mixture(models: Iterable[MixtureModel]) -> MixtureModel:
    """Highest likelihood; the earliest restart among equals."""
    return min(models, key=lambda m: (-m.score, m.seed))


def mixture_responsibilities(df: DataFrame, array: str, model: MixtureModel, out: str = "responsibility") -> DataFrame:
    """Probability of every component for every row, and the most probable one as ``cluster``."""

    @pandas_udf("array<double>")
    def score(v: pd.Series) -> pd.Series:
        return pd.Series(list(_responsibilities(matrix(v), model)[0]))

    scored = df.withColumn(out, score(F.col(array).cast("array<double>")))
    first_best = F.array_position(F.col(out), F.array_max(F.col(out))) - 1
    return scored.withColumn("cluster", first_best.cast("int"))


def mixture_from_classes(df: DataFrame, array: str, label: str, floor: float = 1e-6) -> tuple[list, MixtureModel]:
    """The mixture whose components are the classes of a labelled frame."""
    summary = Summarizer.metrics("count", "mean", "variance").summary(array_to_vector(F.col(array).cast("array<double>")))
    rows = df.groupBy(label).agg(summary.alias("s")).select(label, "s.*").orderBy(label).collect()
    n = np.array([r["count"] for r in rows], dtype=np.float64)
    means = np.array([r["mean"].toArray() for r in rows])
    variances = np.array([r["variance"].toArray() * (r["count"] - 1) / r["count"] for r in rows])
    return [r[label] for r in rows], MixtureModel(len(rows), 0, n / n.sum(), means, variances + floor)


def silhouette_rows(
    df: DataFrame, id_col: str, array: str, clusterings: Sequence[str], block: int = BLOCK_ROWS, among: Column | None = None
) -> DataFrame:
    """Exact silhouette of every row with plain Euclidean distances, one result column per clustering.

    Every row has to be compared with every other one, so the work grows with the square of the rows.
    The rows are cut into blocks; a task compares two blocks once for all clusterings and returns, per
    row, one distance sum per cluster. ``among`` tells the rows whose silhouettes are wanted, by the id column; they are
    compared with all rows. For large data use that or :func:`silhouette_squared`, whose cost is linear.
    """
    wanted = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
    names = [f"_c{i}" for i in range(len(clusterings))]
    rows = df.select(
        F.col(id_col).alias("_id"), F.col(array).cast("array<double>").alias("_v"),
        *[F.col(c).cast("int").alias(n) for c, n in zip(clusterings, names, strict=True)], wanted.alias("_wanted"),
    )
    middle = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("_wanted").alias("wanted"), Summarizer.mean(array_to_vector("_v")).alias("mean")).first()
    shift = middle["mean"].toArray() if middle["n"] else np.zeros(0)

    def side(part: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        """Rows in their block of this side, once for every block of the other side."""
        own_blocks, other_blocks = (max(1, -(-n // block)) for n in (n_own, n_other))
        dealt = F.pmod(F.xxhash64("_id"), F.lit(own_blocks)).cast("int").alias(own)
        return part.drop("_wanted").select("*", dealt, F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1))).alias(other))

    left = side(rows.where("_wanted"), "i", middle["wanted"], "j", middle["n"])
    right = side(rows, "j", middle["n"], "i", middle["wanted"])
    columns = ["_id", "clustering", "mine", "other", "total", "n"]

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if len(a) == 0 or len(b) == 0:
            return pd.DataFrame({c: [] for c in columns})
        x, y = matrix(a["_v"]) - shift, matrix(b["_v"]) - shift
        p, q = a["_id"].to_numpy(), b["_id"].to_numpy()
        # The clusters of all clusterings side by side, as columns of one membership matrix.
        found = [np.unique(b[n].to_numpy(), return_inverse=True) for n in names]
        member = np.concatenate([np.eye(len(labels))[code] for labels, code in found], axis=1)
        # A row is at distance 0 from itself, whatever the expanded form leaves.
        totals = np.concatenate([
            np.where(p[r, None] == q[None], 0.0, np.sqrt(squared_distances(x[r], y))) @ member for r in strips(len(x), len(y))
        ])
        which = np.concatenate([np.full(len(labels), i) for i, (labels, _) in enumerate(found)])
        other = np.concatenate([labels for labels, _ in found])
        mine = np.stack([a[n].to_numpy() for n in names], axis=1)[:, which]
        return pd.DataFrame({
            "_id": np.repeat(a["_id"].to_numpy(), len(which)), "clustering": np.tile(which, len(a)),
            "mine": mine.reshape(-1), "other": np.tile(other, len(a)), "total": totals.reshape(-1),
            "n": np.tile(member.sum(0), len(a)),
        })[columns]

    schema = f"_id {dict(rows.dtypes)['_id']}, clustering int, mine int, other int, total double, n double"
    sums = (
        left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(compare, schema)
        .groupBy("_id", "clustering", "mine", "other").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )
    same = F.col("other") == F.col("mine")
    per_row = sums.groupBy("_id", "clustering").agg(
        F.max(F.when(same, F.try_divide(F.col("total"), F.col("n") - 1))).alias("a"),
        F.min(F.when(~same, F.col("total") / F.col("n"))).alias("b"),
        F.max(F.when(same, F.col("n"))).alias("size"),
    )
    score = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    value = F.when((F.col("size") > 1) & F.col("b").isNotNull(), score).otherwise(0.0)
    return per_row.groupBy(F.col("_id").alias(id_col)).agg(*[
        F.max(F.when(F.col("clustering") == i, value)).alias(f"silhouette_{c}") for i, c in enumerate(clusterings)
    ])


def silhouette_estimate(
    df: DataFrame, id_col: str, array: str, clusterings: Sequence[str], among: Column, block: int = BLOCK_ROWS
) -> DataFrame:
    """Mean plain-distance silhouette of every clustering over the rows ``among``, each compared with all rows:
    ``(clustering, silhouette, error, n)``, ``error`` being the standard error (null for fewer than two rows)."""
    rows = silhouette_rows(df, id_col, array, clusterings, block, among)
    long = rows.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("clustering"), F.col(f"silhouette_{c}").alias("s")) for c in clusterings
    ])).alias("x")).select("x.*")
    n = F.count("s")
    error = F.when(n > 1, F.try_divide(F.stddev_samp("s"), F.sqrt(n)))
    return long.groupBy("clustering").agg(F.avg("s").alias("silhouette"), error.alias("error"), n.alias("n"))


def silhouette_squared(df: DataFrame, array: str, cluster: str) -> DataFrame:
    """Mean silhouette with squared Euclidean distances, in one pass after the cluster moments.

    The mean squared distance to a cluster is the squared distance to its mean plus its variance, so no pair of
    rows is compared.
    """
    x = F.col(array).cast("array<double>")
    summary = Summarizer.metrics("count", "mean", "variance").summary(array_to_vector(x))
    rows = df.groupBy(cluster).agg(summary.alias("s")).select(cluster, "s.*").orderBy(cluster).collect()
    code = {r[cluster]: i for i, r in enumerate(rows)}
    size = np.array([float(r["count"]) for r in rows])
    means = np.array([r["mean"].toArray() for r in rows])
    within = np.array([float(r["variance"].toArray().sum()) * (r["count"] - 1) / r["count"] for r in rows])
    shift = means.mean(axis=0)

    @pandas_udf("double")
    def score(v: pd.Series, c: pd.Series) -> pd.Series:
        m = matrix(v)
        own = c.map(code).to_numpy()
        at = np.arange(len(m))
        mean_d2 = squared_distances(m - shift, means - shift) + within[None, :]
        a = mean_d2[at, own] * size[own] / np.maximum(size[own] - 1, 1)
        mean_d2[at, own] = np.inf
        b = mean_d2.min(1) if len(size) > 1 else np.zeros(len(m))
        top = np.maximum(a, b)
        s = np.divide(b - a, top, out=np.zeros(len(m)), where=top > 0)
        return pd.Series(np.where((size[own] > 1) & (len(size) > 1), s, 0.0))

    return df.select(score(x, F.col(cluster)).alias("s")).agg(F.avg("s").alias("silhouette"))
