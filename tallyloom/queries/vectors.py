"""Exploratory statistics, splits, scores and neighbours with an exact SQL counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import aggregates, approximate, clustering, distributions, evaluation, features, neighbours, ranking, splits
from tallyloom.plans.durable import written
from tallyloom.queries.registry import query
from tallyloom.sources.readers import Tables

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CUTS_THREE = [("train", 80), ("validation", 90), ("test", 100)]
CUTS_TWO = [("train", 80), ("test", 100)]


def vectors(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))


def split_vectors(t: Tables) -> DataFrame:
    """The vectors with their part: training, validation or test, 80/10/10 within each class."""
    return splits.stratified_split(vectors(t), "vec_id", "label", CUTS_THREE)


def stored_split(t: Tables) -> DataFrame:
    """As :func:`split_vectors`, written once for queries that read the parts many times."""
    return written(split_vectors(t), "split")


VECTORS_SQL = """vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
  CAST(('0x' || substr(md5(vec_id || '-42'), 1, 8)) AS BIGINT) AS h FROM embeddings)"""
PARTS_SQL = VECTORS_SQL + """, numbered AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, vec_id) AS rn,
  count(*) OVER (PARTITION BY label) AS n FROM vectors),
parts AS (SELECT vec_id, label, v, CASE WHEN rn <= n * 80 // 100 THEN 'train' WHEN rn <= n * 90 // 100 THEN 'validation'
  ELSE 'test' END AS part FROM numbered)"""


@query("""SELECT CAST(pos AS INTEGER) AS pos, round(avg(CAST(embedding[pos + 1] AS DOUBLE)), 6) AS mean
FROM (SELECT embedding, unnest(range(0, len(embedding))) AS pos FROM embeddings) GROUP BY pos""")
def vector_mean(t: Tables) -> DataFrame:
    return features.vector_mean(t.embeddings, "embedding").withColumn("mean", F.round("mean", 6))


@query("""WITH span AS (SELECT min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem),
binned AS (SELECT l_returnflag, least(floor((l_extendedprice - low) * 50 / (high - low)), 49)::INTEGER AS bin, high - low AS width
  FROM lineitem, span),
counts AS (SELECT l_returnflag, bin, CAST(count(*) AS BIGINT) AS n, any_value(width) AS width FROM binned GROUP BY 1, 2)
SELECT l_returnflag, bin, n, round(n * 50 / (sum(n) OVER (PARTITION BY l_returnflag) * width), 9) AS density FROM counts""")
def density_histogram(t: Tables) -> DataFrame:
    bins = distributions.density_histogram(t.lineitem, "l_returnflag", "l_extendedprice", 50)
    return bins.withColumn("density", F.round("density", 9))


@query("""WITH span AS (SELECT min(l_quantity) AS x0, max(l_quantity) AS x1, min(l_extendedprice) AS y0, max(l_extendedprice) AS y1 FROM lineitem)
SELECT l_returnflag, least(floor((l_quantity - x0) * 20 / (x1 - x0)), 19)::INTEGER AS x_bin,
  least(floor((l_extendedprice - y0) * 20 / (y1 - y0)), 19)::INTEGER AS y_bin, CAST(count(*) AS BIGINT) AS n
FROM lineitem, span GROUP BY 1, 2, 3""")
def scatter_bins(t: Tables) -> DataFrame:
    return distributions.scatter_bins(t.lineitem, "l_returnflag", "l_quantity", "l_extendedprice", 20)


@query("""WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY l_returnflag),
j AS (SELECT l.l_returnflag, q1, median, q3, l_extendedprice AS v,
  l_extendedprice >= q1 - 1.5 * (q3 - q1) AND l_extendedprice <= q3 + 1.5 * (q3 - q1) AS inside
  FROM lineitem l JOIN q ON q.l_returnflag = l.l_returnflag)
SELECT l_returnflag, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
  round(min(CASE WHEN inside THEN v END), 4) AS whisker_low, round(max(CASE WHEN inside THEN v END), 4) AS whisker_high,
  CAST(count(CASE WHEN NOT inside THEN 1 END) AS BIGINT) AS outliers
FROM j GROUP BY l_returnflag, q1, median, q3""")
def box_stats(t: Tables) -> DataFrame:
    boxes = distributions.box_stats(t.lineitem, "l_returnflag", "l_extendedprice")
    return boxes.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")})


@query("""SELECT * FROM (
  SELECT 'l_quantity' AS "column", round(stddev_samp(l_quantity), 4) AS stddev FROM lineitem
  UNION ALL SELECT 'l_extendedprice', round(stddev_samp(l_extendedprice), 4) FROM lineitem
  UNION ALL SELECT 'l_discount', round(stddev_samp(l_discount), 4) FROM lineitem
  UNION ALL SELECT 'l_tax', round(stddev_samp(l_tax), 4) FROM lineitem) ORDER BY stddev DESC, "column" LIMIT 1""")
def top_variance_column(t: Tables) -> DataFrame:
    spread = distributions.column_spread(t.lineitem, NUMBERS).withColumn("stddev", F.round("stddev", 4))
    return ranking.top_k(spread, [F.desc("stddev"), F.col("column")], 1)


def _correlation_sql() -> str:
    lines = [
        f"SELECT '{a}' AS a, '{b}' AS b, " + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 6)") + " AS r FROM lineitem"
        + (" LIMIT 1" if a == b else "")
        for a in NUMBERS for b in NUMBERS
    ]
    return " UNION ALL ".join(f"SELECT * FROM ({x})" for x in lines)


@query("""WITH x AS (SELECT vec_id, unnest(range(64)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings)
SELECT 'e' || a.i AS a, 'e' || b.i AS b, CASE WHEN a.i = b.i THEN 1.0::DOUBLE ELSE round(corr(a.v, b.v), 6) END AS r
FROM x a JOIN x b USING (vec_id) GROUP BY a.i, b.i""")
def correlation_wide(t: Tables) -> DataFrame:
    columns = [f"e{i}" for i in range(64)]
    wide = t.embeddings.select(*[F.col("embedding")[i].alias(c) for i, c in enumerate(columns)])
    return distributions.correlation_matrix(wide, columns).withColumn("r", F.round("r", 6))


@query(_correlation_sql())
def correlation_matrix(t: Tables) -> DataFrame:
    return distributions.correlation_matrix(t.lineitem, NUMBERS).withColumn("r", F.round("r", 6))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _priority_columns(t: Tables) -> DataFrame:
    flags = aggregates.indicators(t.orders, "o_orderpriority", PRIORITIES, "is_")
    return t.orders.select("o_orderstatus", *flags)


@query(" UNION ALL ".join(
    f"SELECT 'is_{p}' AS indicator, CAST(count(CASE WHEN o_orderpriority = '{p}' THEN 1 END) AS BIGINT) AS total FROM orders"
    for p in PRIORITIES))
def indicator_totals(t: Tables) -> DataFrame:
    return aggregates.indicator_totals(_priority_columns(t), "is_")


@query("SELECT o_orderstatus, " + ", ".join(
    f"CAST(count(CASE WHEN o_orderpriority = '{p}' THEN 1 END) AS BIGINT) AS \"is_{p}\"" for p in PRIORITIES
) + " FROM orders GROUP BY o_orderstatus")
def group_indicator_matrix(t: Tables) -> DataFrame:
    return aggregates.indicator_matrix(_priority_columns(t), "o_orderstatus", "is_")


@query("""WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) AS l_quantity, round((l_extendedprice - mp) / sp, 6) AS l_extendedprice
FROM lineitem, s""")
def standardise(t: Tables) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice"]
    scaled = features.standardise(t.lineitem.select("l_orderkey", "l_linenumber", *columns), columns)
    return scaled.withColumns({c: F.round(c, 6) for c in columns})


CORRELATED_ABOVE = 0.12


@query(f"""WITH {VECTORS_SQL}, d AS (SELECT unnest(range(0, 64)) AS i),
cells AS (SELECT vec_id, i, v[i + 1] AS x FROM vectors, d),
r AS (SELECT a.i AS i, b.i AS j, corr(a.x, b.x) AS r FROM cells a JOIN cells b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY 1, 2)
SELECT CAST(j AS INTEGER) AS j, CAST(min(i) AS INTEGER) AS first_i FROM r WHERE abs(r) > {CORRELATED_ABOVE} GROUP BY j""")
def drop_correlated(t: Tables) -> DataFrame:
    return features.correlated_dimensions(features.as_vectors(t.embeddings, "embedding"), above=CORRELATED_ABOVE)


@query("""WITH scores AS (SELECT l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DECIMAL(18, 2)) AS score FROM lineitem GROUP BY l_partkey),
run AS (SELECT *, sum(score) OVER (ORDER BY score, l_partkey ROWS UNBOUNDED PRECEDING) AS running FROM scores)
SELECT l_partkey, CAST(score AS DOUBLE) AS score FROM run WHERE running <= 0.20 * (SELECT sum(score) FROM scores)""")
def cum_drop(t: Tables) -> DataFrame:
    scores = t.lineitem.groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(18,2)").alias("score")
    )
    marked = features.drop_lowest_share(scores, "l_partkey", "score", 0.20)
    return marked.where("dropped").select("l_partkey", F.col("score").cast("double").alias("score"))


@query("""SELECT label, vec_id, CAST(rn AS INTEGER) AS rank FROM (
  SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings) WHERE rn <= 2""")
def sample_per_class(t: Tables) -> DataFrame:
    return ranking.top_k_per_group(t.embeddings.select("label", "vec_id"), ["label"], [F.col("vec_id")], 2)


@query(f"WITH {PARTS_SQL} SELECT vec_id, label, part FROM parts")
def split_stratified(t: Tables) -> DataFrame:
    return split_vectors(t).select("vec_id", "label", "part")


@query("""WITH hashed AS (SELECT o_orderkey, o_orderstatus, CAST(('0x' || substr(md5(o_orderkey || '-42'), 1, 8)) AS BIGINT) AS h FROM orders),
numbered AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY h, o_orderkey) AS rn, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM hashed)
SELECT o_orderkey, CASE WHEN rn <= n * 80 // 100 THEN 'train' ELSE 'test' END AS stratified,
  CASE WHEN h < CAST(floor(0.8 * 4294967296) AS BIGINT) THEN 'train' ELSE 'test' END AS hashed FROM numbered""")
def split_two_way(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    both = splits.stratified_split(orders, "o_orderkey", "o_orderstatus", CUTS_TWO, out="stratified")
    by_hash = splits.hashed_part("o_orderkey", [("train", 0.8), ("test", 1.0)])
    return both.select("o_orderkey", "stratified", by_hash.alias("hashed"))


GUESS_SQL = """guessed AS (SELECT l_returnflag AS actual, CASE WHEN l_linestatus = 'O' THEN 'N' WHEN l_quantity > 25 THEN 'A' ELSE 'R' END AS guess FROM lineitem)"""
# The report on a table guessed (actual, guess).
REPORT_SQL = """classes AS (SELECT actual AS c FROM guessed UNION SELECT guess FROM guessed),
per AS (SELECT c, (SELECT count(*) FROM guessed WHERE actual = c) AS support, (SELECT count(*) FROM guessed WHERE guess = c) AS found,
  (SELECT count(*) FROM guessed WHERE actual = c AND guess = c) AS hits FROM classes),
s AS (SELECT CAST(c AS VARCHAR) AS class, support, hits, coalesce(hits / nullif(found, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS r FROM per),
f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM s)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f"""


def guessed(t: Tables) -> DataFrame:
    guess = F.when(F.col("l_linestatus") == "O", "N").when(F.col("l_quantity") > 25, "A").otherwise("R")
    return t.lineitem.select(F.col("l_returnflag").alias("actual"), guess.alias("guess"))


@query(f"WITH {GUESS_SQL} SELECT actual, guess AS predicted, CAST(count(*) AS BIGINT) AS n FROM guessed GROUP BY 1, 2")
def confusion_matrix(t: Tables) -> DataFrame:
    return evaluation.confusion(guessed(t), "actual", "guess")


@query(f"WITH {GUESS_SQL}, {REPORT_SQL}")
def classification_report(t: Tables) -> DataFrame:
    report = evaluation.classification_report(guessed(t), "actual", "guess")
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("""WITH c AS (SELECT count(CASE WHEN toxic = 1 AND quality = 0 THEN 1 END) AS tp, count(CASE WHEN toxic <> 1 AND quality = 0 THEN 1 END) AS fp,
  count(CASE WHEN toxic = 1 AND quality <> 0 THEN 1 END) AS fn, count(CASE WHEN toxic <> 1 AND quality <> 0 THEN 1 END) AS tn FROM labels)
SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""")
def binary_scores(t: Tables) -> DataFrame:
    scores = evaluation.binary_scores(t.labels, F.col("toxic") == 1, F.col("quality") == 0)
    return scores.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1")})


@query("""WITH cells AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1, 2),
s AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM cells) AS both_, (SELECT sum(m * (m - 1) / 2) FROM (SELECT sum(n) AS m FROM cells GROUP BY a)) AS rows_,
  (SELECT sum(m * (m - 1) / 2) FROM (SELECT sum(n) AS m FROM cells GROUP BY b)) AS cols_, (SELECT sum(n) * (sum(n) - 1) / 2 FROM cells) AS every_)
SELECT round((both_ - rows_ * cols_ / every_) / ((rows_ + cols_) / 2 - rows_ * cols_ / every_), 6) AS adjusted_rand FROM s""")
def adjusted_rand(t: Tables) -> DataFrame:
    score = evaluation.adjusted_rand(t.lineitem, "l_returnflag", "l_linestatus")
    return score.select(F.round("adjusted_rand", 6).alias("adjusted_rand"))


@query("""SELECT CAST(l_linenumber AS INTEGER) AS l_linenumber, l_linestatus, round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END), 6) AS score
FROM lineitem GROUP BY 1, 2 ORDER BY score DESC, l_linenumber, l_linestatus LIMIT 5""")
def best_config(t: Tables) -> DataFrame:
    returned = (F.col("l_returnflag") == "R").cast("double")
    grid = t.lineitem.groupBy("l_linenumber", "l_linestatus").agg(F.round(F.avg(returned), 6).alias("score"))
    return evaluation.best_config(grid, "score", ["l_linenumber", "l_linestatus"], 5)


ELBOW_SQL = """curve AS (SELECT l_returnflag, step, CAST(sum(n) OVER (PARTITION BY l_returnflag ORDER BY step DESC) AS DOUBLE) AS remaining
  FROM (SELECT l_returnflag, CAST(floor(l_extendedprice / 5000) AS INTEGER) AS step, count(*) AS n FROM lineitem GROUP BY 1, 2)),
scaled AS (SELECT l_returnflag, step, (step - min(step) OVER w) / (max(step) OVER w - min(step) OVER w) AS xn,
  1 - (remaining - min(remaining) OVER w) / (max(remaining) OVER w - min(remaining) OVER w) AS yn FROM curve WINDOW w AS (PARTITION BY l_returnflag)),
diff AS (SELECT l_returnflag, step, yn - xn AS d, xn - lag(xn) OVER o AS gap, lag(yn - xn) OVER o AS p, lead(yn - xn) OVER o AS nx
  FROM scaled WINDOW o AS (PARTITION BY l_returnflag ORDER BY step)),
shaped AS (SELECT *, abs(avg(gap) OVER (PARTITION BY l_returnflag)) AS g, d >= coalesce(p, d) AND d >= coalesce(nx, d) AS peak,
  d <= coalesce(p, d) AND d <= coalesce(nx, d) AS valley FROM diff),
marked AS (SELECT l_returnflag, step, d, nx, CASE WHEN valley THEN 0.0 WHEN peak THEN d - g END AS threshold, CASE WHEN peak THEN step END AS at_peak FROM shaped),
scanned AS (SELECT l_returnflag, step, nx, last_value(threshold IGNORE NULLS) OVER f AS lim, last_value(at_peak IGNORE NULLS) OVER f AS at_
  FROM marked WINDOW f AS (PARTITION BY l_returnflag ORDER BY step ROWS UNBOUNDED PRECEDING))"""


@query(f"WITH {ELBOW_SQL} SELECT l_returnflag, CAST(arg_min(at_, step) AS INTEGER) AS elbow FROM scanned WHERE at_ IS NOT NULL AND nx < lim GROUP BY 1")
def elbow_point(t: Tables) -> DataFrame:
    """Lines that cost at least a given price: a falling curve per return flag."""
    from pyspark.sql import Window

    steps = t.lineitem.groupBy("l_returnflag", F.floor(F.col("l_extendedprice") / 5000).cast("int").alias("step")).agg(
        F.count(F.lit(1)).alias("n")
    )
    remaining = F.sum("n").over(Window.partitionBy("l_returnflag").orderBy(F.desc("step")))
    curve = steps.select("l_returnflag", "step", remaining.cast("double").alias("remaining"))
    return evaluation.elbow(curve, "l_returnflag", "step", "remaining")


@query(f"""WITH {VECTORS_SQL}, d AS (SELECT unnest(range(1, 65)) AS i),
means AS (SELECT label, i, avg(v[i]) AS m FROM vectors, d GROUP BY 1, 2),
centres AS (SELECT label, list(m ORDER BY i) AS c FROM means GROUP BY label),
dist AS (SELECT vec_id, x.label AS label, c.label AS cluster, round(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 9) AS d2
  FROM vectors x, centres c)
SELECT vec_id, label, CAST(arg_min(cluster, (d2, cluster)) AS INTEGER) AS cluster, round(min(d2), 6) AS d2 FROM dist GROUP BY vec_id, label""")
def nearest_centroid(t: Tables) -> DataFrame:
    rows = vectors(t)
    per_position = rows.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m"))
    centres = per_position.groupBy("label").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("c")
    )
    assigned = clustering.nearest_centroid(rows, "embedding", centres, "label", "c")
    return assigned.select("vec_id", "label", "cluster", F.round("d2", 6).alias("d2"))


NEIGHBOURS_SQL = """dist AS (SELECT q.vec_id, q.label AS actual, b.label AS label, b.vec_id AS neighbour,
  round(sqrt(list_sum(list_transform(list_zip(q.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))), 9) AS d
  FROM parts q JOIN parts b ON q.part = '{part}' AND b.part = 'train'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbour) AS rank FROM dist)"""


def _neighbours(t: Tables, name: str, k: int) -> DataFrame:
    rows = stored_split(t)
    found = neighbours.nearest(
        rows.where(F.col("part") == name), rows.where(F.col("part") == "train"), "vec_id", "embedding", "label", k
    )
    return found


def _actual(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.col("label").alias("actual"))


@query(f"""WITH {PARTS_SQL}, {NEIGHBOURS_SQL.format(part='test')},
votes AS (SELECT vec_id, actual, label, count(*) AS n FROM ranked WHERE rank <= 5 GROUP BY 1, 2, 3)
SELECT vec_id, actual, CAST(arg_max(label, (n, -label)) AS INTEGER) AS predicted FROM votes GROUP BY 1, 2""")
def knn_classify(t: Tables) -> DataFrame:
    voted = neighbours.vote(_neighbours(t, "test", 5), "vec_id", "label", [5])
    return voted.join(_actual(t), "vec_id").select("vec_id", "actual", "predicted")


@query(f"""WITH {PARTS_SQL}, {NEIGHBOURS_SQL.format(part='validation')}, ks AS (SELECT unnest(range(1, 16)) AS k),
votes AS (SELECT vec_id, actual, k, label, count(*) AS n FROM ranked, ks WHERE rank <= k GROUP BY 1, 2, 3, 4),
best AS (SELECT vec_id, actual, k, arg_max(label, (n, -label)) AS predicted FROM votes GROUP BY 1, 2, 3)
SELECT CAST(k AS INTEGER) AS k, round(avg(CASE WHEN predicted = actual THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM best GROUP BY k""")
def knn_k_sweep(t: Tables) -> DataFrame:
    voted = neighbours.vote(_neighbours(t, "validation", 15), "vec_id", "label", range(1, 16))
    scores = evaluation.accuracy(voted.join(_actual(t), "vec_id"), "actual", "predicted", ["k"])
    return scores.withColumn("accuracy", F.round("accuracy", 6))


@query(f"""WITH {PARTS_SQL}, dist AS (SELECT q.vec_id, q.part, q.label AS actual, b.label AS label, b.vec_id AS neighbour,
  round(sqrt(list_sum(list_transform(list_zip(q.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))), 9) AS d
  FROM parts q JOIN parts b ON q.part <> 'train' AND b.part = 'train'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbour) AS rank FROM dist), ks AS (SELECT unnest(range(1, 16)) AS k),
votes AS (SELECT vec_id, part, actual, k, label, count(*) AS n FROM ranked, ks WHERE rank <= k GROUP BY 1, 2, 3, 4, 5),
best AS (SELECT vec_id, part, actual, k, arg_max(label, (n, -label)) AS predicted FROM votes GROUP BY 1, 2, 3, 4),
scores AS (SELECT k, round(avg(CASE WHEN part = 'validation' THEN (predicted = actual)::INT::DOUBLE END), 6) AS validation_accuracy,
  round(avg(CASE WHEN part = 'test' THEN (predicted = actual)::INT::DOUBLE END), 6) AS test_accuracy FROM best GROUP BY k)
SELECT CAST(k AS INTEGER) AS k, validation_accuracy, test_accuracy FROM scores ORDER BY validation_accuracy DESC, k LIMIT 1""")
def knn_best_k(t: Tables) -> DataFrame:
    """The k that does best on the validation part and its accuracy on the test part, from one search."""
    rows = stored_split(t)
    found = neighbours.nearest(
        rows.where(F.col("part") != "train"), rows.where(F.col("part") == "train"), "vec_id", "embedding", "label", 15
    )
    voted = neighbours.vote(found, "vec_id", "label", range(1, 16))
    truth = rows.select("vec_id", "part", F.col("label").alias("actual"))
    scores = evaluation.accuracy(voted.join(truth, "vec_id"), "actual", "predicted", ["k", "part"])
    wide = aggregates.pivot_wide(scores, "k", "part", ["validation", "test"], F.round(F.first("accuracy"), 6))
    named = wide.select("k", F.col("validation").alias("validation_accuracy"), F.col("test").alias("test_accuracy"))
    return evaluation.best_config(named, "validation_accuracy", ["k"])


@query(f"""WITH {PARTS_SQL}, {NEIGHBOURS_SQL.format(part='validation')}, ks AS (SELECT unnest([3, 5, 7]) AS k), ws AS (SELECT unnest(['uniform', 'distance']) AS weights),
votes AS (SELECT vec_id, actual, k, weights, label, count(CASE WHEN d = 0 AND weights = 'distance' THEN 1 END) AS hits,
  round(sum(CASE WHEN weights = 'uniform' THEN 1.0::DOUBLE WHEN d > 0 THEN 1 / d ELSE 0 END), 6) AS w FROM ranked, ks, ws WHERE rank <= k GROUP BY 1, 2, 3, 4, 5),
best AS (SELECT vec_id, actual, k, weights, arg_max(label, (hits, w, -label)) AS predicted FROM votes GROUP BY 1, 2, 3, 4)
SELECT CAST(k AS INTEGER) AS k, weights, round(avg(CASE WHEN predicted = actual THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM best GROUP BY k, weights""")
def knn_weighted(t: Tables) -> DataFrame:
    voted = neighbours.vote(
        _neighbours(t, "validation", 7), "vec_id", "label", [3, 5, 7], ["uniform", "distance"]
    )
    scores = evaluation.accuracy(voted.join(_actual(t), "vec_id"), "actual", "predicted", ["k", "weights"])
    return scores.withColumn("accuracy", F.round("accuracy", 6))


@query(f"""WITH {VECTORS_SQL}, d AS (SELECT unnest(range(1, 65)) AS i),
moments AS (SELECT label, i, avg(v[i]) AS m, var_pop(v[i]) + 1e-6 AS s, count(*) AS n FROM vectors, d GROUP BY 1, 2),
terms AS (SELECT vec_id, c.label AS component, any_value(n) AS n, sum(-0.5 * (ln(2 * pi() * s) + (v[i] - m) * (v[i] - m) / s)) AS ll
  FROM vectors x JOIN moments c ON true GROUP BY 1, 2),
logs AS (SELECT vec_id, component, ln(n / (SELECT count(*) FROM vectors)) + ll AS lp FROM terms),
norms AS (SELECT *, lp - max(lp) OVER (PARTITION BY vec_id) AS rel FROM logs)
SELECT vec_id, CAST(component AS INTEGER) AS component, round(exp(rel) / sum(exp(rel)) OVER (PARTITION BY vec_id), 6) AS responsibility FROM norms""")
def gmm_estep(t: Tables) -> DataFrame:
    rows = vectors(t)
    names, model = clustering.mixture_from_classes(rows, "embedding", "label")
    scored = clustering.mixture_responsibilities(rows, "embedding", model)
    labels = F.array(*[F.lit(n) for n in names])
    return scored.select("vec_id", F.posexplode("responsibility").alias("i", "r")).select(
        "vec_id", labels[F.col("i")].alias("component"), F.round("r", 6).alias("responsibility")
    )


@query(f"""WITH {VECTORS_SQL},
dist AS (SELECT a.vec_id, a.label, b.label AS other, sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS d
  FROM vectors a, vectors b),
sums AS (SELECT vec_id, label, other, sum(d) AS total, count(*) AS n FROM dist GROUP BY 1, 2, 3),
ab AS (SELECT vec_id, label, max(CASE WHEN other = label THEN total / nullif(n - 1, 0) END) AS a, min(CASE WHEN other <> label THEN total / n END) AS b,
  max(CASE WHEN other = label THEN n END) AS size FROM sums GROUP BY 1, 2)
SELECT vec_id, label, round(CASE WHEN size > 1 AND b IS NOT NULL THEN (b - a) / greatest(a, b) ELSE 0 END, 6) AS silhouette FROM ab""")
def silhouette_exact(t: Tables) -> DataFrame:
    scores = clustering.silhouette_rows(vectors(t), "vec_id", "embedding", ["label"])
    rounded = scores.select("vec_id", F.round("silhouette_label", 6).alias("silhouette"))
    return rounded.join(t.embeddings.select("vec_id", "label"), "vec_id")


@query(f"""WITH {VECTORS_SQL}, named AS (SELECT vec_id, 'label' AS clustering, label AS c FROM vectors
  UNION ALL SELECT vec_id, 'coarse', label % 3 FROM vectors),
dist AS (SELECT a.vec_id, b.vec_id AS to_id, sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS d
  FROM vectors a, vectors b WHERE a.vec_id % 100 = 0),
sums AS (SELECT x.vec_id, m.clustering, m.c AS mine, o.c AS other, sum(d) AS total, count(*) AS n FROM dist x
  JOIN named m ON m.vec_id = x.vec_id JOIN named o ON o.vec_id = x.to_id AND o.clustering = m.clustering GROUP BY 1, 2, 3, 4),
ab AS (SELECT vec_id, clustering, max(CASE WHEN other = mine THEN total / nullif(n - 1, 0) END) AS a,
  min(CASE WHEN other <> mine THEN total / n END) AS b, max(CASE WHEN other = mine THEN n END) AS size FROM sums GROUP BY 1, 2),
s AS (SELECT clustering, CASE WHEN size > 1 AND b IS NOT NULL THEN (b - a) / greatest(a, b) ELSE 0 END AS s FROM ab)
SELECT clustering, round(avg(s), 6) AS silhouette, round(stddev_samp(s) / sqrt(count(*)), 6) AS error, CAST(count(*) AS BIGINT) AS n
FROM s GROUP BY 1""")
def silhouette_sampled(t: Tables) -> DataFrame:
    """Mean silhouettes of two groupings over the vectors whose id is divisible by 100, each against all vectors."""
    rows = vectors(t).withColumn("coarse", F.col("label") % 3)
    found = clustering.silhouette_estimate(rows, "vec_id", "embedding", ["label", "coarse"], F.col("vec_id") % 100 == 0)
    return found.withColumns({c: F.round(c, 6) for c in ("silhouette", "error")})


@query()
def knn_lsh(t: Tables) -> DataFrame:
    """About the ten nearest of all vectors for each one whose id is divisible by 100, by random projections."""
    rows = vectors(t)
    return approximate.nearest_approximate(rows.where(F.col("vec_id") % 100 == 0), rows, "vec_id", "embedding", "label", 10)
