"""Usage queries. Events stand for usage records: day, app (event type), minutes (value), launches (k)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import aggregates, ranking
from tallyloom.queries.registry import query
from tallyloom.sources.readers import Tables

USAGE_SQL = """
usage AS (
  SELECT CAST(ts AS DATE) AS day, event_type AS app, CAST(value AS DECIMAL(18, 2)) AS minutes,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS launches
  FROM events
)"""


def usage(t: Tables) -> DataFrame:
    """One usage record per event."""
    return t.events.select(
        F.to_date("ts").alias("day"),
        F.col("event_type").alias("app"),
        F.col("value").cast("decimal(18,2)").alias("minutes"),
        F.get_json_object("props", "$.k").cast("int").alias("launches"),
    )


@query(f"WITH {USAGE_SQL} SELECT app, CAST(sum(minutes) AS DOUBLE) AS total FROM usage GROUP BY app")
def sum_by_key(t: Tables) -> DataFrame:
    return aggregates.sum_by(usage(t), ["app"], "minutes").withColumn("total", F.col("total").cast("double"))


@query(f"""WITH {USAGE_SQL}
SELECT app, CAST(sum(minutes) AS DOUBLE) AS total FROM usage GROUP BY app ORDER BY sum(minutes) DESC, app LIMIT 5""")
def top_apps(t: Tables) -> DataFrame:
    totals = aggregates.sum_by(usage(t), ["app"], "minutes")
    return ranking.top_k(totals, [F.col("total").desc(), F.col("app")], 5).withColumn("total", F.col("total").cast("double"))


@query(f"WITH {USAGE_SQL} SELECT app, round(avg(launches), 6) AS mean FROM usage GROUP BY app")
def avg_by_key(t: Tables) -> DataFrame:
    # The text label is left out: engines disagree on how `%.2f` rounds a half.
    means = aggregates.avg_by(usage(t), ["app"], "launches", "notifications/day")
    return means.select("app", F.round("mean", 6).alias("mean"))


@query(f"""WITH {USAGE_SQL}
SELECT app, CAST(sum(minutes) AS DOUBLE) AS first_total, CAST(sum(launches) AS BIGINT) AS second_total,
       round(corr(CAST(minutes AS DOUBLE), CAST(launches AS DOUBLE)), 6) AS correlation,
       'minutes: ' || CAST(sum(minutes) AS VARCHAR) || ', launches: ' || CAST(sum(launches) AS VARCHAR) AS label
FROM usage GROUP BY app""")
def two_measure_by_key(t: Tables) -> DataFrame:
    both = aggregates.two_measures_by(usage(t), ["app"], "minutes", "launches")
    return both.withColumns({
        "first_total": F.col("first_total").cast("double"), "correlation": F.round("correlation", 6),
    })


@query(f"WITH {USAGE_SQL} SELECT dayname(day) AS weekday, CAST(sum(launches) AS BIGINT) AS total FROM usage GROUP BY 1")
def sum_by_weekday(t: Tables) -> DataFrame:
    named = usage(t).withColumn("weekday", F.date_format("day", "EEEE"))
    return aggregates.sum_by(named, ["weekday"], "launches")


@query(f"""WITH {USAGE_SQL}, daily AS (SELECT day, app, sum(launches) AS total FROM usage GROUP BY day, app),
ranked AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY total DESC, app) AS rn FROM daily)
SELECT strftime(day, '%Y-%m-%d') AS day, app, CAST(total AS BIGINT) AS total,
       app || ' (' || CAST(total AS VARCHAR) || ' times)' AS label
FROM ranked WHERE rn = 1""")
def daily_top(t: Tables) -> DataFrame:
    daily = aggregates.sum_by(usage(t), ["day", "app"], "launches")
    best = ranking.arg_max_per_group(daily, ["day"], "total", "app")
    return best.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "app", "total",
        F.format_string("%s (%d times)", "app", "total").alias("label"),
    )


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type")
def count_by_key(t: Tables) -> DataFrame:
    return aggregates.count_by(t.events, ["event_type"])
