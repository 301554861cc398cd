"""Title analytics. Products stand for titles: the words of the name are the genres, the price is the
rating, the type the certification (blank for every tenth size), sold units the votes, and the years of
shipment the release year or run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text as tx
from tallyloom.operators import aggregates, compare, pairs, ranking
from tallyloom.plans.sizing import lookup_join
from tallyloom.queries.registry import query
from tallyloom.sources.readers import Tables

TITLES_SQL = """
sold AS (
  SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS votes, min(year(l_shipdate)) AS y0, max(year(l_shipdate)) AS y1
  FROM lineitem GROUP BY l_partkey),
raw AS (
  SELECT p_partkey AS id, p_name AS title, replace(p_name, ' ', ', ') AS genres, p_retailprice AS rating,
         CASE WHEN p_size % 10 = 0 THEN '' ELSE p_type END AS certification, votes,
         CASE WHEN p_size % 2 = 0 THEN '(' || y0 || ')' ELSE y0 || '–' || y1 END AS year_text
  FROM part JOIN sold ON l_partkey = p_partkey),
titles AS (
  SELECT *, CASE WHEN contains(year_text, '–') THEN year_text
                 ELSE regexp_replace(year_text, '[^0-9]', '', 'g') END AS year,
         contains(year_text, '–') AS is_series FROM raw),
genre_rows AS (SELECT id, title, rating, is_series, unnest(string_split(genres, ', ')) AS genre FROM titles)"""


def raw_titles(t: Tables) -> DataFrame:
    """Titles as a messy file would hold them. Lines are totalled per product before the join."""
    shipped = F.year("l_shipdate")
    sold = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum("l_quantity").cast("bigint").alias("votes"), F.min(shipped).alias("y0"), F.max(shipped).alias("y1")
    )
    parts = t.part.select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    year = F.when(F.col("p_size") % 2 == 0, F.format_string("(%d)", "y0")).otherwise(
        F.format_string(f"%d{tx.EN_DASH}%d", "y0", "y1")
    )
    return lookup_join(sold, parts, ["p_partkey"]).select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"),
        F.replace("p_name", F.lit(" "), F.lit(", ")).alias("genres"), F.col("p_retailprice").alias("rating"),
        F.when(F.col("p_size") % 10 == 0, F.lit("")).otherwise(F.col("p_type")).alias("certification"),
        "votes", year.alias("year_text"),
    )


def titles(t: Tables) -> DataFrame:
    """Cleaned titles with their class: a series has a range of years."""
    return raw_titles(t).withColumn("year", tx.tidy_year(F.col("year_text"))).withColumn(
        "is_series", tx.is_year_range(F.col("year"))
    )


def genre_rows(t: Tables) -> DataFrame:
    """One row per product and genre; needs no sales, so it reads the product table alone."""
    genres = tx.list_items(F.replace("p_name", F.lit(" "), F.lit(", ")))
    return t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_retailprice").alias("rating"),
        F.explode(genres).alias("genre"),
    )


PART_GENRES_SQL = """genre_rows AS (
  SELECT p_partkey AS id, p_name AS title, p_retailprice AS rating, unnest(string_split(p_name, ' ')) AS genre FROM part)"""


@query(f"WITH {TITLES_SQL} SELECT id, title, year, is_series FROM titles")
def classify_two_way(t: Tables) -> DataFrame:
    return titles(t).select("id", "title", "year", "is_series")


@query(f"WITH {PART_GENRES_SQL} SELECT id, title, rating, genre FROM genre_rows")
def explode_values(t: Tables) -> DataFrame:
    return genre_rows(t)


@query(f"""WITH {PART_GENRES_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY genre ORDER BY rating DESC, id) AS rank FROM genre_rows)
SELECT genre, id, title, rating, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 10""")
def topk_per_group(t: Tables) -> DataFrame:
    best = ranking.top_k_per_group(genre_rows(t), ["genre"], [F.desc("rating"), F.col("id")], 10)
    return best.select("genre", "id", "title", "rating", "rank")


@query(f"""WITH {PART_GENRES_SQL}
SELECT genre, round(stddev_pop(rating), 6) AS stddev, CAST(count(*) AS BIGINT) AS n FROM genre_rows GROUP BY genre""")
def rating_diversity(t: Tables) -> DataFrame:
    return aggregates.spread_by(genre_rows(t), "genre", "rating").withColumn("stddev", F.round("stddev", 6))


@query(f"""WITH {PART_GENRES_SQL}, spread AS (
  SELECT genre, round(stddev_pop(rating), 6) AS stddev FROM genre_rows GROUP BY genre)
SELECT * FROM (SELECT genre, stddev, 'top' AS side FROM spread ORDER BY stddev DESC, genre LIMIT 3)
UNION ALL SELECT * FROM (SELECT genre, stddev, 'bottom' AS side FROM spread ORDER BY stddev, genre DESC LIMIT 3)""")
def top_bottom_k(t: Tables) -> DataFrame:
    spread = aggregates.spread_by(genre_rows(t), "genre", "rating").select("genre", F.round("stddev", 6).alias("stddev"))
    return ranking.top_and_bottom(spread, "stddev", "genre", 3)


CERT_SQL = """certified AS (
  SELECT CASE WHEN p_size % 10 = 0 THEN '' ELSE p_type END AS certification, CAST(p_retailprice AS DECIMAL(18, 2)) AS rating
  FROM part)"""


def certified(t: Tables) -> DataFrame:
    blanked = F.when(F.col("p_size") % 10 == 0, F.lit("")).otherwise(F.col("p_type"))
    return t.part.select(blanked.alias("certification"), F.col("p_retailprice").cast("decimal(18,2)").alias("rating"))


@query(f"""WITH {CERT_SQL}
SELECT certification, CAST(count(*) AS BIGINT) AS n, CAST(sum(rating) AS DOUBLE) AS total,
       round(avg(CAST(rating AS DOUBLE)), 6) AS mean
FROM certified WHERE certification <> '' GROUP BY certification""")
def certification_stats(t: Tables) -> DataFrame:
    stats = aggregates.stats_by(certified(t), "certification", "rating")
    return stats.select(
        "certification", "n", F.col("total").cast("double"), F.round(F.col("mean").cast("double"), 6).alias("mean")
    )


@query(f"""WITH {CERT_SQL}
SELECT certification, round(avg(CAST(rating AS DOUBLE)), 6) AS mean FROM certified WHERE certification <> ''
GROUP BY certification ORDER BY mean DESC, certification LIMIT 1""")
def best_key(t: Tables) -> DataFrame:
    stats = aggregates.stats_by(certified(t), "certification", "rating")
    means = stats.select("certification", F.round(F.col("mean").cast("double"), 6).alias("mean"))
    return ranking.top_k(means, [F.desc("mean"), F.col("certification")], 1)


@query(f"""WITH {CERT_SQL} SELECT certification, CAST(count(*) AS BIGINT) AS n FROM certified GROUP BY certification""")
def certification_count(t: Tables) -> DataFrame:
    return aggregates.count_by(certified(t), ["certification"])


@query(f"""WITH {TITLES_SQL}
SELECT id, title, year, rating, votes FROM titles WHERE NOT is_series AND rating > 950 AND votes < 700
ORDER BY rating DESC, id LIMIT 20""")
def hidden_gems(t: Tables) -> DataFrame:
    rating = tx.number_text(F.col("rating").cast("string"))
    votes = tx.number_text(F.col("votes").cast("string"))
    gems = titles(t).where(~F.col("is_series") & (rating > 950.0) & (votes < 700))
    return ranking.top_k(gems.select("id", "title", "year", "rating", "votes"), [F.desc("rating"), F.col("id")], 20)


@query(f"""WITH {TITLES_SQL}
SELECT is_series, round(avg(rating), 6) AS mean_value, CAST(sum(votes) AS BIGINT) AS total_weight,
       CAST(count(*) AS BIGINT) AS n FROM titles GROUP BY is_series""")
def class_compare(t: Tables) -> DataFrame:
    return compare.class_summary(titles(t), "is_series", "rating", "votes").withColumn(
        "mean_value", F.round("mean_value", 6)
    )


@query(f"WITH {TITLES_SQL} SELECT is_series, year, round(avg(rating), 6) AS mean_value FROM titles GROUP BY is_series, year")
def class_trend(t: Tables) -> DataFrame:
    trend = compare.class_trend(titles(t), "is_series", "year", "rating")
    return trend.withColumn("mean_value", F.round("mean_value", 6))


@query(f"""WITH {TITLES_SQL} SELECT is_series, year, CAST(sum(votes) AS BIGINT) AS total FROM titles
GROUP BY is_series, year ORDER BY is_series, year""")
def class_year_totals(t: Tables) -> DataFrame:
    return compare.class_totals(titles(t), "is_series", "year", "votes")


@query(f"""WITH {TITLES_SQL}, yearly AS (
  SELECT is_series, year, avg(rating) AS v, avg(votes) AS w FROM titles GROUP BY is_series, year)
SELECT is_series, round(avg(v), 6) AS mean_value, round(avg(w), 6) AS mean_weight FROM yearly GROUP BY is_series""")
def mean_of_yearly_means(t: Tables) -> DataFrame:
    means = aggregates.mean_of_means(titles(t), ["is_series"], "year", "rating", "votes")
    return means.withColumns({c: F.round(c, 6) for c in ("mean_value", "mean_weight")})


PAIRS_SQL = """members AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem),
pairs AS (SELECT x.l_suppkey AS a, y.l_suppkey AS b, x.l_orderkey AS title
          FROM members x JOIN members y ON x.l_orderkey = y.l_orderkey AND x.l_suppkey < y.l_suppkey)"""


@query(f"WITH {PAIRS_SQL} SELECT a, b, CAST(count(*) AS BIGINT) AS n FROM pairs GROUP BY a, b")
def pair_cooccurrence(t: Tables) -> DataFrame:
    return pairs.pair_counts(t.lineitem, "l_orderkey", "l_suppkey")


@query(f"""WITH {PAIRS_SQL},
paged AS (SELECT *, (row_number() OVER (PARTITION BY a, b ORDER BY title) - 1) // 1000 AS part FROM pairs)
SELECT a, b, CAST(part AS BIGINT) AS part, CAST(count(*) AS BIGINT) AS n,
       string_agg(CAST(title AS VARCHAR), ', ' ORDER BY title) AS titles
FROM paged GROUP BY a, b, part""")
def pair_titles(t: Tables) -> DataFrame:
    listed = pairs.pair_titles(t.lineitem, "l_orderkey", "l_suppkey", "l_orderkey")
    joined = F.array_join(F.col("l_orderkey_list").cast("array<string>"), ", ")
    return listed.select("a", "b", "part", "n", joined.alias("titles"))
