"""Cleaning and projection queries; messy cells are built from the tables' own columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import text as tx
from tallyloom.functions.dates import lenient_date
from tallyloom.functions.numeric import norm, row_mean, squared_distance
from tallyloom.functions.unicode import nfkc
from tallyloom.operators import aggregates, features
from tallyloom.queries.registry import query
from tallyloom.sources.readers import Tables, parse_csv_column

# Full-width digits, as the year of a title may be written.
FULL_WIDTH = "０１２３４５６７８９"


@query("""SELECT p_partkey, name, brand FROM (
  SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN '  ' ELSE p_name END AS name,
         CASE WHEN p_size % 11 = 0 THEN NULL ELSE p_brand END AS brand, p_size % 13 <> 0 AND p_size % 17 <> 0 AS whole FROM part)
WHERE length(trim(name)) > 0 AND length(trim(brand)) > 0 AND whole""")
def clean_required(t: Tables) -> DataFrame:
    # Some lines have a field too many, some one too few.
    line = F.concat_ws(
        ",", F.col("p_partkey").cast("string"), "p_type", F.when(F.col("p_size") % 13 == 0, F.lit("")),
        F.when(F.col("p_size") % 17 != 0, F.col("p_container") if "p_container" in t.part.columns else F.lit("x")),
    )
    messy = t.part.select(
        "p_partkey", line.alias("line"),
        F.when(F.col("p_size") % 7 == 0, F.lit("  ")).otherwise(F.col("p_name")).alias("name"),
        F.when(F.col("p_size") % 11 != 0, F.col("p_brand")).alias("brand"),
    ).where(tx.field_count(F.col("line")) == 3).drop("line")
    return messy.where(tx.present(F.col("name")) & tx.present(F.col("brand")))


@query("""SELECT page_id, regexp_replace(url, '[^0-9]', '', 'g') AS digits,
TRY_CAST(NULLIF(regexp_replace(url, '[^0-9]', '', 'g'), '') AS BIGINT) AS value FROM pages""")
def clean_digits(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id", tx.digits_only(F.col("url")).alias("digits"), tx.digits_value(F.col("url")).alias("value")
    )


LIST_SQL = """cells AS (SELECT p_partkey, 'Stars:| ' || p_brand || ',' || p_type || ',  ''' || p_name || ''' ,,' || p_brand || '|' AS cell
  FROM part),
items AS (SELECT p_partkey, [x FOR x IN list_transform(
    string_split(replace(replace(replace(cell, '|', ''), 'Stars:', ''), '''', ''), ','), lambda x: trim(x)) IF length(x) > 0] AS items
  FROM cells)"""


def list_cells(t: Tables) -> DataFrame:
    cell = F.concat(
        F.lit("Stars:| "), "p_brand", F.lit(","), "p_type", F.lit(",  '"), "p_name", F.lit("' ,,"), "p_brand", F.lit("|")
    )
    return t.part.select("p_partkey", cell.alias("cell"))


@query(f"""WITH {LIST_SQL}, bare AS (
  SELECT p_partkey, trim(replace(replace(replace(cell, '|', ''), 'Stars:', ''), '\'\'', '')) AS b FROM cells)
SELECT p_partkey, array_to_string(list_transform(string_split(b, ','), lambda x: ltrim(x)), ', ') AS names FROM bare""")
def clean_list(t: Tables) -> DataFrame:
    return list_cells(t).select("p_partkey", tx.tidy_list(F.col("cell")).alias("names"))


@query(f"""WITH {LIST_SQL}
SELECT p_partkey, array_to_string([x FOR x, i IN items IF list_position(items, x) = i], ', ') AS names FROM items""")
def clean_list_distinct(t: Tables) -> DataFrame:
    return list_cells(t).select("p_partkey", tx.tidy_list_distinct(F.col("cell")).alias("names"))


YEAR_CASES_SQL = """CASE o_orderkey % 6
    WHEN 0 THEN '(' || y || ')' WHEN 1 THEN '[I] ' || y WHEN 2 THEN y || '–'
    WHEN 3 THEN translate(y, '0123456789', '０１２３４５６７８９')
    WHEN 4 THEN '(' || y || ' -' || y || ')' ELSE ' <> ' END"""


@query(f"""WITH raw AS (SELECT o_orderkey, {YEAR_CASES_SQL} AS year_text
  FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS y FROM orders)),
bare AS (SELECT o_orderkey, trim(regexp_replace(translate(year_text, '０１２３４５６７８９', '0123456789'), '[()\\[\\]{{}}<>]', '', 'g')) AS b
  FROM raw),
clean AS (SELECT o_orderkey, contains(b, '–') OR contains(b, '-') AS spans, b FROM bare)
SELECT o_orderkey, CASE WHEN spans THEN b ELSE coalesce(nullif(regexp_replace(b, '[^0-9]', '', 'g'), ''), 'Unknown') END AS year,
  spans AS is_range FROM clean""")
def year_normalise(t: Tables) -> DataFrame:
    y = F.year("o_orderdate").cast("string")
    case = F.col("o_orderkey") % 6
    messy = (
        F.when(case == 0, F.concat(F.lit("("), y, F.lit(")")))
        .when(case == 1, F.concat(F.lit("[I] "), y))
        .when(case == 2, F.concat(y, F.lit(tx.EN_DASH)))
        .when(case == 3, F.translate(y, "0123456789", FULL_WIDTH))
        .when(case == 4, F.concat(F.lit("("), y, F.lit(" -"), y, F.lit(")")))
        .otherwise(F.lit(" <> "))
    )
    cleaned = t.orders.select("o_orderkey", tx.tidy_year(messy).alias("year"))
    return cleaned.withColumn("is_range", tx.is_year_range(F.col("year")))


LETTERS = "abcdefghijklmnopqrstuvwxyz"
WIDE_LETTERS = "ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ"


@query("""SELECT p_partkey, replace(replace(p_name, 'e', 'ệ'), 'o', 'ố') || ' fi 한 ' || CAST(p_size AS VARCHAR) AS name FROM part""")
def nfkc_names(t: Tables) -> DataFrame:
    """Names in wide letters, with marks in either order, a ligature, Korean letters and wide digits, in normal form."""
    wide = F.translate(F.col("p_name"), LETTERS, WIDE_LETTERS)
    marked = F.replace(F.replace(wide, F.lit("ｅ"), F.lit("ｅ\u0302\u0323")), F.lit("ｏ"), F.lit("ｏ\u0302\u0301"))
    size = F.translate(F.col("p_size").cast("string"), "0123456789", FULL_WIDTH)
    messy = F.concat(marked, F.lit("\u3000\ufb01\u00a0\u1112\u1161\u11ab\u2003"), size)
    # Normalising takes far longer than reading: rows of few bytes, as in one row group, go to all cores.
    rows = t.part.select("p_partkey", messy.alias("name"))
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism).withColumn("name", nfkc(F.col("name")))


@query("""SELECT p_partkey, replace(p_name, ' ', ', ') AS name, p_type, p_retailprice AS price FROM part""")
def csv_quoted_parse(t: Tables) -> DataFrame:
    quoted = F.concat(F.lit('"'), F.replace("p_name", F.lit(" "), F.lit(", ")), F.lit('"'))
    lines = t.part.select(
        F.concat_ws(",", F.col("p_partkey").cast("string"), quoted, "p_type", F.col("p_retailprice").cast("string")).alias("line")
    )
    schema = T.StructType([
        T.StructField("p_partkey", T.LongType()), T.StructField("name", T.StringType()),
        T.StructField("p_type", T.StringType()), T.StructField("price", T.DoubleType()),
    ])
    return parse_csv_column(lines, "line", schema)


@query("""SELECT l_orderkey, l_linenumber, round(sqrt(l_quantity * l_quantity + l_tax * l_tax), 6) AS distance,
round((l_quantity + l_discount + l_tax) / 3, 6) AS trio_mean, round(l_extendedprice / (l_quantity + 1), 8) AS ratio
FROM lineitem""")
def feature_engineer(t: Tables) -> DataFrame:
    derived = features.with_derived(
        t.lineitem, "l_quantity", "l_tax", ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", "l_quantity"
    )
    return derived.select(
        "l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in ("distance", "trio_mean")],
        F.round("ratio", 8).alias("ratio"),
    )


@query("SELECT p_partkey, p_brand, p_type, p_size FROM part")
def drop_columns(t: Tables) -> DataFrame:
    return features.without_columns(features.without_columns(t.part, ["p_name"]), prefix="p_retail")


@query("""SELECT 'o_orderkey' AS "column", 'bigint' AS type, CAST(count(o_orderkey) AS BIGINT) AS filled, CAST(count(*) - count(o_orderkey) AS BIGINT) AS missing FROM orders
UNION ALL SELECT 'o_clerk', 'string', count(CASE WHEN o_orderkey % 3 <> 0 THEN 1 END), count(CASE WHEN o_orderkey % 3 = 0 THEN 1 END) FROM orders
UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice), count(*) - count(o_totalprice) FROM orders
UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus), count(*) - count(o_orderstatus) FROM orders""")
def null_profile(t: Tables) -> DataFrame:
    sparse = F.when(F.col("o_orderkey") % 3 != 0, F.lit("clerk"))
    return aggregates.null_profile(t.orders.select("o_orderkey", sparse.alias("o_clerk"), "o_totalprice", "o_orderstatus"))


@query(r"""SELECT p_partkey, array_to_string(string_split_regex(p_name, '\s+'), '_') AS snake, lower(p_type) AS low, upper(trim('  ' || p_brand || ' ')) AS bare,
CAST(length(p_name) AS INTEGER) AS n, regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits, regexp_full_match(p_brand, 'Brand#[0-9]+') AS matched,
contains(p_name, 'ring') AS has_ring, starts_with(p_type, 'ECO') AS eco, CAST(p_size AS VARCHAR) || '%' AS percent,
TRY_CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS brand_no, TRY_CAST(p_brand AS INTEGER) IS NULL AS not_a_number,
least(p_brand, p_type) AS first_text, greatest(p_brand, p_type) AS last_text,
CAST(len(list_distinct([p_type, p_type, p_brand])) AS INTEGER) AS n_distinct, string_split(p_name, ' ')[1] AS head,
CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS size_class FROM part""")
def scalar_tour_string(t: Tables) -> DataFrame:
    words = F.split("p_name", r"\s+")
    return t.part.select(
        "p_partkey",
        F.array_join(words, "_").alias("snake"),
        F.lower("p_type").alias("low"),
        F.upper(F.trim(F.concat(F.lit("  "), "p_brand", F.lit(" ")))).alias("bare"),
        F.length("p_name").alias("n"),
        tx.digits_only(F.col("p_brand")).alias("digits"),
        F.col("p_brand").rlike("^Brand#[0-9]+$").alias("matched"),
        F.col("p_name").contains("ring").alias("has_ring"),
        F.col("p_type").startswith("ECO").alias("eco"),
        tx.percent_text(F.col("p_size")).alias("percent"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).try_cast("int").alias("brand_no"),
        F.col("p_brand").try_cast("int").isNull().alias("not_a_number"),
        F.least("p_brand", "p_type").alias("first_text"),
        F.greatest("p_brand", "p_type").alias("last_text"),
        F.size(F.array_distinct(F.array("p_type", "p_type", "p_brand"))).alias("n_distinct"),
        F.slice(words, 1, 1)[0].alias("head"),
        F.when(F.col("p_size") > 25, F.lit("big")).otherwise(F.lit("small")).alias("size_class"),
    )


@query("""SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS d, CAST(month(o_orderdate) AS INTEGER) AS m,
CAST(year(o_orderdate) AS INTEGER) AS y, dayname(o_orderdate) AS weekday,
strftime(TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE), '%Y/%m/%d') AS parsed,
TRY_CAST(o_orderstatus || '-13-45' AS DATE) IS NULL AS bad FROM orders""")
def scalar_tour_date(t: Tables) -> DataFrame:
    written = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.orders.select(
        "o_orderkey",
        F.dayofmonth("o_orderdate").alias("d"), F.month("o_orderdate").alias("m"), F.year("o_orderdate").alias("y"),
        F.date_format("o_orderdate", "EEEE").alias("weekday"),
        F.date_format(F.try_to_date(written, "yyyy-MM-dd"), "yyyy/MM/dd").alias("parsed"),
        F.try_to_date(F.concat("o_orderstatus", F.lit("-13-45")), "yyyy-MM-dd").isNull().alias("bad"),
    )


@query("""SELECT dayname(CAST(make_date(CAST(year(o_orderdate) - 1 AS BIGINT), 1, 1) + to_months(CAST(month(o_orderdate) + 11 AS INTEGER)) AS DATE)
  + CAST(day(o_orderdate) - 1 + o_orderkey % 40 AS INTEGER)) AS weekday, CAST(count(*) AS BIGINT) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY 1""")
def lenient_weekdays(t: Tables) -> DataFrame:
    """Orders by the weekday of dates whose months and days run over, as in 1995-14-52."""
    day = F.col("o_orderdate")
    late = F.concat_ws(
        "-", F.year(day) - 1, F.month(day) + 12, F.concat((F.dayofmonth(day) + F.col("o_orderkey") % 40).cast("string"), F.lit(" sent"))
    )
    named = t.orders.withColumn("weekday", F.date_format(lenient_date(late), "EEEE"))
    return named.groupBy("weekday").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT vec_id, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS norm,
round(list_sum(list_transform(v, lambda x: (x - 0.5) * (x - 0.5))), 6) AS d2, round(pow(abs(v[1]), 1.5), 6) AS powered,
round(list_min(v), 6) AS least, round((v[1] + v[2] + v[3]) / 3, 6) AS mean3
FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)""")
def scalar_tour_math(t: Tables) -> DataFrame:
    v = F.col("v")
    vectors = t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    half = F.transform(v, lambda x: F.lit(0.5))
    return vectors.select(
        "vec_id",
        F.round(norm(v), 6).alias("norm"),
        F.round(squared_distance(v, half), 6).alias("d2"),
        F.round(F.pow(F.abs(v[0]), F.lit(1.5)), 6).alias("powered"),
        F.round(F.array_min(v), 6).alias("least"),
        F.round(row_mean([v[0], v[1], v[2]]), 6).alias("mean3"),
    )
