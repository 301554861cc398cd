"""Universal quantification: groups all of whose rows, or only whose rows, satisfy a predicate.

``matches`` is a boolean column. The two operators treat an unknown (NULL) match differently.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def all_match(df: DataFrame, keys: Sequence[str], matches: Column) -> DataFrame:
    """Keys every row of which matches. An unknown match counts as a row that fails."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"), F.count_if(matches).alias("_hits"))
        .where(F.col("_rows") == F.col("_hits"))
        .select(*keys)
    )


def all_match_counted(df: DataFrame, keys: Sequence[str], rows: str, hits: str) -> DataFrame:
    """As :func:`all_match` for input that already counts ``rows`` and ``hits`` at a finer level."""
    return (
        df.groupBy(*keys)
        .agg(F.sum(rows).alias("_rows"), F.sum(hits).alias("_hits"))
        .where((F.col("_rows") > 0) & (F.col("_rows") == F.col("_hits")))
        .select(*keys)
    )


def only_match(df: DataFrame, keys: Sequence[str], matches: Column) -> DataFrame:
    """Keys with at least one matching row and none that fails. Unknown matches are ignored.

    This is ``matching EXCEPT failing`` answered with one aggregation: both flags come out of the same
    partial aggregate, so neither side of an anti join has to be shuffled.
    """
    return (
        df.groupBy(*keys)
        .agg(F.bool_or(matches).alias("_any"), F.bool_and(matches).alias("_all"))
        .where(F.col("_any") & F.col("_all"))
        .select(*keys)
    )


def only_match_anti(df: DataFrame, keys: Sequence[str], matches: Column) -> DataFrame:
    """As :func:`only_match`, written as distinct matching keys without the failing ones (anti join)."""
    keys = list(keys)
    flagged = df.select(*keys, matches.alias("_hit"))
    hits = flagged.where(F.col("_hit")).select(*keys).distinct()
    misses = flagged.where(~F.col("_hit")).select(*keys).distinct()
    return hits.join(misses, keys, "left_anti")


def register_table_functions(spark: SparkSession, lines: str, suffix: str = "") -> tuple[str, str]:
    """SQL table functions over a view ``lines(customer, order_key, brand)``; returns their names.

    ``customers_of_one_brand(name)`` and ``orders_of_one_brand(name)``, with ``suffix`` behind their names, can be used
    in FROM and IN. The parameter is compared in an inner projection because a table function cannot see it deeper down.
    """
    customers, orders = f"customers_of_one_brand{suffix}", f"orders_of_one_brand{suffix}"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {customers}(name STRING)
        RETURNS TABLE (customer BIGINT)
        RETURN SELECT customer FROM (SELECT customer, brand = name AS hit FROM {lines})
               GROUP BY customer HAVING count(*) = count_if(hit)
    """)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {orders}(name STRING)
        RETURNS TABLE (order_key BIGINT)
        RETURN SELECT order_key FROM (SELECT order_key, brand = name AS hit FROM {lines})
               GROUP BY order_key HAVING bool_or(hit) AND bool_and(hit)
    """)
    return customers, orders


@contextmanager
def table_functions(lines: DataFrame) -> Iterator[tuple[str, str]]:
    """The same functions over a frame, under names that nothing else in the session has, and gone afterwards.

    Statements made inside keep working, since the names are resolved when a statement is made.
    """
    spark, mark = lines.sparkSession, f"_{uuid.uuid4().hex}"
    view = f"lines{mark}"
    lines.createTempView(view)
    names = register_table_functions(spark, view, mark)
    try:
        yield names
    finally:
        for name in names:
            spark.sql(f"DROP TEMPORARY FUNCTION {name}")
        spark.catalog.dropTempView(view)
