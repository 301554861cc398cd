"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_pairs(df: DataFrame, key: str, value: str, path: str) -> None:
    """One ``key<TAB>value`` line per row."""
    df.select(key, value).write.option("sep", "\t").option("emptyValue", "").csv(path)


def read_pairs(spark: SparkSession, path: str, key: T.StructField, value: T.StructField) -> DataFrame:
    """Read back what :func:`write_pairs` wrote."""
    return spark.read.option("sep", "\t").schema(T.StructType([key, value])).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; quotes inside a field are doubled."""
    df.write.option("header", True).option("escape", '"').csv(path)
