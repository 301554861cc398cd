"""File scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD_RECORD = "_bad_record"


class Tables:
    """Parquet tables of one directory, as attributes: ``Tables(spark, path).orders``."""

    def __init__(self, spark: SparkSession, directory: str):
        self._spark = spark
        self._directory = directory.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self._spark.read.parquet(f"{self._directory}/{name}.parquet")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of a file or directory, one row each, in column ``value``."""
    return spark.read.text(path)


def read_typed_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False, strict: bool = False
) -> DataFrame:
    """CSV with a header and a declared schema.

    Lines that do not fit the schema fail the job when ``strict``; otherwise they are dropped whole.
    Quoted fields may hold commas and, with ``multi_line``, line breaks.
    """
    reader = (
        spark.read.option("header", True).option("enforceSchema", True)
        .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    )
    if strict:
        return reader.option("mode", "FAILFAST").schema(schema).csv(path)
    marked = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
    rows = (
        reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_RECORD)
        .schema(marked).csv(path)
    )
    # Whether a line fits is only known once all its fields are parsed, so the filter refers to them: a plan that
    # keeps few fields would check only these, one that keeps none (a count) is refused by Spark. The condition
    # on the hash always holds.
    parsed = F.hash(*[f"`{f.name}`" for f in schema.fields]) >= -(2**31)
    return rows.where(F.col(BAD_RECORD).isNull() & parsed).drop(BAD_RECORD)


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and inferred types; costs an extra pass, so meant for exploration."""
    return spark.read.option("header", True).option("inferSchema", True).option("escape", '"').csv(path)


def parse_csv_column(df: DataFrame, line: str, schema: T.StructType) -> DataFrame:
    """Split a column of CSV text into typed fields, honouring quotes around commas."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(F.col(line), ddl, {"quote": '"', "escape": '"'})
    rest = [c for c in df.columns if c != line]
    return df.select(*rest, parsed.alias("_parsed")).select(*rest, "_parsed.*")
