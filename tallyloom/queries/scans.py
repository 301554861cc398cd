"""Scans, sinks and round trips through files in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import text as tx
from tallyloom.operators import aggregates
from tallyloom.plans.durable import scratch_path
from tallyloom.queries.registry import query
from tallyloom.sources import readers, records, writers
from tallyloom.sources.readers import Tables


def _scan(table: str, date: str | None = None) -> None:
    picked = "*" if date is None else f"* REPLACE (strftime({date}, '%Y-%m-%d') AS {date})"

    def scan(t: Tables) -> DataFrame:
        rows = getattr(t, table)
        return rows if date is None else rows.withColumn(date, F.date_format(date, "yyyy-MM-dd"))

    query(f"SELECT {picked} FROM {table}", f"scan_{table}")(scan)


for _table, _date in (
    ("customer", None), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("part", None), ("supplier", None),
    ("nation", None),
):
    _scan(_table, _date)


@query(r"SELECT unnest(string_split_regex(text, '\r\n|\r|\n')) AS value FROM documents")
def scan_text_lines(t: Tables) -> DataFrame:
    documents = t.documents
    path = scratch_path(documents.sparkSession, "lines")
    documents.select("text").write.text(path)
    return readers.read_lines(documents.sparkSession, path)


USAGE_SCHEMA = T.StructType([
    T.StructField("day", T.StringType()), T.StructField("app", T.StringType()),
    T.StructField("minutes", T.DoubleType()), T.StructField("launches", T.IntegerType()),
    T.StructField("props", T.StringType()),
])
USAGE_ROWS_SQL = """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS app, value AS minutes,
CAST(json_extract_string(props, '$.k') AS INTEGER) AS launches, props FROM events"""


def _usage_csv(t: Tables) -> str:
    """Events as a CSV file with a header; the JSON cell holds quotes and so exercises quoting."""
    events = t.events
    path = scratch_path(events.sparkSession, "usage")
    rows = events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_type").alias("app"), F.col("value").alias("minutes"),
        F.get_json_object("props", "$.k").cast("int").alias("launches"), "props",
    )
    writers.write_csv(rows, path)
    return path


@query(USAGE_ROWS_SQL)
def scan_csv_typed(t: Tables) -> DataFrame:
    return readers.read_typed_csv(t.events.sparkSession, _usage_csv(t), USAGE_SCHEMA)


@query(USAGE_ROWS_SQL)
def scan_csv_inferred(t: Tables) -> DataFrame:
    rows = readers.read_inferred_csv(t.events.sparkSession, _usage_csv(t))
    return rows.withColumn("day", F.col("day").cast("string"))


TEXTS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
])


@query("SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS digest, source FROM documents WHERE text <> ''")
def scan_csv_multiline(t: Tables) -> DataFrame:
    """Documents through CSV files whose fields hold line breaks, every file read by as many tasks as it has ranges."""
    documents = t.documents
    path = scratch_path(documents.sparkSession, "texts")
    writers.write_csv(documents.select("doc_id", "text", "source").where("text <> ''"), path)
    rows = records.read_multiline_csv(documents.sparkSession, path, TEXTS_SCHEMA, strict=True)
    return rows.select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"), "source")


@query(r"""WITH words AS (SELECT unnest(string_split_regex(lower(text), '[ \t\n\x0B\f\r]+')) AS word FROM conversations)
SELECT word, CAST(count(*) AS BIGINT) AS n FROM words WHERE word <> '' GROUP BY word""")
def write_kv_roundtrip(t: Tables) -> DataFrame:
    talk = t.conversations
    spark = talk.sparkSession
    counts = aggregates.count_by(aggregates.word_rows(talk, tx.words(F.col("text"))), ["word"])
    path = scratch_path(spark, "counts")
    writers.write_pairs(counts, "word", "n", path)
    return writers.read_pairs(spark, path, T.StructField("word", T.StringType()), T.StructField("n", T.LongType()))
