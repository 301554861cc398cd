"""Multi-line CSV read by many tasks.

Spark's own multi-line reader gives a whole file to one task. Here files are read as lines, in byte ranges as any text
file. Whether a line starts inside a quoted field depends on all lines before it, but a line's effect does not: it maps
each of the two states (outside, inside) to one. A first pass composes these maps over every byte range, windows over
the ranges of a file give the state in which each starts, and a second pass cuts records at true line ends. Only what
crosses the border of a range is shuffled: at most a head and a tail per range.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.plans.durable import written
from tallyloom.sources.readers import BAD_RECORD

# Ranges whose states are sent to all tasks (24 bytes each); more are joined by key and sorted.
MOST_RANGES = 1_000_000

# A line that starts outside quotes and ends inside: whole fields, then one whose quote stays open. Quotes inside a
# quoted field are doubled, those inside an unquoted one are ordinary characters.
_OPENED = r'"(?:[^"]+|"")*+'
_ENDS_INSIDE = re.compile(rf'(?:(?:{_OPENED}"[^,]*+|[^",][^,]*+)?,)*+{_OPENED}')


def line_effect(line: str) -> tuple[bool, bool]:
    """Whether a quoted field is open at the end of a line that starts outside quotes, and of one that starts inside."""
    if '"' not in line:
        return False, True
    return _ENDS_INSIDE.fullmatch(line) is not None, _ENDS_INSIDE.fullmatch('"' + line) is not None


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    for batch in batches:
        yield list(zip(*(c.to_pylist() for c in batch.columns), strict=True))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_EFFECT = pa.schema([("file", pa.int64()), ("range", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_()), ("starts", pa.bool_())])


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: the state it leads to from outside and from inside, and whether a record starts in it from inside."""
    at, ends, starts = None, (False, True), False
    for rows in _rows(batches):
        done = []
        for file, first, line in rows:
            if (file, first) != at:
                if at is not None:
                    done.append((*at, *ends, starts))
                at, ends, starts = (file, first), (False, True), False
            starts = starts or not ends[1]
            effect = line_effect(line)
            ends = effect[ends[0]], effect[ends[1]]
        yield _batch(done, _EFFECT)
    if at is not None:
        yield _batch([(*at, *ends, starts)], _EFFECT)


_PIECE = pa.schema([("file", pa.int64()), ("range", pa.int64()), ("number", pa.int64()), ("place", pa.int64()), ("record", pa.string())])


def _cut(parts: bool):
    """Records that lie in one range or, with ``parts``, the heads and tails of the others.

    A piece carries the range in which its record starts and the record's number there.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, owner, lines, number = None, False, None, [], 0

        def piece(whole: bool) -> Iterator[tuple]:
            if whole != parts:
                file, first = at
                yield file, first if owner is None else owner[0], number if owner is None else owner[1], first, "\n".join(lines)

        for rows in _rows(batches):
            done = []
            for file, first, line, state, owning, owning_number in rows:
                if (file, first) != at:
                    if lines:
                        done.extend(piece(False))
                    at, inside, lines, number = (file, first), state, [], 0
                    owner = (owning, owning_number) if inside else None
                lines.append(line)
                inside = line_effect(line)[inside]
                if not inside:
                    done.extend(piece(owner is None))
                    number += owner is None
                    lines, owner = [], None
            yield _batch(done, _PIECE)
        if lines:
            yield _batch(list(piece(False)), _PIECE)

    return task


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, range, line) in the order of the file within each range."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), F.col("value").alias("line")
    )


def range_states(lines: DataFrame) -> DataFrame:
    """(file, range, state, owner): whether a range starts inside a field, and the range where that field's record starts."""
    effects = lines.mapInArrow(_effects, "file long, range long, outside boolean, inside boolean, starts boolean")
    order = Window.partitionBy("file").orderBy("range")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # Of the four maps, two forget the state; after the last of these only the number of flips counts.
    flips = (F.col("outside") & ~F.col("inside")).cast("long")
    fixed = F.col("outside") == F.col("inside")
    counted = effects.withColumn("flips", F.sum(flips).over(order))
    last = F.last(F.when(fixed, F.struct(F.col("outside").cast("long").alias("value"), "flips")), True).over(before)
    since = F.coalesce(F.lag("flips").over(order), F.lit(0)) - F.coalesce(last["flips"], F.lit(0))
    stated = counted.withColumn("state", (F.coalesce(last["value"], F.lit(0)) + since) % 2 == 1)
    has_start = ~F.col("state") | F.col("starts")
    return stated.withColumn("owner", F.last(F.when(has_start, F.col("range")), True).over(before)).select("file", "range", "state", "owner")


def csv_records(spark: SparkSession, path: str, header: bool = True, most_ranges: int = MOST_RANGES) -> DataFrame:
    """One row per record of the CSV files at ``path``, as its text in column ``record``; quoted fields may hold line breaks.

    Fields with quotes, commas or line breaks are quoted and quotes in them doubled. Blank records are left out, and with
    ``header`` the first record of every file. Line breaks inside fields stay as they are. A field whose quote is
    never closed ends with its file. Files without lines give no rows.
    """
    lines = _lines(spark, path)
    states = written(range_states(lines), "csv-ranges")
    if states.count() <= most_ranges:
        stated = lines.join(F.broadcast(states), ["file", "range"], "left")
    else:
        stated = lines.withColumn("at", F.monotonically_increasing_id()).join(states, ["file", "range"], "left")
        stated = stated.repartition("file", "range").sortWithinPartitions("file", "range", "at")
    # Both passes must see the same ranges. Where a table is so small that Spark cuts it by the number of cores and that
    # number changes in between, the job fails instead of losing records.
    moved = F.raise_error(F.lit("the files were split in another way between two passes; read them again"))
    stated = stated.select(
        "file", "range", "line", F.coalesce("state", moved.cast("boolean")).alias("state"), "owner", F.lit(-1).cast("long").alias("number")
    )
    kind = "file long, range long, number long, place long, record string"
    whole = stated.mapInArrow(_cut(False), kind).select("file", "range", "number", "record")
    # The last record that starts in a range is the only one that can go on in the next: its tail has the largest number.
    parts = stated.mapInArrow(_cut(True), kind).groupBy("file", "range").agg(
        F.max("number").alias("number"), F.sort_array(F.collect_list(F.struct("place", "number", "record"))).alias("parts")
    )
    parts = parts.withColumn("number", F.when(F.col("number") < 0, moved.cast("long")).otherwise(F.col("number")))
    joined = parts.select("file", "range", "number", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    records = whole.unionByName(joined)
    if header:
        records = records.where("NOT (range = 0 AND number = 0)")
    return records.select(F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''")


def read_multiline_csv(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False, header: bool = True) -> DataFrame:
    """As ``read_typed_csv(..., multi_line=True)``, with every file read by as many tasks as it has byte ranges.

    Records that do not fit the schema fail the job when ``strict``, otherwise they are dropped whole.
    """
    records = csv_records(spark, path, header)
    marked = schema if strict else T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST" if strict else "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.fields)
    rows = records.select(F.from_csv("record", ddl, options).alias("row"))
    if strict:
        return rows.select("row.*")
    return rows.where(F.col(f"row.{BAD_RECORD}").isNull()).select(*[F.col(f"row.`{f.name}`") for f in schema.fields])
