"""Multi-line CSV cut into byte ranges against one task that reads the whole file."""

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from tallyloom.sources import readers, records

SCHEMA = T.StructType([T.StructField(c, k) for c, k in (("id", T.LongType()), ("text", T.StringType()), ("more", T.StringType()))])


@pytest.fixture
def small_ranges(spark):
    """Text files are split every 2,000 bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def made(n, seed, longest):
    rng = random.Random(seed)

    def text():
        return "".join(rng.choice(['"', '""', ",", "\n", "\n\n", "a", "bc ", " ", "é", '",\n"']) for _ in range(rng.randint(1, longest))) + "."

    return [(i, text(), text()) for i in range(n)]


def as_csv(rows, end="\n"):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["id", "text", "more"])
    writer.writerows(rows)
    return out.getvalue()


def plain_state(text):
    """Whether a quoted field is open at the end, by single characters."""
    state = "start"
    for c in text:
        if state == "quoted":
            state = "closing" if c == '"' else state
        elif c == '"' and state in ("start", "closing"):
            state = "quoted"
        else:
            state = "start" if c in ",\n" else "plain"
    return state == "quoted"


def test_effect_of_a_line():
    rng = random.Random(3)
    for _ in range(20_000):
        line = "".join(rng.choice('"",ab ') for _ in range(rng.randint(0, 12)))
        assert records.line_effect(line)[0] == plain_state(line), line
        assert records.line_effect(line)[1] == plain_state('"' + line), line


@pytest.mark.parametrize("longest", [5, 60, 3_000])
@pytest.mark.parametrize("most_ranges", [records.MOST_RANGES, 0])
def test_ranges_equal_one_task(spark, tmp_path, small_ranges, longest, most_ranges, monkeypatch):
    monkeypatch.setattr(records.csv_records, "__defaults__", (True, most_ranges))
    rows = made(8_000 // longest + 5, longest, longest)
    for i, part in enumerate((rows[::2], rows[1::2])):
        (tmp_path / f"{i}.csv").write_text(as_csv(part), encoding="utf-8", newline="")
    path = str(tmp_path)
    assert records._lines(spark, path).rdd.getNumPartitions() > 4
    got = [tuple(r) for r in records.read_multiline_csv(spark, path, SCHEMA, strict=True).collect()]
    assert sorted(got) == rows
    one_task = readers.read_typed_csv(spark, path, SCHEMA, multi_line=True)
    assert sorted(tuple(r) for r in one_task.collect()) == rows


def test_record_over_many_ranges_line_ends_and_open_quote(spark, tmp_path, small_ranges):
    rows = [(1, "x\n" * 10_000, "a"), (2, 'says "no"', "b"), (3, "c", "d,e")]
    (tmp_path / "a.csv").write_text(as_csv(rows, "\r\n") + '\r\n4,5" wide,f\r\n5,"never closed\r\n6,g', newline="")
    got = [tuple(r) for r in records.csv_records(spark, str(tmp_path)).collect()]
    assert sorted(len(r[0]) for r in got)[-1] > 20_000 and len(got) == 5
    fitting = sorted(tuple(r) for r in records.read_multiline_csv(spark, str(tmp_path), SCHEMA).collect())
    assert fitting[:4] == [*rows, (4, '5" wide', "f")]


def test_records_that_do_not_fit_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,more\n1,"a\nb",c\nx,d,e\n2,f\n3,g,h\n')
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text("id,text,more\n")
    got = records.read_multiline_csv(spark, str(tmp_path), SCHEMA)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a\nb", "c"), (3, "g", "h")] and got.count() == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        records.read_multiline_csv(spark, str(tmp_path), SCHEMA, strict=True).collect()


def test_other_ranges_fail_instead_of_losing_records(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text(as_csv(made(200, 1, 40)), encoding="utf-8", newline="")
    frame = records.csv_records(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    with pytest.raises(Exception, match="split in another way"):
        frame.collect()
