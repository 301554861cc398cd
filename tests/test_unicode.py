"""NFKC inside the JVM against ``unicodedata``."""

import random
import sys
import unicodedata

from pyspark.sql import functions as F

from tallyloom.functions.unicode import nfkc

POINTS = [p for p in range(sys.maxunicode + 1) if not 0xD800 <= p < 0xE000]


def wrong(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, s string").repartition(16)
    found = rows.select("s", nfkc(F.col("s")).alias("n")).collect()
    assert len(found) == len(texts)
    return [ascii(r.s) for r in found if r.n != (None if r.s is None else unicodedata.normalize("NFKC", r.s))]


def test_every_code_point(spark):
    assert wrong(spark, [chr(p) for p in POINTS]) == []


def test_random_texts(spark):
    rng = random.Random(5)
    reactive = [p for p in POINTS if unicodedata.combining(chr(p)) or (p < 0xAC00 and unicodedata.normalize("NFKD", chr(p)) != chr(p))]
    korean = [0x1100, 0x1112, 0x1161, 0x1175, 0x11A7, 0x11A8, 0x11C2, 0xAC00, 0xAC01, 0xD788]
    pools = [reactive, POINTS, korean, [ord(c) for c in "aeioucn"], [0x300, 0x301, 0x302, 0x323, 0x327, 0x345]]
    texts = ["".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randint(0, 25))) for _ in range(20_000)]
    assert wrong(spark, texts) == []


def test_null_empty_and_long_texts(spark):
    assert wrong(spark, [None, "", "plain " * 50_000, "ệ ﬁ" * 20_000, "a" + "̣́" * 500, "́x"]) == []


def test_no_python_worker(spark):
    frame = spark.range(3).select(nfkc(F.col("id").cast("string")).alias("n"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
