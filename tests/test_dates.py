"""Dates whose fields roll over."""

import datetime
import random

from pyspark.sql import functions as F

from tallyloom.functions.dates import lenient_date


def plain(year, month, day):
    year, month = divmod(year * 12 + month - 1, 12)
    return datetime.date(year, month + 1, 1) + datetime.timedelta(days=day - 1)


def dates(spark, texts):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, s string")
    return [r.d for r in frame.select("i", lenient_date(F.col("s")).alias("d")).orderBy("i").collect()]


def test_fields_roll_over(spark):
    day = datetime.date
    cases = {
        "2019-13-45": day(2020, 2, 14), "2019-01-00": day(2018, 12, 31), "2020-02-30": day(2020, 3, 1), "2019-00-10": day(2018, 12, 10),
        "2019-1-5": day(2019, 1, 5), " 2019- 3-\t7 and more": day(2019, 3, 7), "2019-03-07T10:00": day(2019, 3, 7),
        "2019-03-400": day(2020, 4, 3), "2021-24-31": day(2022, 12, 31),
        "2019/03/07": None, "2019-03": None, "": None, "x2019-03-07": None, "99999-01-01": None, "0-01-01": None, "2019-1234567-01": None,
    }
    assert dates(spark, [*cases, None]) == [*cases.values(), None]


def test_random_fields(spark):
    r = random.Random(2)
    fields = [(r.randint(1800, 2200), r.randint(0, 60), r.randint(0, 900)) for _ in range(500)]
    assert dates(spark, [f"{y}-{m}-{d}" for y, m, d in fields]) == [plain(*f) for f in fields]
