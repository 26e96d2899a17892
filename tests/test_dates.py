"""Calendar helpers (FIXTURES.md section 3.4)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline import config as C
from ledgerline.functions.dates import month_start, qtr_locking_date, renewal_locking_date
from ledgerline.plans.health import renewal_window


def test_quarter_lock(spark):
    days = [dt.datetime(1997, 3, 31), dt.datetime(1997, 4, 1), dt.datetime(1997, 9, 30), dt.datetime(1997, 12, 31), None]
    df = spark.createDataFrame([(d,) for d in days], "d timestamp_ntz")
    got = [r.x for r in df.select(qtr_locking_date("d").alias("x")).collect()]
    assert got == [dt.date(1997, 5, 15), dt.date(1997, 8, 15), dt.date(1997, 11, 15), dt.date(1998, 2, 15), None]


def test_renewal_lock_keeps_time_of_day(spark):
    rows = [(dt.datetime(1997, 2, 10), dt.datetime(1997, 5, 15, 0, 0)),
            (dt.datetime(1997, 2, 10), dt.datetime(1997, 5, 15, 10, 0))]
    df = spark.createDataFrame(rows, "prev timestamp_ntz, booked timestamp_ntz")
    got = [r.x for r in df.select(renewal_locking_date("prev", "booked").alias("x")).collect()]
    assert got == [dt.date(1997, 5, 15), None]


def test_renewal_window():
    assert renewal_window(C.Period.year(1997)) == (dt.date(1996, 11, 1), dt.date(1998, 2, 16))


def test_month_start(spark):
    df = spark.createDataFrame([(dt.datetime(1997, 3, 31, 23, 59),)], "d timestamp_ntz")
    assert df.select(month_start("d").alias("m")).first().m == dt.date(1997, 3, 1)


def test_early_guard_months_keep_time(spark):
    # prior end 1997-05-31: booking 1997-02-28 is kept (end - 3 months clamps to 02-28), 02-27 dropped
    df = spark.createDataFrame([(dt.datetime(1997, 5, 31), dt.datetime(1997, 2, 28)),
                                (dt.datetime(1997, 5, 31), dt.datetime(1997, 2, 27))], "e timestamp_ntz, b timestamp_ntz")
    got = [r.ok for r in df.select((F.col("b") >= F.col("e") - F.expr("INTERVAL 3 MONTHS")).alias("ok")).collect()]
    assert got == [True, False]
