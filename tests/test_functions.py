import datetime as dt

import pandas as pd
import pytest
from helpers import OFFSETS
from pyspark.sql import functions as F

from loomcast.functions.metrics import mape, rmse, smape
from loomcast.functions.missing import coerce_number, is_missing, nan_to_null
from loomcast.functions.steps import add_steps, clock, from_clock, step_index, to_step


def _days(spark):
    days = pd.date_range("2019-12-01", "2024-03-05")
    return days, spark.createDataFrame([(d.date(),) for d in days], "ds date")


@pytest.mark.parametrize("freq", ["D", "W", "M"])
@pytest.mark.parametrize("n", [1, 3, 12, -2])
def test_steps_match_calendar_offsets(spark, freq, n):
    days, df = _days(spark)
    got = df.select("ds", add_steps(F.col("ds"), n, freq).alias("to")).toPandas()
    expected = [(d + OFFSETS[freq](n)).date() for d in days]
    assert dict(zip(got["ds"], got["to"])) == dict(zip((d.date() for d in days), expected))


def test_month_steps(spark):
    rows = [(dt.date(2024, 1, 15),), (dt.date(2024, 1, 31),), (dt.date(2024, 2, 29),)]
    got = spark.createDataFrame(rows, "ds date").select(add_steps(F.col("ds"), 1, "M"))
    assert [r[0] for r in got.collect()] == [
        dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 31)
    ]


def test_hours_cross_days_and_keep_no_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 31, 1, 59, 59, 5),)], "ts timestamp_ntz")
    hour = to_step(F.col("ts"), "H")
    got = df.select(
        hour, add_steps(hour, 25, "H"), from_clock(clock(hour, "H"), "H"),
        step_index(add_steps(hour, -30, "H"), hour, "H"),
    ).first()
    assert list(got) == [
        dt.datetime(2024, 3, 31, 1), dt.datetime(2024, 4, 1, 2), dt.datetime(2024, 3, 31, 1), -30
    ]


def test_weeks_round_down(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 9), dt.date(2024, 1, 10))], "ds date, anchor date")
    assert df.select(step_index(F.col("ds"), F.col("anchor"), "W")).first()[0] == -1


def test_missing_values(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert df.where(is_missing(F.col("v"))).count() == 2
    assert df.agg(F.count(nan_to_null(F.col("v"))), F.avg(nan_to_null(F.col("v")))).first()[:] == (1, 1)
    text = spark.createDataFrame([("2.5",), ("x",)], "v string")
    assert [r[0] for r in text.select(coerce_number(F.col("v"))).collect()] == [2.5, None]


def test_metrics(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 1.0)], "y double, p double")
    args = F.col("y"), F.col("p"), F.lit(1)
    assert df.agg(smape(*args)).first()[0] == pytest.approx(0.8888888888888888)
    assert df.agg(rmse(*args)).first()[0] == pytest.approx((2 / 3) ** 0.5)
    assert df.agg(mape(*args)).first()[0] == pytest.approx(0.5)
    weighted = F.col("y"), F.col("p"), F.col("y") + 1
    assert df.agg(smape(*weighted)).first()[0] == pytest.approx((2 * 2 + 3 * 2 / 3) / 6)
