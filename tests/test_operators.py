import datetime as dt

import pandas as pd
import pytest
from helpers import EPOCH, config, daily, sales
from pyspark.sql import functions as F

from loomcast.operators.keys import null_safe_join, series_rows, with_series_key
from loomcast.operators.quality import (
    kept_rows,
    removed_series,
    require_survivors,
    series_profile,
)
from loomcast.operators.steps import resample_spine
from loomcast.operators.windows import (
    backtest_cutoffs,
    running_windows,
    training_windows,
)
from loomcast.operators.steps import fold_steps, series_steps
from loomcast.sources.tables import preview, quote_name, read_source


def test_series_key_skips_nulls(spark):
    df = spark.createDataFrame([(1, 2), (None, 3), (None, None)], "store_nbr int, item_nbr int")
    keyed = with_series_key(df, "store_nbr", "item_nbr", "group_id")
    assert [r.group_id for r in keyed.collect()] == ["1_2", "3", ""]
    with pytest.raises(ValueError, match="item"):
        with_series_key(df, "store_nbr", "item", "group_id")


def test_strict_keys_keep_colliding_series_apart(spark):
    rows = [("1_2", "3", EPOCH, 1.0), ("1", "2_3", EPOCH, 2.0), (None, "3", EPOCH, 3.0)]
    df = spark.createDataFrame(rows, "store_nbr string, item_nbr string, date date, unit_sales double")
    for strict, expected in ((False, 2), (True, 3)):
        cfg = config(strict_keys=strict)
        assert series_profile(series_rows(df, cfg), cfg.keys).count() == expected


def test_null_safe_join_matches_null_keys(spark):
    left = spark.createDataFrame([("3", None, "3", 1)], "g string, a string, b string, k int")
    right = spark.createDataFrame([("3", None, "3", 1, "v")], "g string, a string, b string, k int, v string")
    joined = null_safe_join(left, right, ["g", "a", "b"], ["k"])
    assert joined.columns == ["g", "a", "b", "k", "v"] and joined.count() == 1


def test_missing_ratio_is_strict(spark):
    values = lambda missing: [None] * missing + [1.0] * (10 - missing)
    df = sales(spark, daily(1, 1, values(2)) + daily(1, 2, values(3)))
    cfg = config()
    rows = series_rows(df, cfg)
    profile = series_profile(rows, cfg.keys)
    assert [r.group_id for r in removed_series(profile, cfg.keys, 0.2).collect()] == ["1_2"]
    kept = kept_rows(rows, cfg.keys, 0.2)
    assert {r.group_id for r in kept.collect()} == {"1_1"} and kept.count() == 10


def test_nan_counts_as_missing(spark):
    df = sales(spark, daily(1, 1, [1.0, float("nan"), None]))
    cfg = config()
    profile = series_profile(series_rows(df, cfg), cfg.keys).first()
    assert (profile.n_rows, profile.n_missing) == (3, 2)


def test_no_survivors_raises(spark):
    cfg = config()
    rows = series_rows(sales(spark, daily(1, 1, [None] * 5)), cfg)
    with pytest.raises(ValueError, match="no series"):
        require_survivors(series_profile(rows, cfg.keys), 0.2)


def test_kept_rows_of_one_large_series(spark):
    """A third of all rows in one series: every row survives, none twice."""
    hot = spark.range(3000).selectExpr(
        "1 store_nbr", "1 item_nbr", "date'2024-01-01' + cast(id % 30 as int) date",
        "cast(id % 50 as double) unit_sales",
    )
    cold = spark.range(6000).selectExpr(
        "2 store_nbr", "cast(id % 60 as int) item_nbr", "date'2024-01-01' date",
        "case when id % 120 < 60 then null else 1D end unit_sales",
    )
    cfg = config()
    rows = series_rows(hot.unionByName(cold), cfg)
    assert kept_rows(rows, cfg.keys, 0.2).groupBy("group_id").count().collect()[0][:] == ("1_1", 3000)


@pytest.mark.parametrize("freq", ["D", "W", "M", "H"])
def test_resample_fills_every_step(spark, freq):
    stamps = {
        "D": ["2024-02-27", "2024-03-02"], "W": ["2024-01-02", "2024-01-23"],
        "M": ["2024-01-15", "2024-04-30"], "H": ["2024-01-01 22:10", "2024-01-02 01:50"],
    }[freq]
    spine = {
        "D": pd.date_range("2024-02-27", "2024-03-02"),
        "W": pd.date_range("2024-01-02", "2024-01-23", freq="7D"),
        "M": pd.to_datetime(["2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30"]),
        "H": pd.date_range("2024-01-01 22:00", "2024-01-02 01:00", freq="h"),
    }[freq]
    rows = [(1, 1, pd.Timestamp(s).to_pydatetime(), 2.0) for s in [*stamps, stamps[1]]]
    cfg = config(freq=freq)
    got = resample_spine(series_rows(sales(spark, rows), cfg), cfg).orderBy("ds").toPandas()
    assert list(pd.to_datetime(got["ds"])) == list(spine)
    assert got["y"].fillna(-1).tolist() == [2.0] + [-1.0] * (len(spine) - 2) + [4.0]


def test_resample_keeps_bounds_through_gaps(spark):
    rows = [(1, 1, EPOCH, 1.0, 9.0, 1.0), (1, 1, EPOCH + dt.timedelta(days=2), 2.0, 8.0, 0.0)]
    cfg = config()
    df = series_rows(sales(spark, rows, "cap double, promo double"), cfg, ["cap", "promo"])
    got = resample_spine(df, cfg).orderBy("ds").select("y", "cap", "promo").collect()
    assert [tuple(r) for r in got] == [(1.0, 9.0, 1.0), (None, 9.0, None), (2.0, 8.0, 0.0)]


def test_configured_windows_are_four(spark):
    cfg = config()
    rows = series_rows(sales(spark, daily(1, 1, [1.0] * 40)), cfg)
    got = [r.cutoff for r in backtest_cutoffs(rows, cfg).orderBy("cutoff").collect()]
    first = EPOCH + dt.timedelta(days=39 - 29)
    assert got == [first + dt.timedelta(days=7 * k) for k in range(4)]


@pytest.mark.parametrize("stride,length", [(1, 7), (7, 7), (3, 5), (10, 4)])
def test_running_sums_match_range_join(spark, stride, length):
    import random

    pick = random.Random(stride)
    data = []
    for item in range(4):
        for row in daily(1, item, [float(i) for i in range(60)]):
            data += [row] * pick.choice([0, 1, 1, 2])
    cfg = config(stride=stride, prediction_length=length)
    rows = series_rows(sales(spark, data), cfg)
    steps = fold_steps(rows, cfg.keys)
    joined = training_windows(steps, backtest_cutoffs(rows, cfg), cfg).groupBy(
        "group_id", "cutoff"
    ).agg(F.sum("sum_y").alias("sy"), F.max("ds").alias("last_train"))
    expected = {(r.group_id, r.cutoff): (r.sy, r.last_train) for r in joined.collect()}
    running = running_windows(series_steps(rows, cfg), cfg, {"sy": F.col("sum_y")}).collect()
    assert running
    for r in running:
        assert (r.sy, r.last_train) == expected[r.group_id, r.cutoff]


def test_quote_name():
    assert quote_name("a-b.c.d") == "`a-b`.`c`.`d`"
    assert quote_name("`a-b`.c") == "`a-b`.c"
    assert quote_name("t") == "`t`"


def test_sources(spark, tmp_path):
    df = spark.range(3)
    df.createOrReplaceTempView("three_rows")
    df.write.parquet(str(tmp_path / "three"))
    assert read_source(spark, df) is df
    assert read_source(spark, "three_rows").count() == 3
    assert read_source(spark, str(tmp_path / "three")).count() == 3
    assert [r.id for r in preview(df, 2, ("id",)).collect()] == [0, 1]
    with pytest.raises(ValueError):
        read_source(spark, None)
