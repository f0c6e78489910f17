"""Physical plans: how often the data moves and what is read."""

import re

import pytest
from helpers import config

from loomcast import backtest, forecast


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sales") / "t")
    spark.range(2000).selectExpr(
        "id % 7 store_nbr", "id % 3 item_nbr", "date'2024-01-01' + cast(id / 21 as int) date",
        "cast(id as double) unit_sales", "'x' unused", "id other",
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


def exchanges(text):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


@pytest.mark.parametrize("models,history,few,expected", [
    (("LinearTrend",), False, False, 1),
    (("LinearTrend",), True, False, 2),
    (("LinearTrend",), True, True, 1),
    (("SeasonalNaive",), True, True, 1),
    (("Decomposable",), True, False, 2),
    (("Decomposable",), True, True, 1),
    (("Decomposable", "second"), True, True, 1),
])
def test_forecast_exchanges(table, capsys, models, history, few, expected):
    cfg = config(
        active_models=models, include_history=history, few_rows_per_step=few,
        models={"LinearTrend": {}, "SeasonalNaive": {}, "Decomposable": {}, "second": {"kind": "Decomposable"}},
    )
    text = plan(forecast(table, cfg), capsys)
    assert len(exchanges(text)) == expected
    assert text.count("FlatMapGroupsInPandas") <= 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "unused" not in text and "other" not in text


def test_native_models_share_one_shuffle(table, spark):
    names = ("LinearTrend", "SeasonalNaive", "WeekdayProfile")
    for few, moved, history in ((False, 2, True), (True, 1, True), (False, 2, False), (True, 1, False)):
        used = (*names, "Decomposable") if few else names
        cfg = config(active_models=used, few_rows_per_step=few, include_history=history)
        df = forecast(table, cfg)
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        made = [m for m in re.findall(r"(Reused)?Exchange.*hashpartitioning", text)]
        assert made.count("") == moved and text.count("FileScan") == 1


def test_resampling_folds_where_the_spine_lies(table, capsys):
    text = plan(forecast(table, config(resample=True, few_rows_per_step=True)), capsys)
    assert len(exchanges(text)) == 2


def test_backtest_needs_one_exchange_of_rows(table, capsys):
    text = plan(backtest(table, config(few_rows_per_step=True)), capsys)
    assert len(exchanges(text)) == 1 and text.count("FileScan") == 1
    assert "Join" not in text


def test_backtest_joins_rows_on_series_and_date(table, capsys, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(backtest(table, config()), capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin \[group_id#\d+, ds#\d+\]", text)
    assert "unused" not in text


def test_scoring_moves_only_tested_dates(spark, tmp_path):
    """400 dates, of which 30 are tested; each date has 20 rows per series."""
    spark.range(16000).selectExpr(
        "1 store_nbr", "id % 2 item_nbr", "date'2024-01-01' + cast(id / 40 as int) date",
        "cast(id as double) unit_sales",
    ).write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = backtest(spark.read.parquet(str(tmp_path / "t")), config())
        assert df.where("status = 'ok'").count() == 8
        df.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    node = df._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in node and "FileScan" in node
    moved = _records(df._jdf.queryExecution().executedPlan())
    assert max(moved) <= 1200  # 30 dates of 40 rows; the whole table has 16000


def _records(node):
    """Records each exchange of an executed plan has written."""
    out, todo = [], [node]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "ShuffleExchangeExec":
            out.append(node.metrics().get("shuffleRecordsWritten").get().value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def test_grouped_map_keeps_its_partitions(table, spark):
    cfg = config(active_models=("Decomposable",), series_partitions=13)
    assert forecast(table, cfg).rdd.getNumPartitions() == 13
