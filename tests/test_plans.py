"""Physical-plan checks: pushdown, pruning, shared exchanges, no cross joins."""

from conftest import SF_SMALL
from marketlens.plans import queries as Q
from marketlens.operators import series

FORECASTS = ("forecast", "forecast_grid_best", "forecast_frame")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_column_pruning_reaches_scan(spark):
    p = _plan(Q.q_last_update(spark, SF_SMALL))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "l_comment" not in scan and "l_tax" not in scan and "l_discount" not in scan


def test_one_exchange_for_returns_and_rolling(spark):
    for master in (Q.dense_master, Q.wide_master):
        m = master(spark, SF_SMALL).select("ticker", "date", "close", "converted_close")
        df = series.rolling_means(series.daily_returns(m), "converted_close")
        lines = _plan(df).splitlines()
        wins = [i for i, line in enumerate(lines) if "Window [" in line]
        assert len(wins) >= 4
        between = lines[wins[0]:wins[-1] + 1]
        assert not any("Exchange" in line for line in between)
        below = lines[wins[-1]:]
        assert sum("Exchange hashpartitioning(ticker" in line for line in below) <= 2


def test_no_cartesian_or_nested_loop(spark):
    for name, fn in Q.QUERIES.items():
        if name in (*FORECASTS, "stream_loads"):
            continue
        p = _plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name


def test_weekday_filter_pushed_below_joins(spark):
    p = Q.dense_master(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    # the weekday predicate appears below the FX join, next to the order scan
    assert p.count("weekday(") >= 2


def test_python_only_in_the_forecaster(spark):
    for name, fn in Q.QUERIES.items():
        if name == "stream_loads":
            continue
        p = _plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        has_group_map = "FlatMapGroupsInPandas" in p
        assert has_group_map == (name in FORECASTS), name


def _line_scans(df) -> int:
    return sum("lineitem.parquet" in line for line in _plan(df).splitlines() if "FileScan parquet" in line)


def test_fact_table_is_scanned_once(spark):
    assert _line_scans(Q.q_enriched_prices(spark, SF_SMALL)) == 1
    assert _line_scans(Q.q_quality_report(spark, SF_SMALL)) <= 2


def test_colocated_tables_need_no_exchange_after_the_scan(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as if both sides were large
    try:
        df = Q.q_colocated_series(spark, SF_SMALL)
        plan = _plan(df)
        assert df.count() > 0
    finally:
        spark.conf.set(key, before)
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2 and "SortMergeJoin" in plan


def test_forecast_calendar_reads_the_lines_once(spark):
    assert _line_scans(Q.q_future_calendar(spark, SF_SMALL)) <= 2
    assert "LocalTableScan" in _plan(Q.q_future_calendar(spark, SF_SMALL))
