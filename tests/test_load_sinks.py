"""S5, S9, J5, K1-K8, T1."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import bars
from marketlens.operators import incremental
from marketlens.sinks import tables
from marketlens.streaming import new_bars as stream


def _history(spark):
    return bars(spark, [("A", "2024-01-08", 1.0), ("A", "2024-01-09", 2.0),
                        ("B", "2024-01-08", 5.0)])


def test_last_update_per_ticker(spark):
    # Every ticker keeps its own watermark, as a date
    out = {r.ticker: r.last_date for r in incremental.last_update(_history(spark)).collect()}
    assert out == {"A": dt.date(2024, 1, 9), "B": dt.date(2024, 1, 8)}


def test_overlap_day_not_duplicated_and_rerun_is_noop(spark):
    # The increment starts at the last stored day; it must not duplicate it
    target = _history(spark)
    incoming = bars(spark, [("A", "2024-01-09", 2.0), ("A", "2024-01-10", 3.0),
                            ("B", "2024-01-08", 5.0), ("C", "2024-01-10", 7.0),
                            ("A", "2024-01-05", 9.0)])
    once = incremental.append_new_bars(target, incoming)
    assert once.count() == 6  # the late day of A included
    assert once.groupBy("ticker", "date").count().where("count > 1").count() == 0
    twice = incremental.append_new_bars(once, incoming)
    assert twice.count() == 6


def test_end_bound(spark):
    new = incremental.new_bars(_history(spark),
                               bars(spark, [("A", "2024-01-10", 3.0), ("A", "2024-01-11", 4.0)]),
                               end="2024-01-11")
    assert [str(r.date) for r in new.collect()] == ["2024-01-10"]


def test_write_modes(spark, scratch):
    df = _history(spark)
    path = f"{scratch}/t"
    tables.write_table(df, path, "replace", partition_by=["ticker"])
    tables.write_table(df, path, "append", partition_by=["ticker"])
    assert spark.read.parquet(path).count() == 6
    tables.write_table(df, path, "replace", partition_by=["ticker"])
    assert spark.read.parquet(path).count() == 3
    try:
        tables.write_table(df, path, "fail")
        raise AssertionError("expected failure")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e).lower() or "PATH_ALREADY_EXISTS" in str(e)


def test_column_ddl(spark):
    df = spark.createDataFrame([("abc", 1, 2.0), ("abcdef", 2, None)], "s string, i int, x double")
    ddl = tables.create_table_column_types(df)
    assert ddl == "s VARCHAR(6), i INT, x DOUBLE"


def test_full_refresh(spark, scratch):
    df = _history(spark)
    tables.full_refresh({"stock_history": df, "stocks_master": df.select("ticker").distinct()},
                        scratch, {"stock_history": ["ticker"]})
    tables.full_refresh({"stock_history": df}, scratch, {"stock_history": ["ticker"]})
    assert spark.read.parquet(f"{scratch}/stock_history").count() == 3
    assert spark.read.parquet(f"{scratch}/stocks_master").count() == 2


def test_stream_two_runs_with_overlap(spark, scratch):
    landing, target, ck = f"{scratch}/landing", f"{scratch}/target", f"{scratch}/ck"
    bars(spark, [("A", "2024-01-08", 1.0), ("A", "2024-01-09", 2.0)]).write.parquet(
        f"{landing}/batch1")
    stream.load_new_bars(spark, f"{landing}/*", target, checkpoint=ck)
    bars(spark, [("A", "2024-01-09", 2.0), ("A", "2024-01-10", 3.0)]).write.parquet(
        f"{landing}/batch2")
    stream.load_new_bars(spark, f"{landing}/*", target, checkpoint=ck)
    out = spark.read.parquet(target)
    assert out.count() == 3
    assert out.agg(F.countDistinct("ticker", "date")).first()[0] == 3


def test_catalog_table_view_and_scan(spark):
    from marketlens.operators.reports import create_yearly_view
    from marketlens.sources.landing import read_table
    df = _history(spark)
    tables.save_table(df, "stock_history_t", "replace", partition_by=["ticker"])
    hist = read_table(spark, "stock_history_t")
    assert hist.count() == 3
    create_yearly_view(spark, hist, "yearly_stock_t")
    rows = {r.ticker: r for r in spark.sql("SELECT * FROM yearly_stock_t").collect()}
    assert rows["A"].avg_close == 1.5 and rows["A"].year == 2024


def test_stream_late_duplicate_is_not_appended(spark, scratch):
    landing, target, ck = f"{scratch}/landing", f"{scratch}/target", f"{scratch}/ck"
    bars(spark, [("A", "2024-03-01", 1.0), ("A", "2024-03-04", 2.0)]).write.parquet(
        f"{landing}/b1")
    stream.load_new_bars(spark, f"{landing}/*", target, checkpoint=ck)
    # a bar far behind the watermark, already stored, arrives again
    bars(spark, [("A", "2024-03-01", 1.0), ("B", "2024-01-02", 9.0)]).write.parquet(
        f"{landing}/b2")
    stream.load_new_bars(spark, f"{landing}/*", target, checkpoint=ck)
    out = spark.read.parquet(target)
    assert out.groupBy("ticker", "date").count().where("count > 1").count() == 0
    assert out.where("ticker = 'A'").count() == 2
    assert [str(r.date) for r in out.where("ticker = 'B'").collect()] == ["2024-01-02"]


def test_batch_and_stream_store_the_same_rows(spark, scratch):
    first = [("A", "2024-03-01", 1.0), ("A", "2024-03-04", 2.0)]
    second = [("A", "2024-03-04", 2.0), ("A", "2024-03-05", 3.0), ("A", "2024-03-05", 3.0),
              ("B", "2024-01-02", 9.0), ("B", "2024-03-05", 8.0)]
    landing, target, ck = f"{scratch}/landing", f"{scratch}/target", f"{scratch}/ck"
    stored = incremental.append_new_bars(bars(spark, first).limit(0), bars(spark, first))
    stored = incremental.append_new_bars(stored, bars(spark, second))
    for i, rows in enumerate((first, second)):
        bars(spark, rows).coalesce(1).write.csv(f"{landing}/b{i}")
        stream.load_new_bars(spark, f"{landing}/*", target, fmt="csv", checkpoint=ck)
    key = lambda df: sorted((r.ticker, str(r.date), r.close) for r in df.collect())
    assert key(spark.read.parquet(target)) == key(stored)
    assert ("B", "2024-01-02", 9.0) in key(stored) and len(key(stored)) == 5


def test_overlapping_files_give_one_bar_per_day(spark, scratch):
    import time
    from marketlens.sources.landing import read_bars
    bars(spark, [("A", "2024-03-01", 1.0), ("A", "2024-03-04", 2.0)]).coalesce(1).write.parquet(f"{scratch}/l/b1")
    time.sleep(1.1)
    bars(spark, [("A", "2024-03-04", 2.5)]).coalesce(1).write.parquet(f"{scratch}/l/b2")
    got = {str(r.date): r.close for r in read_bars(spark, f"{scratch}/l/*").collect()}
    assert got == {"2024-03-01": 1.0, "2024-03-04": 2.5}


def test_tables_not_loaded_again_end_up_empty(spark, scratch):
    df = _history(spark)
    tables.full_refresh({"a": df, "b": df}, scratch)
    tables.full_refresh({"a": df}, scratch, drop={"b": df.schema})
    assert spark.read.parquet(f"{scratch}/b").count() == 0 and spark.read.parquet(f"{scratch}/a").count() == 3


def test_empty_and_dotted_columns_get_a_type(spark):
    df = spark.createDataFrame([("",)], "`a.b` string")
    assert tables.create_table_column_types(df) == "a.b VARCHAR(1)"


def test_a_cluster_session_needs_a_shared_folder():
    from types import SimpleNamespace
    import pytest
    from marketlens.session import ensure_checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(
        master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)

def test_full_and_incremental_loads_share_one_schema(spark, scratch):
    # Both paths go through the same normaliser, so schemas are equal
    from marketlens.api import LandingPaths, MarketETL
    raw = spark.createDataFrame(
        [("2024-01-08", "1", "2", "0.5", "1.5", "100", "0", "IAG.L", "extra")],
        "Date string, Open string, High string, Low string, Close string, Volume string, "
        "Dividends string, Stock string, Comment string")
    raw.write.parquet(f"{scratch}/landing")
    etl = MarketETL(spark, LandingPaths(f"{scratch}/landing", f"{scratch}/cur", []))
    full = etl.history()
    inc = incremental.new_bars(full.limit(0), etl.history())
    assert full.schema == inc.schema
    assert full.columns == ["ticker", "date", "open", "high", "low", "close", "volume", "dividends"]


def _rows(df):
    return sorted((r.ticker, str(r.date), r.close) for r in df.collect())


def _land(spark, folder, rows):
    """A landing file that is written later than the ones before it."""
    import time
    time.sleep(1.1)
    bars(spark, rows).coalesce(1).write.parquet(folder)


def test_a_late_day_is_kept_and_only_the_increments_years_are_read(spark, scratch):
    path = f"{scratch}/t"
    stored = bars(spark, [("A", "2021-03-01", 1.0), ("A", "2023-03-01", 3.0), ("A", "2024-03-05", 5.0)])
    tables.write_table(stored.withColumn("year", F.year("date")), path, "append", ["year"])
    target = stream.stored_bars(spark, path)
    late = bars(spark, [("A", "2024-03-04", 4.0), ("A", "2024-03-05", 5.0), ("A", "2024-03-06", 6.0), ("A", "2021-03-02", 2.0)])
    new = incremental.new_bars(target, late)
    assert _rows(new) == [("A", "2021-03-02", 2.0), ("A", "2024-03-04", 4.0), ("A", "2024-03-06", 6.0)]
    plan = new._jdf.queryExecution().toString()
    filters = plan.split("PartitionFilters: [")[1].split("], ")[0]
    assert "year" in filters and "Subquery" in filters or "subquery" in filters
    assert "number of partitions read: 2" in _metrics(new)


def _metrics(df):
    """The scan metrics of a frame's final plan."""
    df.collect()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            node = node.executedPlan()
        if "QueryStage" in node.nodeName():
            node = node.plan()
        if node.metrics().contains("numPartitions") and "Scan" in node.nodeName():
            out.append(f"number of partitions read: {node.metrics().apply('numPartitions').value()}")
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def test_the_bar_written_last_wins_whatever_its_price(spark, scratch):
    from marketlens.operators.normalize import normalize_bars, with_load_marks
    _land(spark, f"{scratch}/l/1", [("A", "2024-03-04", 11.0)])
    _land(spark, f"{scratch}/l/2", [("A", "2024-03-04", 10.5)])
    raw = normalize_bars(with_load_marks(spark.read.parquet(f"{scratch}/l/*")), keep=["_file_time", "_file"])
    assert _rows(incremental.new_bars(bars(spark, []), raw)) == [("A", "2024-03-04", 10.5)]


def test_three_stream_runs_with_late_and_corrected_days_equal_the_batch_load(spark, scratch):
    from marketlens.api import LandingPaths, MarketETL
    pulls = [[("A", "2024-03-01", 1.0), ("A", "2024-03-05", 2.0), ("B", "2023-03-05", 7.0)],
             [("A", "2024-03-05", 2.0), ("A", "2024-03-04", 1.5), ("A", "2024-03-06", 3.0)],
             [("A", "2024-03-01", 0.5), ("B", "2023-03-05", 7.0), ("B", "2021-01-04", 6.0), ("A", "2024-03-06", 3.5)]]
    want = [("A", "2024-03-01", 0.5), ("A", "2024-03-04", 1.5), ("A", "2024-03-05", 2.0), ("A", "2024-03-06", 3.5),
            ("B", "2021-01-04", 6.0), ("B", "2023-03-05", 7.0)]
    landing, target, ck = f"{scratch}/landing", f"{scratch}/target", f"{scratch}/ck"
    etl = MarketETL(spark, LandingPaths(f"{landing}/*", f"{scratch}/cur", []))
    for i, rows in enumerate(pulls):
        _land(spark, f"{landing}/b{i}", rows)
        stream.load_new_bars(spark, f"{landing}/*", target, checkpoint=ck)
        etl.update_history(f"{scratch}/batch")
    assert _rows(stream.stored_bars(spark, target)) == want
    assert _rows(etl.stored_history(f"{scratch}/batch")) == want
    assert _rows(etl.history()) == want
    # A run without new files, and a load that is repeated, change nothing.
    stream.load_new_bars(spark, f"{landing}/*", target, checkpoint=ck)
    etl.update_history(f"{scratch}/batch")
    assert _rows(stream.stored_bars(spark, target)) == _rows(etl.stored_history(f"{scratch}/batch")) == want


def test_stream_state_drops_repeats_before_the_target_is_read(spark, scratch):
    landing, ck = f"{scratch}/landing", f"{scratch}/ck"
    seen = []
    for rows in ([("A", "2024-03-01", 1.0)], [("A", "2024-03-01", 1.0), ("A", "2024-03-01", 2.0)]):
        _land(spark, f"{landing}/b{len(seen)}", rows)
        q = (stream.without_repeats(stream.bar_stream(spark, f"{landing}/*")).writeStream
             .foreachBatch(lambda batch, i: seen.append(_rows(batch)))
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()
    assert [s for s in seen if s] == [[("A", "2024-03-01", 1.0)], [("A", "2024-03-01", 2.0)]]


def test_last_dates_come_from_file_statistics(spark, scratch):
    df = bars(spark, [("0700", "2024-03-01", 1.0), ("0700", "2024-03-04", 2.0), ("B", "2020-01-02", 3.0)])
    tables.write_table(df, f"{scratch}/t", "append", ["ticker"])
    got = incremental.last_update_from_files(spark, f"{scratch}/t")
    assert "PushedAggregation: [MAX(date)]" in got._jdf.queryExecution().toString()
    assert sorted(map(tuple, got.collect())) == [("0700", dt.date(2024, 3, 4)), ("B", dt.date(2020, 1, 2))]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_a_refresh_that_fails_leaves_the_old_set_whole(spark, scratch):
    import pytest
    old = {n: bars(spark, [("old", "2024-01-08", 1.0)]) for n in ("a", "b", "c", "d")}
    tables.publish(old, scratch)
    new = {n: bars(spark, [("new", "2024-01-09", 2.0)]) for n in old}
    new["c"] = new["c"].withColumn("close", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        tables.publish(new, scratch)
    for n in old:
        assert _rows(tables.read_published(spark, scratch, n)) == [("old", "2024-01-08", 1.0)]
    new["c"] = bars(spark, [("new", "2024-01-09", 2.0)])
    tables.publish(new, scratch)
    assert {_rows(tables.read_published(spark, scratch, n))[0][0] for n in old} == {"new"}
    # A set of other tables, and tables that are not loaded again.
    tables.publish({"e": old["a"]}, scratch, drop={"d": old["d"].schema})
    assert _rows(tables.read_published(spark, scratch, "a"))[0][0] == "new"
    assert tables.read_published(spark, scratch, "d").count() == 0
    assert tables.current_path(spark, scratch, "x") is None
    with pytest.raises(ValueError):
        tables.read_published(spark, scratch, "x")


def test_an_update_needs_no_earlier_refresh(spark, scratch):
    from marketlens.api import LandingPaths, MarketETL
    _land(spark, f"{scratch}/landing", [("A", "2024-03-01", 1.0)])
    etl = MarketETL(spark, LandingPaths(f"{scratch}/landing", f"{scratch}/cur", []))
    etl.update_history(f"{scratch}/db")
    assert _rows(etl.stored_history(f"{scratch}/db")) == [("A", "2024-03-01", 1.0)]
