"""Physical-plan properties: JVM-only expressions, pruning, pushdown, shuffles."""

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL


def plan(df):
    df.collect()  # run on this Dataset so that its adaptive plan is final
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def feeds(spark):
    return E._Feeds(spark, SF_SMALL)


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_no_python_udf_and_no_cartesian(feeds, name):
    p = plan(E.QUERIES[name](feeds))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


def test_historical_marts_prune_other_feeds(feeds):
    for name in ("city_rankings", "temporal_patterns", "monthly_city_stats"):
        p = plan(E.QUERIES[name](feeds))
        assert "orders.parquet" in p and "events.parquet" not in p, name


def test_scan_pushdown_and_pruning(feeds):
    p = plan(feeds.stg_current())
    assert "PushedFilters: [In(event_type" in p.replace("PushedFilters: [IsNotNull(event_type), In(event_type", "PushedFilters: [In(event_type")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p
    assert "props" not in p.split("ReadSchema")[1].split("\n")[0]


def test_temporal_mart_scans_history_once(feeds):
    p = plan(E.QUERIES["temporal_patterns"](feeds)).split("== Initial Plan ==")[0]
    assert p.count("orders.parquet") == 1 and "Join" not in p.replace("BroadcastHashJoin", "")
    assert "Expand" in p


def test_rank_windows_share_partitioning(feeds):
    p = plan(E.QUERIES["city_rankings"](feeds))
    window_part = p[: p.index("HashAggregate")] if "HashAggregate" in p else p
    assert window_part.count("Exchange hashpartitioning") == 1, window_part


def test_newest_rows_of_a_written_mart_read_the_needed_days_once(spark, feeds):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    df = E.QUERIES["newest_daily_top"](feeds)
    p = plan(df).split("== Initial Plan ==")[0]
    assert p.count("FileScan") == 1 and "TakeOrderedAndProject" in p
    days = {f.split("measurement_date=")[1].split("/")[0] for f in df.inputFiles()}
    rows = [str(r.measurement_date) for r in df.collect()]
    assert days == set(rows) and len(rows) == E.NEWEST and before is not None


def test_forecast_scoring_stages_each_feed_once(feeds):
    for name in ("forecast_accuracy", "forecast_pair_stats"):
        p = plan(E.QUERIES[name](feeds)).split("== Initial Plan ==")[0]
        assert p.count("events.parquet") == 2, name  # the forecasts and the actual readings
        assert "ReusedExchange" in p
