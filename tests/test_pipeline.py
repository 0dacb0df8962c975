"""Layered pipeline run (J1, J2) and the incremental refresh, on landed test feeds."""

import os

import pytest

from airshed.plans import pipeline
from airshed.plans.models import Context
from airshed.sinks import landing
from airshed.sources import raw, testdata
from airshed.streaming.refresh import refresh_staged

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    landing.land_historical(testdata.historical_feed(spark, SF_SMALL), root, 788_918_400, 1_009_843_200, chunk_days=366)
    landing.land_current(testdata.current_feed(spark, SF_SMALL), root)
    landing.land_forecast(testdata.forecast_feed(spark, SF_SMALL), root)
    return root


def _ctx(spark, root):
    return Context(spark, [raw.read_historical(spark, root)], raw.read_current(spark, root),
                   raw.read_forecast(spark, root), as_of="2024-01-10")


def test_full_run_stops_at_failing_checks(spark, landed, tmp_path):
    out = str(tmp_path)
    steps = pipeline.run_pipeline(spark, _ctx(spark, landed), out)
    assert [s.name for s in steps][-1] == "tests"
    assert all(s.ok for s in steps[:-1]) and not steps[-1].ok  # the synthetic feed has out-of-range rows
    assert "check_aqi_range" in steps[-1].detail
    fct = raw.read_mart(spark, os.path.join(out, "fct_daily_air_quality_summary"))
    assert fct.count() == 2003  # FIXTURES: daily groups at sf0.001
    staged = spark.table("stg_air_quality_historical").count()
    assert staged == 1479


def test_select_one_layer(spark, landed, tmp_path):
    steps = pipeline.run_pipeline(spark, _ctx(spark, landed), str(tmp_path), select=["staging"])
    assert [s.name for s in steps] == ["stg_air_quality_historical", "stg_air_quality_current", "stg_air_quality_forecast"]
    with pytest.raises(ValueError):
        pipeline._selected(["nope"])


def test_cli_exit_code(landed, tmp_path, spark):
    code = pipeline.main(["--raw", landed, "--out", str(tmp_path), "--select", "staging", "--as-of", "2024-01-10"])
    assert code == 0


def test_incremental_refresh_overwrites_same_day(spark, tmp_path):
    import datetime as dt

    from airshed.sources.schema import RAW

    land, out, ck = (str(tmp_path / n) for n in ("land", "out", "ck"))
    t0 = dt.datetime(2024, 1, 1, 6, tzinfo=dt.timezone.utc)
    t1 = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)
    row = lambda t, d, a: (t, "UK", "London", 1.0, 2.0, d, a, None)
    landing.land_current(spark.createDataFrame([row(t0, 1704088800, 1.0), row(t0, 1704092400, 2.0)], RAW), land)
    refresh_staged(spark, land, "current", out, ck)
    assert spark.read.parquet(out).count() == 2
    landing.land_current(spark.createDataFrame([row(t1, 1704110400, 3.0)], RAW), land)  # same-day rerun
    refresh_staged(spark, land, "current", out, ck)
    got = spark.read.parquet(out).collect()
    assert [r.aqi for r in got] == [3.0]


def test_checkpoint_root_reads_the_session(spark):
    from airshed.session import checkpoint_root, scratch_path

    root = checkpoint_root(spark)
    assert root and checkpoint_root(spark) == root
    assert scratch_path(spark, "x").startswith(root)


def test_keep_incomplete_flags_rows(spark):
    from pyspark.sql import functions as F

    from airshed.operators import daily, staging, unified

    feed = testdata.historical_feed(spark, SF_SMALL)
    st = staging.stage_historical(feed, keep_incomplete=True)
    assert st.count() == feed.count() and st.filter("is_data_quality_issue = 1").count() > 0
    empty = feed.limit(0)
    u = unified.unify(st, staging.stage_current(empty), staging.stage_forecast(empty))
    d = daily.daily_summary(u)
    assert d.filter(F.col("quality_issues") > 0).count() > 0


def test_refresh_restages_whole_days(spark, tmp_path):
    import datetime as dt

    from airshed.sources.schema import RAW

    land, out = str(tmp_path / "land"), str(tmp_path / "out")
    t0 = dt.datetime(2024, 1, 1, 6, tzinfo=dt.timezone.utc)
    t2 = dt.datetime(2024, 1, 2, 6, tzinfo=dt.timezone.utc)
    row = lambda t, c, d: (t, c, "X", 1.0, 2.0, d, 1.0, None)
    landing.land_current(spark.createDataFrame([row(t0, "UK", 1704088800), row(t0, "USA", 1704088800)], RAW), land)
    refresh_staged(spark, land, "current", out)  # checkpoint under the shared checkpoint folder
    landing.land_current(spark.createDataFrame([row(t2, "UK", 1704175200)], RAW), land)  # another day, UK only
    refresh_staged(spark, land, "current", out)
    got = sorted((r.country, str(r.ingest_date)) for r in spark.read.parquet(out).collect())
    assert got == [("UK", "2024-01-01"), ("UK", "2024-01-02"), ("USA", "2024-01-01")]


def test_refresh_lists_inside_the_batch_and_empties_days(spark, tmp_path, monkeypatch):
    import datetime as dt

    from airshed.sources.schema import RAW
    from airshed.streaming import refresh

    land, out, ck = (str(tmp_path / n) for n in ("land", "out", "ck"))
    day = lambda d, h=6: dt.datetime(2024, 1, d, h, tzinfo=dt.timezone.utc)
    row = lambda t, c, a: (t, c, "X", 1.0, 2.0, 1704088800, a, None)
    put = lambda *rows: landing.land_current(spark.createDataFrame(list(rows), RAW), land)
    put(row(day(10), "UK", 1.0), row(day(12), "A/B =c", 1.0))
    read = type(spark).readStream
    monkeypatch.setattr(type(spark), "readStream", property(lambda self: (put(row(day(11), "UK", 2.0)), read.fget(self))[1]))
    refresh_staged(spark, land, "current", out, ck)  # day 11 lands while the stream starts
    monkeypatch.undo()
    staged = lambda: sorted((r.country, r.ingest_date.day, r.aqi) for r in spark.read.parquet(out).collect())
    assert staged() == [("A/B =c", 12, 1.0), ("UK", 10, 1.0), ("UK", 11, 2.0)]
    put(row(day(10, 9), "UK", None), row(day(12, 9), "A/B =c", None))  # reruns without a complete row
    refresh_staged(spark, land, "current", out, ck)
    assert staged() == [("UK", 11, 2.0)]
    assert refresh.STAGERS["current"]


def test_marts_after_a_full_run_read_no_raw_json(spark, landed, tmp_path):
    out = str(tmp_path)
    pipeline.run_pipeline(spark, _ctx(spark, landed), out)
    ctx = _ctx(spark, landed)
    ctx.written = out
    from airshed.plans.models import MODELS

    for m in MODELS.values():
        if m.layer == "marts":
            plan = m.build(ctx)._jdf.queryExecution().executedPlan().toString().lower()
            assert "json" not in plan and "parquet" in plan, m.name
    steps = pipeline.run_pipeline(spark, _ctx(spark, landed), out, select=["marts"])
    assert all(s.ok for s in steps) and len(steps) == 5


def test_tables_built_otherwise_are_not_taken(spark, landed, tmp_path):
    from airshed.plans.models import StaleTable
    from airshed.sinks import commits

    out = str(tmp_path)
    pipeline.run_pipeline(spark, _ctx(spark, landed), out, select=["staging", "intermediate"])
    record = commits.latest(spark, os.path.join(out, "int_air_quality_daily_summary"))[1]
    assert record["fingerprint"]["keep_incomplete"] == "False" and record["fingerprint"]["files of current"]
    for changed in ({"keep_incomplete": True}, {"dedupe": True}, {"fix_night": True}):
        ctx = _ctx(spark, landed)
        ctx.written = out
        for k, v in changed.items():
            setattr(ctx, k, v)
        text = ctx.ref("int_air_quality_daily_summary")._jdf.queryExecution().analyzed().toString().lower()
        assert "json" in text, changed  # built anew, from the feeds
        ctx.frames.clear()
        ctx.refuse_stale = True
        with pytest.raises(StaleTable):
            ctx.ref("int_air_quality_daily_summary")
    same = _ctx(spark, landed)
    same.written, same.refuse_stale, same.as_of = out, True, "2030-01-01"  # the day does not reach this table
    assert "json" not in same.ref("int_air_quality_daily_summary")._jdf.queryExecution().analyzed().toString().lower()


def test_scores_of_today_without_a_day(spark):
    import datetime as dt

    from airshed.operators import forecast, staging
    from airshed.sources.schema import RAW

    today = dt.datetime.now(dt.timezone.utc).replace(hour=12, minute=0, second=0, microsecond=0)
    rows = [(today - dt.timedelta(days=k + 1), "UK", "X", 1.0, 2.0, int((today - dt.timedelta(days=k)).timestamp()), 40.0 + k, None) for k in (-1, 0, 1)]
    feed = spark.createDataFrame(rows, RAW)
    got = forecast.forecast_accuracy(staging.stage_forecast(feed), staging.stage_current(feed)).collect()
    assert sum(r.total_forecasts for r in got) == 2  # tomorrow's and today's, not yesterday's


def test_refresh_keeps_readings_without_an_ingestion_time(spark, tmp_path):
    import datetime as dt

    from airshed.sources.schema import RAW

    land, out, ck = (str(tmp_path / n) for n in ("land", "out", "ck"))
    t = dt.datetime(2024, 3, 1, 2, tzinfo=dt.timezone.utc)
    row = lambda t, a: (t, "UK", "London", 1.0, 2.0, 1704088800, a, None)
    landing.land_current(spark.createDataFrame([row(None, 1.0), row(t, 2.0)], RAW), land)
    refresh_staged(spark, land, "current", out, ck)
    staged = lambda: sorted((str(r.ingest_date), r.aqi) for r in spark.read.parquet(out).collect())
    assert staged() == [("2024-03-01", 2.0), ("None", 1.0)]
    landing.land_current(spark.createDataFrame([row(None, None)], RAW), land)
    refresh_staged(spark, land, "current", out, ck)
    assert staged() == [("2024-03-01", 2.0)]


def test_a_city_without_a_name_has_no_pattern(spark):
    import datetime as dt

    from airshed.operators import staging, temporal, unified
    from airshed.sources.schema import RAW

    t = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(t, "UK", c, 1.0, 2.0, 1704067200 + h * 3600, float(5 + h), None) for c in ("X", None) for h in range(5)]
    empty = spark.createDataFrame([], RAW)
    u = unified.unify(staging.stage_historical(spark.createDataFrame(rows, RAW)), staging.stage_current(empty), staging.stage_forecast(empty))
    got = {r.city: (r.peak_pollution_hour, r.best_air_quality_hour, r.weekday_avg_aqi) for r in temporal.temporal_patterns(u).collect()}
    assert got == {"X": (4, 0, 7.0), None: (None, None, None)}
