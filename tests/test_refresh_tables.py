"""Change propagation: a refresh reads and writes what new landed files change, and gives a full run's rows."""

import datetime as dt
import glob
import json
import os
import subprocess
import sys

import pytest

from airshed.plans import pipeline
from airshed.plans.models import MODELS, UNIFIED, Context
from airshed.plans.refresh import refresh_tables
from airshed.sinks import commits, landing
from airshed.sinks.publish import read_published
from airshed.sources.schema import RAW

BASE = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
DAY = 86400
T0 = int(BASE.timestamp())
TABLES = [m.name for m in MODELS.values() if m.materialized == "table"]


def readings(spark, days, cities=("A", "B"), plus=0.0, at=None, hours=(1, 13)):
    rows = []
    for d in days:
        for c in cities:
            for h in hours:
                t = T0 + d * DAY + h * 3600
                seen = at or dt.datetime.fromtimestamp(t, dt.timezone.utc)
                rows.append((seen, "UK", c, 1.0, 2.0, t, float(20 + 7 * d % 60 + h + plus), (1.0, 2.0, 3.0, 4.0, 5.0, 6.0 + d, 7.0, 8.0)))
    return spark.createDataFrame(rows, RAW)


def land_all(spark, root):
    landing.land_historical(readings(spark, [*range(0, 5), *range(55, 66)]), root, T0, T0 + 70 * DAY)
    for d in (60, 61, 62):
        landing.land_current(readings(spark, [d]), root)
        landing.land_forecast(readings(spark, [d, d + 1], plus=5, at=BASE + dt.timedelta(days=d)), root)


def context(spark, root, **more):
    return Context.from_landing(spark, root, as_of="2024-01-01", **more)


def plain(v):
    """Sums of doubles may differ in their last digits with the order of rows."""
    return round(v, 8) if isinstance(v, float) else tuple(map(plain, v)) if isinstance(v, tuple) else v


def contents(spark, out):
    return {t: sorted(str(plain(tuple(r))) for r in read_published(spark, os.path.join(out, t)).collect()) for t in TABLES}


def full(spark, root, out):
    steps = pipeline.run_pipeline(spark, context(spark, root), out, ["staging", "intermediate", "marts"])
    assert all(s.ok for s in steps), steps
    return contents(spark, out)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root, out = str(tmp_path_factory.mktemp("landing")), str(tmp_path_factory.mktemp("tables"))
    land_all(spark, root)
    full(spark, root, out)
    return root, out


def refreshed(spark, root, out):
    steps = refresh_tables(spark, context(spark, root), out)
    assert all(s.ok for s in steps), steps
    return {s.name: s.detail for s in steps}


def test_a_new_day_changes_its_own_partitions(spark, built, tmp_path):
    root, out = built
    before = {t: commits.latest(spark, os.path.join(out, t))[1] for t in TABLES}
    assert set(refreshed(spark, root, out).values()) == {"as it was"}
    landing.land_current(readings(spark, [63]), root)
    landing.land_historical(readings(spark, [80], ("C",)), root, T0 + 80 * DAY, T0 + 81 * DAY)
    done = refreshed(spark, root, out)
    assert done[UNIFIED] == "2 days" and done["city_air_quality_rankings"] == "1 months" and done["fct_air_quality_measurements"] == "2 days"
    for t in TABLES:
        old, new = before[t]["partitions"], commits.latest(spark, os.path.join(out, t))[1]["partitions"]
        moved = {p for p in old | new if old.get(p) != new.get(p)}
        if MODELS[t].grain == "all":
            continue
        months = MODELS[t].grain == "month"
        want = {"measurement_year=2024/measurement_month=3"} if months else {"2024-03-04", "2024-03-21"}
        if t == "int_air_quality_forecast_days":
            want = {"2024-03-04"}  # of the current feed; the forecast of that day was there
        assert {p if months else p.split("=")[-1] for p in moved} == want, t
    assert contents(spark, out) == full(spark, root, str(tmp_path / "again"))


def test_replaced_and_vanished_folders(spark, built, tmp_path):
    root, out = built
    landing.land_current(readings(spark, [61], ("A",), plus=30, hours=(5,)), root)  # the same day again: replaces its folder
    landing.land_historical(readings(spark, [2, 3], ("A",), plus=9), root, T0 + 2 * DAY, T0 + 4 * DAY)  # another range: stands beside
    landing.land_historical(readings(spark, [0], ("B",)), root, T0, T0 + 70 * DAY)  # the first range again, less of it
    done = refreshed(spark, root, out)
    assert done[UNIFIED] == "6 days"  # one of the current feed, five of the chunk that holds less now
    commits.delete(spark, glob.glob(f"{root}/forecast/country=UK/ingest_date=2024-03-03")[0])
    assert refreshed(spark, root, out)[UNIFIED] == "2 days"
    assert contents(spark, out) == full(spark, root, str(tmp_path / "again"))


def test_a_refresh_that_was_cut_short_is_caught_up_with(spark, built, tmp_path, monkeypatch):
    from airshed.plans import refresh

    root, out = built
    landing.land_current(readings(spark, [64], plus=3), root)
    build = refresh.build_table

    def killed(ctx, model, *a):
        if model.name == "int_air_quality_hourly_summary":
            raise RuntimeError("killed")
        return build(ctx, model, *a)

    monkeypatch.setattr(refresh, "build_table", killed)
    steps = refresh_tables(spark, context(spark, root), out)
    assert not steps[-1].ok and steps[-1].name == "int_air_quality_hourly_summary"
    monkeypatch.undo()
    done = refreshed(spark, root, out)
    assert done[UNIFIED] == "as it was" and done["int_air_quality_daily_summary"] == "as it was" and done["int_air_quality_hourly_summary"] == "1 days"
    assert contents(spark, out) == full(spark, root, str(tmp_path / "again"))
    ctx = context(spark, root, refuse_stale=True)  # every record says that it is of these files
    ctx.written = out
    assert all(ctx.ref(t) is not None for t in TABLES)


def test_other_options_and_merged_copies_mean_a_full_run(spark, tmp_path):
    root, out = str(tmp_path / "l"), str(tmp_path / "o")
    landing.land_current(readings(spark, [1]), root)
    landing.land_forecast(readings(spark, [1]), root)
    landing.land_historical(readings(spark, [1]), root, T0, T0 + 3 * DAY)
    run = lambda **o: {s.name: s.detail for s in refresh_tables(spark, context(spark, root, **o), out)}
    assert "table" in run()[UNIFIED]  # nothing was there
    assert run()[UNIFIED] == "as it was"
    assert "table" in run(keep_incomplete=True)[UNIFIED]
    assert "table" in run(dedupe=True)[UNIFIED] and "table" in run(dedupe=True)[UNIFIED]


SCRIPT = """
import sys
sys.path[:0] = [{repo!r}, {tests!r}]
from airshed.session import build_session
import test_refresh_tables as t
spark = build_session("local[4]", **{{"spark.sql.shuffle.partitions": "4", "spark.eventLog.enabled": "true", "spark.eventLog.dir": {log!r}, "spark.eventLog.compress": "false"}})
t.land_all(spark, {root!r})
t.full(spark, {root!r}, {out!r})
t.landing.land_current(t.readings(spark, [63]), {root!r})
spark.sparkContext.setLocalProperty("test.phase", "refresh")
t.refresh_tables(spark, t.context(spark, {root!r}), {out!r})
spark.stop()
"""


def test_event_log_shows_only_the_new_days_files(tmp_path):
    """Which records the tasks of a refresh read and wrote, from Spark's own event log."""
    log, root, out = (str(tmp_path / n) for n in ("log", "landing", "tables"))
    os.mkdir(log)
    script = SCRIPT.format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), tests=os.path.dirname(os.path.abspath(__file__)), log=log, root=root, out=out)
    subprocess.run([sys.executable, "-c", script], check=True, timeout=600, capture_output=True)
    events = [json.loads(x) for f in glob.glob(f"{log}/**/*", recursive=True) if os.path.isfile(f) and not f.endswith(".crc") for x in open(f)]
    mine = {e["Stage Info"]["Stage ID"] for e in events if e["Event"] == "SparkListenerStageSubmitted" and (e.get("Properties") or {}).get("test.phase") == "refresh"}
    tasks = [e for e in events if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in mine]
    read = sum(e["Task Metrics"]["Input Metrics"]["Records Read"] for e in tasks)
    wrote = sum(e["Task Metrics"]["Output Metrics"]["Records Written"] for e in tasks)
    assert tasks and wrote < 120  # the full build wrote over a thousand
    assert read < 600, read
    scans = [e for e in events if e["Event"].endswith("SparkListenerSQLExecutionStart") and "physicalPlanDescription" in e]
    assert scans
