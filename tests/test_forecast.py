"""Forecast scoring without pairs, checked against a brute-force pair join."""

import math
import random
from datetime import datetime, timezone

import pandas as pd
import pytest

from airshed.operators import forecast as FC
from airshed.operators import staging


def _value(rnd, kind):
    if kind == "decimals":  # one decimal, so that differences fall on the bounds
        return rnd.choice([10.1, 20.1, 0.1, 35.1, 60.1, 110.3, 120.3, 85.3, 160.3, 299.9, 309.9, 324.9, 349.9, -0.9, 9.1]) + rnd.choice([0, 0, 0, 0.1, 10, 25, 50])
    return float(rnd.randrange(0, 400)) if kind == "integers" else rnd.uniform(-5, 420)


def _frames(spark, seed, kind):
    rnd = random.Random(seed)
    fc, cur = [], []
    base = 1704844800  # 2024-01-10 00:00 UTC
    for i in range(400):
        city = rnd.choice(["A", "B"])
        hour = rnd.randrange(0, 6)
        dt = base + rnd.randrange(0, 3) * 86400 + hour * 3600 + rnd.randrange(0, 3600)
        aqi = _value(rnd, kind)
        lag = rnd.randrange(0, 5) * 86400 - 6 * 3600
        fc.append((datetime.fromtimestamp(dt - lag, timezone.utc), "X", city, 1.0, 2.0, dt, aqi, None))
    for i in range(300):
        city = rnd.choice(["A", "B"])
        hour = rnd.randrange(0, 6)
        dt = base + rnd.randrange(-1, 3) * 86400 + hour * 3600 + rnd.randrange(0, 3600)
        aqi = _value(rnd, kind)
        cur.append((datetime.fromtimestamp(dt, timezone.utc), "X", city, 1.0, 2.0, dt, aqi, None))
    schema = "ingestion_timestamp timestamp, country string, city string, lat double, lon double, dt bigint, aqi double, components struct<co:double,no:double,no2:double,o3:double,so2:double,pm2_5:double,pm10:double,nh3:double>"
    f = staging.stage_forecast(spark.createDataFrame(fc, schema))
    c = staging.stage_current(spark.createDataFrame(cur, schema))
    return f, c


def _brute(f, c, as_of):
    fp = f.toPandas()
    cp = c.toPandas()
    fp = fp[pd.to_datetime(fp.forecast_date) >= pd.Timestamp(as_of)]
    fp["lead"] = ((fp.forecast_datetime - pd.to_datetime(fp.forecast_created_date)).dt.total_seconds() / 3600).astype(int)
    m = fp.merge(cp, left_on=["country", "city", "forecast_date", "forecast_hour"],
                 right_on=["country", "city", "measurement_date", "measurement_hour"], suffixes=("_f", "_a"))
    m["err"] = (m.aqi_f - m.aqi_a).abs()

    def cat(x):
        for lo, hi, lab in [(0, 50, "Good"), (51, 100, "Moderate"), (101, 150, "S"), (151, 200, "Unhealthy"), (201, 300, "VU")]:
            if lo <= x <= hi:
                return lab
        return "Hazardous" if x > 300 else "Unknown"

    m["fcat"] = m.aqi_f.map(cat)
    m["hit"] = (m.fcat == m.aqi_a.map(cat)).astype(int)
    rows = {}
    for (country, city, lead), g in m.groupby(["country", "city", "lead"]):
        e = g.err
        rows[(country, city, lead)] = dict(
            total_forecasts=len(g), avg_absolute_error=e.mean(), error_stddev=e.std() if len(g) > 1 else None,
            min_error=e.min(), max_error=e.max(),
            good_forecast_error=g.err[g.fcat == "Good"].mean() if (g.fcat == "Good").any() else None,
            category_accuracy_percentage=g.hit.mean() * 100,
            excellent_forecasts=int((e <= 10).sum()), good_forecasts=int(((e > 10) & (e <= 25)).sum()),
            fair_forecasts=int(((e > 25) & (e <= 50)).sum()), poor_forecasts=int((e > 50).sum()),
        )
    return rows


@pytest.mark.parametrize("kind", ["integers", "uniform", "decimals"])
def test_accuracy_matches_brute_force_pairs(spark, kind):
    f, c = _frames(spark, 7, kind)
    want = _brute(f, c, "2024-01-10")
    got = {(r.country, r.city, r.forecast_lead_time_hours): r.asDict()
           for r in FC.accuracy_metrics(FC.forecast_pair_stats(f, c, "2024-01-10")).collect()}
    assert set(got) == set(want) and len(want) > 5
    for k, w in want.items():
        g = got[k]
        for name, v in w.items():
            if v is None or (isinstance(v, float) and pd.isna(v)):
                assert g[name] is None, (k, name)
            else:
                assert g[name] == pytest.approx(v, rel=1e-9, abs=1e-9), (k, name, g[name], v)


def _one_hour(spark, forecasts, actuals):
    schema = "country string, city string, forecast_date date, forecast_hour bigint, forecast_created_date date, forecast_datetime timestamp, aqi double"
    day, at = datetime(2024, 1, 10).date(), datetime(2024, 1, 10, 5, tzinfo=timezone.utc)
    f = spark.createDataFrame([("X", "A", day, 5, day, at, v) for v in forecasts], schema)
    a = spark.createDataFrame([("X", "A", day, 5, at, v) for v in actuals], "country string, city string, measurement_date date, measurement_hour bigint, measurement_datetime timestamp, aqi double")
    return f, a


def test_deviation_does_not_cancel(spark):
    import statistics

    f, a = [300.1, 300.2, 300.3], [0.1, 0.15, 0.31]
    got = FC.accuracy_metrics(FC.forecast_pair_stats(*_one_hour(spark, f, a), "2024-01-10")).first()
    want = statistics.stdev([abs(x - y) for x in f for y in a])
    assert got.error_stddev == pytest.approx(want, rel=1e-12)


def test_bounds_follow_the_subtraction_of_doubles(spark):
    rnd = random.Random(1)
    f = sorted({round(rnd.uniform(-20, 400), 1) for _ in range(120)})
    a = set()
    for x in rnd.sample(f, 60):
        for b in (10, 25, 50):
            for y in (x + b, x - b):
                a |= {y, math.nextafter(y, 1e9), math.nextafter(y, -1e9), round(y, 1), y + b * 2.0**-53, y - b * 2.0**-53}
    got = {r.forecasted_aqi: (r.within_10, r.within_25, r.within_50, r.pairs) for r in FC.forecast_pair_stats(*_one_hour(spark, f, sorted(a)), "2024-01-10").collect()}
    assert got == {x: (*(sum(abs(x - y) <= b for y in a) for b in (10, 25, 50)), len(a)) for x in f}


def test_linear_frames_and_pushed_day_in_plan(spark):
    f, c = _frames(spark, 3, "integers")
    plan = FC.forecast_accuracy(f, c, "2024-01-10")._jdf.queryExecution().executedPlan().toString().lower()
    assert "window" in plan and "unboundedfollowing" not in plan and "rangeframe" not in plan and "nestedloop" not in plan and "cartesian" not in plan
    optimized = FC.forecast_pair_stats(f, c, "2024-01-10")._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count(">= 2024-01-10") + optimized.count(">= 19732") >= 2  # both sides


def test_running_sums_are_taken_on_narrow_rows(spark):
    """The key's totals, an array per row, are joined after the windows, so no window's sort holds them."""
    f, c = _frames(spark, 3, "integers")
    plan = FC.forecast_pair_stats(f, c, "2024-01-10")._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Join ") < plan.index("Window ")
