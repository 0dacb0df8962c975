"""Classifiers on hand-made frames: one row per CASE branch and edge."""

import pytest
from pyspark.sql import functions as F

from airshed.functions import classify as C
from airshed.functions.numeric import round2


def col_values(spark, values, expr, typ="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


AQI_EDGES = [-1.0, 0.0, 50.0, 50.5, 51.0, 100.0, 100.5, 101.0, 150.0, 151.0, 200.0, 201.0, 300.0, 300.5, 301.0, None]


def test_aqi_category_gaps_and_edges(spark):
    got = col_values(spark, AQI_EDGES, C.aqi_category)
    assert got == [
        "Unknown", "Good", "Good", "Unknown", "Moderate", "Moderate", "Unknown",
        "Unhealthy for Sensitive Groups", "Unhealthy for Sensitive Groups", "Unhealthy", "Unhealthy",
        "Very Unhealthy", "Very Unhealthy", "Hazardous", "Hazardous", "Unknown",
    ]


def test_aqi_code_and_impact(spark):
    codes = col_values(spark, AQI_EDGES, C.aqi_category_code)
    assert codes == [0, 1, 1, 0, 2, 2, 0, 3, 3, 4, 4, 5, 5, 6, 6, 0]
    impact = col_values(spark, [25.0, 75.0, 125.0, 175.0, 250.0, 400.0, 50.5], C.health_impact_level)
    assert impact == ["Low", "Moderate", "High for Sensitive Groups", "High", "Very High", "Extreme", "Unknown"]


def test_pollution_level_has_no_gaps(spark):
    got = col_values(spark, [-1.0, 50.0, 50.5, 100.0, 100.5, 150.0, 200.0, 300.0, 300.5, None], C.pollution_level)
    assert got == ["Clean", "Clean", "Acceptable", "Acceptable", "Concerning", "Concerning", "Poor", "Very Poor", "Critical", "Critical"]


def test_time_of_day_night_never_matches(spark):
    got = col_values(spark, list(range(24)), C.time_of_day, "int")
    assert got[:6] == ["Midnight"] * 6 and got[6:12] == ["Morning"] * 6
    assert got[12:18] == ["Afternoon"] * 6 and got[18:22] == ["Evening"] * 4
    assert got[22:] == ["Unknown", "Unknown"] and "Night" not in got
    fixed = col_values(spark, [22, 23, 3], lambda h: C.time_of_day(h, fix_night=True), "int")
    assert fixed == ["Night", "Night", "Midnight"]


def test_business_hours_and_weekend(spark):
    got = col_values(spark, list(range(24)), C.is_business_hours, "int")
    assert [h for h, v in enumerate(got) if v] == list(range(7, 20))
    assert col_values(spark, list(range(1, 8)), C.is_weekend, "int") == [1, 0, 0, 0, 0, 0, 1]
    assert col_values(spark, [1, 2, 7], C.day_type, "int") == ["Weekend", "Weekday", "Weekend"]


def test_primary_pollutant_priority(spark):
    names = ["pm2_5", "pm10", "o3", "no2", "so2", "co", "nh3"]
    limits = [35, 150, 100, 100, 75, 10000, 200]
    rows = []
    for i, n in enumerate(names):
        at = {k: 0.0 for k in names}
        at[n] = float(limits[i])
        over = dict(at)
        over[n] = limits[i] + 1.0
        rows += [at, over]
    rows.append({k: float(v + 1) for k, v in zip(names, limits)})  # all exceeded
    rows.append({k: None for k in names})
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    got = [r[0] for r in df.select(C.primary_pollutant()).collect()]
    labels = ["PM2.5", "PM10", "O3", "NO2", "SO2", "CO", "NH3"]
    exp = []
    for lab in labels:
        exp += ["Multiple/None", lab]
    exp += ["PM2.5", "Multiple/None"]
    assert got == exp


def test_dominant_category_ties_go_to_the_worse_class(spark):
    names = ["good", "moderate", "unhealthy_sensitive", "unhealthy", "very_unhealthy", "hazardous"]
    labels = ["Good", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy", "Very Unhealthy", "Hazardous"]
    rows, exp = [], []
    for i in range(6):
        for j in range(i + 1, 6):
            r = [0] * 6
            r[i] = r[j] = 3
            rows.append(r)
            exp.append(labels[j])
    rows.append([0] * 6)
    exp.append("Hazardous")  # all zero: the first test (hazardous = max) is true
    df = spark.createDataFrame(rows, ", ".join(f"hours_{n} bigint" for n in names))
    assert [r[0] for r in df.select(C.dominant_category()).collect()] == exp


def test_load_index_nulls_and_single_pollutants(spark):
    cols = ["pm2_5", "pm10", "o3", "no2", "so2", "co", "nh3", "no"]
    weights = {"pm2_5": 1.0, "pm10": 0.5, "o3": 0.8, "no2": 0.7, "so2": 0.6, "co": 0.1, "nh3": 0.3, "no": 0.0}
    rows = [{c: None for c in cols}]
    for c in cols:
        r = {k: None for k in cols}
        r[c] = 10.0
        rows.append(r)
    df = spark.createDataFrame(rows, ", ".join(f"avg_{c} double" for c in cols).replace("avg_", "")).toDF(*[f"avg_{c}" for c in cols])
    got = [r[0] for r in df.select(C.pollution_load_index()).collect()]
    assert got == [0.0] + [round(10 * weights[c], 2) for c in cols]


def test_round2_decides_ties_on_decimal_digits(spark):
    assert col_values(spark, [1.005, 2.675, 0.125, -0.125, None], round2) == [1.01, 2.68, 0.13, -0.13, None]


def test_seasons(spark):
    got = col_values(spark, list(range(1, 13)), C.season, "int")
    assert got == ["Winter", "Winter", "Spring", "Spring", "Spring", "Summer", "Summer", "Summer", "Fall", "Fall", "Fall", "Winter"]


def test_country_status_labels_by_country_size(spark):
    def labels(n):
        df = spark.createDataFrame([(r, n) for r in range(1, n + 1)], "r int, n int")
        return [x[0] for x in df.select(C.country_performance_status("r", "n")).collect()]

    assert labels(1) == ["Best in Country"]
    assert labels(2) == ["Best in Country", "Top 3 in Country"]
    assert labels(3) == ["Best in Country", "Top 3 in Country", "Top 3 in Country"]
    assert labels(4) == ["Best in Country", "Top 3 in Country", "Top 3 in Country", "Worst in Country"]
    assert labels(7)[3:] == ["Average in Country", "Worst in Country", "Worst in Country", "Worst in Country"]


def test_forecast_scoring_labels(spark):
    assert col_values(spark, [0.0, 10.0, 10.5, 25.0, 50.0, 51.0], C.accuracy_rating) == [
        "Excellent", "Excellent", "Good", "Good", "Fair", "Poor"]
    assert col_values(spark, [-1, 0, 24, 25, 72, 73], C.forecast_horizon, "int") == [
        "Short-term (1 day)"] * 3 + ["Medium-term (2-3 days)"] * 2 + ["Long-term (4+ days)"]
    assert col_values(spark, [80.0, 79.99, 70.0, 60.0, 50.0, 49.99, None], C.quality_rating) == [
        "Highly Reliable", "Reliable", "Reliable", "Moderately Reliable",
        "Low Reliability", "Unreliable", "Unreliable"]


def test_health_risk_and_percentages(spark):
    df = spark.createDataFrame([(6, 10), (3, 10), (2, 10), (1, 10), (0, 0)], "u bigint, t bigint")
    got = df.select(C.health_risk_level("u", "t"), C.percentage("u", "t")).collect()
    assert [r[0] for r in got] == ["High Risk", "Moderate Risk", "Low Risk", "Minimal Risk", "Minimal Risk"]
    assert [r[1] for r in got] == [60.0, 30.0, 20.0, 10.0, None]


def test_rounding_over_all_doubles(spark):
    import duckdb
    import oracle_sql
    from airshed.functions.numeric import round_dp

    values = [1e19, -1e300, 0.005, -0.005, 1.005, 2.675, 0.125, 9007199254740991.0, 9007199254740992.0, 1e18, -4503599627370497.5, float("inf"), 0.0, None]
    want = [1e19, -1e300, 0.01, -0.01, 1.01, 2.68, 0.13, 9007199254740991.0, 9007199254740992.0, 1e18, -4503599627370497.5, float("inf"), 0.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    assert [r.y for r in df.select("i", round_dp("x", 2).alias("y")).orderBy("i").collect()] == want
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INT, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    found = [r[0] for r in con.sql(f"SELECT {oracle_sql.r('x')} FROM t ORDER BY i").fetchall()]
    assert found[:7] == want[:7] and found[8:] == want[8:] and found[7] == pytest.approx(want[7], rel=1e-15)  # its cast has 53 bits
