"""Scaling check: the marts on multiplied feeds, along three axes.

readings  copies are extra readings of the same cities: copy c is shifted by c * 7 seconds,
          so it stays in (nearly always) the same hour and day. Rows grow x N, the groups
          (city-days, city-months, cells) stay, as with a denser feed.
groups    copy c is of another city, and another block of days, so the groups grow x N too.
values    one hour of one city with N distinct forecasts and N distinct actual values (the
          factor is N in thousands), where forecast scoring could turn quadratic.

The multiplied feeds are written once as parquet under the scratch folder given on the
command line; each query is then run fully (noop sink), warm, and median, least and
greatest seconds are printed, one JSON line per axis and factor.

Usage: python tools/scale_bench.py SCRATCH_DIR readings|groups|values [factor ...]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from airshed.operators import daily, forecast, quality, rankings, staging, temporal, unified  # noqa: E402
from airshed.session import build_session  # noqa: E402
from airshed.sources import testdata  # noqa: E402

FEEDS = {"historical": testdata.historical_feed, "current": testdata.current_feed, "forecast": testdata.forecast_feed}


def multiplied(feed, axis: str, n: int):
    copies = feed.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_copy"))
    if axis == "readings":
        return copies.withColumn("dt", F.col("dt") + F.col("_copy") * 7).drop("_copy")
    moved = copies.withColumn("city", F.concat("city", F.lit("_"), F.col("_copy").cast("string")))
    return moved.withColumn("dt", F.col("dt") + F.col("_copy") * 86400 * 30).drop("_copy")


def kept(df, path: str):
    if not os.path.exists(path):
        df.repartition(16).write.parquet(path)  # several files, so the scan is split as a real landing would be
    return df.sparkSession.read.parquet(path)


def one_hour(spark, n: int):
    """n distinct one-hour forecasts and actual values of one city."""
    day = F.lit("2024-01-10").cast("date")
    at = F.timestamp_seconds(F.lit(1704862800))
    value = (F.col("id") * 399.0 / n + F.rand(3) * 0.01).alias("aqi")
    rows = spark.range(0, n, 1, 8)
    f = rows.select(F.lit("X").alias("country"), F.lit("A").alias("city"), day.alias("forecast_date"), F.lit(5).cast("bigint").alias("forecast_hour"), day.alias("forecast_created_date"), at.alias("forecast_datetime"), value)
    a = rows.select(F.lit("X").alias("country"), F.lit("A").alias("city"), day.alias("measurement_date"), F.lit(5).cast("bigint").alias("measurement_hour"), at.alias("measurement_datetime"), value)
    return f, a


def main() -> None:
    scratch, axis = sys.argv[1:3]
    factors = [int(x) for x in sys.argv[3:]] or [1, 10, 100]
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("local[8]", app="airshed-scale", **{"spark.sql.shuffle.partitions": "64", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    for n in factors:
        if axis == "values":
            qs, rows = {"forecast_accuracy": forecast.forecast_accuracy(*one_hour(spark, n * 1000), "2024-01-10")}, 2000 * n
        else:
            feeds = {k: kept(multiplied(f(spark, sf_dir), axis, n), os.path.join(scratch, f"{k}_{axis}_x{n}")) for k, f in FEEDS.items()}
            stg = staging.stage_historical(feeds["historical"])
            current, predicted = staging.stage_current(feeds["current"]), staging.stage_forecast(feeds["forecast"])
            uni = unified.unify(stg, current, predicted)
            day, rows = daily.daily_summary(uni), feeds["historical"].count()
            qs = {
                "int_daily_summary": day,
                "city_rankings": rankings.city_rankings(day),
                "temporal_patterns": temporal.temporal_patterns(uni),
                "check_duplicates": quality.check_duplicates(stg),
                "forecast_accuracy": forecast.forecast_accuracy(predicted, current, "2024-01-10"),
            }
        out = {}
        for name, df in qs.items():
            df.write.format("noop").mode("overwrite").save()
            ts = []
            for _ in range(runs):
                t0 = time.perf_counter()
                df.write.format("noop").mode("overwrite").save()
                ts.append(round(time.perf_counter() - t0, 3))
            out[name] = {"median": statistics.median(ts), "min": min(ts), "max": max(ts)}
        print(json.dumps({"axis": axis, "factor": n, "rows": rows, "queries": out}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
