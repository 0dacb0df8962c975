"""Dashboard reads (O5-O9, R1-R4): sorting, filtering and top-N run in the cluster;
only the small final result is meant to be collected by a caller."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _published_orders() -> dict[str, tuple[list, list]]:
    """By mart: the columns of its order that a few rows share, and those within them."""
    from airshed.functions.classify import season_order

    place = [F.col("country").asc(), F.col("city").asc()]
    return {
        "fct_daily_air_quality_summary": (place, [F.col("measurement_date").asc()]),
        "city_air_quality_rankings": ([F.col("measurement_year").desc(), F.col("measurement_month").desc()], [F.col("global_aqi_rank").asc()]),
        "forecast_accuracy_analysis": (place, [F.col("forecast_lead_time_hours").asc()]),
        "temporal_air_quality_patterns": (place, [F.col("measurement_year").asc(), season_order("season").asc()]),
    }


ORDER_GROUPS = {"city_air_quality_rankings": ["measurement_year", "measurement_month"]}


def in_published_order(df: DataFrame, mart: str) -> DataFrame:
    """A mart in the order its model declares. A read-time sort (range
    partitioned, parallel); published tables are only clustered within files."""
    outer, inner = _published_orders()[mart]
    return df.orderBy(*outer, *inner)


def with_position(df: DataFrame, mart: str, tie: Sequence[str] = ()) -> DataFrame:
    """O1-O4 as a column: each row's place (from 1) in the mart's order, ties by `tie`.
    Places are counted within a group of the leading columns (one city, or one month)
    and added to the number of rows in earlier groups, a window over one row per group."""
    outer, inner = _published_orders()[mart]
    group = ORDER_GROUPS.get(mart, ["country", "city"])
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy(*outer).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(g).alias(f"_{g}") for g in group], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*group).orderBy(*inner, *tie))
    placed = df.withColumn("_place", within)
    same = reduce(lambda x, y: x & y, (F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group))
    out = placed.join(offsets, same).withColumn("position", F.col("_before") + F.col("_place"))
    return out.select(*df.columns, "position")


def newest_first(df: DataFrame, order: str, limit: int | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """Rows newest first by `order`, ties by the `tie` columns, NULL orders last; all
    of them, or the first `limit`. Without `tie` the rows at the cut are any of equals.

    All rows: a range-partitioned sort. With a limit: each task keeps its own first `limit` rows and one
    merges these. Over a written mart, raw.read_mart first leaves out the partitions that cannot
    be among them, so that few tasks have rows at all.
    """
    out = df.orderBy(F.col(order).desc_nulls_last(), *tie)
    return out if limit is None else out.limit(limit)


def preview(df: DataFrame, n: int) -> DataFrame:
    """Any n rows."""
    return df.limit(n)


def latest_kpis(daily_fact: DataFrame) -> DataFrame:
    """The latest day's PM2.5, PM10 and AQI (ties -> country, city, data type)."""
    return (
        daily_fact.orderBy(F.col("measurement_date").desc(), "country", "city", "data_type")
        .limit(1)
        .select(
            F.col("measurement_date").alias("latest_date"),
            "country",
            "city",
            "data_type",
            F.col("avg_pm2_5").alias("avg_pm25"),
            "avg_pm10",
            F.col("daily_avg_aqi").alias("avg_aqi"),
        )
    )


def city_options(daily_fact: DataFrame) -> DataFrame:
    """The sorted distinct cities (distinct combines map-side)."""
    return daily_fact.select("city").distinct().orderBy("city")


def daily_trend(daily_fact: DataFrame, cities: Sequence[str] = (), metric: str = "avg_pm2_5") -> DataFrame:
    """Date x city series of one metric; an empty city list means all."""
    df = daily_fact
    if cities:
        df = df.filter(F.col("city").isin(*cities))
    return df.select("measurement_date", "country", "city", "data_type", F.col(metric).alias("value")).orderBy(
        "measurement_date", "country", "city", "data_type"
    )


def top_cities(rankings: DataFrame, n: int) -> DataFrame:
    """The n most polluted city-months by monthly mean AQI (top-k)."""
    return (
        rankings.orderBy(
            F.col("monthly_avg_aqi").desc(),
            F.col("measurement_year").desc(),
            F.col("measurement_month").desc(),
            "country",
            "city",
        )
        .limit(n)
        .select("country", "city", "measurement_year", "measurement_month", F.col("monthly_avg_aqi").alias("aqi_value"))
    )


def forecast_error_series(accuracy: DataFrame) -> DataFrame:
    """Mean absolute forecast error by lead time (the published chart's
    `forecast_error` bound to avg_aqi_error, H15)."""
    return accuracy.select(
        "country", "city", "forecast_lead_time_hours", F.col("avg_aqi_error").alias("forecast_error")
    ).orderBy("country", "city", "forecast_lead_time_hours")


def hourly_heatmap(measurements: DataFrame) -> DataFrame:
    """Data type x city x hour of day mean AQI."""
    return measurements.groupBy("data_type", "country", "city", "measurement_hour").agg(F.avg("aqi").alias("avg_aqi"), F.count(F.lit(1)).alias("measurements"))


def geo_aqi(measurements: DataFrame) -> DataFrame:
    """Mean AQI per data type and reported location."""
    return measurements.groupBy("data_type", "country", "city", "lat", "lon").agg(F.avg("aqi").alias("avg_aqi"), F.count(F.lit(1)).alias("measurements"))
