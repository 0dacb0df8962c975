"""Seasonal, hourly and weekday patterns.

Only temporal_cells reads measurements; every later step works on cells (at most
one row per city, month, hour, weekday), so all of them are small. The three
consumers of the cells share one shuffle (the exchange is reused in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.functions import classify as C
from airshed.functions.numeric import count_when, percentage, ratio, round2, round_dp

CELL_KEYS = [
    "country",
    "city",
    "measurement_year",
    "measurement_month",
    "measurement_hour",
    "measurement_day_of_week",
    "time_of_day",
]


def temporal_cells(unified: DataFrame) -> DataFrame:
    """A4: historical readings per city, year, month, hour, weekday; season of the month."""
    code = F.col("aqi_category_code")
    cells = (
        unified.filter(F.col("data_type") == "historical")
        .groupBy(*CELL_KEYS)
        .agg(
            F.avg("aqi").alias("avg_aqi"),
            F.min("aqi").alias("min_aqi"),
            F.max("aqi").alias("max_aqi"),
            F.stddev_samp("aqi").alias("aqi_stddev"),
            F.avg("pm2_5").alias("avg_pm25"),
            F.avg("pm10").alias("avg_pm10"),
            F.avg("o3").alias("avg_o3"),
            F.avg("no2").alias("avg_no2"),
            F.count(F.lit(1)).alias("total_measurements"),
            count_when(code == 1).alias("good_measurements"),
            count_when(code == 2).alias("moderate_measurements"),
            count_when(code >= 4).alias("unhealthy_measurements"),
        )
    )
    return cells.select(
        "country",
        "city",
        "measurement_year",
        "measurement_month",
        C.season("measurement_month").alias("season"),
        *CELL_KEYS[4:],
        *cells.columns[len(CELL_KEYS):],
    )


def seasonal_analysis(cells: DataFrame) -> DataFrame:
    """A5: per city, season, year; averages of cell values (H5)."""
    return cells.groupBy("country", "city", "season", "measurement_year").agg(
        F.avg("avg_aqi").alias("seasonal_avg_aqi"),
        F.avg("aqi_stddev").alias("seasonal_aqi_variability"),
        F.avg("avg_pm25").alias("seasonal_avg_pm25"),
        F.avg("avg_pm10").alias("seasonal_avg_pm10"),
        F.sum("total_measurements").alias("seasonal_total_measurements"),
        F.sum("good_measurements").alias("seasonal_good_measurements"),
        F.sum("moderate_measurements").alias("seasonal_moderate_measurements"),
        F.sum("unhealthy_measurements").alias("seasonal_unhealthy_measurements"),
        percentage(F.sum("unhealthy_measurements"), F.sum("total_measurements")).alias("seasonal_unhealthy_percentage"),
    )


def hourly_patterns(cells: DataFrame) -> DataFrame:
    """Per city and hour; the good share is a mean of per-cell ratios."""
    return cells.groupBy("country", "city", "measurement_hour", "time_of_day").agg(
        F.avg("avg_aqi").alias("hourly_avg_aqi"),
        F.avg("avg_pm25").alias("hourly_avg_pm25"),
        F.avg("avg_o3").alias("hourly_avg_o3"),
        F.sum("total_measurements").alias("hourly_total_measurements"),
        round2(F.avg(ratio(F.col("good_measurements"), F.col("total_measurements")) * F.lit(100.0))).alias(
            "hourly_good_percentage"
        ),
    )


def weekday_patterns(cells: DataFrame) -> DataFrame:
    """Per city and day of week."""
    w = cells.groupBy("country", "city", "measurement_day_of_week").agg(
        F.avg("avg_aqi").alias("weekday_avg_aqi"),
        F.avg("avg_pm25").alias("weekday_avg_pm25"),
        F.avg("aqi_stddev").alias("weekday_aqi_variability"),
    )
    return w.select(
        "country",
        "city",
        "measurement_day_of_week",
        C.day_type("measurement_day_of_week").alias("day_type"),
        "weekday_avg_aqi",
        "weekday_avg_pm25",
        "weekday_aqi_variability",
    )


def peak_hours(hourly: DataFrame) -> DataFrame:
    """The hour with the highest and the lowest mean aqi; ties -> earliest hour (H9).

    max_by / min_by over a (value, hour) struct replace ARRAY_AGG(... LIMIT 1) and
    combine map-side.
    """
    v = round_dp("hourly_avg_aqi", 6)
    h = F.col("measurement_hour")
    return hourly.groupBy("country", "city").agg(
        F.max("hourly_avg_aqi").alias("max_hourly_avg_aqi"),
        F.max_by(h, F.struct(v, -h)).alias("peak_pollution_hour"),
        F.min_by(h, F.struct(v, h)).alias("best_air_quality_hour"),
    )


def weekday_weekend(weekday: DataFrame) -> DataFrame:
    """MAX of the weekday and of the weekend day means (a max, as published)."""
    t = F.col("day_type")
    return weekday.groupBy("country", "city").agg(
        F.max(F.when(t == "Weekday", F.col("weekday_avg_aqi"))).alias("weekday_avg_aqi"),
        F.max(F.when(t == "Weekend", F.col("weekday_avg_aqi"))).alias("weekend_avg_aqi"),
    )


def temporal_patterns(unified: DataFrame) -> DataFrame:
    """The temporal mart: seasons with peak hours and weekday/weekend means, ranked
    by cleanliness within (country, year); ties -> city, then season order.

    One pass over the cells: a GROUPING SETS aggregate yields the seasonal, hourly and
    weekday rows together, and a per-city window hands each seasonal row its city's
    peak / best hour and weekday / weekend maxima (the published LEFT JOINs on
    country, city). The raw history is scanned and shuffled once; every later step
    works on at most a few hundred rows per city.
    """
    return patterns_of(temporal_cells(unified))


def patterns_of(cells: DataFrame) -> DataFrame:
    """temporal_patterns from the cells (A4)."""
    season_set = ["country", "city", "season", "measurement_year"]
    hour_set = ["country", "city", "measurement_hour", "time_of_day"]
    dow_set = ["country", "city", "measurement_day_of_week"]
    keys = ["country", "city", "season", "measurement_year", "measurement_hour", "time_of_day", "measurement_day_of_week"]
    g = cells.groupingSets([season_set, hour_set, dow_set], *keys).agg(
        (F.grouping("measurement_year") == 0).alias("_is_season"),
        (F.grouping("measurement_hour") == 0).alias("_is_hour"),
        (F.grouping("measurement_day_of_week") == 0).alias("_is_dow"),
        F.avg("avg_aqi").alias("_avg_aqi"),
        F.avg("aqi_stddev").alias("seasonal_aqi_variability"),
        F.avg("avg_pm25").alias("seasonal_avg_pm25"),
        F.avg("avg_pm10").alias("seasonal_avg_pm10"),
        percentage(F.sum("unhealthy_measurements"), F.sum("total_measurements")).alias("seasonal_unhealthy_percentage"),
    )
    city = Window.partitionBy("country", "city")
    v, h = round_dp("_avg_aqi", 6), F.col("measurement_hour")
    is_hour, is_dow = F.col("_is_hour"), F.col("_is_dow")
    dtype = C.day_type("measurement_day_of_week")
    per_city = g.select(
        "*",
        F.max_by(h, F.when(is_hour, F.struct(v, -h))).over(city).alias("peak_pollution_hour"),
        F.min_by(h, F.when(is_hour, F.struct(v, h))).over(city).alias("best_air_quality_hour"),
        F.max(F.when(is_dow & (dtype == "Weekday"), F.col("_avg_aqi"))).over(city).alias("weekday_avg_aqi"),
        F.max(F.when(is_dow & (dtype == "Weekend"), F.col("_avg_aqi"))).over(city).alias("weekend_avg_aqi"),
    ).filter(F.col("_is_season"))
    w = Window.partitionBy("country", "measurement_year").orderBy(v, "city", C.season_order("season"))
    return per_city.select(
        "country",
        "city",
        "season",
        "measurement_year",
        F.col("_avg_aqi").alias("seasonal_avg_aqi"),
        "seasonal_aqi_variability",
        "seasonal_avg_pm25",
        "seasonal_avg_pm10",
        "seasonal_unhealthy_percentage",
        # equality matches no NULL: a city without a name has no pattern of its own
        *[F.when(F.col("country").isNotNull() & F.col("city").isNotNull(), F.col(c)).alias(c) for c in ("peak_pollution_hour", "best_air_quality_hour", "weekday_avg_aqi", "weekend_avg_aqi")],
        F.row_number().over(w).cast("bigint").alias("seasonal_cleanliness_rank"),
    )
