"""Daily and hourly summaries (A1, A2) and the daily fact (fct_daily_summary).

One hash aggregation each. Every aggregate here (avg, min, max, stddev_samp, counts)
has a partial form, so Spark combines map-side and a city that holds a third of
all rows costs one partial row per task and group, not a hot reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.functions import classify as C
from airshed.functions.numeric import count_when, flag, round2
from airshed.functions.timeparts import daily_summary_id
from airshed.sources.schema import POLLUTANTS

DAILY_KEYS = ["country", "city", "measurement_date", "measurement_year", "measurement_month", "data_type"]
CLASS_HOURS = ["good", "moderate", "unhealthy_sensitive", "unhealthy", "very_unhealthy", "hazardous"]
DAY_PARTS = [("morning", "Morning"), ("afternoon", "Afternoon"), ("evening", "Evening"), ("night", "Night")]


def daily_aggregations(unified: DataFrame) -> DataFrame:
    """A1: per (country, city, date, year, month, data_type)."""
    code = F.col("aqi_category_code")
    aggs = [
        F.avg("aqi").alias("avg_aqi"),
        F.min("aqi").alias("min_aqi"),
        F.max("aqi").alias("max_aqi"),
        F.stddev_samp("aqi").alias("stddev_aqi"),
        *[F.avg(p).alias(f"avg_{p}") for p in POLLUTANTS],
        # category codes 1..6 are the six classes in order
        *[count_when(code == i).alias(f"hours_{name}") for i, name in enumerate(CLASS_HOURS, start=1)],
        F.count(F.lit(1)).alias("total_measurements"),
        count_when(F.col("is_data_quality_issue") == 1).alias("quality_issues"),
        *[count_when(F.col("time_of_day") == label).alias(f"{name}_hours") for name, label in DAY_PARTS],
    ]
    return unified.groupBy(*DAILY_KEYS).agg(*aggs)


def daily_summary(unified: DataFrame) -> DataFrame:
    """int_daily_summary: the daily aggregates plus rounded stats and day classes."""
    d = daily_aggregations(unified)
    return d.select(
        "*",
        round2("avg_aqi").alias("avg_aqi_rounded"),
        round2("stddev_aqi").alias("aqi_variability"),
        C.dominant_category().alias("dominant_category"),
        C.daily_rating("avg_aqi").alias("daily_air_quality_rating"),
        C.pollution_load_index().alias("pollution_load_index"),
        C.data_completeness_pct("total_measurements", "quality_issues").alias("data_completeness_pct"),
    )


def hourly_summary(unified: DataFrame) -> DataFrame:
    """A2: per (country, city, date, hour, data_type). Defined but unused by the
    published models; published here as its own mart."""
    return unified.groupBy("country", "city", "measurement_date", "measurement_hour", "data_type").agg(
        F.avg("aqi").alias("hourly_avg_aqi"),
        F.min("aqi").alias("hourly_min_aqi"),
        F.max("aqi").alias("hourly_max_aqi"),
        F.count(F.lit(1)).alias("measurements_in_hour"),
    )


def fct_daily_summary(daily: DataFrame) -> DataFrame:
    """fct_daily_summary: the published daily fact. Its id leaves out data_type, so
    (daily_summary_id, data_type) is the key."""
    return daily.select(
        daily_summary_id().alias("daily_summary_id"),
        "country",
        "city",
        "measurement_date",
        "data_type",
        F.col("avg_aqi_rounded").alias("daily_avg_aqi"),
        F.col("min_aqi").alias("daily_min_aqi"),
        F.col("max_aqi").alias("daily_max_aqi"),
        "aqi_variability",
        "dominant_category",
        "daily_air_quality_rating",
        *[f"avg_{p}" for p in POLLUTANTS],
        *[f"hours_{n}" for n in CLASS_HOURS],
        *[f"{n}_hours" for n, _ in DAY_PARTS],
        "pollution_load_index",
        "data_completeness_pct",
        flag(F.col("avg_aqi_rounded") > C.UNHEALTHY_AQI).alias("had_unhealthy_days"),
        flag(F.col("max_aqi") > C.VERY_UNHEALTHY_AQI).alias("had_very_unhealthy_hours"),
        flag(F.col("hours_hazardous") > 0).alias("had_hazardous_hours"),
        C.pollution_intensity("pollution_load_index").alias("pollution_intensity"),
        "total_measurements",
        "quality_issues",
    )
