"""fct_measurements: one row per good-quality reading, with flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.functions import classify as C
from airshed.functions.numeric import flag
from airshed.functions.timeparts import measurement_id
from airshed.sources.schema import POLLUTANTS


def fct_measurements(unified: DataFrame) -> DataFrame:
    """Map-only: filter + projection over the unified frame."""
    return unified.filter(F.col("is_data_quality_issue") == 0).select(
        measurement_id().alias("measurement_id"),
        "country",
        "city",
        "measurement_datetime",
        "measurement_date",
        "measurement_hour",
        "measurement_month",
        "measurement_year",
        "measurement_day_of_week",
        "time_of_day",
        "data_type",
        "lat",
        "lon",
        "aqi",
        "aqi_category",
        "aqi_category_code",
        "health_impact_level",
        "pollution_level",
        "primary_pollutant",
        *POLLUTANTS,
        "ingestion_timestamp",
        "is_data_quality_issue",
        flag(F.col("aqi") > C.UNHEALTHY_AQI).alias("is_unhealthy"),
        flag(F.col("aqi") > C.VERY_UNHEALTHY_AQI).alias("is_very_unhealthy"),
        flag(F.col("pm2_5") > C.PM2_5_LIMIT).alias("is_pm2_5_exceeded"),
        flag(F.col("pm10") > C.PM10_LIMIT).alias("is_pm10_exceeded"),
        C.is_weekend("measurement_day_of_week").alias("is_weekend"),
        C.is_business_hours("measurement_hour").alias("is_business_hours"),
    )
