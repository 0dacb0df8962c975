"""int_unified: historical + current + forecast in one frame, classified."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.functions import classify as C
from airshed.sources.schema import POLLUTANTS

PARTS = ["datetime", "date", "hour", "day_of_week", "month", "year"]

BASE_COLUMNS = (
    ["ingestion_timestamp", "country", "city", "timestamp", "lat", "lon", "aqi"]
    + POLLUTANTS
    + ["data_type", "is_data_quality_issue"]
    + [f"measurement_{p}" for p in PARTS]
)


CLASS_COLUMNS = ["aqi_category", "aqi_category_code", "health_impact_level", "primary_pollutant", "pollution_level", "time_of_day"]


def _align(df: DataFrame, prefix: str, carry: Sequence[str] = ()) -> DataFrame:
    """The staged columns under the unified names."""
    return df.select(
        "ingestion_timestamp",
        "country",
        "city",
        F.col(f"{prefix}_timestamp").alias("timestamp"),
        "lat",
        "lon",
        "aqi",
        *POLLUTANTS,
        "data_type",
        "is_data_quality_issue",
        *[F.col(f"{prefix}_{p}").alias(f"measurement_{p}") for p in PARTS],
        *carry,
    )


def classify(df: DataFrame, fix_night: bool = False) -> DataFrame:
    """Append the six class columns to a unified-shaped frame."""
    coded = df.select("*", C.aqi_category_code("aqi").alias("aqi_category_code"))
    code = F.col("aqi_category_code")
    out = coded.select(
        "*",
        C.aqi_category("aqi", code).alias("aqi_category"),
        C.health_impact_level("aqi", code).alias("health_impact_level"),
        C.primary_pollutant().alias("primary_pollutant"),
        C.pollution_level("aqi").alias("pollution_level"),
        C.time_of_day("measurement_hour", fix_night).alias("time_of_day"),
    )
    return out.select(*df.columns, *CLASS_COLUMNS)


def unify(historical: DataFrame, current: DataFrame, forecast: DataFrame, fix_night: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """UNION ALL of the three staged feeds, then the classes; `carry`: further staged columns.

    A later filter on data_type prunes the other union branches at plan time, so a
    historical-only mart never scans the current or forecast feed.
    """
    u = (
        _align(historical, "measurement", carry)
        .unionByName(_align(current, "measurement", carry))
        .unionByName(_align(forecast, "forecast", carry))
    )
    return classify(u, fix_night)
