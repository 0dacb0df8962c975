"""Data-quality checks (Q1-Q3): each returns the violating rows; empty means pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Valid ranges.
AQI_MIN, AQI_MAX = 0, 500
LAT_MIN, LAT_MAX = -90, 90
LON_MIN, LON_MAX = -180, 180


def check_aqi_range(staged: DataFrame) -> DataFrame:
    """Q1: aqi outside 0..500."""
    return staged.filter((F.col("aqi") < AQI_MIN) | (F.col("aqi") > AQI_MAX))


def check_coordinates(staged: DataFrame) -> DataFrame:
    """Q2: latitude or longitude out of range."""
    lat, lon = F.col("lat"), F.col("lon")
    return staged.filter((lat < LAT_MIN) | (lat > LAT_MAX) | (lon < LON_MIN) | (lon > LON_MAX))


def check_duplicates(staged: DataFrame, ts: str = "measurement_timestamp") -> DataFrame:
    """Q3: more than one row per (country, city, epoch second). The published check
    names the raw `dt`, which staging renamed; the staged name is used (H16).
    A partial count per task keeps a hot key cheap."""
    return (
        staged.groupBy("country", "city", ts)
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .filter(F.col("duplicate_count") > 1)
    )


def violations(staged: DataFrame, ts: str = "measurement_timestamp") -> dict[str, int]:
    """Number of violating rows (groups, for duplicates) of each check, in two passes."""
    lat, lon, aqi = F.col("lat"), F.col("lon"), F.col("aqi")
    row = staged.agg(
        F.count_if((aqi < AQI_MIN) | (aqi > AQI_MAX)).alias("check_aqi_range"),
        F.count_if((lat < LAT_MIN) | (lat > LAT_MAX) | (lon < LON_MIN) | (lon > LON_MAX)).alias("check_coordinates"),
    ).first()
    return {**row.asDict(), "check_duplicates": check_duplicates(staged, ts).count()}


CHECKS = {
    "check_aqi_range": check_aqi_range,
    "check_coordinates": check_coordinates,
    "check_duplicates": check_duplicates,
}
