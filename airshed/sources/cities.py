"""City dimension (S7): the cities the feeds are fetched for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (country, city, lat, lon) of the published city list.
CITIES = [
    ("Nigeria", "Lagos", 6.5244, 3.3792),
    ("Nigeria", "Abuja", 9.0765, 7.3986),
    ("USA", "New York", 40.7128, -74.0060),
    ("USA", "Los Angeles", 34.0522, -118.2437),
    ("UK", "London", 51.5072, -0.1276),
    ("UK", "Birmingham", 52.4862, -1.8904),
    ("India", "Delhi", 28.6139, 77.2090),
    ("India", "Mumbai", 19.0760, 72.8777),
]

SCHEMA = "country string, city string, lat double, lon double"


def city_dim(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """The city dimension as a DataFrame. The built-in list is a literal of eight rows, so
    it carries a broadcast hint; a caller's list may have any length and carries none."""
    if rows is None:
        return F.broadcast(spark.createDataFrame(CITIES, SCHEMA))
    return spark.createDataFrame(rows, SCHEMA)
