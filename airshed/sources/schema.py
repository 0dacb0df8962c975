"""The one raw feed schema shared by the historical, current and forecast feeds."""

from __future__ import annotations

from pyspark.sql import types as T

# Pollutant columns, in the order every contract lists them.
POLLUTANTS = ["co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3"]

COMPONENTS = T.StructType([T.StructField(p, T.DoubleType(), True) for p in POLLUTANTS])

RAW = T.StructType(
    [
        T.StructField("ingestion_timestamp", T.TimestampType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("city", T.StringType(), True),
        T.StructField("lat", T.DoubleType(), True),
        T.StructField("lon", T.DoubleType(), True),
        T.StructField("dt", T.LongType(), True),
        T.StructField("aqi", T.DoubleType(), True),
        T.StructField("components", COMPONENTS, True),
    ]
)

RAW_COLUMNS = [f.name for f in RAW.fields]

# One item of an API response list: {dt, main: {aqi}, components: {...}}.
API_ITEM = T.StructType(
    [
        T.StructField("dt", T.LongType(), True),
        T.StructField("main", T.StructType([T.StructField("aqi", T.DoubleType(), True)]), True),
        T.StructField("components", COMPONENTS, True),
    ]
)

# A response: either {list: [item, ...]} (history, forecast) or a bare item (current).
API_RESPONSE = T.StructType(
    [
        T.StructField("list", T.ArrayType(API_ITEM, True), True),
        T.StructField("dt", T.LongType(), True),
        T.StructField("main", T.StructType([T.StructField("aqi", T.DoubleType(), True)]), True),
        T.StructField("components", COMPONENTS, True),
    ]
)
