"""Flatten API responses into raw records.

Input: one row per fetched response with the request context
(country, city, lat, lon, ingestion_timestamp) and `response`, the JSON text.
Output: (records, rejected): RAW rows, and the responses that gave none because they could
not be read, with the reason. Parsing is from_json with a fixed schema, once per response;
text that is not a JSON object of that shape is kept aside as corrupt. from_json cannot tell
a missing key from a null one, both are treated as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.sources.schema import API_RESPONSE, COMPONENTS, POLLUTANTS, RAW_COLUMNS

CONTEXT = ["country", "city", "lat", "lon"]
CORRUPT = "_corrupt_record"


def _prepare(payloads: DataFrame, cities: DataFrame | None) -> DataFrame:
    df = payloads
    if cities is not None and not {"lat", "lon"} <= set(df.columns):
        # No hint: Spark broadcasts the city table only while its size estimate allows.
        df = df.join(cities.select(*CONTEXT), ["country", "city"], "left")
    if "ingestion_timestamp" not in df.columns:
        df = df.withColumn("ingestion_timestamp", F.current_timestamp())
    schema = T.StructType([*API_RESPONSE.fields, T.StructField(CORRUPT, T.StringType(), True)])
    df = df.withColumn("_r", F.from_json(F.col("response"), schema, {"columnNameOfCorruptRecord": CORRUPT}))
    unread = F.col("response").isNull() | F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()
    return df.withColumn("_reason", F.when(unread, F.lit("malformed")))


def _rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason").drop("_r")


def _empty_components() -> Column:
    return F.struct(*[F.lit(None).cast("double").alias(p) for p in POLLUTANTS]).cast(COMPONENTS)


def _record(item: Column) -> list[Column]:
    return [
        F.col("ingestion_timestamp"),
        F.col("country"),
        F.col("city"),
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
        item.getField("dt").alias("dt"),
        item.getField("main").getField("aqi").alias("aqi"),
        F.coalesce(item.getField("components"), _empty_components()).alias("components"),
    ]


def _complete(x: Column) -> Column:
    return x.getField("dt").isNotNull() & x.getField("main").getField("aqi").isNotNull() & x.getField("components").isNotNull()


def flatten_history(payloads: DataFrame, cities: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Strict. A response whose list has an item without dt, main.aqi or components
    is rejected whole (the reference counts it as a failed chunk), and so is one that is not
    JSON; a missing or empty list yields no records. Returns (records, rejected)."""
    df = _prepare(payloads, cities)
    items = F.coalesce(F.col("_r.list"), F.array())
    df = df.withColumn("_reason", F.coalesce("_reason", F.when(~F.forall(items, _complete), F.lit("incomplete item"))))
    # The check sits inside the generator (a rejected response explodes nothing), so
    # no filter is pushed below the parse and each response is parsed once.
    good = df.select("*", F.explode(F.when(F.col("_reason").isNull(), items)).alias("_i")).select(*_record(F.col("_i")))
    return good.select(*RAW_COLUMNS), _rejected(df)


def flatten_forecast(payloads: DataFrame, cities: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Lenient. Every list item is a record; missing fields are NULL, missing
    components are eight NULLs; a missing or empty list yields no records. Only text that is
    not JSON is rejected. Returns (records, rejected)."""
    df = _prepare(payloads, cities)
    items = F.explode(F.when(F.col("_reason").isNull(), F.col("_r.list"))).alias("_i")
    return df.select("*", items).select(*_record(F.col("_i"))).select(*RAW_COLUMNS), _rejected(df)


def flatten_current(payloads: DataFrame, cities: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """One record per response, read from the top level or, if the response has
    the list form, from its first item (hazard H1); none from text that is not JSON, which is
    rejected. Returns (records, rejected)."""
    df = _prepare(payloads, cities)
    first = F.get(F.col("_r.list"), F.lit(0))
    top = F.col("_r")
    item = F.struct(
        F.coalesce(top.getField("dt"), first.getField("dt")).alias("dt"),
        F.struct(F.coalesce(top.getField("main").getField("aqi"), first.getField("main").getField("aqi")).alias("aqi")).alias("main"),
        F.coalesce(top.getField("components"), first.getField("components")).alias("components"),
    )
    one = F.explode(F.when(F.col("_reason").isNull(), F.array(item))).alias("_i")
    return df.select("*", one).select(*_record(F.col("_i"))).select(*RAW_COLUMNS), _rejected(df)


def to_history_response(raw: DataFrame) -> DataFrame:
    """Inverse helper: RAW rows -> one single-item history response each (request
    context + JSON text); NULL fields are left out of the JSON, as a missing key."""
    item = F.struct(
        F.col("dt").alias("dt"),
        F.struct(F.col("aqi").alias("aqi")).alias("main"),
        F.col("components").alias("components"),
    )
    return raw.select(
        *CONTEXT, "ingestion_timestamp", F.to_json(F.struct(F.array(item).alias("list"))).alias("response")
    )
