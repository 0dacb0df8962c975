"""Adapter: the three raw feeds derived from the driver's test tables.

country / city come from customer -> nation -> region; the measured values are
rule-based functions of the row key k (o_orderkey for history, event_id otherwise),
so that every class, gap, NULL and out-of-range case occurs at every scale. The
rules are documented in FIXTURES.md section 2. Output: the RAW schema.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.session import use_utc
from airshed.sources.schema import POLLUTANTS, RAW_COLUMNS

# Fixed values of the mapping (FIXTURES.md section 2).
CURRENT_EVENTS = ("click", "view", "purchase")
FORECAST_EVENTS = ("signup", "error")
# Modulus of k per pollutant (co is additionally multiplied by 100).
COMPONENT_MODULI = [("co", 127), ("no", 31), ("no2", 109), ("o3", 113), ("so2", 83), ("pm2_5", 53), ("pm10", 163), ("nh3", 211)]


_TABLES: dict[tuple[str, int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table handle, created once per session (like a catalog entry): the footer is
    read once, the data on every execution."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    key = (spark.sparkContext.applicationId, id(spark), path)  # never reuse a handle of a stopped session
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> region. Both are the fixed 25 / 5-row TPC-H dimensions at every
    scale factor, so broadcasting them is size-safe."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"]).select(
        F.col("n_nationkey"), F.col("n_name"), F.col("r_name")
    )


def with_city(facts: DataFrame, spark: SparkSession, sf_dir: str, cust_col: str) -> DataFrame:
    """Attach (country, city, nation) to fact rows by customer key.

    The facts join customer first; customer grows with the scale factor, so that join
    is left to Spark's size-checked choice (broadcast while small, sort-merge beyond).
    Only the fixed-size geography is broadcast explicitly.
    """
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    df = facts.join(c, F.col(cust_col) == F.col("c_custkey")).join(
        F.broadcast(geography(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return df.select(
        "*",
        F.col("r_name").alias("country"),
        F.concat(F.col("n_name"), F.lit("_"), (F.col("c_custkey") % 2).cast("string")).alias("city"),
        F.col("n_nationkey").cast("bigint").alias("nation"),
    )


def _components(k: Column) -> Column:
    fields = [((k % m) * (100 if p == "co" else 1)).cast("double").alias(p) for p, m in COMPONENT_MODULI]
    assert [p for p, _ in COMPONENT_MODULI] == POLLUTANTS
    nulls = [F.lit(None).cast("double").alias(p) for p in POLLUTANTS]
    return F.when(k % 97 == 0, F.struct(*nulls)).otherwise(F.struct(*fields))


def _place(k: Column) -> list[Column]:
    n = F.col("nation")
    return [
        F.when(k % 223 == 0, F.lit(None).cast("double"))
        .when(k % 233 == 0, F.lit(95.0))
        .otherwise((n * 3).cast("double"))
        .alias("lat"),
        (n * 7 - 90).cast("double").alias("lon"),
    ]


def _epoch(ts_ntz: Column) -> Column:
    """Whole epoch seconds of a wall-clock UTC timestamp (floored)."""
    return F.unix_seconds(ts_ntz.cast("timestamp"))


def historical_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> historical measurements, all regions in one feed."""
    use_utc(spark)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    k = F.col("o_orderkey")
    price = F.col("o_totalprice") / F.lit(1000.0)
    df = with_city(o, spark, sf_dir, "o_custkey")
    return df.select(
        F.timestamp_seconds(_epoch(F.col("o_orderdate")) + 86400).alias("ingestion_timestamp"),
        "country",
        "city",
        *_place(k),
        F.when(k % 211 == 0, F.lit(None).cast("bigint"))
        .otherwise(_epoch(F.col("o_orderdate")) + (k % 24) * 3600)
        .alias("dt"),
        F.when(k % 199 == 0, F.lit(None).cast("double"))
        .when(k % 227 == 0, F.lit(-1.0))
        .when(k % 229 == 0, F.lit(600.0))
        .when(k % 10 == 0, price)
        .otherwise(F.floor(price).cast("double"))
        .alias("aqi"),
        _components(k).alias("components"),
    ).select(*RAW_COLUMNS)


def _event_feed(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...], ingestion: Column) -> DataFrame:
    use_utc(spark)
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin(*kinds))
    e = e.select("event_id", "ts", "user_id", "value")
    k = F.col("event_id")
    df = with_city(e, spark, sf_dir, "user_id")
    return df.select(
        ingestion.alias("ingestion_timestamp"),
        "country",
        "city",
        *_place(k),
        F.when(k % 211 == 0, F.lit(None).cast("bigint")).otherwise(_epoch(F.col("ts"))).alias("dt"),
        F.when(k % 199 == 0, F.lit(None).cast("double"))
        .when(k % 10 == 0, F.col("value") * 2)
        .otherwise(F.floor(F.col("value") * 2).cast("double"))
        .alias("aqi"),
        _components(k).alias("components"),
    ).select(*RAW_COLUMNS)


def current_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events click / view / purchase -> current readings, ingested at the minute."""
    ingestion = F.timestamp_seconds(F.floor(_epoch(F.col("ts")) / 60) * 60)
    return _event_feed(spark, sf_dir, CURRENT_EVENTS, ingestion)


def forecast_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events signup / error -> forecasts, issued 0..4 days before the forecast day at 06:00."""
    day = F.floor(_epoch(F.col("ts")) / 86400) * 86400
    ingestion = F.timestamp_seconds(day - (F.col("event_id") % 5) * 86400 + 6 * 3600)
    return _event_feed(spark, sf_dir, FORECAST_EVENTS, ingestion)
