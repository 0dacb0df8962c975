"""Staging (stg_*): flatten, tag, flag, drop incomplete rows, derive time parts.

Map-only operators: each is a projection + filter over the raw feed, so staging adds
no shuffle and its filter reaches the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.functions.timeparts import time_parts
from airshed.sources.schema import POLLUTANTS, RAW_COLUMNS

REQUIRED = ["dt", "lat", "lon", "aqi"]


def dq_flag() -> Column:
    """P5: 1 if aqi, lat, lon or dt is NULL, else 0."""
    return (
        F.when(F.col("aqi").isNull(), F.lit(1))
        .when(F.col("lat").isNull() | F.col("lon").isNull(), F.lit(1))
        .when(F.col("dt").isNull(), F.lit(1))
        .otherwise(F.lit(0))
        .cast("bigint")
    )


def drop_incomplete(df: DataFrame) -> DataFrame:
    """keep rows with dt, lat, lon and aqi all present."""
    return df.dropna(subset=REQUIRED)


def dedupe_latest(df: DataFrame) -> DataFrame:
    """Option for H13: one row per (country, city, dt), the newest ingestion wins.

    Written as a max over a struct (ingestion time first, then every other field as a
    deterministic tie-break) so that the aggregate combines map-side: a group of copies
    that holds a third of all rows is reduced in each task before the shuffle.
    """
    rest = [c for c in RAW_COLUMNS if c not in ("country", "city", "dt", "ingestion_timestamp")]
    latest = F.max(F.struct("ingestion_timestamp", *rest)).alias("_latest")
    return (
        df.groupBy("country", "city", "dt")
        .agg(latest)
        .select("country", "city", "dt", "_latest.*")
        .select(*RAW_COLUMNS)
    )


def union_feeds(*feeds: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """UNION ALL of any number of raw feeds (one per country glob in the reference)."""
    if not feeds:
        raise ValueError("at least one feed is needed")
    return reduce(lambda a, b: a.unionByName(b), [f.select(*RAW_COLUMNS, *carry) for f in feeds])


def _stage(df: DataFrame, data_type: str, prefix: str, keep_incomplete: bool, dedupe: bool, carry: Sequence[str] = ()) -> DataFrame:
    """`carry`: further columns of the feed that come along, last."""
    if dedupe:
        if carry:
            raise ValueError("copies are merged: no column of theirs can be carried")
        df = dedupe_latest(df)
    if not keep_incomplete:
        df = drop_incomplete(df)
    return df.select(
        "ingestion_timestamp",
        "country",
        "city",
        F.col("dt").alias(f"{prefix}_timestamp"),
        "lat",
        "lon",
        "aqi",
        *[F.col(f"components.{p}").alias(p) for p in POLLUTANTS],
        F.lit(data_type).alias("data_type"),
        dq_flag().alias("is_data_quality_issue"),
        *time_parts("dt", prefix),
        *carry,
    )


def stage_historical(*feeds: DataFrame, keep_incomplete: bool = False, dedupe: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """stg_historical: the union of the historical feeds, staged."""
    return _stage(union_feeds(*feeds, carry=carry), "historical", "measurement", keep_incomplete, dedupe, carry)


def stage_current(feed: DataFrame, keep_incomplete: bool = False, dedupe: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """stg_current."""
    return _stage(feed, "current", "measurement", keep_incomplete, dedupe, carry)


def stage_forecast(feed: DataFrame, keep_incomplete: bool = False, dedupe: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """stg_forecast: as current with forecast_ names, plus creation date and hours_ahead.

    hours_ahead is an INTERVAL (forecast instant - ingestion instant), as published.
    """
    df = _stage(feed, "forecast", "forecast", keep_incomplete, dedupe, carry)
    return df.select(
        *[c for c in df.columns if c not in carry],
        F.to_date("ingestion_timestamp").alias("forecast_created_date"),
        (F.col("forecast_datetime") - F.col("ingestion_timestamp")).alias("hours_ahead"),
        *carry,
    )
