"""Backfill chunk planner (S11): split [start, end) into fixed-day pieces per city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_DAYS = 30  # fixed value: the published chunk size


def _c(x: Column | str | int) -> Column:
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(int(x)).cast("bigint")


def plan_chunks(cities: DataFrame, start: Column | str | int, end: Column | str | int, days: int = CHUNK_DAYS) -> DataFrame:
    """One row per (city, chunk): chunk (1-based), chunk_start, chunk_end epoch seconds.

    Pieces are [s, min(s + days, end)); the last is clipped; start >= end gives no
    chunk. Map-only: `sequence` + `posexplode` per city row, no join; `start` and
    `end` may be per-city columns or scalars.
    """
    step = days * 24 * 3600
    s, e = _c(start), _c(end)
    with_range = cities.select("*", s.alias("_start"), e.alias("_end"))
    # Spark's sequence raises on an empty range (start > stop), so the stop is never
    # below the start and the one spurious chunk of an empty range is filtered out.
    stop = F.greatest(F.col("_end") - 1, F.col("_start"))
    starts = F.sequence(F.col("_start"), stop, F.lit(step).cast("bigint"))
    exploded = with_range.select("*", F.posexplode(starts).alias("_pos", "chunk_start"))
    return exploded.filter(F.col("chunk_start") < F.col("_end")).select(
        *[c for c in cities.columns],
        (F.col("_pos") + 1).cast("bigint").alias("chunk"),
        F.col("chunk_start"),
        F.least(F.col("chunk_start") + step, F.col("_end")).alias("chunk_end"),
    )
