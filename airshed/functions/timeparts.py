"""Time parts of an epoch-seconds instant (P6) and composite ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


SECONDS_PER_DAY = 86400
THURSDAY = 5  # 1970-01-01, in dayofweek numbering (1 = Sunday)


def time_parts(dt: Column | str, prefix: str = "measurement") -> list[Column]:
    """datetime, date, hour, day_of_week (1 = Sunday), month, year of epoch seconds `dt`.

    The parts are UTC by definition (TIMESTAMP_SECONDS), so day and hour come from
    integer arithmetic on the epoch seconds: no per-row time-zone conversion, and the
    result does not depend on the session zone. Parts are bigint (INT64).
    """
    secs = F.col(dt) if isinstance(dt, str) else dt
    day_no = F.floor(secs / F.lit(SECONDS_PER_DAY))  # days since 1970-01-01, floored
    date = F.date_from_unix_date(day_no.cast("int"))
    return [
        F.timestamp_seconds(secs).alias(f"{prefix}_datetime"),
        date.alias(f"{prefix}_date"),
        (F.pmod(secs, F.lit(SECONDS_PER_DAY)) / F.lit(3600)).cast("bigint").alias(f"{prefix}_hour"),
        (F.pmod(day_no + (THURSDAY - 1), F.lit(7)) + 1).cast("bigint").alias(f"{prefix}_day_of_week"),
        F.month(date).cast("bigint").alias(f"{prefix}_month"),
        F.year(date).cast("bigint").alias(f"{prefix}_year"),
    ]


def utc_date(ts: Column | str) -> Column:
    """The UTC day of an instant, whatever the session zone; NULL stays NULL."""
    micros = F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)
    day = F.lit(SECONDS_PER_DAY * 1_000_000)
    return F.date_from_unix_date(((micros - F.pmod(micros, day)) / day).cast("int"))


def ts_text(ts: Column | str) -> Column:
    """A UTC instant as the warehouse prints it: 'YYYY-MM-DD HH:MM:SS+00'."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("+00"))


def measurement_id(country: str = "country", city: str = "city", ts: str = "measurement_datetime") -> Column:
    """country_city_datetime; NULL if any part is NULL. Not unique across data types."""
    return F.concat(F.col(country), F.lit("_"), F.col(city), F.lit("_"), ts_text(ts))


def daily_summary_id(country: str = "country", city: str = "city", date: str = "measurement_date") -> Column:
    """country_city_date; NULL if any part is NULL."""
    return F.concat(F.col(country), F.lit("_"), F.col(city), F.lit("_"), F.date_format(F.col(date), "yyyy-MM-dd"))
