"""Monthly city statistics and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.functions import classify as C
from airshed.functions.numeric import percentage, round_dp

MONTH_KEYS = ["country", "city", "measurement_year", "measurement_month", "month_start_date"]


def rank_key(c: str) -> Column:
    """Order key for ranks: the value at 6 decimals.

    Monthly values are means of 2-decimal daily values over <= 31 days, so distinct
    true values differ by more than 1e-5; at 6 decimals floating sum-order noise
    cannot reorder them, and exact ties fall to the named tie-breakers.
    """
    return round_dp(c, 6)


def monthly_city_stats(daily: DataFrame) -> DataFrame:
    """A3: historical days only, per city and calendar month (averages of daily values)."""
    d = daily.filter(F.col("data_type") == "historical")
    dom = F.col("dominant_category")
    return d.groupBy(
        "country",
        "city",
        F.year("measurement_date").cast("bigint").alias("measurement_year"),
        F.month("measurement_date").cast("bigint").alias("measurement_month"),
        F.trunc("measurement_date", "month").alias("month_start_date"),
    ).agg(
        F.avg("avg_aqi_rounded").alias("monthly_avg_aqi"),
        F.avg("max_aqi").alias("monthly_max_aqi"),
        F.avg("aqi_variability").alias("monthly_aqi_variability"),
        F.avg("pollution_load_index").alias("monthly_pollution_load"),
        F.avg("avg_pm2_5").alias("monthly_avg_pm25"),
        F.avg("avg_pm10").alias("monthly_avg_pm10"),
        F.sum(F.when(dom.isin(*C.UNHEALTHY_CATEGORIES), 1).otherwise(0)).cast("bigint").alias("unhealthy_days"),
        F.count(F.lit(1)).alias("total_days"),
        F.sum(F.when(F.col("hours_hazardous") > 0, 1).otherwise(0)).cast("bigint").alias("hazardous_days"),
        F.avg("data_completeness_pct").alias("avg_data_completeness"),
    )


def rank_cities(monthly: DataFrame) -> DataFrame:
    """city_rankings: four row_number ranks, the city count, and the labels.

    Ties (H9) go to country, then city. The global ranks (by year, month) are taken
    first: their hash partitioning on (year, month) already clusters the country
    windows (country, year, month), so all five window columns share one shuffle.
    Window partitions hold one row per city and month, never raw measurements.
    """
    month = ["measurement_year", "measurement_month"]
    glob = Window.partitionBy(*month)
    ctry = Window.partitionBy("country", *month)
    aqi, load = rank_key("monthly_avg_aqi"), rank_key("monthly_pollution_load")
    ranked = (
        monthly.withColumn("global_aqi_rank", F.row_number().over(glob.orderBy(aqi, "country", "city")).cast("bigint"))
        .withColumn("global_pollution_rank", F.row_number().over(glob.orderBy(load, "country", "city")).cast("bigint"))
        .withColumn("country_aqi_rank", F.row_number().over(ctry.orderBy(aqi, "city")).cast("bigint"))
        .withColumn("country_pollution_rank", F.row_number().over(ctry.orderBy(load, "city")).cast("bigint"))
        .withColumn("_cities", F.count(F.lit(1)).over(ctry))
    )
    return ranked.select(
        *MONTH_KEYS,
        "monthly_avg_aqi",
        "monthly_max_aqi",
        "monthly_aqi_variability",
        "monthly_pollution_load",
        "monthly_avg_pm25",
        "monthly_avg_pm10",
        "unhealthy_days",
        "total_days",
        "hazardous_days",
        "avg_data_completeness",
        "country_aqi_rank",
        "country_pollution_rank",
        "global_aqi_rank",
        "global_pollution_rank",
        C.daily_rating("monthly_avg_aqi").alias("air_quality_performance"),
        C.health_risk_level("unhealthy_days", "total_days").alias("health_risk_level"),
        percentage("unhealthy_days", "total_days").alias("unhealthy_days_percentage"),
        percentage("hazardous_days", "total_days").alias("hazardous_days_percentage"),
        C.country_performance_status("country_aqi_rank", "_cities").alias("country_performance_status"),
        F.col("monthly_avg_aqi").alias("current_month_aqi"),
        F.col("monthly_pollution_load").alias("current_month_pollution"),
    )


def city_rankings(daily: DataFrame) -> DataFrame:
    """The rankings mart from the daily summary."""
    return rank_cities(monthly_city_stats(daily))
