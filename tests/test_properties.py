
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def feeds(spark):
    return E._Feeds(spark, SF_SMALL)


def test_union_count_is_the_sum_of_parts(feeds):
    parts = feeds.stg_historical().count() + feeds.stg_current().count() + feeds.stg_forecast().count()
    assert feeds.unified().count() == parts == 1479 + 593 + 393  # FIXTURES.md


def test_classes_partition_the_rows(feeds):
    d = feeds.daily()
    bad = d.filter(
        F.col("hours_good") + F.col("hours_moderate") + F.col("hours_unhealthy_sensitive") + F.col("hours_unhealthy")
        + F.col("hours_very_unhealthy") + F.col("hours_hazardous") > F.col("total_measurements")
    )
    assert bad.count() == 0
    u = feeds.unified()
    known = u.filter(F.col("aqi_category") != "Unknown").count()
    assert known + u.filter(F.col("aqi_category") == "Unknown").count() == u.count()
    assert d.agg(F.sum("total_measurements")).first()[0] == u.count()


def test_quality_flag_is_always_zero_after_the_completeness_filter(feeds):
    # H2: F1 removes exactly the rows P5 would flag
    d = feeds.daily()
    assert d.filter(F.col("quality_issues") != 0).count() == 0
    assert d.filter(F.col("data_completeness_pct") != 100.0).count() == 0
    assert d.filter(F.col("night_hours") != 0).count() == 0  # H4


def test_ranks_are_one_to_n(feeds):
    r = feeds.rankings()
    for part, rank in [(["country", "measurement_year", "measurement_month"], "country_aqi_rank"),
                       (["measurement_year", "measurement_month"], "global_pollution_rank")]:
        w = Window.partitionBy(*part)
        chk = r.select(rank, F.count(F.lit(1)).over(w).alias("n"), F.sum(rank).over(w).alias("s"))
        assert chk.filter((F.col(rank) < 1) | (F.col(rank) > F.col("n")) | (F.col("s") != F.col("n") * (F.col("n") + 1) / 2)).count() == 0


def test_forecast_pairs_total(feeds):
    acc = feeds.accuracy()
    assert acc.agg(F.sum("total_forecasts")).first()[0] == 18  # FIXTURES.md, sf0.001
    row = acc.agg(*[F.sum(c) for c in ["excellent_forecasts", "good_forecasts", "fair_forecasts", "poor_forecasts"]]).first()
    assert sum(row) == 18
