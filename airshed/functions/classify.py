"""Classifiers and derived metrics (C1-C30) as Column builders.

Every builder is a CASE chain made of pyspark.sql.functions, driven by the fixed
breakpoint tables below, so a class is computed JVM-side inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from airshed.functions.numeric import percentage, ratio, round2  # noqa: F401

# ---------------------------------------------------------------------------
# Fixed values. They must equal the published models' values for equal results.
# ---------------------------------------------------------------------------

# AQI classes: closed ranges [low, high] -> (category, code, health impact).
# A value between two ranges (50.5, 100.5, ...) or below 0 matches none.
AQI_RANGES = [
    (0, 50, "Good", 1, "Low"),
    (51, 100, "Moderate", 2, "Moderate"),
    (101, 150, "Unhealthy for Sensitive Groups", 3, "High for Sensitive Groups"),
    (151, 200, "Unhealthy", 4, "High"),
    (201, 300, "Very Unhealthy", 5, "Very High"),
]
AQI_ABOVE = (300, "Hazardous", 6, "Extreme")  # aqi > 300
AQI_OTHER = ("Unknown", 0, "Unknown")

# Primary pollutant: the first limit exceeded, in this order.
POLLUTANT_LIMITS = [
    ("pm2_5", 35, "PM2.5"),
    ("pm10", 150, "PM10"),
    ("o3", 100, "O3"),
    ("no2", 100, "NO2"),
    ("so2", 75, "SO2"),
    ("co", 10000, "CO"),
    ("nh3", 200, "NH3"),
]
POLLUTANT_OTHER = "Multiple/None"

# Pollution level: aqi <= bound, first match.
POLLUTION_LEVELS = [(50, "Clean"), (100, "Acceptable"), (150, "Concerning"), (200, "Poor"), (300, "Very Poor")]
POLLUTION_OTHER = "Critical"

# Time of day: hour BETWEEN low AND high. "Night" is written 22..5 and never matches.
TIME_OF_DAY = [(0, 5, "Midnight"), (6, 11, "Morning"), (12, 17, "Afternoon"), (18, 21, "Evening"), (22, 5, "Night")]
TIME_OF_DAY_OTHER = "Unknown"

# Daily rating (and monthly performance): avg aqi <= bound.
DAILY_RATINGS = [(50, "Excellent"), (100, "Good"), (150, "Moderate"), (200, "Poor")]
DAILY_RATING_OTHER = "Very Poor"

# Pollution load index weights, summed in this order; "no" is not used.
LOAD_WEIGHTS = [("pm2_5", 1.0), ("pm10", 0.5), ("o3", 0.8), ("no2", 0.7), ("so2", 0.6), ("co", 0.1), ("nh3", 0.3)]

# Pollution intensity: load > bound.
INTENSITY = [(100, "High Pollution Day"), (50, "Moderate Pollution Day")]
INTENSITY_OTHER = "Low Pollution Day"

# Seasons by calendar month (December joins January of the same year).
SEASONS = [((12, 1, 2), "Winter"), ((3, 4, 5), "Spring"), ((6, 7, 8), "Summer"), ((9, 10, 11), "Fall")]

# Day type: day of week 1 = Sunday, 7 = Saturday.
WEEKEND_DAYS = (1, 7)
BUSINESS_HOURS = (7, 19)

# Health flags.
UNHEALTHY_AQI = 100
VERY_UNHEALTHY_AQI = 150
PM2_5_LIMIT = 35
PM10_LIMIT = 150
UNHEALTHY_CATEGORIES = ("Unhealthy", "Very Unhealthy", "Hazardous")

# Health risk: share of unhealthy days > bound.
RISK_LEVELS = [(0.5, "High Risk"), (0.25, "Moderate Risk"), (0.1, "Low Risk")]
RISK_OTHER = "Minimal Risk"

# Country performance labels.
STATUS_BEST = "Best in Country"
STATUS_TOP3 = "Top 3 in Country"
STATUS_WORST = "Worst in Country"
STATUS_AVERAGE = "Average in Country"

# Forecast scoring: absolute error <= bound.
ACCURACY_RATINGS = [(10, "Excellent"), (25, "Good"), (50, "Fair")]
ACCURACY_OTHER = "Poor"
# Reliability score weights: category hit % and (excellent + good) %.
RELIABILITY_WEIGHTS = (0.6, 0.4)
# Quality rating: score >= bound.
QUALITY_RATINGS = [(80, "Highly Reliable"), (70, "Reliable"), (60, "Moderately Reliable"), (50, "Low Reliability")]
QUALITY_OTHER = "Unreliable"
# Horizon: lead hours <= bound.
HORIZONS = [(24, "Short-term (1 day)"), (72, "Medium-term (2-3 days)")]
HORIZON_OTHER = "Long-term (4+ days)"

# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _chain(cases: list[tuple[Column, object]], otherwise: object) -> Column:
    """CASE WHEN p1 THEN v1 ... ELSE otherwise END."""
    first, *rest = cases
    out = F.when(first[0], F.lit(first[1]))
    for pred, val in rest:
        out = out.when(pred, F.lit(val))
    return out.otherwise(F.lit(otherwise))


def aqi_category_code(aqi: Column | str) -> Column:
    """Category code 1..6 (Good .. Hazardous), else 0 (Unknown, gaps, NULL)."""
    a = _col(aqi)
    cases = [(a.between(lo, hi), code) for lo, hi, _, code, _ in AQI_RANGES]
    cases.append((a > AQI_ABOVE[0], AQI_ABOVE[2]))
    return _chain(cases, AQI_OTHER[1]).cast("bigint")


def _by_code(code: Column, labels: list[str]) -> Column:
    """Label of a category code: one array lookup instead of a second CASE chain."""
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (code + 1).cast("int"))


AQI_CATEGORY_BY_CODE = [AQI_OTHER[0]] + [r[2] for r in AQI_RANGES] + [AQI_ABOVE[1]]
HEALTH_IMPACT_BY_CODE = [AQI_OTHER[2]] + [r[4] for r in AQI_RANGES] + [AQI_ABOVE[3]]


def aqi_category(aqi: Column | str, code: Column | None = None) -> Column:
    """EPA category; values in the gaps between integer ranges are 'Unknown'.
    Pass an already computed `code` to avoid classifying twice."""
    return _by_code(aqi_category_code(aqi) if code is None else code, AQI_CATEGORY_BY_CODE)


def health_impact_level(aqi: Column | str, code: Column | None = None) -> Column:
    """Health impact label."""
    return _by_code(aqi_category_code(aqi) if code is None else code, HEALTH_IMPACT_BY_CODE)


def primary_pollutant(prefix: str = "") -> Column:
    """C4: first pollutant over its limit, in priority order (not the largest ratio)."""
    return _chain([(F.col(prefix + name) > limit, label) for name, limit, label in POLLUTANT_LIMITS], POLLUTANT_OTHER)


def pollution_level(aqi: Column | str) -> Column:
    """No gaps; negative values are 'Clean', NULL is 'Critical'."""
    a = _col(aqi)
    return _chain([(a <= b, label) for b, label in POLLUTION_LEVELS], POLLUTION_OTHER)


def time_of_day(hour: Column | str, fix_night: bool = False) -> Column:
    """Hour bucket. As published, 22 and 23 fall through to 'Unknown' (the 'Night'
    range is written 22..5, which BETWEEN never matches); fix_night=True makes it 22..23."""
    h = _col(hour)
    cases = [((h >= lo) if (fix_night and lo > hi) else h.between(lo, hi), label) for lo, hi, label in TIME_OF_DAY]
    return _chain(cases, TIME_OF_DAY_OTHER)


def is_weekend(dow: Column | str) -> Column:
    """day_of_week IN (1, 7)."""
    return F.when(_col(dow).isin(*WEEKEND_DAYS), F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def day_type(dow: Column | str) -> Column:
    """C18: 'Weekend' / 'Weekday'."""
    return F.when(_col(dow).isin(*WEEKEND_DAYS), F.lit("Weekend")).otherwise(F.lit("Weekday"))


def is_business_hours(hour: Column | str) -> Column:
    """Hour 7..19 inclusive."""
    return F.when(_col(hour).between(*BUSINESS_HOURS), F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def dominant_category(prefix: str = "hours_") -> Column:
    """The category with the most hours; ties go to the worse class, else 'Good'."""
    names = ["good", "moderate", "unhealthy_sensitive", "unhealthy", "very_unhealthy", "hazardous"]
    labels = [r[2] for r in AQI_RANGES] + [AQI_ABOVE[1]]
    top = F.greatest(*[F.col(prefix + n) for n in names])
    worst_first = list(zip(names, labels))[::-1][:-1]
    return _chain([(F.col(prefix + n) == top, label) for n, label in worst_first], labels[0])


def daily_rating(avg_aqi: Column | str) -> Column:
    """Excellent .. Very Poor by average aqi."""
    a = _col(avg_aqi)
    return _chain([(a <= b, label) for b, label in DAILY_RATINGS], DAILY_RATING_OTHER)


def pollution_load_index(prefix: str = "avg_") -> Column:
    """Weighted pollutant load, NULL as 0, rounded to 2 places."""
    terms = [F.coalesce(F.col(prefix + name), F.lit(0.0)) * F.lit(w) for name, w in LOAD_WEIGHTS]
    return round2(reduce(lambda a, b: a + b, terms))


def data_completeness_pct(total: Column | str, issues: Column | str) -> Column:
    """Share of rows without a quality issue, in percent."""
    t, i = _col(total), _col(issues)
    return round2((t - i).cast("double") / t.cast("double") * F.lit(100.0))


def pollution_intensity(load: Column | str) -> Column:
    """By pollution load index."""
    x = _col(load)
    return _chain([(x > b, label) for b, label in INTENSITY], INTENSITY_OTHER)


def season(month: Column | str) -> Column:
    """C17: meteorological season of a calendar month (NULL month -> NULL)."""
    m = _col(month)
    out = None
    for months, label in SEASONS:
        out = F.when(m.isin(*months), F.lit(label)) if out is None else out.when(m.isin(*months), F.lit(label))
    return out


def season_order(s: Column | str) -> Column:
    """Sort key: Winter 1, Spring 2, Summer 3, Fall 4."""
    c = _col(s)
    out = None
    for i, (_, label) in enumerate(SEASONS, start=1):
        out = F.when(c == label, F.lit(i)) if out is None else out.when(c == label, F.lit(i))
    return out


def health_risk_level(unhealthy: Column | str, total: Column | str) -> Column:
    """C20: share of unhealthy days; a zero total is 'Minimal Risk'."""
    r = ratio(_col(unhealthy), _col(total))
    return _chain([(r > b, label) for b, label in RISK_LEVELS], RISK_OTHER)


def country_performance_status(rank: Column | str, n_cities: Column | str) -> Column:
    """Best / Top 3 / Worst (rank >= n - 2) / Average. With n <= 3 'Worst' cannot occur."""
    r, n = _col(rank), _col(n_cities)
    return (
        F.when(r == 1, F.lit(STATUS_BEST))
        .when(r <= 3, F.lit(STATUS_TOP3))
        .when(r >= n - 2, F.lit(STATUS_WORST))
        .otherwise(F.lit(STATUS_AVERAGE))
    )


def accuracy_rating(abs_error: Column | str) -> Column:
    """Forecast error rating."""
    e = _col(abs_error)
    return _chain([(e <= b, label) for b, label in ACCURACY_RATINGS], ACCURACY_OTHER)


def reliability_score(hit_pct: Column | str, excellent: Column | str, good: Column | str, total: Column | str) -> Column:
    """round(hit% * 0.6 + (excellent + good) / total * 100 * 0.4, 2)."""
    w_hit, w_close = RELIABILITY_WEIGHTS
    close = ratio(_col(excellent) + _col(good), _col(total)) * F.lit(100.0) * F.lit(w_close)
    return round2(_col(hit_pct) * F.lit(w_hit) + close)


def quality_rating(score: Column | str) -> Column:
    """By reliability score (NULL -> 'Unreliable')."""
    s = _col(score)
    return _chain([(s >= b, label) for b, label in QUALITY_RATINGS], QUALITY_OTHER)


def forecast_horizon(lead_hours: Column | str) -> Column:
    """By lead time in hours."""
    h = _col(lead_hours)
    return _chain([(h <= b, label) for b, label in HORIZONS], HORIZON_OTHER)
