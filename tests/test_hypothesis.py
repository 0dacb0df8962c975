"""Property tests: the column classifiers against plain-Python statements of the rules."""

import decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from airshed.functions import classify as C
from airshed.functions.numeric import round2


def py_category(x):
    if x is None:
        return "Unknown"
    for lo, hi, label in [(0, 50, "Good"), (51, 100, "Moderate"), (101, 150, "Unhealthy for Sensitive Groups"),
                          (151, 200, "Unhealthy"), (201, 300, "Very Unhealthy")]:
        if lo <= x <= hi:
            return label
    return "Hazardous" if x > 300 else "Unknown"


def py_level(x):
    if x is None:
        return "Critical"
    for b, label in [(50, "Clean"), (100, "Acceptable"), (150, "Concerning"), (200, "Poor"), (300, "Very Poor")]:
        if x <= b:
            return label
    return "Critical"


def py_round2(x):
    d = decimal.Decimal(repr(x)).quantize(decimal.Decimal("1e-10"), rounding=decimal.ROUND_HALF_UP)
    return float(d.quantize(decimal.Decimal("0.01"), rounding=decimal.ROUND_HALF_UP))


aqi_values = st.one_of(
    st.none(),
    st.integers(-5, 600).map(float),
    st.floats(-10, 700, allow_nan=False).map(lambda v: round(v, 3)),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(aqi_values, min_size=1, max_size=200))
def test_categories_and_levels(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select(C.aqi_category("x"), C.pollution_level("x"), C.aqi_category_code("x")).collect()
    assert [r[0] for r in got] == [py_category(v) for v in values]
    assert [r[1] for r in got] == [py_level(v) for v in values]
    labels = ["Unknown", "Good", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy", "Very Unhealthy", "Hazardous"]
    assert [labels[r[2]] for r in got] == [r[0] for r in got]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False), min_size=1, max_size=200))
def test_round2_is_half_up_on_decimal_digits(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(round2("x")).collect()] == [py_round2(v) for v in values]
