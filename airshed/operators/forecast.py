"""Forecast against actual (D1, C23-C29, A10) without materialising pairs.

The published model joins every forecast to every actual reading of the same
(country, city, date, hour) and aggregates the pairs. That join is many-to-many:
a busy hour with n forecasts and m actuals emits n * m rows, all in one task.

Here each side is first reduced to (key, aqi value) -> count, which combines
map-side. A forecast value f then asks seven questions about the sorted actuals of its
key: what lies at or below f, and how many actuals lie at or below the last (below the
first) value within 10, 25 and 50 of f. Each question is one probe row among the actual
rows, and one running sum in ascending order answers them all; a second running minimum in
descending order gives the nearest actual above. Both frames grow by one row at a time, so
the work is linear in rows.

A key's rows are split by value bucket (at most 2 * BUCKETS + 1), so no hour sits in one
task. Count, mean and squared deviations of the actuals are kept per bucket and merged,
in order, to what lies before and after each bucket; as deviations from means are carried
and never squares of values, the variance does not cancel. That array comes from the actuals
alone and is handed to the rows by key, so each feed is staged once.

Errors are summed per (group, day) in the same way, by bucket of the mean error and then folded
over the buckets (day_errors); the mart folds the days. The days are mergeable: a day that
changes is worked out again by itself.

The bounds are decided by the published subtraction |f - a| <= b of doubles: the last value
within b above f is the greatest double y whose difference to f rounds to at most b.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.functions import classify as C
from airshed.functions.numeric import round2

KEY = ["country", "city", "forecast_date", "forecast_hour"]
CLASS_CODES = list(range(0, 7))  # 0 = Unknown, 1..6 = Good .. Hazardous
RATING_BOUNDS = [b for b, _ in C.ACCURACY_RATINGS]  # 10, 25, 50
BUCKET_WIDTH, BUCKETS = 8.0, 128  # values beyond +-1024 share the outermost buckets


def lead_time_hours(created_date: Column, forecast_ts: Column) -> Column:
    """Whole hours from midnight of the creation date, truncated toward zero."""
    return F.timestamp_diff("HOUR", created_date.cast("timestamp"), forecast_ts)


def _as_of_day(as_of: str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def _below(c: Column) -> Column:
    """The double next below c."""
    unit = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(F.abs(c), F.lit(1e-290)))) - 52)
    half = c - unit / 2  # differs from c only where it is the next one
    return F.when(half < c, half).otherwise(c - unit)


def _with_bounds(df: DataFrame, f: str) -> DataFrame:
    """df with lo{b} and hi{b}: the least and greatest double y with |f - y| <= b as the
    subtraction of doubles decides it. y - f rounds to at most b if and only if y <= f + b + h,
    h half a unit in b's last place (ties round to b, which is even). With s = f + b rounded and
    e what the rounding left out, that is the greatest double not above s + (e + h). The lower
    bound is the upper one of -f, negated."""
    names = [(side, b, f"_{side}{b}") for side in ("lo", "hi") for b in RATING_BOUNDS]
    x = {side: F.col(f) if side == "hi" else -F.col(f) for side in ("lo", "hi")}
    df = df.withColumns({f"{n}_s": x[side] + F.lit(float(b)) for side, b, n in names})
    df = df.withColumns({f"{n}_d": F.col(f"{n}_s") - x[side] for side, _, n in names})
    left = {n: (x[side] - (F.col(f"{n}_s") - F.col(f"{n}_d"))) + (F.lit(float(b)) - F.col(f"{n}_d")) for side, b, n in names}
    df = df.withColumns({f"{n}_t": left[n] + F.lit(2.0 ** (int(math.log2(b)) - 53)) for _, b, n in names})
    df = df.withColumns({f"{n}_c": F.col(f"{n}_s") + F.col(f"{n}_t") for _, _, n in names})
    y = {n: F.when(F.col(f"{n}_c") - F.col(f"{n}_s") <= F.col(f"{n}_t"), F.col(f"{n}_c")).otherwise(_below(F.col(f"{n}_c"))) for _, _, n in names}
    df = df.withColumns({f"{side}{b}": y[n] if side == "hi" else -y[n] for side, b, n in names})
    return df.drop(*[f"{n}_{k}" for _, _, n in names for k in "sdtc"])


def _bucket(v: Column) -> Column:
    return F.greatest(F.least(F.floor(v / BUCKET_WIDTH), F.lit(BUCKETS)), F.lit(-BUCKETS))


def _moments(n: Column, mean: Column, m2: Column) -> Column:
    return F.struct(n.cast("double").alias("n"), mean.alias("mean"), m2.alias("m2"))


def _merged(x: Column, y: Column) -> Column:
    """Count, mean and squared deviations of two sets together; no cancellation."""
    n = x["n"] + y["n"]
    gap = y["mean"] - x["mean"]
    both = _moments(n, x["mean"] + gap * (y["n"] / n), x["m2"] + y["m2"] + gap * gap * (x["n"] * y["n"] / n))
    return F.when(x["n"] == 0, y).when(y["n"] == 0, x).otherwise(both)


def _nothing() -> Column:
    return _moments(F.lit(0.0), F.lit(0.0), F.lit(0.0))


def _folded(entries: Column, take) -> Column:
    """Moments of an array's entries together, in order."""
    return F.aggregate(entries, _nothing(), lambda acc, x: _merged(acc, take(x)))


def _key_totals(a: DataFrame) -> DataFrame:
    """Per key of the actuals: `all`, an entry per value bucket in order (at most 2 * BUCKETS + 1) with the
    moments of its actuals about their mean and of those before and after it; the key's extremes and class counts."""
    na, v = F.col("n_a"), F.col("v")
    # deviations are taken from the bucket's middle, at most half a bucket away
    rows = a.select(*KEY, _bucket(v).alias("bucket"), "v", "n_a", C.aqi_category_code(v).alias("code"))
    code, d = F.col("code"), F.col("v") - (F.col("bucket") + 0.5) * BUCKET_WIDTH
    sums = rows.groupBy(*KEY, "bucket").agg(
        F.sum(na).alias("n"), F.sum(na * d).alias("s"), F.sum(na * d * d).alias("q"), F.min("v").alias("lo"), F.max("v").alias("hi"),
        *[F.sum(F.when(code == k, na).otherwise(0)).alias(f"k{k}") for k in CLASS_CODES],
    )
    n = F.greatest(F.col("n"), F.lit(1))
    own = _moments(F.col("n"), (F.col("bucket") + 0.5) * BUCKET_WIDTH + F.col("s") / n, F.greatest(F.col("q") - F.col("s") * F.col("s") / n, F.lit(0.0)))
    per_key = sums.groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.struct("bucket", own.alias("own"), "lo", "hi"))).alias("all"),
        F.sum("n").alias("N"), F.min("lo").alias("a_min"), F.max("hi").alias("a_max"), *[F.sum(f"k{k}").alias(f"k{k}") for k in CLASS_CODES],
    )

    def running(entries, near):
        """For each entry: the moments of those passed before it, and the last of their nearest values."""
        start = F.struct(_nothing().alias("sum"), F.lit(None).cast("double").alias("near"), F.array().cast("array<struct<m:struct<n:double,mean:double,m2:double>,near:double>>").alias("out"))

        def add(acc, x):
            seen = F.struct(acc["sum"].alias("m"), acc["near"].alias("near"))
            return F.struct(_merged(acc["sum"], x["own"]).alias("sum"), near(x).alias("near"), F.concat(acc["out"], F.array(seen)).alias("out"))

        return F.aggregate(entries, start, add, lambda acc: acc["out"])

    before = running(F.col("all"), lambda x: x["hi"])
    after = F.reverse(running(F.reverse("all"), lambda x: x["lo"]))
    zipped = F.arrays_zip(F.col("all").alias("e"), before.alias("before"), after.alias("after"))
    entry = F.transform(zipped, lambda z: F.struct(z["e"]["bucket"].alias("bucket"), z["e"]["own"].alias("own"), z["e"]["hi"].alias("hi"), z["before"].alias("before"), z["after"].alias("after")))
    return per_key.withColumn("whole", _folded(F.col("all"), lambda x: x["own"])).withColumn("all", entry)


def _entry(bucket: Column) -> Column:
    """The key's last entry at or below the bucket."""
    return F.try_element_at(F.filter("all", lambda x: x["bucket"] <= bucket), F.lit(-1))


def _passed(e: Column, bucket: Column) -> Column:
    """Moments of the key's actuals in the buckets before this one."""
    return F.when(e.isNull(), _nothing()).when(e["bucket"] == bucket, e["before"]["m"]).otherwise(_merged(e["before"]["m"], e["own"]))


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with what lies before and after the bucket of f, which may hold no actual, and the count before each bound's."""
    bounds = [f"{side}{b}" for b in RATING_BOUNDS for side in ("lo", "hi")]
    rows = rows.withColumns({f"_{x}": _entry(_bucket(F.col(f"v_{x}"))) for x in ["at", *bounds]})
    e, bucket = F.col("_at"), _bucket(F.col("v_at"))
    none, same = e.isNull(), e["bucket"] == bucket
    rows = rows.withColumns({
        "own": F.when(same, e["own"]).otherwise(_nothing()),
        "before": F.struct(_passed(e, bucket).alias("m"), F.when(same, e["before"]["near"]).otherwise(e["hi"]).alias("near")),
        "after": F.struct(F.when(none, F.col("whole")).otherwise(e["after"]["m"]).alias("m"), F.when(none, F.col("a_min")).otherwise(e["after"]["near"]).alias("near")),
        **{f"upto_{x}": (_passed(F.col(f"_{x}"), _bucket(F.col(f"v_{x}")))["n"] + F.col(f"c_{x}")).cast("bigint") for x in bounds},
    })
    return rows.drop("all", "whole", *[f"_{x}" for x in ["at", *bounds]])


EVERY_DAY = "every day"


def forecast_pair_stats(forecast: DataFrame, current: DataFrame, as_of: str | None = None) -> DataFrame:
    """Per (key, lead hours, forecast value): the pair statistics against actuals.

    Only forecasts dated as_of or later (F4) that have an actual reading in the same
    hour (F5) appear. as_of=None means today, as published; EVERY_DAY sets no bound. The bound holds for the
    actuals too, as the dates of a pair are equal: both scans read from as_of on.
    """
    if as_of != EVERY_DAY:
        forecast = forecast.filter(F.col("forecast_date") >= _as_of_day(as_of))
        current = current.filter(F.col("measurement_date") >= _as_of_day(as_of))
    f = (
        forecast
        .filter(F.col("aqi").isNotNull())
        .groupBy(
            *KEY,
            lead_time_hours(F.col("forecast_created_date"), F.col("forecast_datetime")).alias("forecast_lead_time_hours"),
            F.col("aqi").alias("f"),
        )
        .agg(F.count(F.lit(1)).alias("n_f"))
    )
    a = (
        current
        .filter(F.col("measurement_datetime").isNotNull() & F.col("aqi").isNotNull())
        .groupBy(
            "country",
            "city",
            F.col("measurement_date").alias("forecast_date"),
            F.col("measurement_hour").alias("forecast_hour"),
            F.col("aqi").alias("v"),
        )
        .agg(F.count(F.lit(1)).alias("n_a"))
    )
    # probes: a lower bound sorts before the actuals of its value (rank 0), f and the upper bounds after (2)
    fv = F.col("f")
    probes = [F.struct(F.lit("at").alias("probe"), fv.alias("v"), F.lit(2).alias("rank"))]
    for b in RATING_BOUNDS:
        probes.append(F.struct(F.lit(f"lo{b}").alias("probe"), F.col(f"lo{b}").alias("v"), F.lit(0).alias("rank")))
        probes.append(F.struct(F.lit(f"hi{b}").alias("probe"), F.col(f"hi{b}").alias("v"), F.lit(2).alias("rank")))
    asked = _with_bounds(f, "f").select(*KEY, "forecast_lead_time_hours", "f", "n_f", F.explode(F.array(*probes)).alias("p"))
    asked = asked.select(*KEY, "forecast_lead_time_hours", "f", "n_f", "p.probe", "p.v", "p.rank", F.lit(0).cast("bigint").alias("n_a"))
    none = {"forecast_lead_time_hours": "bigint", "f": "double", "n_f": "bigint", "probe": "string"}
    rows = asked.unionByName(a.select(*KEY, *[F.lit(None).cast(t).alias(c) for c, t in none.items()], "v", F.lit(1).alias("rank"), "n_a"))
    # the running sums come first, on narrow rows, and the probes of a forecast become one row before
    # the key's totals, which are wide, are joined: what a task sorts stays small
    rows = rows.withColumn("bucket", _bucket(F.col("v")))
    na, v = F.col("n_a"), F.col("v")
    split = Window.partitionBy(*KEY, "bucket")
    d = v - (F.col("bucket") + 0.5) * BUCKET_WIDTH
    up = split.orderBy("v", "rank").rowsBetween(Window.unboundedPreceding, 0)
    down = split.orderBy(F.col("v").desc(), F.col("rank").asc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({
        "c": F.sum(na).over(up), "s": F.sum(na * d).over(up), "q": F.sum(na * d * d).over(up),
        "near_lo": F.max(F.when(na > 0, v)).over(up), "near_hi": F.min(F.when(na > 0, v)).over(down),
    }).filter("probe IS NOT NULL")

    def of(probe, c):
        return F.max(F.when(F.col("probe") == probe, F.col(c)))

    bounds = [f"{side}{b}" for b in RATING_BOUNDS for side in ("lo", "hi")]
    answer = rows.groupBy(*KEY, "forecast_lead_time_hours", "f", "n_f").agg(
        *[of("at", c).alias(c) for c in ("c", "s", "q", "near_lo", "near_hi")],
        of("at", "v").alias("v_at"), *[of(x, c).alias(f"{c}_{x}") for x in bounds for c in ("v", "c")],
    )
    answer = _placed(answer.join(_key_totals(a), KEY))

    def moments(n, s, q):  # from sums of deviations from the bucket's mean
        k = F.greatest(n, F.lit(1))
        return F.when(n > 0, _moments(n, F.col("own.mean") + s / k, F.greatest(q - s * s / k, F.lit(0.0)))).otherwise(_nothing())

    # from the bucket's middle to its mean, about which deviations sum to zero over the bucket
    c, off = F.col("c"), F.when(F.col("own.n") > 0, F.col("own.mean") - (_bucket(F.col("v_at")) + 0.5) * BUCKET_WIDTH).otherwise(0.0)
    answer = answer.withColumns({"s": F.col("s") - c * off, "q": F.col("q") - 2 * off * F.col("s") + c * off * off})
    answer = answer.withColumns({
        "lower": moments(F.col("c"), F.col("s"), F.col("q")),
        "upper": moments(F.col("own.n") - F.col("c"), -F.col("s"), F.col("own.m2") - F.col("q")),
    })
    stats = answer.select(
        *KEY, "forecast_lead_time_hours", "f", "n_f", "N", "a_min", "a_max", *[f"k{k}" for k in CLASS_CODES],
        _merged(F.col("before.m"), F.col("lower")).alias("below"), _merged(F.col("upper"), F.col("after.m")).alias("above"),
        F.coalesce("near_lo", "before.near").alias("near_lo"), F.coalesce("near_hi", "after.near").alias("near_hi"),
        *[(F.col(f"upto_hi{b}") - F.col(f"upto_lo{b}")).alias(f"c{b}") for b in RATING_BOUNDS],
    )

    nf, N, f_ = F.col("n_f"), F.col("N"), F.col("f")
    f_code = C.aqi_category_code(f_)
    same_class = F.coalesce(*[F.when(f_code == k, F.col(f"k{k}")) for k in CLASS_CODES])
    # errors below are f - a, above a - f; an empty side weighs nothing
    under = _moments(F.col("below.n"), f_ - F.col("below.mean"), F.col("below.m2"))
    over = _moments(F.col("above.n"), F.col("above.mean") - f_, F.col("above.m2"))
    stats = stats.withColumns({"under": under, "over": over})
    return stats.withColumn("e", _merged(F.col("under"), F.col("over"))).select(
        *KEY,
        "forecast_lead_time_hours",
        f_.alias("forecasted_aqi"),
        C.aqi_category(f_).alias("forecasted_category"),
        nf.alias("forecasts"),
        (nf * N).alias("pairs"),
        (nf * N * F.col("e.mean")).alias("sum_abs_error"),
        (nf * (F.col("e.m2") + N * F.col("e.mean") * F.col("e.mean"))).alias("sum_sq_error"),
        (nf * F.col("e.m2")).alias("error_m2"),
        F.least(f_ - F.col("near_lo"), F.col("near_hi") - f_).alias("min_abs_error"),
        F.greatest(f_ - F.col("a_min"), F.col("a_max") - f_).alias("max_abs_error"),
        (nf * same_class).alias("category_hits"),
        *[(nf * F.col(f"c{b}")).alias(f"within_{b}") for b in RATING_BOUNDS],
    )


GROUP = ["country", "city", "forecast_lead_time_hours"]
CATEGORIES = [("good", "Good"), ("moderate", "Moderate"), ("unhealthy", "Unhealthy")]  # whose errors the mart shows
ADDED = ["sum_abs_error", "category_hits", *[f"within_{b}" for b in RATING_BOUNDS], *[f"{n}_{c}" for n, _ in CATEGORIES for c in ("error", "pairs")]]


def day_errors(pairs: DataFrame) -> DataFrame:
    """Per (country, city, lead hours, day) from the pair statistics: moments of the errors (n, mean,
    m2), extremes, and sums. Sums are taken per bucket of the mean error, about its middle, and the
    buckets (at most 2 * BUCKETS + 1) folded; everything combines map-side."""
    n, mean = F.col("pairs"), F.col("sum_abs_error") / F.col("pairs")
    cat = F.col("forecasted_category")
    rows = pairs.select(
        *GROUP, "forecast_date", "pairs", "error_m2", "min_abs_error", "max_abs_error", _bucket(mean).alias("bucket"), mean.alias("mean"), *ADDED[: 2 + len(RATING_BOUNDS)],
        *[F.when(cat == label, F.col(c)).alias(f"{name}_{short}") for name, label in CATEGORIES for c, short in (("sum_abs_error", "error"), ("pairs", "pairs"))],
    )
    d = F.col("mean") - (F.col("bucket") + 0.5) * BUCKET_WIDTH
    sums = rows.groupBy(*GROUP, "forecast_date", "bucket").agg(
        F.sum(n).alias("n"), F.sum(n * d).alias("s"), F.sum(F.col("error_m2") + n * d * d).alias("q"),
        F.min("min_abs_error").alias("min_error"), F.max("max_abs_error").alias("max_error"), *[F.sum(c).alias(c) for c in ADDED],
    )
    own = _moments(F.col("n"), (F.col("bucket") + 0.5) * BUCKET_WIDTH + F.col("s") / F.col("n"), F.greatest(F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.lit(0.0)))
    return _together(sums.withColumn("errors", own), [*GROUP, "forecast_date"], "bucket")


def _together(rows: DataFrame, group: list[str], within: str) -> DataFrame:
    """Rows of mergeable errors as one per group, folded in the order of `within`."""
    parts = F.sort_array(F.collect_list(F.struct(within, "errors")))
    out = rows.groupBy(*group).agg(parts.alias("parts"), F.min("min_error").alias("min_error"), F.max("max_error").alias("max_error"), *[F.sum(c).alias(c) for c in ADDED])
    return out.select(*group, _folded(F.col("parts"), lambda x: x["errors"]).alias("errors"), "min_error", "max_error", *ADDED)


def metrics_of_days(days: DataFrame) -> DataFrame:
    """A10 from the days' errors: exact pair counts, means, sample standard deviation, extremes,
    class errors and rating counts."""
    m = _together(days, GROUP, "forecast_date")
    n = F.col("errors.n")
    count = n.cast("bigint")
    return m.select(
        *GROUP,
        count.alias("total_forecasts"),
        (F.col("sum_abs_error") / n).alias("avg_absolute_error"),
        F.when(n > 1, F.sqrt(F.col("errors.m2") / (n - 1))).alias("error_stddev"),
        "min_error",
        "max_error",
        *[(F.col(f"{name}_error") / F.col(f"{name}_pairs")).alias(f"{name}_forecast_error") for name, _ in CATEGORIES],
        (F.col("category_hits") / n * F.lit(100.0)).alias("category_accuracy_percentage"),
        F.col("within_10").alias("excellent_forecasts"),
        (F.col("within_25") - F.col("within_10")).alias("good_forecasts"),
        (F.col("within_50") - F.col("within_25")).alias("fair_forecasts"),
        (count - F.col("within_50")).alias("poor_forecasts"),
    )


def accuracy_metrics(pairs: DataFrame) -> DataFrame:
    """A10 from the per-value pair statistics."""
    return metrics_of_days(day_errors(pairs))


def forecast_accuracy(forecast: DataFrame, current: DataFrame, as_of: str | None = None) -> DataFrame:
    """forecast_accuracy mart: metrics per (country, city, lead hours) and the scores."""
    return scored(accuracy_metrics(forecast_pair_stats(forecast, current, as_of)))


def accuracy_of_days(days: DataFrame, as_of: str | None = None) -> DataFrame:
    """The mart from days that have been worked out before (F4 holds here too)."""
    return scored(metrics_of_days(days.filter(F.col("forecast_date") >= _as_of_day(as_of))))


def scored(m: DataFrame) -> DataFrame:
    """The scores and ratings (C26-C29) beside the metrics."""
    score = C.reliability_score("category_accuracy_percentage", "excellent_forecasts", "good_forecasts", "total_forecasts")
    return m.select(
        "*",
        score.alias("forecast_reliability_score"),
        round2("avg_absolute_error").alias("avg_aqi_error"),
        round2("error_stddev").alias("error_variability"),
        C.quality_rating(score).alias("forecast_quality_rating"),
        C.forecast_horizon("forecast_lead_time_hours").alias("forecast_horizon"),
    )



def from_unified(unified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(forecast, current) as forecast_accuracy takes them, from the unified readings."""
    own = {"forecast_date": "measurement_date", "forecast_hour": "measurement_hour", "forecast_datetime": "measurement_datetime"}
    f = unified.filter(F.col("data_type") == "forecast").select("country", "city", "aqi", F.to_date("ingestion_timestamp").alias("forecast_created_date"), *[F.col(v).alias(k) for k, v in own.items()])
    return f, unified.filter(F.col("data_type") == "current")
