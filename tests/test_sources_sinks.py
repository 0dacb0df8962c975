"""Sources and sinks: readers, payload flattening, chunk plans, landing, publishing."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from airshed.operators import staging
from airshed.sinks import commits, landing, publish
from airshed.sources import chunks, cities, payloads, raw
from airshed.sources.schema import RAW

DAY = 86400


def raw_rows(spark, rows):
    return spark.createDataFrame(rows, RAW)


def rec(ts, country, city, dtv, aqi, co=1.0):
    comps = (co, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7)
    return (ts, country, city, 1.0, 2.0, dtv, aqi, comps)


T0 = dt.datetime(2024, 1, 1, 6, 0, tzinfo=dt.timezone.utc)
T1 = dt.datetime(2024, 1, 1, 12, 0, tzinfo=dt.timezone.utc)
T2 = dt.datetime(2024, 1, 2, 6, 0, tzinfo=dt.timezone.utc)


def test_city_dim_is_the_fixed_list(spark):
    df = cities.city_dim(spark)
    assert df.count() == 8
    assert sorted(r.country for r in df.select("country").distinct().collect()) == ["India", "Nigeria", "UK", "USA"]


@pytest.mark.parametrize("days,expected", [(0, 0), (30, 1), (31, 2), (61, 3)])
def test_chunk_plan(spark, days, expected):
    c = cities.city_dim(spark)
    start = 1704067200
    out = chunks.plan_chunks(c, start, start + days * DAY).collect()
    assert len(out) == expected * 8
    if expected:
        lon = sorted((r.chunk, r.chunk_start, r.chunk_end) for r in out if r.city == "London")
        assert lon[0][1] == start and lon[-1][2] == start + days * DAY
        assert all(b - a <= 30 * DAY for _, a, b in lon)
        assert all(lon[i][2] == lon[i + 1][1] for i in range(len(lon) - 1))


def _payload_frame(spark, responses):
    rows = [("UK", "London", 51.5, -0.12, T0, r) for r in responses]
    return spark.createDataFrame(rows, "country string, city string, lat double, lon double, ingestion_timestamp timestamp, response string")


ITEM = {"dt": 1704067200, "main": {"aqi": 2}, "components": {"co": 201.94, "no": 0.01, "no2": 0.77, "o3": 68.66, "so2": 0.64, "pm2_5": 0.5, "pm10": 0.54, "nh3": 0.12}}


def test_flatten_history_is_strict(spark):
    no_main = dict(ITEM)
    del no_main["main"]
    responses = [
        json.dumps({"list": [ITEM, ITEM]}),  # 2 records
        json.dumps({"coord": {}}),  # no list: nothing, not a failure
        json.dumps({"list": []}),  # empty list: nothing
        json.dumps({"list": [ITEM, no_main]}),  # one bad item rejects the response
        json.dumps({"list": [dict(ITEM, components={})]}),  # empty components is present
    ]
    responses += ["{not json", "[]", None, json.dumps({"list": [dict(ITEM, dt="x")]})]
    good, rejected = payloads.flatten_history(_payload_frame(spark, responses))
    assert good.count() == 3
    assert sorted(r.reason for r in rejected.collect()) == ["incomplete item"] + ["malformed"] * 4
    empty = good.filter(F.col("components.co").isNull()).count()
    assert empty == 1


def test_flatten_forecast_is_lenient(spark):
    no_main = {k: v for k, v in ITEM.items() if k != "main"}
    no_comp = {k: v for k, v in ITEM.items() if k != "components"}
    responses = [json.dumps({"list": [ITEM, no_main, no_comp]}), json.dumps({"nolist": 1}), json.dumps({"list": []})]
    out, rejected = payloads.flatten_forecast(_payload_frame(spark, responses + ["{not json"]))
    out = out.collect()
    assert len(out) == 3 and rejected.count() == 1
    assert sorted([r.aqi is None for r in out]) == [False, False, True]
    assert sum(r.components.co is None for r in out) == 1


def test_flatten_current_accepts_both_shapes(spark):
    responses = [json.dumps(ITEM), json.dumps({"list": [ITEM]}), json.dumps({})]
    out, rejected = payloads.flatten_current(_payload_frame(spark, responses + ["{not json"]))
    assert rejected.count() == 1
    out = out.collect()
    assert [r.aqi for r in out] == [2.0, 2.0, None]
    assert [r.dt for r in out] == [1704067200, 1704067200, None]


def test_flatten_joins_city_attributes_when_missing(spark):
    rows = [("UK", "London", T0, json.dumps(ITEM))]
    df = spark.createDataFrame(rows, "country string, city string, ingestion_timestamp timestamp, response string")
    out = payloads.flatten_current(df, cities.city_dim(spark))[0].collect()
    assert out[0].lat == 51.5072 and out[0].lon == -0.1276


def test_landing_is_keyed_by_range_and_chunk(spark, tmp_dir):
    hist = raw_rows(spark, [rec(T0, "UK", "London", 1704067200, 2.0), rec(T0, "UK", "New Town", 1704070800, 3.0),
                            rec(T0, "USA", "Boston", 1704067200, 1.0)])
    landing.land_historical(hist, tmp_dir, 1704067200, 1706659200)
    landing.land_historical(hist, tmp_dir, 1704067200, 1706659200)  # the same load again replaces itself
    assert raw.read_historical(spark, tmp_dir).count() == 3
    assert raw.read_historical(spark, tmp_dir, ["UK"]).count() == 2
    later = raw_rows(spark, [rec(T2, "UK", "London", 1704067200, 5.0)])
    landing.land_historical(later, tmp_dir, 1704067200, 1709251200)  # another end date adds a second copy
    back = raw.read_historical(spark, tmp_dir)
    assert back.count() == 4
    from airshed.operators import quality
    st = staging.stage_historical(back)
    assert quality.check_duplicates(st).collect()[0].duplicate_count == 2
    dd = staging.stage_historical(back, dedupe=True)
    assert dd.count() == 3 and dd.filter("city = 'London'").collect()[0].aqi == 5.0


def test_current_landing_overwrites_same_day_only(spark, tmp_dir):
    landing.land_current(raw_rows(spark, [rec(T0, "UK", "London", 1, 1.0), rec(T0, "USA", "Boston", 1, 1.0)]), tmp_dir)
    landing.land_current(raw_rows(spark, [rec(T2, "UK", "London", 2, 2.0)]), tmp_dir)  # next day
    landing.land_current(raw_rows(spark, [rec(T1, "UK", "London", 3, 3.0)]), tmp_dir)  # same day as T0, later run
    got = sorted((r.country, r.dt) for r in raw.read_current(spark, tmp_dir).collect())
    assert got == [("UK", 2), ("UK", 3), ("USA", 1)]


def test_register_sources(spark, tmp_dir):
    one = lambda c, t, a: raw_rows(spark, [rec(T0, c, t, 1, a)])
    landing.land_historical(one("UK", "London", 1.0), tmp_dir, 0, DAY)
    landing.land_historical(one("UK", "London", 7.0), tmp_dir, 0, DAY)  # replaces it
    landing.land_historical(one("USA", "1984", 2.0), tmp_dir, 0, DAY)
    landing.write_load(one("UK", "Leeds", 3.0), os.path.join(tmp_dir, "historical"), 0, DAY)  # not committed
    landing.land_current(one("UK", "London", 1.0), tmp_dir)
    landing.land_forecast(one("UK", "London", 1.0), tmp_dir, run="06")
    names = raw.register_sources(spark, tmp_dir, ["UK", "USA"], "lake")
    assert set(names) == {f"lake.ext_air_quality_{n}" for n in ("raw_UK", "raw_USA", "current_all", "forecast_all")}
    other = spark.newSession()  # the catalog outlives the session that wrote it
    assert [(r.city, r.aqi, r.components.no) for r in other.table("lake.ext_air_quality_raw_UK").collect()] == [("London", 7.0, 0.1)]
    assert [r.city for r in other.table("lake.ext_air_quality_raw_USA").collect()] == ["1984"]
    for kind in ("current", "forecast"):
        assert other.table(f"lake.ext_air_quality_{kind}_all").select(raw.RAW_COLUMNS).collect()[0].aqi == 1.0
    landing.land_current(raw_rows(spark, [rec(T2, "UK", "London", 2, 2.0)]), tmp_dir)
    spark.sql("REFRESH TABLE lake.ext_air_quality_current_all")
    assert spark.table("lake.ext_air_quality_current_all").filter("ingest_date = '2024-01-02'").count() == 1
    for name, about in names.items():
        shown = {r.col_name: (r.data_type, r.comment) for r in other.sql(f"DESCRIBE EXTENDED {name}").collect()}
        assert shown["Comment"][0] == about and shown["dt"][1] == raw.COLUMN_COMMENTS["dt"], name
    assert "Lagos" in raw.SOURCE_DESCRIPTIONS["ext_air_quality_raw_Nigeria"]


def test_publish_read_mart_and_csv(spark, tmp_dir):
    df = spark.createDataFrame([(dt.date(2024, 1, d), "c%d" % (d % 3), float(d)) for d in range(1, 11)],
                               "measurement_date date, city string, v double")
    path = os.path.join(tmp_dir, "mart")
    publish.publish(df, path=path, partition_by=["measurement_date"], cluster_by=["city"])
    version = [p for p in os.listdir(path) if p.startswith("_version=")]
    assert len(version) == 1 and len([p for p in os.listdir(os.path.join(path, version[0])) if p.startswith("measurement_date=")]) == 10
    top = raw.read_mart(spark, path, order="measurement_date", limit=3).collect()
    assert [r.measurement_date.day for r in top] == [10, 9, 8]
    csv = os.path.join(tmp_dir, "csv")
    df.write.option("header", True).csv(csv)
    back = raw.read_mart_csv(spark, csv, df.schema)
    assert back.schema == df.schema and back.count() == 10


def test_long_fact_layout(spark, tmp_dir):
    from airshed.operators import unified

    st = staging.stage_historical(raw_rows(spark, [rec(T0, "UK", "London", 1704067200, 2.0),
                                                    (T0, "UK", "London", 1.0, 2.0, 1704153600, 3.0, None)]))
    empty = spark.createDataFrame([], RAW)
    u = unified.unify(st, staging.stage_current(empty), staging.stage_forecast(empty))
    long = publish.to_long(u)
    rows = long.collect()  # every parameter of every reading; a missing value stays, as NULL
    assert len(rows) == 16 and sum(r.value is None for r in rows) == 8 and {r.data_type for r in rows} == {"historical"}
    path = os.path.join(tmp_dir, "fact_long")
    publish.write_fact_long(long, path)
    assert sorted(commits.latest(spark, path)[1]["rows"].items()) == [("date_local_day=2024-01-01", 8), ("date_local_day=2024-01-02", 8)]


def test_current_landing_can_keep_every_run(spark, tmp_dir):
    landing.land_current(raw_rows(spark, [rec(T0, "UK", "London", 1, 1.0)]), tmp_dir)
    for _ in range(2):  # a retried run adds nothing
        landing.land_current(raw_rows(spark, [rec(T1, "UK", "London", 3, 3.0)]), tmp_dir, run="12")
    landing.land_current(raw_rows(spark, [rec(T2, "UK", "London", 4, 4.0)]), tmp_dir, run="12")
    assert sorted(r.dt for r in raw.read_current(spark, tmp_dir).collect()) == [1, 3, 4]


def test_landing_days_are_utc_whatever_the_session_zone(spark, tmp_dir):
    zone = spark.conf.get("spark.sql.session.timeZone")
    early, late = (dt.datetime(2024, 3, 1, h, tzinfo=dt.timezone.utc) for h in (2, 23))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        landing.land_current(raw_rows(spark, [rec(early, "UK", "London", 1, 1.0)]), tmp_dir)
        landing.land_current(raw_rows(spark, [rec(late, "UK", "London", 2, 2.0), rec(None, "UK", "London", 3, 3.0)]), tmp_dir)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted(os.listdir(os.path.join(tmp_dir, "current", "country=UK"))) == ["ingest_date=2024-03-01", "ingest_date=__HIVE_DEFAULT_PARTITION__"]
    assert sorted(r.dt for r in raw.read_current(spark, tmp_dir).collect()) == [2, 3]


def test_loads_do_not_replace_each_other_and_uncommitted_ones_are_not_there(spark, tmp_dir, monkeypatch):
    land = lambda day, aqi: landing.land_historical(raw_rows(spark, [rec(T0, "UK", "London", day * DAY, aqi)]), tmp_dir, day * DAY, (day + 1) * DAY)
    got = lambda: sorted((r.dt // DAY, r.aqi) for r in raw.read_historical(spark, tmp_dir).collect())
    land(3, 1.0)
    land(5, 2.0)  # another day of the same 30
    assert got() == [(3, 1.0), (5, 2.0)]
    land(5, 2.0)  # the same load again
    assert got() == [(3, 1.0), (5, 2.0)]

    def killed(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(landing.commits, "append", killed)
    with pytest.raises(RuntimeError):
        land(3, 9.0)
    with pytest.raises(RuntimeError):
        land(7, 9.0)
    monkeypatch.undo()
    assert got() == [(3, 1.0), (5, 2.0)] and len(os.listdir(os.path.join(tmp_dir, "historical", "data"))) == 5
    land(3, 9.0)  # the retry
    assert got() == [(3, 9.0), (5, 2.0)]
    assert landing.clean_up(spark, tmp_dir, hours=24) == 2 and landing.clean_up(spark, tmp_dir, hours=0) == 2  # replaced; left behind
    assert got() == [(3, 9.0), (5, 2.0)]
    with pytest.raises(Exception, match="outside the load's range"):
        landing.land_historical(raw_rows(spark, [rec(T0, "UK", "London", 9 * DAY, 1.0)]), tmp_dir, 0, 5 * DAY)
    with pytest.raises(ValueError):
        landing.land_historical(raw_rows(spark, []), tmp_dir, 5, 5)
    landing.land_historical(raw_rows(spark, []), tmp_dir, 0, 5)  # nothing to commit
    assert got() == [(3, 9.0), (5, 2.0)]
    landing.land_historical(raw_rows(spark, [rec(T0, "UK", "London", 10 * DAY, 4.0), rec(T0, "UK", "York", None, 5.0)]), tmp_dir, 9 * DAY, 10 * DAY)  # the end itself
    assert sorted(r.aqi for r in raw.read_historical(spark, tmp_dir, ["UK"]).collect()) == [2.0, 4.0, 5.0, 9.0]


def test_published_orders(spark):
    from airshed.operators import reads

    df = spark.createDataFrame([("A", "x", 2024, "Fall"), ("A", "x", 2024, "Winter"), ("A", "x", 2024, "Summer")],
                               "country string, city string, measurement_year int, season string")
    got = [r.season for r in reads.in_published_order(df, "temporal_air_quality_patterns").collect()]
    assert got == ["Winter", "Summer", "Fall"]


@pytest.mark.parametrize("k", [1, 7, 500, 5000])
def test_newest_first_equals_a_full_sort(spark, k):
    import __spark_entry__ as E
    from airshed.operators import reads

    from conftest import SF_SMALL

    fact = E._Feeds(spark, SF_SMALL).fct_daily()
    tie = ["country", "city", "data_type"]
    got = [tuple(r) for r in reads.newest_first(fact, "measurement_date", k, tie).select("daily_summary_id", "data_type").collect()]
    want = [tuple(r) for r in fact.orderBy(F.col("measurement_date").desc(), *tie).limit(k).select("daily_summary_id", "data_type").collect()]
    assert got == want and len(got) == min(k, fact.count())


def test_newest_first_keeps_null_orders(spark):
    from airshed.operators import reads

    day = dt.date
    df = spark.createDataFrame([(day(2024, 1, 1), 1), (day(2024, 1, 2), 2), (None, 3), (None, 4), (day(2024, 1, 2), 5)], "d date, i int")
    for k in (1, 2, 3, 4, 5, 10, None):
        want = [5, 2, 1, 4, 3][: k or 5]
        assert [r.i for r in reads.newest_first(df, "d", k, [F.col("i").desc()]).collect()] == want
    for col in ("cast(d as timestamp)", "cast(i as double)", "cast(d as string)"):
        by = df.withColumn("o", F.expr(col))
        assert [r.i for r in reads.newest_first(by, "o", 3, ["i"]).collect()] == [r.i for r in by.orderBy(F.col("o").desc(), "i").limit(3).collect()]
    assert reads.newest_first(df.filter("d is null"), "d", 1, ["i"]).collect()[0].i == 3 and reads.newest_first(df.limit(0), "d", 3).count() == 0


def test_partitioned_write_makes_files_by_size_not_by_task(spark, tmp_dir):
    df = spark.range(0, 4000, 1, 8).selectExpr("date_add(date'2024-01-01', cast(id % 100 as int)) AS day", "id")
    path = os.path.join(tmp_dir, "days")
    publish.publish(df, path=path, partition_by=["day"])
    files = [f for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    assert len(files) <= 110 and publish.read_published(spark, path).count() == 4000


def test_a_publish_that_fails_leaves_the_last_mart_and_open_readers_keep_theirs(spark, tmp_dir):
    path = os.path.join(tmp_dir, "mart")
    days = lambda n, plus=0: spark.range(n).selectExpr("date_add(date'2024-01-01', cast(id % 3 as int)) AS day", f"id + {plus} AS id", "'x' AS _hidden")
    publish.publish(days(30), path=path, partition_by=["day"])
    opened = publish.read_published(spark, path)
    fails = days(30).withColumn("id", F.when(F.col("id") == 29, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="half-way"):
        publish.publish(fails, path=path, partition_by=["day"])
    assert publish.read_published(spark, path).count() == 30
    publish.publish(days(6, 100), path=path, partition_by=["day"])
    assert opened.agg(F.max("id")).first()[0] == 29 and publish.read_published(spark, path).agg(F.min("id")).first()[0] == 100
    # some partitions: the others stay where they are, one that has no rows any more goes
    draft = publish.write_version(days(7, 200).filter("day = '2024-01-01'"), path, ["day"])
    publish.commit(spark, draft, ["day=2024-01-01", "day=2024-01-03"])
    got = sorted((r.day.day, r.id) for r in publish.read_published(spark, path).collect())
    assert got == [(1, 200), (1, 203), (1, 206), (2, 101), (2, 104)]
    assert publish.read_published(spark, path).columns == ["day", "id"] and publish.read_published(spark, path, hidden=True).columns[-1] == "_hidden"
    with pytest.raises(ValueError, match="outside"):
        publish.commit(spark, publish.write_version(days(3), path, ["day"]), ["day=2024-01-01"])
    for k in range(3):
        publish.publish(days(3, k), path=path, partition_by=["day"])
    named = {v for r in (commits.read(spark, path, n)[0] for n in commits.numbers(spark, path)[-2:]) for v in r["partitions"].values()}
    there = {d.split("=")[1] for d in os.listdir(path) if d.startswith("_version=")}
    assert named <= there and len(there) <= 4  # what no kept record names goes (a draft that failed stays)
    publish.publish(days(0), path=path, partition_by=["day"])
    assert publish.read_published(spark, path).count() == 0


def test_records_never_replace_each_other(spark, tmp_dir, monkeypatch):
    assert commits.latest(spark, tmp_dir) is None
    assert commits.append(spark, tmp_dir, [{"a": 1}]) == 1
    monkeypatch.setattr(commits, "numbers", lambda *_: [])  # as one that has not seen the first
    assert commits.append(spark, tmp_dir, [{"a": 2}]) == 2
    monkeypatch.undo()
    assert [commits.read(spark, tmp_dir, n)[0]["a"] for n in commits.numbers(spark, tmp_dir)] == [1, 2]


def test_published_names_move_at_once_and_bucketed_tables_spare_shuffles(spark, tmp_dir):
    from airshed.operators import daily, rankings, temporal, unified

    rows = [rec(T0, "UK", f"c{i % 9}", 1704067200 + i * 7200, float(i % 400)) for i in range(600)]
    empty = spark.createDataFrame([], RAW)
    u = unified.unify(staging.stage_historical(raw_rows(spark, rows)), staging.stage_current(empty), staging.stage_forecast(empty))
    publish.publish_bucketed(u, "bucketed_unified", 4, "city", ["country", "measurement_datetime"], path=os.path.join(tmp_dir, "b"), comment="unified, by city")
    t = raw.read_mart(spark, "bucketed_unified")
    conf = spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    for df in (temporal.temporal_cells(t), rankings.monthly_city_stats(daily.daily_summary(t))):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text, text
    one = t.filter("city = 'c3'")
    assert "SelectedBucketsCount: 1 out of 4" in one.groupBy("city").count()._jdf.queryExecution().executedPlan().toString() and conf
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(temporal.temporal_cells(t).drop("avg_aqi", "aqi_stddev"), temporal.temporal_cells(u).drop("avg_aqi", "aqi_stddev")) and one.count() == u.filter("city = 'c3'").count()
    for n in (5, 6, 7):
        publish.publish_bucketed(u.limit(n), "bucketed_unified", 4, path=os.path.join(tmp_dir, "b"))
        assert spark.table("bucketed_unified").count() == n
    assert len([r for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith("bucketed_unified__")]) == publish.KEEP
    spark.sql("DROP VIEW bucketed_unified")


def test_a_mart_by_name(spark, tmp_dir):
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    df = spark.createDataFrame([(1, "a'b"), (2, "c")], "k int, v string")
    publish.publish(df, table="mart_by_name", partition_by=["v"], comment="it's a mart")
    opened = spark.table("mart_by_name")
    publish.publish(df.limit(0), table="mart_by_name")
    assert raw.read_mart(spark, "mart_by_name").count() == 0 and sorted(r.v for r in opened.collect()) == ["a'b", "c"]
    spark.sql("DROP VIEW mart_by_name")
    commits.delete(spark, f"{warehouse}/mart_by_name")


def test_preview_is_any_rows(spark):
    from airshed.operators import reads

    assert reads.preview(spark.range(50), 20).count() == 20 and reads.preview(spark.range(5), 20).count() == 5


def test_submitted_settings_win(monkeypatch):
    from airshed import session

    monkeypatch.setattr(session.SparkContext, "_active_spark_context", None)
    monkeypatch.delenv("PYSPARK_GATEWAY_PORT", raising=False)
    monkeypatch.setenv("PYSPARK_SUBMIT_ARGS", "--conf spark.executor.extraJavaOptions=-XX:+UseG1GC --conf spark.sql.adaptive.enabled=false pyspark-shell")
    put = {}

    class Builder:
        def appName(self, name):
            return self

        def config(self, k, v):
            put[k] = v
            return self

        def getOrCreate(self):
            raise StopIteration

    monkeypatch.setattr(session.SparkSession, "builder", Builder())
    with pytest.raises(StopIteration):
        session.build_session(**{"spark.sql.shuffle.partitions": "3"})
    assert put["spark.executor.extraJavaOptions"] == f"-XX:+UseG1GC {session.JIT_HUGE}" and put["spark.sql.shuffle.partitions"] == "3"
    assert "spark.sql.adaptive.enabled" not in put and put["spark.sql.session.timeZone"] == "UTC"
