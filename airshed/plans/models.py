"""The model DAG: every published model as a named DataFrame function with its layer.

A Context holds the raw feeds and memoises each model's DataFrame, so a model is
defined once and referenced by its consumers (like a view), while each written
table is read back by later layers instead of being recomputed.

Every table's record holds what it was built from: the options that reach it and a signature of
the landed files (Context.fingerprint). A table that was built otherwise is not
taken for this run's: it is built anew, or refused.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.operators import daily, forecast, measurements, rankings, staging, temporal, unified
from airshed.sinks import commits
from airshed.sinks.publish import read_published
from airshed.sources.raw import SOURCE, Feed

UNIFIED = "int_air_quality_unified"
KINDS = ("historical", "current", "forecast")


class StaleTable(RuntimeError):
    """A written table was built from other files or with other options."""


@dataclass
class Context:
    spark: SparkSession
    historical: list[DataFrame]
    current: DataFrame
    forecast: DataFrame
    as_of: str | None = None
    keep_incomplete: bool = False
    dedupe: bool = False
    fix_night: bool = False
    written: str | None = None  # root of the tables of earlier runs
    refuse_stale: bool = False  # raise StaleTable where a table would be built anew
    feeds: dict[str, Feed] | None = None  # the landed feeds, if the frames come from a landing
    frames: dict[str, DataFrame] = field(default_factory=dict)
    within: Callable[[str], Callable | None] | None = None  # in a refresh: which partitions of a table are read
    _signatures: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_landing(cls, spark: SparkSession, root: str, **options) -> Context:
        feeds = {k: Feed(spark, root, k) for k in KINDS}
        return cls(spark, [feeds["historical"].read()], feeds["current"].read(), feeds["forecast"].read(), feeds=feeds, **options)

    @property
    def carry(self) -> list[str]:
        """The landed folder of each reading, where it can be told (copies that are merged have several)."""
        return [SOURCE] if self.feeds is not None and not self.dedupe else []

    def ref(self, name: str) -> DataFrame:
        """The model as built in this run, else as an earlier run wrote it, else built now."""
        if name not in self.frames:
            earlier = self._earlier(name)
            self.frames[name] = MODELS[name].build(self) if earlier is None else earlier
        return self.frames[name]

    def _earlier(self, name: str) -> DataFrame | None:
        if self.written is None or MODELS[name].materialized != "table":
            return None
        path = os.path.join(self.written, name)
        found = commits.latest(self.spark, path)
        if found is None:
            return None
        if self.within is None and found[1].get("fingerprint") != self.fingerprint(name):
            if self.refuse_stale:
                raise StaleTable(f"{name} was built with {found[1].get('fingerprint')}, not {self.fingerprint(name)}")
            return None
        return read_published(self.spark, path, self.within(name) if self.within else None)

    def fingerprint(self, name: str) -> dict[str, str]:
        """The options and landed files that a model's rows depend on."""
        out: dict[str, str] = {}
        for n in [name, *_upstream(name)]:
            for o in MODELS[n].options:
                out[o] = str(getattr(self, o)) if o != "as_of" or self.as_of else dt.datetime.now(dt.timezone.utc).date().isoformat()
            for kind in MODELS[n].feeds:
                out[f"files of {kind}"] = self._signature(kind)
        return out

    def _signature(self, kind: str) -> str:
        if kind not in self._signatures:
            if self.feeds is not None:
                rows = self.feeds[kind].listing().agg(F.count(F.lit(1)), F.sum(F.xxhash64(SOURCE, "signature").cast("decimal(38,0)"))).first()
                own = f"{rows[0]} {rows[1]}"
            else:
                frames = self.historical if kind == "historical" else [getattr(self, kind)]
                own = "\n".join(sorted(f for df in frames for f in df.inputFiles()))
            self._signatures[kind] = hashlib.sha256(own.encode()).hexdigest()[:16]
        return self._signatures[kind]

    def restricted(self, within: Callable[[str], Callable | None], frames: dict[str, DataFrame] | None = None) -> Context:
        """This context over some partitions of the written tables."""
        return replace(self, frames=dict(frames or {}), within=within)


@dataclass(frozen=True)
class Model:
    name: str
    layer: str  # staging | intermediate | marts
    materialized: str  # view | table
    build: Callable[[Context], DataFrame]
    needs: tuple[str, ...] = ()
    options: tuple[str, ...] = ()  # of the context, that its own step uses
    feeds: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    grain: str = "all"  # what of it a changed day changes: that "day", its "month", or "all"
    of: tuple[str, ...] = KINDS  # data types whose days matter to it


def _m(*args, **kw) -> Model:
    return Model(*args, **kw)


_STAGED = ("keep_incomplete", "dedupe")
_LIST = [
    _m("stg_air_quality_historical", "staging", "view",
       lambda c: staging.stage_historical(*c.historical, keep_incomplete=c.keep_incomplete, dedupe=c.dedupe, carry=c.carry),
       options=_STAGED, feeds=("historical",)),
    _m("stg_air_quality_current", "staging", "view",
       lambda c: staging.stage_current(c.current, keep_incomplete=c.keep_incomplete, dedupe=c.dedupe, carry=c.carry),
       options=_STAGED, feeds=("current",)),
    _m("stg_air_quality_forecast", "staging", "view",
       lambda c: staging.stage_forecast(c.forecast, keep_incomplete=c.keep_incomplete, dedupe=c.dedupe, carry=c.carry),
       options=_STAGED, feeds=("forecast",)),
    # Written (not a view): several consumers, and staging re-parses raw JSON.
    _m(UNIFIED, "intermediate", "table",
       lambda c: unified.unify(c.ref("stg_air_quality_historical"), c.ref("stg_air_quality_current"),
                               c.ref("stg_air_quality_forecast"), c.fix_night, c.carry),
       needs=("stg_air_quality_historical", "stg_air_quality_current", "stg_air_quality_forecast"), options=("fix_night",),
       partition_by=("data_type", "measurement_date"), cluster_by=("country", "city"), grain="day"),
    _m("int_air_quality_daily_summary", "intermediate", "table",
       lambda c: daily.daily_summary(c.ref(UNIFIED)),
       needs=(UNIFIED,), partition_by=("measurement_date",), cluster_by=("country", "city"), grain="day"),
    _m("int_air_quality_hourly_summary", "intermediate", "table",
       lambda c: daily.hourly_summary(c.ref(UNIFIED)),
       needs=(UNIFIED,), partition_by=("measurement_date",), cluster_by=("country", "city"), grain="day"),
    _m("int_air_quality_temporal_cells", "intermediate", "table",
       lambda c: temporal.temporal_cells(c.ref(UNIFIED)),
       needs=(UNIFIED,), partition_by=("measurement_year", "measurement_month"), cluster_by=("country", "city"), grain="month", of=("historical",)),
    _m("int_air_quality_forecast_days", "intermediate", "table",
       lambda c: forecast.day_errors(forecast.forecast_pair_stats(*forecast.from_unified(c.ref(UNIFIED)), forecast.EVERY_DAY)),
       needs=(UNIFIED,), partition_by=("forecast_date",), cluster_by=("country", "city"), grain="day", of=("current", "forecast")),
    _m("fct_air_quality_measurements", "marts", "table",
       lambda c: measurements.fct_measurements(c.ref(UNIFIED)),
       needs=(UNIFIED,), partition_by=("measurement_date",), cluster_by=("country", "city"), grain="day"),
    _m("fct_daily_air_quality_summary", "marts", "table",
       lambda c: daily.fct_daily_summary(c.ref("int_air_quality_daily_summary")),
       needs=("int_air_quality_daily_summary",), partition_by=("measurement_date",), cluster_by=("country", "city"), grain="day"),
    _m("city_air_quality_rankings", "marts", "table",
       lambda c: rankings.city_rankings(c.ref("int_air_quality_daily_summary")),
       needs=("int_air_quality_daily_summary",), partition_by=("measurement_year", "measurement_month"), cluster_by=("global_aqi_rank",), grain="month", of=("historical",)),
    _m("forecast_accuracy_analysis", "marts", "table",
       lambda c: forecast.accuracy_of_days(c.ref("int_air_quality_forecast_days"), c.as_of),
       needs=("int_air_quality_forecast_days",), options=("as_of",), cluster_by=("country", "city", "forecast_lead_time_hours"), of=("current", "forecast")),
    _m("temporal_air_quality_patterns", "marts", "table",
       lambda c: temporal.patterns_of(c.ref("int_air_quality_temporal_cells")),
       needs=("int_air_quality_temporal_cells",), cluster_by=("country", "city", "measurement_year"), of=("historical",)),
]

MODELS: dict[str, Model] = {m.name: m for m in _LIST}
LAYERS = ["staging", "intermediate", "marts"]


def _upstream(name: str) -> list[str]:
    out: list[str] = []
    for n in MODELS[name].needs:
        out += [x for x in (n, *_upstream(n)) if x not in out]
    return out
