"""Refresh of the written tables: only what new landed files change.

1. The landed folders are listed and compared with the lineage of the unified table.
2. A changed folder changes the days it had readings of (from the lineage) and those it has now
   (read from that folder alone). For these (data type, day) partitions the unified
   table is built anew from all folders that hold such days, and from no others.
3. Each table then rebuilds its own days, or the months around them, from just those
   partitions of the table before it; a table with one result over all days (scores by
   lead time, patterns by city) is folded anew from small per-day or per-month tables.

Every step commits a version of its table that keeps all other partitions where they are.
A table's record names the record of the unified table that it has followed, so a refresh
that was cut short, or that some table missed, is caught up with: the days of all
records since are taken together. Where files cannot be told apart (copies merged by
dedupe), nothing is written yet, or options differ, all tables are built in full.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.operators import staging, unified
from airshed.plans import lineage
from airshed.plans.models import KINDS, MODELS, UNIFIED, Context, Model
from airshed.plans.pipeline import Step, build_table, run_pipeline
from airshed.session import use_utc
from airshed.sinks import commits
from airshed.sinks.publish import partition_name, partition_values, publish_view, read_published
from airshed.sources.raw import SOURCE

MOST_DAYS = 1_000  # (data type, day) partitions rebuilt one by one; beyond, a full build is less work
STAGE = {"historical": staging.stage_historical, "current": staging.stage_current, "forecast": staging.stage_forecast}


def refresh_tables(spark: SparkSession, ctx: Context, out_root: str) -> list[Step]:
    """Bring every written table up to date with the landed files; in full where that is needed."""
    use_utc(spark)
    ctx.written = out_root
    tables = [m for m in MODELS.values() if m.materialized == "table"]
    if not ctx.carry or not all(_same_options(ctx, m) for m in tables):
        return run_pipeline(spark, ctx, out_root, [m.name for m in MODELS.values()])
    days = _changed_days(ctx)
    if len(days) > MOST_DAYS:
        return run_pipeline(spark, ctx, out_root, [m.name for m in MODELS.values()])
    steps: list[Step] = []
    for model in tables:
        try:
            done = _rebuild_unified(ctx, model, days) if model.name == UNIFIED else _rebuild(ctx, model)
            publish_view(read_published(spark, _path(ctx, model)), model.name)
            steps.append(Step(model.name, True, done))
        except Exception as e:  # noqa: BLE001 - the runner reports and stops
            steps.append(Step(model.name, False, f"{type(e).__name__}: {e}"))
            break
    return steps


def _path(ctx: Context, model: Model) -> str:
    return os.path.join(ctx.written, model.name)


def _same_options(ctx: Context, model: Model) -> bool:
    """Whether the table is there, followed the unified table, and differs from this context in files at most."""
    found = commits.latest(ctx.spark, _path(ctx, model))
    if found is None or (model.name == UNIFIED and not found[1].get("lineage")) or (model.name != UNIFIED and not found[1].get("unified")):
        return False
    plain = [{k: v for k, v in x.items() if not k.startswith("files of") and k != "as_of"} for x in (found[1].get("fingerprint", {}), ctx.fingerprint(model.name))]
    return plain[0] == plain[1]


def _staged(ctx: Context, kind: str, sources: list[str]) -> DataFrame:
    """The unified readings of some landed folders of a feed."""
    raw = {k: ctx.feeds[k].read(sources if k == kind else []) for k in KINDS}
    frames = {k: STAGE[k](raw[k], keep_incomplete=ctx.keep_incomplete, carry=ctx.carry) for k in KINDS}
    return unified.unify(frames["historical"], frames["current"], frames["forecast"], ctx.fix_night, ctx.carry).filter(F.col("data_type") == kind)


def _changed_days(ctx: Context) -> set[tuple]:
    """(data type, day as text or None) whose readings the changed folders change."""
    path = os.path.join(ctx.written, UNIFIED)
    changed = lineage.changed_folders(ctx, path).collect()
    if not changed:
        return set()
    names = ctx.spark.createDataFrame([(r["data_type"], r[SOURCE]) for r in changed], f"data_type string, {SOURCE} string")
    had = lineage.read(ctx, path).filter("has_rows").join(F.broadcast(names), ["data_type", SOURCE], "left_semi").select("data_type", "measurement_date")
    for kind in KINDS:
        now = [r[SOURCE] for r in changed if r["data_type"] == kind and r["there"]]
        if now:
            had = had.union(_staged(ctx, kind, now).select("data_type", "measurement_date"))
    rows = had.distinct().collect()
    return {(r["data_type"], None if r["measurement_date"] is None else r["measurement_date"].isoformat()) for r in rows}


def _rebuild_unified(ctx: Context, model: Model, days: set[tuple]) -> str:
    path = _path(ctx, model)
    if not days:
        if lineage.changed_folders(ctx, path).isEmpty():
            return "as it was"
    else:
        known = lineage.read(ctx, path)
    frames = []
    for kind in KINDS:
        mine = {d for d in days if d[0] == kind}
        if not mine:
            continue
        held = {r[SOURCE] for r in known.filter("has_rows").filter(lineage.in_days(mine)).select(SOURCE).distinct().collect()}
        changed = lineage.changed_folders(ctx, path).filter(F.col("data_type") == kind).collect()
        sources = sorted((held - {r[SOURCE] for r in changed}) | {r[SOURCE] for r in changed if r["there"]})
        frames.append(_staged(ctx, kind, sources).filter(lineage.in_days(mine)))
    df = frames[0] if frames else read_published(ctx.spark, path, lambda v: False, hidden=True)
    for f in frames[1:]:
        df = df.unionByName(f)
    replaced = [partition_name({"data_type": t, "measurement_date": d}) for t, d in days]
    build_table(ctx, model, df, path, replaced)
    return f"{len(days)} days"


def _days_since(ctx: Context, model: Model) -> set[str | None] | None:
    """Days that records of the unified table have changed since the one this table followed; None: all."""
    path = os.path.join(ctx.written, UNIFIED)
    seen = commits.latest(ctx.spark, _path(ctx, model))[1]["unified"]
    out: set[str | None] = set()
    for n in [n for n in commits.numbers(ctx.spark, path) if n > seen]:
        changed = commits.read(ctx.spark, path, n)[0]["changed"]
        if changed is None:
            return None
        out |= {v["measurement_date"] for v in map(partition_values, changed) if v["data_type"] in model.of}
    return out


def _months(days: set[str | None]) -> set[tuple]:
    return {(None, None) if d is None else (dt.date.fromisoformat(d).year, dt.date.fromisoformat(d).month) for d in days}


def _month_of(values: dict) -> tuple:
    if "measurement_date" in values:
        return next(iter(_months({values["measurement_date"]})))
    return tuple(None if values[c] is None else int(values[c]) for c in ("measurement_year", "measurement_month"))


def _rebuild(ctx: Context, model: Model) -> str:
    days = _days_since(ctx, model)
    last = commits.latest(ctx.spark, _path(ctx, model))[1]
    own = ctx.fingerprint(model.name)
    if days is not None and not days and last["fingerprint"].get("as_of") == own.get("as_of"):
        followed = commits.latest(ctx.spark, os.path.join(ctx.written, UNIFIED))[0]
        if (last["fingerprint"], last["unified"]) != (own, followed):  # the same files, and now known to be up to date
            commits.append(ctx.spark, _path(ctx, model), [last | {"fingerprint": own, "unified": followed, "changed": []}])
        return "as it was"
    if days is None or model.grain == "all":
        build_table(ctx, model, model.build(ctx.restricted(lambda name: None)), _path(ctx, model))
        return "all of it"
    wanted = _months(days)

    def touched(values: dict) -> bool:
        if model.grain == "month":
            return _month_of(values) in wanted
        return next(v for c, v in values.items() if c.endswith("_date")) in days

    def within(name: str):
        if name == UNIFIED:
            return lambda values: values["data_type"] in model.of and touched(values)
        return touched

    if model.grain == "month":
        replaced = [partition_name(dict(zip(("measurement_year", "measurement_month"), m))) for m in wanted]
    else:
        replaced = [partition_name({model.partition_by[0]: d}) for d in days]
    build_table(ctx, model, model.build(ctx.restricted(within)), _path(ctx, model), replaced)
    return f"{len(replaced)} {model.grain}s"
