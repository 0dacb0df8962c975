"""Which landed folders each partition of the unified table comes from.

Beside every version of the unified table lies a small table with a row for each (data
type, landed folder, day) that has readings, and the signature of the folder's files. The
table's record names it, so both are committed together. A folder whose signature differs
from the one recorded is new, changed or gone; the days it had or has now are what changes.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.plans.models import KINDS, Context
from airshed.sinks import commits
from airshed.sinks.publish import VERSION, Draft, partition_values
from airshed.sources.raw import SOURCE

SCHEMA = f"data_type string, {SOURCE} string, signature string, measurement_date date, has_rows boolean"


def _listing(ctx: Context) -> DataFrame:
    """data_type, _source, signature of all landed folders."""
    return reduce(DataFrame.unionByName, [ctx.feeds[k].listing().withColumn("data_type", F.lit(k)) for k in KINDS])


def write(ctx: Context, draft: Draft, path: str, replaced: Iterable[str] | None) -> dict:
    """The lineage of a draft of the unified table; what its record says of it."""
    if not ctx.carry:
        return {"lineage": None}
    spark = ctx.spark
    folder = f"{path}/{VERSION}={draft.version}"
    if draft.rows:
        rows = spark.read.schema(draft.schema).option("basePath", folder).parquet(folder)
        held = rows.select("data_type", SOURCE, "measurement_date").distinct()
    else:
        held = spark.createDataFrame([], f"data_type string, {SOURCE} string, measurement_date date")
    if replaced is not None:
        held = held.union(read(ctx, path).filter("has_rows").select("data_type", SOURCE, "measurement_date").filter(~in_days(_values(replaced))))
    own = _listing(ctx).join(held.withColumn("has_rows", F.lit(True)), ["data_type", SOURCE], "left").withColumn("has_rows", F.coalesce("has_rows", F.lit(False)))
    name = f"_lineage-{uuid.uuid4().hex[:12]}"
    own.select("data_type", SOURCE, "signature", "measurement_date", "has_rows").write.parquet(os.path.join(path, name))
    return {"lineage": name}


def read(ctx: Context, path: str) -> DataFrame | None:
    """The lineage of the newest committed version; None if it has none."""
    found = commits.latest(ctx.spark, path)
    if found is None or not found[1].get("lineage"):
        return None
    return ctx.spark.read.schema(SCHEMA).parquet(os.path.join(path, found[1]["lineage"]))


def _values(partitions: Iterable[str]) -> set[tuple]:
    return {(v["data_type"], v["measurement_date"]) for v in map(partition_values, partitions)}


def in_days(days: set[tuple]):
    """Whether a row's (data type, day) is among these; a null day is a day too."""
    pair = lambda t, d: F.col("data_type").eqNullSafe(F.lit(t)) & F.col("measurement_date").eqNullSafe(F.lit(d).cast("date"))
    return reduce(lambda x, y: x | y, [pair(t, d) for t, d in sorted(days, key=str)], F.lit(False))


def changed_folders(ctx: Context, path: str) -> DataFrame:
    """data_type, _source, there (whether it is still landed) of the folders that differ from the
    lineage: new, with other files, or gone."""
    before = read(ctx, path).select("data_type", SOURCE, "signature").distinct().withColumnRenamed("signature", "old")
    both = _listing(ctx).join(before, ["data_type", SOURCE], "full")
    return both.filter(~F.col("signature").eqNullSafe(F.col("old"))).select("data_type", SOURCE, F.col("signature").isNotNull().alias("there"))
