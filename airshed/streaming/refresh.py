"""Incremental refresh of the current / forecast feeds with Structured Streaming.

The feeds land four times a day (K2, K3). Instead of re-staging every landed file on
each run, a file stream picks up only the new files and re-stages just the
(country, ingestion day) partitions they belong to, replacing those partitions of the
staged table, so a same-day rerun overwrites as the landing does. trigger(availableNow=True) processes what is
there and stops, so a scheduler can run it like a batch job; the checkpoint
records which files were done and makes a restart after executor loss safe.
"""

from __future__ import annotations

import hashlib
import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.operators import staging
from airshed.sinks import commits
from airshed.sources.schema import RAW, RAW_COLUMNS
from airshed.session import scratch_path, use_utc

STAGERS = {"current": staging.stage_current, "forecast": staging.stage_forecast}


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _remove_folder(spark: SparkSession, root: str, country: str | None, day) -> None:
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    name = NO_VALUE if country is None else escape(country)
    commits.delete(spark, f"{root}/country={name}/ingest_date={NO_VALUE if day is None else day}")


def refresh_staged(spark: SparkSession, landing_root: str, kind: str, out_path: str, checkpoint: str | None = None, max_files: int = 1000):
    """Stage newly landed `kind` files into `out_path` (parquet, partitioned by
    country and ingest_date). The checkpoint defaults to a folder under the shared
    spark.checkpoint.dir. Returns the finished StreamingQuery."""
    use_utc(spark)
    if checkpoint is None:  # one progress log per (landing folder, target table)
        tag = hashlib.sha1(f"{landing_root}|{out_path}".encode()).hexdigest()[:12]
        checkpoint = scratch_path(spark, f"refresh-{kind}-{tag}")
    stage = STAGERS[kind]
    schema = T.StructType(RAW.fields + [T.StructField("ingest_date", T.DateType(), True), T.StructField("run", T.StringType(), True)])
    src = (
        spark.readStream.schema(schema)
        .option("mode", "FAILFAST")
        .option("allowNonNumericNumbers", "false")
        .option("maxFilesPerTrigger", max_files)
        .json(os.path.join(landing_root, kind))
    )

    def write_batch(batch: DataFrame, _epoch: int) -> None:
        # Re-stage every landed file of the (country, day) folders this batch touches, not
        # just the batch's files: a day is then always replaced whole, whether its files
        # arrived in one micro-batch or several, and a retried batch rewrites the same result
        # (idempotent). The files are listed here, after the batch was planned, so none
        # that the batch knows of can be missing. The folders of a batch are at most its
        # files (maxFilesPerTrigger); as literals they prune the scan to those folders.
        # A record without an ingestion time lies in the null day, which no equality matches.
        folders = {(r["country"], r["ingest_date"]) for r in batch.select("country", "ingest_date").distinct().collect()}
        if not folders:
            return
        touched = reduce(lambda x, y: x | y, (F.col("country").eqNullSafe(F.lit(c)) & F.col("ingest_date").eqNullSafe(F.lit(d).cast("date")) for c, d in folders))
        landed = spark.read.schema(schema).option("mode", "FAILFAST").option("allowNonNumericNumbers", "false").json(os.path.join(landing_root, kind))
        staged = stage(landed.filter(touched).select(*RAW_COLUMNS, "ingest_date"), carry=["ingest_date"])  # the folder's own day
        (
            staged.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("country", "ingest_date")
            .parquet(out_path)
        )
        # a touched day without a row left has no folder to overwrite: remove the old one
        filled = {(r["country"], r["ingest_date"]) for r in staged.select("country", "ingest_date").distinct().collect()}
        for country, day in folders - filled:
            _remove_folder(spark, out_path, country, day)

    q = (
        src.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q
