"""Landing sinks for raw feeds (K1-K3), NDJSON in folders partitioned by key.

K1 keeps a manifest. A load's files go into a folder of its own (historical/data/load=<id>);
then one record is committed for each (country, city, range, chunk) that it holds, naming its
files. Readers take the newest record of each key and open only those files: a load that
dies before its commit is not there, a retried load replaces its own keys and nothing
else, and what it replaced goes when clean_up is called.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions.timeparts import utc_date
from airshed.sinks import commits
from airshed.sources.chunks import CHUNK_DAYS
from airshed.sources.schema import RAW_COLUMNS

LOAD_KEYS = ["country", "city", "range", "chunk"]
MANIFEST = "country string, city string, range string, chunk bigint, load string, files array<string>"
SAME_DAY = "day"  # run key of the feeds that a later run of the day replaces


def land_historical(df: DataFrame, root: str, start: int, end: int, chunk_days: int = CHUNK_DAYS) -> str:
    """K1: the history records of one load, under root/historical.

    The load is named by its range, epoch seconds [start, end] as asked of the source (which
    may return a reading at the end itself); a record's chunk is the piece of `chunk_days` of
    that range it lies in (0 without a time). A reading outside the range is an error. The same range again
    replaces each (country, city, chunk) it holds; another range is another load, whose
    records stand beside (H13; stage with dedupe=True to keep the newest). Empty input commits nothing.
    """
    path = os.path.join(root, "historical")
    load = write_load(df, path, start, end, chunk_days)
    commit_load(df.sparkSession, path, load)
    return path


def write_load(df: DataFrame, path: str, start: int, end: int, chunk_days: int = CHUNK_DAYS) -> str:
    """The files of a load that is not committed; its id."""
    if not start < end:
        raise ValueError("a load has a range: start < end, in epoch seconds")
    size, load = chunk_days * 86400, uuid.uuid4().hex[:16]
    last = -(-(end - start) // size)
    outside = F.raise_error(F.format_string("a reading at %s is outside the load's range %s-%s", F.col("dt"), F.lit(start), F.lit(end)))
    number = F.least(F.floor((F.col("dt") - start) / size) + 1, F.lit(last))
    chunk = F.when(F.col("dt").isNull(), F.lit(0)).when(F.col("dt").between(start, end), number).otherwise(outside.cast("bigint"))
    keyed = df.select(*RAW_COLUMNS, F.lit(f"{start}-{end}").alias("range"), chunk.cast("bigint").alias("chunk"))
    out = keyed.hint("rebalance", *LOAD_KEYS).sortWithinPartitions(*LOAD_KEYS, "dt")
    out.write.partitionBy(*LOAD_KEYS).json(f"{path}/data/load={load}")
    return load


def commit_load(spark: SparkSession, path: str, load: str) -> int | None:
    """Commit a written load: a record per key it holds. None if it holds nothing."""
    folder = f"{path}/data/load={load}"
    if not any(n.startswith("country=") for n in commits.children(spark, folder)):
        return None
    kinds = "path string, modificationTime timestamp, length bigint, content binary, country string, city string, range string, chunk bigint"
    names = spark.read.format("binaryFile").schema(kinds).option("basePath", folder).load(folder)  # listed, not opened
    keys = names.select(*LOAD_KEYS, F.col("_metadata.file_path").alias("file")).distinct()
    records = keys.groupBy(*LOAD_KEYS).agg(F.sort_array(F.collect_list("file")).alias("files")).collect()  # a row per key, as the log holds
    return commits.append(spark, path, [{**{k: r[k] for k in LOAD_KEYS}, "load": load, "files": r["files"]} for r in records])


def committed(spark: SparkSession, path: str) -> DataFrame:
    """The newest record of each key: country, city, range, chunk, load, files."""
    newest = F.max_by(F.struct("load", "files"), F.col("number")).alias("m")
    return commits.frame(spark, path, MANIFEST).groupBy(*LOAD_KEYS).agg(newest).select(*LOAD_KEYS, "m.*")


def clean_up(spark: SparkSession, root: str, hours: float = 24.0) -> int:
    """Remove files that committed loads have replaced, and those that a load left uncommitted
    more than `hours` ago; how many."""
    path = os.path.join(root, "historical")
    held = committed(spark, path).select(F.explode("files").alias("file"))
    known = commits.frame(spark, path, MANIFEST).select(F.explode("files").alias("file")).distinct().withColumn("known", F.lit(True))
    old = F.col("modified") < F.current_timestamp() - F.expr(f"INTERVAL '{int(hours * 3600)}' SECOND")
    idle = commits.files_under(spark, f"{path}/data").join(held, "file", "left_anti").join(known, "file", "left").filter(F.col("known") | old)
    files = [commits.plain(r["file"]) for r in idle.select("file").collect()]
    for f in files:
        commits.delete(spark, f)
    return len(files)


def _land_daily(df: DataFrame, root: str, name: str, run: str | None) -> str:
    path = os.path.join(root, name)
    keyed = df.select(*RAW_COLUMNS, utc_date("ingestion_timestamp").alias("ingest_date"), F.lit(run or SAME_DAY).alias("run"))
    w = keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    w.partitionBy("country", "ingest_date", "run").json(path)
    return path


def land_current(df: DataFrame, root: str, run: str | None = None) -> str:
    """K2: current readings keyed (country, UTC ingestion date, run). Without `run`, a later run
    on the same UTC day replaces that day's folder for that country; other days survive
    (dynamic partition overwrite). With a `run` key (such as the hour it was due) every run
    is kept beside the others (H14), and the same run again replaces itself."""
    return _land_daily(df, root, "current", run)


def land_forecast(df: DataFrame, root: str, run: str | None = None) -> str:
    """K3: forecasts, keyed and replaced like K2."""
    return _land_daily(df, root, "forecast", run)
