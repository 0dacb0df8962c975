"""Publishing marts and views (K4-K7) and the long-format fact (K6).

A table at a path is versioned. Each publish writes its files into a folder of its own
(path/_version=<id>/<partitions>) and then commits one small record, which names for every
partition the version that holds it, its number of rows, and the schema. Readers take the newest record
and read just those folders, so they see one version whole: a run that fails half-way
changes nothing, and a reader that has opened a table keeps its files while the next version
comes (the last KEEP versions stay). A publish of some partitions replaces those and
keeps the others where they are.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.sinks import commits

# Parameter labels and unit of the long-format fact.
PARAMETERS = [
    ("co", "CO"),
    ("no", "NO"),
    ("no2", "NO2"),
    ("o3", "O3"),
    ("so2", "SO2"),
    ("pm2_5", "PM2.5"),
    ("pm10", "PM10"),
    ("nh3", "NH3"),
]
UNIT = "μg/m³"

FACT_LONG_COLUMNS = ["date_local", "city", "parameter", "value", "unit", "latitude", "longitude", "created_at", "data_type"]
VERSION = "_version"
KEEP = 2  # versions whose files stay
NULL = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Draft:
    """A version that is written and not committed yet."""

    path: str
    version: str
    schema: T.StructType
    partition_by: Sequence[str]
    rows: dict[str, int] = field(default_factory=dict)  # by partition ("" for the whole table)


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> Draft:
    """K7: the files of a new version, which nobody reads yet.

    A partitioned write is rebalanced by its partition columns first: a folder gets as
    many files as its size asks for (a large day is split, small ones share tasks), not one
    per task that holds a row of it. Clustering is a sort within each task's output
    (partition columns first, so the writer adds no sort of its own), which gives tight
    parquet min/max statistics per file for city filters. No global sort.
    """
    spark = df.sparkSession
    order = [*partition_by, *cluster_by]
    out = df.hint("rebalance", *partition_by) if partition_by else df
    out = out.sortWithinPartitions(*order) if order else out
    draft = Draft(path, uuid.uuid4().hex[:12], df.schema, tuple(partition_by))
    folder = f"{path}/{VERSION}={draft.version}"
    w = out.write
    (w.partitionBy(*partition_by) if partition_by else w).parquet(folder)
    part = F.regexp_extract(F.col("_metadata.file_path"), rf"/{VERSION}={draft.version}/(?:(.*)/)?[^/]*$", 1)
    written = spark.read.schema("_none string").option("recursiveFileLookup", "true").parquet(folder)  # counts come from the footers
    draft.rows = {commits.plain(r["part"]): r["n"] for r in written.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    return draft


def commit(spark: SparkSession, draft: Draft, replace: Iterable[str] | None = None, **more) -> int:
    """Make a draft the table's newest version. `replace`: only these partitions are replaced (those
    that have no rows any more go), the others stay; None: all. `more` goes into the record."""
    last = commits.latest(spark, draft.path)
    old = last[1] if last and replace is not None else {"partitions": {}, "rows": {}}
    gone = set(replace or ())
    if replace is not None and not set(draft.rows) <= gone:
        raise ValueError(f"rows outside the replaced partitions: {sorted(set(draft.rows) - gone)[:5]}")
    parts = {p: v for p, v in old["partitions"].items() if p not in gone} | {p: draft.version for p in draft.rows}
    rows = {p: n for p, n in old["rows"].items() if p not in gone} | draft.rows
    record = {"partitions": parts, "rows": rows, "schema": draft.schema.jsonValue(), "partition_by": list(draft.partition_by), "changed": None if replace is None else sorted(gone), **more}
    number = commits.append(spark, draft.path, [record])
    _forget(spark, draft.path, number)
    return number


def _forget(spark: SparkSession, path: str, number: int) -> None:
    """Folders that the record KEEP before names and none since does."""
    known = [n for n in commits.numbers(spark, path) if n <= number]
    if len(known) <= KEEP:
        return
    held = {(v, p) for n in known[-KEEP:] for p, v in commits.read(spark, path, n)[0]["partitions"].items()}
    old = {(v, p) for p, v in commits.read(spark, path, known[-KEEP - 1])[0]["partitions"].items()}
    versions = {v for v, _ in held}
    for v in {v for v, _ in old} - versions:  # nothing of it is left
        commits.delete(spark, f"{path}/{VERSION}={v}")
    for v, p in old - held:
        if v in versions and p:
            commits.delete(spark, f"{path}/{VERSION}={v}/{p}")


def publish(
    df: DataFrame,
    path: str | None = None,
    table: str | None = None,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    comment: str | None = None,
    **more,
) -> None:
    """K4 / K7: full replace of a mart, optionally partitioned and clustered. At a path: a new
    version. As a table: a new version below the warehouse folder, and the name, a view, is
    moved to it in one catalog change."""
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path or table")
    spark = df.sparkSession
    path = path or _table_path(spark, table)
    draft = write_version(df, path, partition_by, cluster_by)
    commit(spark, draft, **more)
    if table is not None:
        _point(spark, table, f"SELECT {_columns(df.columns)} FROM parquet.`{path}/{VERSION}={draft.version}`" if draft.rows else _no_rows(df.schema), df.schema, comment)


def _table_path(spark: SparkSession, table: str) -> str:
    return os.path.join(spark.conf.get("spark.sql.warehouse.dir"), table.replace(".", "/"))


def _columns(names: Iterable[str]) -> str:
    return ", ".join(f"`{c}`" for c in names)


def _no_rows(schema: T.StructType) -> str:
    return "SELECT " + ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema) + " WHERE false"


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _point(spark: SparkSession, name: str, query: str, schema: T.StructType, comment: str | None) -> None:
    about = f" COMMENT {quoted(comment)}" if comment else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name} ({_columns(schema.names)}){about} AS {query}")


def read_published(spark: SparkSession, path: str, keep: Callable[[dict[str, str | None]], bool] | None = None, hidden: bool = False, number: int | None = None) -> DataFrame:
    """The newest committed version at `path` (or that of record `number`): only the folders it names,
    and of these only the partitions for which `keep` (of its values by column) holds; nothing is listed or
    opened for the others. Columns that begin with an underscore are shown if `hidden`."""
    if number is None:
        found = commits.latest(spark, path)
        if found is None:
            raise FileNotFoundError(f"nothing is published at {path}")
        record = found[1]
    else:
        record = commits.read(spark, path, number)[0]
    schema = T.StructType.fromJson(record["schema"])
    parts = {p: v for p, v in record["partitions"].items() if keep is None or keep(partition_values(p))}
    out = _folders(spark, path, schema, parts, record["partitions"])
    return out.select(*[c for c in schema.names if hidden or not c.startswith("_")])


def _folders(spark: SparkSession, path: str, schema: T.StructType, parts: dict[str, str], all_: dict[str, str]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    held: dict[str, set[str]] = {}
    for p, v in all_.items():
        held.setdefault(v, set()).add(p)
    # one path stands for a version that is read whole and that no later one has replaced in part
    fresh = set(all_.values()) if len(commits.numbers(spark, path)) == 1 else set()
    paths = [f"{path}/{VERSION}={v}" for v in fresh if held[v] <= set(parts)]
    paths += [f"{path}/{VERSION}={v}/{p}".rstrip("/") for p, v in parts.items() if not (v in fresh and held[v] <= set(parts))]
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def partition_values(partition: str) -> dict[str, str | None]:
    """Values by column of a partition folder; None for the null partition."""
    pairs = (x.split("=", 1) for x in partition.split("/") if "=" in x)
    return {c: None if v == NULL else commits.plain(v) for c, v in pairs}


def partition_name(values: dict[str, object]) -> str:
    """The folder of plain values (dates, numbers, simple text)."""
    return "/".join(f"{c}={NULL if v is None else v}" for c, v in values.items())


def publish_bucketed(df: DataFrame, table: str, buckets: int, by: str = "city", sort_by: Sequence[str] = (), path: str | None = None, comment: str | None = None) -> None:
    """K6 / K7: a mart bucketed by one column and sorted within buckets. Aggregates and joins on that
    column, alone or among others, need no shuffle, and a filter on one value reads one bucket. Each
    publish is a table of its own, to which the name, a view, is moved; the one before
    stays for readers that have it open."""
    spark = df.sparkSession
    root = path or _table_path(spark, table)
    version = f"{table}__{uuid.uuid4().hex[:12]}"
    out = df.hint("rebalance", by)  # a bucket gets as many files as its size asks for
    out = out.sortWithinPartitions(by, *sort_by)
    out.write.bucketBy(buckets, by).sortBy(by, *sort_by).option("path", f"{root}/{version.rpartition('.')[2]}").saveAsTable(version)
    _point(spark, table, f"SELECT * FROM {version}", df.schema, comment)
    number = commits.append(spark, root, [{"table": version, "path": f"{root}/{version.rpartition('.')[2]}"}])
    known = [n for n in commits.numbers(spark, root) if n <= number]
    if len(known) > KEEP:
        old = commits.read(spark, root, known[-KEEP - 1])[0]
        spark.sql(f"DROP TABLE IF EXISTS {old['table']}")
        commits.delete(spark, old["path"])


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """K5: a staging / intermediate model as a (recomputed) view."""
    df.createOrReplaceTempView(name)
    return df


def to_long(unified: DataFrame) -> DataFrame:
    """K6: one row per parameter of a good-quality reading, of every data type and with
    NULL values as they are (value is nullable)."""
    src = unified.filter(F.col("is_data_quality_issue") == 0)
    long = src.select(
        F.col("measurement_datetime").alias("date_local"),
        "city",
        "data_type",
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        F.col("ingestion_timestamp").alias("created_at"),
        F.explode(
            F.array(*[F.struct(F.lit(label).alias("parameter"), F.col(col).alias("value")) for col, label in PARAMETERS])
        ).alias("_p"),
    )
    return long.select(
        "date_local", "city", F.col("_p.parameter").alias("parameter"), F.col("_p.value").alias("value"),
        F.lit(UNIT).alias("unit"), "latitude", "longitude", "created_at", "data_type",
    )


def write_fact_long(df: DataFrame, path: str) -> None:
    """K6 layout: partitioned by day of date_local, clustered by (city, parameter)."""
    publish(df.withColumn("date_local_day", F.to_date("date_local")), path=path,
            partition_by=["date_local_day"], cluster_by=["city", "parameter"])
