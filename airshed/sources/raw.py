"""Raw feed readers (S1-S6). The schema is always given: never inferred."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.sinks import commits, landing
from airshed.sinks.publish import partition_values, quoted, read_published
from airshed.sources.schema import RAW, RAW_COLUMNS

SOURCE = "_source"  # the landed folder a record comes from, as a column on request

# The four countries of the historical tables, and the source descriptions.
HISTORICAL_COUNTRIES = ["Nigeria", "USA", "UK", "India"]
SOURCE_DESCRIPTIONS = {
    "ext_air_quality_raw_Nigeria": "Historical air quality for Nigerian cities (Lagos, Abuja)",
    "ext_air_quality_raw_USA": "Historical air quality for US cities (New York, Los Angeles)",
    "ext_air_quality_raw_UK": "Historical air quality for UK cities (London, Birmingham)",
    "ext_air_quality_raw_India": "Historical air quality for Indian cities (Delhi, Mumbai)",
    "ext_air_quality_current_all": "Current air quality for all selected countries, refreshed daily",
    "ext_air_quality_forecast_all": "Forecast air quality for all selected countries, refreshed daily",
}


def _reader(spark: SparkSession, base: str):
    return (
        spark.read.schema(RAW)
        .option("mode", "FAILFAST")
        .option("allowNonNumericNumbers", "false")
        .option("basePath", base)
    )


def _folder(kind: str):
    """The landed folder of a record: its path below the feed, without the load and the file."""
    return F.regexp_extract(F.col("_metadata.file_path"), rf"/{kind}/(?:data/load=[^/]*/)?(.*)/[^/]*$", 1).alias(SOURCE)


def read_feed(spark: SparkSession, base: str, partitions: Sequence[str] = (), source: bool = False) -> DataFrame:
    """NDJSON records under `base` (all, or only the given partition sub-folders)."""
    paths = [os.path.join(base, p) for p in partitions] or [base]
    more = [_folder(os.path.basename(base))] if source else []
    return _reader(spark, base).json(paths).select(*RAW_COLUMNS, *more)


def _read_files(spark: SparkSession, base: str, files: Sequence[str], source: bool = False) -> DataFrame:
    more = [_folder(os.path.basename(base))] if source else []
    if not files:
        empty = spark.createDataFrame([], RAW)
        return empty.withColumn(SOURCE, F.lit(None).cast("string")) if source else empty
    below = f"{base}/data" if commits.exists(spark, f"{base}/{commits.FOLDER}") else base
    return _reader(spark, below).json([commits.plain(f) for f in files]).select(*RAW_COLUMNS, *more)


def read_historical(spark: SparkSession, root: str, countries: Sequence[str] | None = None, source: bool = False) -> DataFrame:
    """The historical feed; `countries` picks country=... folders (one table each
    in the reference), None reads them all in one scan. Where loads are committed (K1), only the
    files of the newest record of each key are listed and read."""
    base = os.path.join(root, "historical")
    if not commits.exists(spark, f"{base}/{commits.FOLDER}"):
        return read_feed(spark, base, [f"country={c}" for c in countries or ()], source)
    held = landing.committed(spark, base)
    held = held.filter(F.col("country").isin(*countries)) if countries else held
    files = [r["file"] for r in held.select(F.explode("files").alias("file")).collect()]  # what Spark's own listing would hold
    return _read_files(spark, base, files, source)


def read_historical_tables(spark: SparkSession, root: str, countries: Sequence[str] = HISTORICAL_COUNTRIES) -> list[DataFrame]:
    """S1 as separate per-country frames (for stage_historical(*feeds))."""
    return [read_historical(spark, root, [c]) for c in countries]


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The current feed, all countries and days."""
    return read_feed(spark, os.path.join(root, "current"))


def read_forecast(spark: SparkSession, root: str) -> DataFrame:
    """S3: the forecast feed, all countries and days."""
    return read_feed(spark, os.path.join(root, "forecast"))


@dataclass(frozen=True)
class Feed:
    """A landed feed whose folders can be told apart: what it holds, and a read of some of it."""

    spark: SparkSession
    root: str
    kind: str  # historical | current | forecast

    @property
    def base(self) -> str:
        return os.path.join(self.root, self.kind)

    def files(self) -> DataFrame:
        """file, _source, size, modified of what readers read."""
        if not commits.exists(self.spark, self.base):
            return self.spark.createDataFrame([], f"file string, size bigint, modified timestamp, {SOURCE} string")
        found = commits.files_under(self.spark, self.base if self.kind != "historical" or not self._logged() else f"{self.base}/data")
        found = found.filter(F.col("file").endswith(".json"))
        if self._logged():
            held = landing.committed(self.spark, self.base).select(F.explode("files").alias("file"))
            found = found.join(held, "file", "left_semi")
        return found.withColumn(SOURCE, F.regexp_extract("file", rf"/{self.kind}/(?:data/load=[^/]*/)?(.*)/[^/]*$", 1))

    def _logged(self) -> bool:
        return self.kind == "historical" and commits.exists(self.spark, f"{self.base}/{commits.FOLDER}")

    def listing(self) -> DataFrame:
        """_source and a signature of its files' names, sizes and times."""
        sign = F.sum(F.xxhash64("file", "size", "modified").cast("decimal(38,0)")).cast("string")
        return self.files().groupBy(SOURCE).agg(sign.alias("signature"))

    def read(self, sources: Sequence[str] | None = None) -> DataFrame:
        """The records with their _source; only those of the given folders."""
        if not commits.exists(self.spark, self.base):
            return _read_files(self.spark, self.base, [], source=True)
        if sources is None:
            return read_historical(self.spark, self.root, source=True) if self.kind == "historical" else read_feed(self.spark, self.base, source=True)
        wanted = self.spark.createDataFrame([(s,) for s in sources], f"{SOURCE} string")
        files = [r["file"] for r in self.files().join(F.broadcast(wanted), SOURCE, "left_semi").select("file").collect()]
        return _read_files(self.spark, self.base, files, source=True)


COLUMN_COMMENTS = {
    "ingestion_timestamp": "when the record was fetched (UTC)", "country": "country of the city", "city": "city", "lat": "latitude, degrees", "lon": "longitude, degrees",
    "dt": "time of the reading or forecast, epoch seconds", "aqi": "air quality index", "components": "pollutant concentrations, micrograms per cubic metre",
}


def register_sources(spark: SparkSession, root: str, countries: Sequence[str] = HISTORICAL_COUNTRIES, database: str | None = None) -> dict[str, str]:
    """The named sources in the catalog, with descriptions of the sources and of their columns;
    returns name -> description. The current and forecast feeds are external JSON tables over
    their folders (REFRESH TABLE after a landing, in a session that has read them). A country's
    history is a view that joins the landed lines with the manifest, so it shows what is committed."""
    where = f"{database}." if database else ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    about = {f"{where}ext_air_quality_raw_{c}": SOURCE_DESCRIPTIONS.get(f"ext_air_quality_raw_{c}", f"Historical air quality for {c}") for c in countries}
    for (name, text), country in zip(about.items(), countries):
        columns = ", ".join(f"{c} COMMENT {quoted(COLUMN_COMMENTS[c])}" for c in RAW_COLUMNS)
        spark.sql(f"CREATE OR REPLACE VIEW {name} ({columns}) COMMENT {quoted(text)} AS {_history_sql(os.path.join(root, 'historical'), country)}")
    for kind in ("current", "forecast"):
        name = f"{where}ext_air_quality_{kind}_all"
        about[name] = SOURCE_DESCRIPTIONS[f"ext_air_quality_{kind}_all"]
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()} COMMENT {quoted(COLUMN_COMMENTS[f.name])}" for f in RAW.fields if f.name != "country")
        columns += f", country string COMMENT {quoted(COLUMN_COMMENTS['country'])}, ingest_date date COMMENT 'UTC day of the fetch', run string COMMENT 'run of the day'"
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its files stay
        options = f"path {quoted(os.path.join(root, kind))}, mode 'FAILFAST', allowNonNumericNumbers 'false'"
        spark.sql(f"CREATE TABLE {name} ({columns}) USING json OPTIONS ({options}) COMMENT {quoted(about[name])}")
    return about


def _history_sql(base: str, country: str) -> str:
    """The committed records of one country, as SQL over the landed lines and the manifest."""
    record = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW.fields if f.name not in ("country", "city"))
    shown = ", ".join(c if c in ("country", "city") else f"r.{c}" for c in RAW_COLUMNS)
    lines = f"SELECT from_json(value, {quoted(record)}, map('mode', 'FAILFAST', 'allowNonNumericNumbers', 'false')) AS r, country, CAST(city AS string) AS city, _metadata.file_path AS file FROM text.`{base}/data` WHERE country = {quoted(country)}"
    manifest = f"SELECT country, city, range, chunk, files, CAST(regexp_extract(_metadata.file_name, '([0-9]+)', 1) AS bigint) AS number FROM json.`{base}/{commits.FOLDER}`"
    held = f"SELECT explode(max_by(files, number)) AS file FROM ({manifest}) WHERE country = {quoted(country)} GROUP BY country, city, range, chunk"
    return f"SELECT {shown} FROM ({lines}) LEFT SEMI JOIN ({held}) held USING (file)"


def read_mart_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An exported mart CSV with header; dates and timestamps parsed by the schema."""
    return spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)


def read_mart(
    spark: SparkSession, source: str, order: str | None = None, limit: int | None = None, fmt: str = "parquet", tie: Sequence[str] = ()
) -> DataFrame:
    """A published mart by table name or path; with `order` newest first (NULLs last,
    ties by the `tie` columns), with `limit` only so many rows.

    Where the mart is published in partitions of the `order` column, the rows are counted from the record
    that names its folders, newest first, until `limit` is reached; only those folders
    are read, once. Nothing runs while the frame is defined."""
    from airshed.operators.reads import newest_first

    if os.sep not in source and "://" not in source:
        df = spark.table(source)
    elif commits.exists(spark, f"{source}/{commits.FOLDER}"):
        df = read_published(spark, source, _newest(spark, source, order, limit) if order and limit is not None else None)
    else:
        df = spark.read.format(fmt).load(source)
    if order:
        return newest_first(df, order, limit, tie)
    return df.limit(limit) if limit is not None else df


def _newest(spark: SparkSession, path: str, order: str, limit: int):
    """A test for the partitions with the newest `limit` rows; None if it is not partitioned by `order`."""
    record = commits.latest(spark, path)[1]
    if order not in record["partition_by"]:
        return None
    kind = T.StructType.fromJson(record["schema"])[order].dataType
    typed = (lambda v: float(v)) if isinstance(kind, T.NumericType) else (lambda v: v)  # dates and instants sort as their text
    count: dict = {}
    for part, n in record["rows"].items():
        value = partition_values(part)[order]
        count[value] = count.get(value, 0) + n
    kept, total = set(), 0
    for value in sorted(count, key=lambda v: (v is not None, typed(v) if v is not None else 0), reverse=True):  # null last
        if total >= limit:
            break
        kept.add(value)
        total += count[value]
    return lambda values: values[order] in kept
