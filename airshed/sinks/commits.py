"""A log of small records beside a table's files: what has been committed, and in which order.

A record is one file, root/_commits/<number>.json, of one JSON object per line. It is written under
another name and renamed, which fails if the number is taken (the next is tried then): a
record is there whole or not at all, and none replaces another. Files that no record
names belong to nothing, so a writer that dies half-way leaves what was committed
readable. Paths go through Hadoop's file systems, as Spark's own do.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "_commits"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    return [s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path))] if exists(spark, path) else []


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed records, rising."""
    names = children(spark, f"{root}/{FOLDER}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def append(spark: SparkSession, root: str, lines: list[dict]) -> int:
    """Commit a record of these lines; its number."""
    jvm, fs = spark.sparkContext._jvm, _fs(spark, root)
    folder = f"{root}/{FOLDER}"
    draft = _path(spark, f"{folder}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    try:
        out.write("".join(json.dumps(x, sort_keys=True) + "\n" for x in lines).encode())
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # no option: never overwrite
    number = max(numbers(spark, root), default=0) + 1
    while True:
        try:
            context.rename(draft, _path(spark, f"{folder}/{number:012d}.json"), never)
            return number
        except Exception as e:  # noqa: BLE001 - taken meanwhile: the next number
            if "AlreadyExists" not in str(e):
                raise
            number += 1


def read(spark: SparkSession, root: str, number: int) -> list[dict]:
    stream = _fs(spark, root).open(_path(spark, f"{root}/{FOLDER}/{number:012d}.json"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return [json.loads(x) for x in text.splitlines()]


def latest(spark: SparkSession, root: str) -> tuple[int, dict] | None:
    """(number, first line) of the newest record."""
    found = numbers(spark, root)
    return (found[-1], read(spark, root, found[-1])[0]) if found else None


def frame(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All lines of all records, and the `number` of each one's record."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.json$", 1).cast("long")
    return spark.read.schema(schema).json(f"{root}/{FOLDER}").withColumn("number", number)


def files_under(spark: SparkSession, root: str) -> DataFrame:
    """file (as Spark spells it), size, modified: the data files below root, listed by Spark and not opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return listed.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("modified"))


def plain(path: str) -> str:
    """A path as readers take it, from the way Spark spells it in _metadata."""
    return unquote(path)
