"""Intermediate tables, and row keys that repeated or null ids cannot confuse."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.session import scratch_path

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
NULL_IDS = 1 << 62  # ids from here on stand for null ids
_OPEN: list[list[DataFrame]] = []  # tables written in the tidy() blocks that are open


def few_files(df: DataFrame, *by: str) -> DataFrame:
    """`df` dealt by columns that spread its rows into partitions of the advisory size. A join or
    an aggregate leaves a partition, and so a file, for each part of what it read, however little
    it found. And each file that a task writes on a local file system starts `chmod` three times
    (Hadoop without its native library), a process that begins as an image of the executor's JVM."""
    return df.hint("rebalance", *by)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written below the shared checkpoint folder and read back: lineage ends here,
    and a lost executor costs a read, not a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")  # nothing but the table is read again: the shuffle files can go
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    if _OPEN:
        _OPEN[-1].append(out)
    return out


class Folder:
    """A folder below the shared checkpoint folder for a job's own files; it goes as tables do."""

    def __init__(self, spark: SparkSession, name: str):
        self.sparkSession, self._scratch = spark, scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
        if _OPEN:
            _OPEN[-1].append(self)


def drop(*tables: DataFrame | Folder) -> None:
    """Remove tables of written() and folders that nothing reads any more."""
    for table in tables:
        for made in _OPEN:
            made[:] = [t for t in made if t is not table]
        path = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(table._scratch)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def tidy() -> Iterator[list[DataFrame]]:
    """Tables written inside are removed at the end, but for those taken out of the list."""
    made: list[DataFrame] = []
    _OPEN.append(made)
    try:
        yield made
    finally:
        _OPEN.remove(made)
        drop(*list(made))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_id(name: str = "doc_id") -> Column:
    """The id as a long that always compares. A null id comes after every id (of less than
    2**62), in an order fixed by the text, so that null ids are no hot key."""
    stand_in = F.lit(NULL_IDS) + F.xxhash64(F.col("text")).bitwiseAND(F.lit(NULL_IDS - 1))
    return F.coalesce(F.col(name).cast("long"), stand_in)


def keyed(docs: DataFrame) -> DataFrame:
    """(id, text_hash, text): id and text hash together name a text, whatever other columns
    the input has and even if ids repeat or are null."""
    return docs.select(order_id().alias("id"), F.xxhash64(F.col("text")).alias("text_hash"), F.col("text").cast("string").alias("text"))


def shown_id(name: str = "id") -> Column:
    return F.when(F.col(name) < NULL_IDS, F.col(name))


FILTER_WORDS, FILTER_BITS = 1 << 20, 4  # 8 MB whatever the number of keys


def _key_word(k: Column) -> Column:
    return F.shiftrightunsigned(k, 44)


def _key_mask(k: Column) -> Column:
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(k, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(FILTER_BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def filter_words(keys: DataFrame, name: str) -> DataFrame:
    """(word, bits) of the filter of a column of 64-bit hashes; at most FILTER_WORDS rows."""
    return keys.groupBy(_key_word(F.col(name)).alias("word")).agg(F.bit_or(_key_mask(F.col(name))).alias("bits"))


def with_possible(rows: DataFrame, words: DataFrame, key: str, name: str = "possible") -> DataFrame:
    """`rows` with a flag, whether the filter of filter_words() may hold the hash in `key`."""
    k = F.col(key)
    asked = rows.join(F.broadcast(words), _key_word(k) == F.col("word"), "left")  # at most FILTER_WORDS rows
    return asked.withColumn(name, F.coalesce(_key_mask(k).bitwiseAND(F.col("bits")) == _key_mask(k), F.lit(False))).drop("word", "bits")


def key_filter(keys: DataFrame, name: str) -> np.ndarray:
    """A blocked Bloom filter (one 64-bit word per key) of a column of 64-bit hashes, made
    by an aggregate of at most FILTER_WORDS rows. It spares a later exact join rows without a
    partner; where keys are so many that it lets most rows pass, the join does the work."""
    words = filter_words(keys, name)
    out = np.zeros(FILTER_WORDS, dtype=np.uint64)
    for rows in words.select("word", "bits").toArrow().to_batches():
        out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def may_hold(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the hashes the filter may hold."""
    mask = np.zeros(len(keys), dtype=np.uint64)
    for i in range(FILTER_BITS):
        mask |= np.uint64(1) << ((keys >> np.uint64(6 * i)) & np.uint64(63))
    return (words[(keys >> np.uint64(44)).astype(np.int64)] & mask) == mask
