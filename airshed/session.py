"""Session helpers: UTC clock, sane defaults, a shared checkpoint folder."""

from __future__ import annotations

import os
import shlex
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

UTC = "UTC"


# Staging -> classification fuses into one whole-stage-codegen method that is larger
# than the 8 KB the JVM JIT compiles by default; run interpreted, it is ~5x slower.
# Sessions we launch let the JIT compile it.
JIT_HUGE = "-XX:-DontCompileHugeMethods"
HUGE_METHOD_LIMIT = "8000"


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session clock to UTC. Dates and hours of an epoch instant depend on the
    session zone; the feeds are defined in UTC, so every entry point calls this before
    building a plan. Nothing else of the caller's session changes."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)
    return spark


def guard_huge_methods(spark: SparkSession) -> SparkSession:
    """For a session whose JVMs leave methods over 8 KB interpreted: let Spark use
    per-operator code for such stages. A caller's choice; nothing here calls it."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD_LIMIT)
    return spark


def submitted() -> dict[str, str]:
    """Settings that spark-submit, the environment or a running session has made."""
    if SparkContext._active_spark_context:
        return dict(SparkContext._active_spark_context.getConf().getAll())
    if "PYSPARK_GATEWAY_PORT" in os.environ:  # launched by spark-submit: its JVM knows
        SparkContext._ensure_initialized()
        return dict(SparkConf().getAll())
    args = shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    return dict(v.split("=", 1) for k, v in zip(args, args[1:]) if k in ("--conf", "-c") and "=" in v)


def build_session(master: str | None = None, app: str = "airshed", **conf: str) -> SparkSession:
    """A session for tests, benches and local runs.

    On a cluster the session comes from spark-submit; only the settings that are
    still unset are filled in here.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    preset = submitted()
    defaults = {
        "spark.sql.session.timeZone": UTC,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in defaults.items():
        if k not in preset:
            b = b.config(k, v)
    for k, v in conf.items():  # the caller's own
        b = b.config(k, v)
    for k in ("spark.driver.extraJavaOptions", "spark.executor.extraJavaOptions"):
        own = conf.get(k, preset.get(k, ""))
        b = b.config(k, own if "DontCompileHugeMethods" in own else f"{own} {JIT_HUGE}".strip())
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return use_utc(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Set our own only where it is unset (local tests); on a cluster the setting
    points at shared storage that survives executor loss.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (machine-local folders do not survive executor loss)")
        d = tempfile.mkdtemp(prefix="airshed-ckpt-")  # local runs and tests only
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint root for written intermediate tables."""
    return os.path.join(checkpoint_root(spark), name)
