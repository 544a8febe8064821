"""Session set-up and the shared folder that staged tables live in."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app_name: str = "skyledger", master: str | None = None, **settings: str) -> SparkSession:
    """A UTC session with adaptive execution and skew handling on."""

    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Wide projections become methods the JIT would otherwise leave interpreted.
        "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
        "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone, so that zone-less epochs mean UTC everywhere."""

    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a machine-local folder; on a cluster an
    unset folder is an error rather than data written where others cannot see it.
    """

    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_SETTING} must name a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="skyledger-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a result that several steps read to the shared folder, and read it from there.

    That cuts the lineage, and the table outlives any executor.
    """

    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
