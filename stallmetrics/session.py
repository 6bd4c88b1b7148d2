"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str = "stallmetrics", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library defaults; the cluster supplies memory and shuffle sizing."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost together with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    fallback = tempfile.mkdtemp(prefix="stallmetrics-")
    atexit.register(shutil.rmtree, fallback, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def work_folder(spark: SparkSession) -> str:
    """Folder of this application's work files below the shared folder."""
    return f"{shared_folder(spark)}/stallmetrics-{spark.sparkContext.applicationId}"


def new_workdir(spark: SparkSession, label: str) -> str:
    """A fresh directory name in the work folder; Spark creates it on first write."""
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the work folder: computed once, with its lineage cut, and not
    lost together with an executor. It stays until ``remove`` or ``clean``."""
    path = new_workdir(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.work_path = path
    return out


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the jobs of a block; what was set before holds again afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of work files."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clean(spark: SparkSession) -> None:
    """Delete all work files of this application. Results that read them (those of most
    operators that write) must have been read or stored elsewhere before."""
    remove(spark, work_folder(spark))
