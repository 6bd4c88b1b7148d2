"""Thin helpers over the Hadoop file system, so that paths work on any store."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly below ``path`` (none if it does not exist), without
    those that begin with ``_`` or ``.``, which readers skip too."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
    return sorted(n for n in names if n[0] not in "_.")


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, p = _fs(spark, src)
    _, q = _fs(spark, dst)
    if not fs.rename(p, q):
        raise OSError(f"could not rename {src} to {dst}")


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it exists already, so that only one of several callers gets it."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    return fs.createNewFile(p)


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path`` (none if it does not exist)."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile()) if fs.exists(p) else []


def content(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of all files below ``path``."""
    fs, p = _fs(spark, path)
    found = fs.getContentSummary(p)
    return found.getFileCount(), found.getLength()
