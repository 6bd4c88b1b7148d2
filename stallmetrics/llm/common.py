"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from stallmetrics.session import new_workdir, remove

#: Columns of documents that operators know by name.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")

#: Bytes of text that a worker handles at once; a longer text is handled alone.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and outlives lost executors."""
    spark = df.sparkSession
    path = new_workdir(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.work_path = path
    return out


def done(*tables: DataFrame) -> None:
    """Remove tables of ``written`` that nothing reads any more."""
    for df in tables:
        remove(df.sparkSession, df.work_path)


def under_plain_names(docs: DataFrame, stage: Callable[[DataFrame], DataFrame], known: tuple[str, ...] = DOCUMENT) -> DataFrame:
    """The result of a stage that keeps the columns of ``docs``, run while all columns that it does not
    know have plain names, so that no given name can clash with one of the stage or hold a dot."""
    names = docs.columns
    plain = [n if n in known else f"extra_{k}" for k, n in enumerate(names)]
    return stage(docs.toDF(*plain)).toDF(*names)


def sized(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text, balanced within each batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        share = max(1, -(-int(ends[-1]) // max(1, -(-int(ends[-1]) // limit))))
        cuts = np.flatnonzero(np.diff(ends // share, prepend=0)) if ends[-1] else []
        start = 0
        for stop in [*(int(c) for c in cuts), batch.num_rows]:
            if stop > start:
                yield batch.slice(start, stop - start)
                start = stop
    give_back()


def give_back() -> None:
    """Return freed memory to the system, since a worker stays for other tasks; where the C library cannot, nothing happens."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch[column].to_pylist()]


def with_columns(batch: pa.RecordBatch, keep: list[str], **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch[k] for k in keep), *columns.values()], names=[*keep, *columns])
