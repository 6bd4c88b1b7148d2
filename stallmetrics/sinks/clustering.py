"""Tables clustered by several columns at once, and what a look-up in them has to open.

Each column is cut at places of equal share in a bounded sample, the numbers of the cuts are
interleaved bit by bit, and rows are dealt by ranges of the result inside each partition
value. Files then cover small boxes that hardly overlap, so min/max statistics skip files for
any of the columns, where sorting helps the first column only. Bloom filters in the footers
tell for single keys whether a file can hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.operators.ordered import tasks
from stallmetrics.schemas import PARTITION_COLUMN

SAMPLE_ROWS = 8192
#: Bits of each column: it is cut into two to this power parts.
BITS = 7


def column_cuts(df: DataFrame, column: str, bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> list:
    """Values that cut a column into parts of about equal share (fewer where values repeat)."""
    found = df.select(column).filter(F.col(column).isNotNull()).orderBy(F.rand(23)).limit(sample_rows)
    values = sorted(r[0] for r in found.collect())
    parts = 1 << bits
    return sorted({values[len(values) * k // parts] for k in range(1, parts)}) if values else []


def part_of(column: str, cuts: list, bits: int = BITS) -> Column:
    """Number of the part that a value falls in; nulls come first."""
    if not cuts:
        return F.lit(0)
    known = F.array(*[F.lit(c) for c in cuts])
    part = F.aggregate(F.array(*[F.lit(1 << b) for b in reversed(range(bits))]), F.lit(0),
                       lambda at, step: F.when(F.get(known, at + step - 1) <= F.col(column), at + step).otherwise(at))
    return F.when(F.col(column).isNull(), 0).otherwise(part)


def interleaved(parts: list[Column], bits: int = BITS) -> Column:
    """The bits of several numbers in turn, the highest first."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for k, part in enumerate(reversed(parts)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(part, b).bitwiseAND(1).cast("long"), b * len(parts) + k))
    return out


def write_interleaved(df: DataFrame, path: str, columns: list[str], partition: str = PARTITION_COLUMN, bits: int = BITS,
                      bloom: list[str] = (), files: int | None = None) -> None:
    """Write a table partitioned by day and clustered by all ``columns``; ``bloom`` columns get
    Bloom filters. A day with many rows is split into files by ranges, so its files do not overlap
    along the curve."""
    place = interleaved([part_of(c, column_cuts(df, c, bits), bits) for c in columns], bits)
    marked = df.withColumn("__place", place)
    dealt = marked.repartitionByRange(files or tasks(df), partition, "__place").sortWithinPartitions(partition, "__place", *columns)
    writer = dealt.drop("__place").write.mode("errorifexists").partitionBy(partition)
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


def file_bounds(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, least and greatest value of each column per file of a stored table."""
    bounds = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("rows"), *bounds)


def files_opened(df: DataFrame, column: str, keys: list) -> DataFrame:
    """For each key of a short list how many files of the stored table a look-up by min and max
    must open. Runs over one row per file."""
    asked = F.array(*[F.lit(k) for k in keys])
    inside = F.filter(asked, lambda k: k.between(F.col(f"min_{column}"), F.col(f"max_{column}")))
    return file_bounds(df, [column]).select(F.explode(inside).alias("key")).groupBy("key").agg(F.count("*").alias("files"))
