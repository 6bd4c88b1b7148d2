"""Rows in which two tables differ, found by digests that do not depend on order.

Both tables are folded to one small row per (day, piece of the keys): the number of rows and
the sums of the four quarters of their 128-bit digests, which add up in any order and count
copies. Only the cells whose sums differ are read again and compared row by row. What a table's rows
come to is computed once, into the work folder, since two steps read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.functions.filters import day_text
from stallmetrics.functions.keys import ROW_DIGEST, row_digest
from stallmetrics.schemas import PARTITION_COLUMN
from stallmetrics.session import new_workdir

PIECES = 256
QUARTERS = [f"quarter_{k}" for k in range(2 * len(ROW_DIGEST))]
CELL = ["__day", "__piece"]


def marked(df: DataFrame, day: str, key: str, pieces: int) -> DataFrame:
    """The day, key and digest of each row, and the cell that it counts in."""
    piece = F.pmod(F.xxhash64(key), F.lit(pieces)).cast("int")
    # Columns by name, so that both tables hash them in one order.
    return df.select(*row_digest(df.select(*sorted(df.columns))), F.col(day).alias("date"), F.col(key).alias("key"),
                     day_text(day).alias("__day"), piece.alias("__piece"))


def kept(rows: DataFrame) -> DataFrame:
    """Marked rows as a table in the work folder: thirty bytes each or so, where the joins behind them move several times as much."""
    path = new_workdir(rows.sparkSession, "marked")
    rows.drop("__day").write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.drop("__day").schema).parquet(path).withColumn("__day", day_text("date"))


def cell_sums(rows: DataFrame, name: str) -> DataFrame:
    """Count and digest sums per cell. A quarter has 32 bits, so 2**31 rows of a cell fit."""
    half = lambda c, high: F.shiftrightunsigned(c, 32) if high else F.col(c).bitwiseAND((1 << 32) - 1)
    quarters = [F.sum(half(c, high)) for c in ROW_DIGEST for high in (True, False)]
    return rows.groupBy(*CELL).agg(F.struct(F.count("*").alias("rows"), *[
        q.alias(n) for q, n in zip(quarters, QUARTERS, strict=True)]).alias(name))


def differing_cells(a: DataFrame, b: DataFrame) -> DataFrame:
    """Cells whose sums differ, or that one side lacks, from ``marked`` rows."""
    both = cell_sums(a, "a").join(cell_sums(b, "b"), CELL, "full_outer")
    return both.filter(~F.col("a").eqNullSafe(F.col("b"))).select(*CELL)


def differing_days(a: DataFrame, b: DataFrame, day: str = PARTITION_COLUMN, key: str = "order_id") -> DataFrame:
    """Days with any difference, from the sums alone: no rows are matched."""
    cells = differing_cells(marked(a, day, key, 1), marked(b, day, key, 1))
    return cells.select(F.when(F.col("__day") != "", F.col("__day")).cast("date").alias("date")).distinct()


def reconcile_rows(a: DataFrame, b: DataFrame, day: str = PARTITION_COLUMN, key: str = "order_id",
                   pieces: int = PIECES) -> DataFrame:
    """date, key, side (``a`` or ``b``) and number of every row that the other table lacks; of
    copies those that are too many. Both tables have the same columns, in any order."""
    if set(a.columns) != set(b.columns):
        raise ValueError("the tables have different columns")
    left, right = (kept(marked(rows, day, key, pieces)) for rows in (a, b))
    # One row per day, at most a calendar's, with a bit for each piece: rows are picked out without a shuffle.
    days = differing_cells(left, right).groupBy("__day", F.shiftright("__piece", 6).alias("__word")).agg(
        F.bit_or(F.expr("shiftleft(1L, __piece % 64)")).alias("__bits")).groupBy("__day").agg(
        F.map_from_entries(F.collect_list(F.struct("__word", "__bits"))).alias("__words"))
    sided = lambda rows, sign: rows.withColumn("__sign", F.lit(sign))
    rows = sided(left, 1).unionByName(sided(right, -1)).join(F.broadcast(days), "__day")
    bits = F.coalesce(F.try_element_at("__words", F.shiftright("__piece", 6)), F.lit(0).cast("long"))
    rows = rows.filter(F.getbit(bits, F.col("__piece") % 64) == 1)
    surplus = rows.groupBy("date", "key", *ROW_DIGEST).agg(F.sum("__sign").alias("__n")).filter("__n <> 0")
    side: Column = F.when(F.col("__n") > 0, "a").otherwise("b")
    return surplus.groupBy("date", "key", side.alias("side")).agg(F.sum(F.abs("__n")).alias("rows"))
