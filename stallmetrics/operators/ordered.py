"""Numbering and previous values in which no key is too large for a task.

A plain window puts all rows of a key into one task. Here a bounded sample of (key, order)
tells which keys hold more than a task's share of the table and at which places of their
order to cut them; the window runs inside (key, piece), and a table with one row per piece
of a cut key (no more than there are tasks) carries counts or last values from each piece to
the next. Keys that are not cut cost what a plain window costs. Equal places stay in one
piece, so the result is that of the plain window for every sample.

The position in the whole table needs no key: rows are dealt by ranges of the order, numbered
where they are, and each range adds the number of rows before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stallmetrics.session import written

#: Sampled rows for each task; a key with more of them is cut after each such number.
SAMPLED_PER_TASK = 24
#: Steps of the search for a row's piece: more pieces than tasks can be told apart.
SEARCH_STEPS = [1 << b for b in reversed(range(20))]
#: ``monotonically_increasing_id`` is the partition above this many bits, and the row in it below.
ROW_BITS = 33


def tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def cut_points(df: DataFrame, keys: list[str], order: list[str], per_task: int = SAMPLED_PER_TASK) -> DataFrame | None:
    """Places at which large keys are cut, as (key, cuts) rows; None if there is no such key.

    At most one cut for each task comes back, whatever the number of rows and keys.
    """
    spark, n = df.sparkSession, max(2, tasks(df))
    place = F.struct(*order).alias("place")
    sample = df.select(F.struct(*keys, F.lit(0).alias("__")).alias("key"), place).orderBy(F.rand(17)).limit(per_task * n)
    ranked = sample.withColumn("r", F.row_number().over(W.partitionBy("key").orderBy("place")))
    cuts = ranked.filter(F.col("r") % per_task == 0).groupBy("key").agg(F.array_sort(F.array_distinct(F.collect_list("place"))).alias("cuts"))
    found = cuts.toArrow()
    return spark.createDataFrame(found, cuts.schema) if found.num_rows else None


def _pieces(df: DataFrame, keys: list[str], order: list[str], cuts: DataFrame) -> DataFrame:
    """``df`` dealt by ``__group``: the key and the row's piece of it (null if the key is whole).

    A struct compares null fields as equal, so rows with a null key keep their group.
    """
    known = F.broadcast(cuts.select(F.col("key").alias("__key"), F.col("cuts").alias("__cuts")))
    place = F.struct(*order)
    piece = F.when(F.col("__cuts").isNotNull(), F.aggregate(
        F.array(*[F.lit(s) for s in SEARCH_STEPS]), F.lit(0),
        lambda at, step: F.when(F.get("__cuts", at + step - 1) <= place, at + step).otherwise(at)))
    marked = df.join(known, F.struct(*keys, F.lit(0).alias("__")) == F.col("__key"), "left")
    grouped = marked.withColumn("__group", F.struct(*keys, piece.alias("__piece"))).drop("__key", "__cuts")
    # Shuffled once: the window, the summary of the pieces and the join all use it.
    return grouped.repartition("__group")


def _across(keys: list[str]) -> "W":
    return W.partitionBy(*[F.col(f"__group.{k}") for k in keys]).orderBy("__group.__piece")


def _per_piece(cut: DataFrame, *aggregates: Column) -> DataFrame:
    """One row per piece of the keys that are cut. A whole row goes along, so that this branch
    reads the columns of the other one and Spark reuses its shuffle; the filters stand on
    results, since they would be pushed below the shuffle otherwise."""
    row = F.any_value(F.struct(*[F.col(c) for c in cut.columns])).alias("__row")
    sums = cut.groupBy("__group").agg(F.max("__group.__piece").alias("__cut"), *aggregates, row)
    return sums.filter(F.col("__cut").isNotNull() & F.col("__row").isNotNull())


def running_index(df: DataFrame, keys: list[str], order: list[str], name: str = "index",
                  per_task: int = SAMPLED_PER_TASK) -> DataFrame:
    """1-based position of each row within its key, by the columns of ``order`` ascending."""
    cuts = cut_points(df, keys, order, per_task)
    if cuts is None:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long"))
    cut = _pieces(df, keys, order, cuts)
    local = cut.withColumn("__local", F.row_number().over(W.partitionBy("__group").orderBy(*order)))
    before = _across(keys).rowsBetween(W.unboundedPreceding, -1)
    sizes = _per_piece(cut, F.count("*").alias("__n"))
    offsets = sizes.select("__group", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    joined = local.join(F.broadcast(offsets), "__group", "left")
    place = F.col("__local") + F.coalesce("__offset", F.lit(0))
    return joined.withColumn(name, place).drop("__local", "__offset", "__group")


def table_index(df: DataFrame, order: list[str], name: str = "index") -> DataFrame:
    """1-based position of each row in the whole table. The numbered ranges are written before
    they are counted, so that both see the same ranges."""
    dealt = df.repartitionByRange(tasks(df), *order).sortWithinPartitions(*order)
    placed = written(dealt.withColumn("__at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("__at", ROW_BITS)
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    joined = placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    index = F.col("__at").bitwiseAND((1 << ROW_BITS) - 1) + F.col("__before") + 1
    return joined.withColumn(name, index).drop("__at", "__part", "__before")


def previous_value(df: DataFrame, keys: list[str], order: list[str], value: str, name: str = "previous",
                   per_task: int = SAMPLED_PER_TASK) -> DataFrame:
    """``value`` of the row before, within its key. ``order`` must be unique within a key."""
    cuts = cut_points(df, keys, order, per_task)
    if cuts is None:
        return df.withColumn(name, F.lag(value).over(W.partitionBy(*keys).orderBy(*order)))
    cut = _pieces(df, keys, order, cuts)
    # The struct is null only for the first row of a piece, so null values stay apart.
    inside = cut.withColumn("__before", F.lag(F.struct(F.col(value).alias("v"))).over(
        W.partitionBy("__group").orderBy(*order)))
    last = F.max(F.struct(*[F.col(c) for c in order], F.col(value).alias("__v")))
    ends = _per_piece(cut, last.alias("__end"))
    carried = ends.select("__group", F.lag(F.struct(F.col("__end.__v").alias("v"))).over(_across(keys)).alias("__carry"))
    joined = inside.join(F.broadcast(carried), "__group", "left")
    return joined.withColumn(name, F.coalesce("__before", "__carry")["v"]).drop("__before", "__carry", "__group")
