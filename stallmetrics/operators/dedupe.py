"""Row selection per key: exact duplicates, first, last, newest, first n.

The ``row_number`` forms are filtered at once, so Spark plans a group limit on both
sides of the shuffle: a task sends at most n rows per key, however hot the key is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stallmetrics.functions.keys import ROW_DIGEST, row_digest
from stallmetrics.operators.ordered import running_index


def _first_rows(df: DataFrame, keys: list, order: list, n: int = 1) -> DataFrame:
    ranked = df.withColumn("__rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("__rn") <= n).drop("__rn")


#: Rows that one part of a day holds, about.
PART_ROWS = 250_000
PART = "__part"


def dealt(df: DataFrame, day: str, near: Column, spread: list[Column], weight: Column | None = None) -> DataFrame:
    """Rows with the number of a part of their day, each part whole in one task: copies can be
    sorted out and days written without a further shuffle.

    A day has as many parts as its rows fill. Rows of one day with equal ``near`` stay together, which
    compresses well, unless they alone would fill a part; these, and rows without it, go by ``spread``.
    ``weight`` is what a row counts, 1 if not given.
    """
    weight = F.lit(1) if weight is None else weight
    named = df.withColumn("__near", near)
    days = named.groupBy(F.col(day).alias("__day")).agg(F.ceil(F.sum(weight) / PART_ROWS).alias("__parts"))
    # At most one value for each PART_ROWS rows.
    large = named.groupBy(F.col("__near").alias("__large")).agg(F.sum(weight).alias("__rows")).filter(
        F.col("__rows") > PART_ROWS).select("__large")
    sized = named.join(F.broadcast(days), F.col(day).eqNullSafe(F.col("__day"))).join(
        F.broadcast(large), F.col("__near") == F.col("__large"), "left")
    alone = F.col("__near").isNull() | F.col("__large").isNotNull()
    part = F.pmod(F.when(alone, F.xxhash64(*spread)).otherwise(F.xxhash64("__near")), "__parts")
    return sized.select(*df.columns, part.alias(PART)).repartition(day, PART)


def dedupe_exact(df: DataFrame) -> DataFrame:
    """One copy of every identical row. Copies are alike, so which one stays is no question."""
    return df.dropDuplicates()


def dedupe_fingerprint(df: DataFrame, order_col: str = "order_creation_timestamp") -> DataFrame:
    """Same, but partitioned by a 128-bit digest of the row; the newest copy stays."""
    marked = df.select("*", *row_digest(df))
    return _first_rows(marked, ROW_DIGEST, [F.col(order_col).desc_nulls_first()]).drop(*ROW_DIGEST)


def dedupe_latest(df: DataFrame, keys: list[str], order_col: str, tiebreak: list[str] = ()) -> DataFrame:
    """Newest row per key; a missing timestamp counts as newest.

    Keyed by order id alone this removes the further items of an order. Repairs use
    ``dedupe_exact`` instead.
    """
    order = [F.col(order_col).desc_nulls_first(), *[F.col(c).desc_nulls_first() for c in tiebreak]]
    return _first_rows(df, keys, order)


def keep_first(df: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """First row per key by arrival position."""
    return _first_rows(df, keys, [F.col(c).asc() for c in position])


def keep_last(df: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """Last row per key by arrival position (the last write wins)."""
    return _first_rows(df, keys, [F.col(c).desc() for c in position])


def first_n(df: DataFrame, keys: list[str], n: int, order: list[str | Column]) -> DataFrame:
    """First n rows per key; without keys the first n of the table.

    Up to ``spark.sql.optimizer.windowGroupLimitThreshold`` rows (1000) a task sends at most n
    of a key. Beyond, large keys are numbered in pieces (see ``ordered``), and ``order`` must
    be names of columns, ascending.
    """
    if not keys:
        return df.orderBy(*order).limit(n)
    if n <= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        return _first_rows(df, keys, order, n)
    if not all(isinstance(c, str) for c in order):
        raise ValueError("more rows than the group limit need an order by column names")
    return running_index(df, keys, order, "__rn").filter(F.col("__rn") <= n).drop("__rn")
