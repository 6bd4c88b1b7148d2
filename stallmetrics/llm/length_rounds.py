"""Exact searches of a stated set of vectors against all rows, longest rows first.

Vectors are turned into whole numbers, floor(scale * x), and scored by inner product. The
rows are cut by length into rounds that grow by a factor, and after each round the k-th best
score found so far is the least that a row of the next rounds must reach. By the inequality
of Cauchy and Schwarz a search whose length times the greatest length of a round stays below
that is finished and leaves. A round beats the k-th best of the rounds before it only some k
times a search, so the rows that a search gives back grow with the logarithm of the table and
not with the number of its pieces.

Within a round the rows are dealt to pieces and the searches to blocks, both of bounded size,
and each piece meets each block once: no task holds more than one piece and one block,
however many rows a label or a length has. What is inside a task is the operator's own.

Vectors that are null, empty, or hold null or non-finite components take no part, nor do null
ids and vectors of another size than the most frequent one (the larger of equally frequent
ones). Scores are exact below 2**53; beyond, they are rounded to doubles and held to the
range of a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stallmetrics.llm.common import done, written

#: Rows of the first round, and the factor from one round to the next.
FIRST_ROWS, GROWTH = 8192, 4
#: Bytes of vectors that a piece or a block holds as doubles.
SIDE_BYTES = 32 << 20
#: Labels with their numbers of pieces, 16 bytes each, that may be broadcast; above, they are joined.
BROADCAST_LABELS = 1_000_000
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: The ends of a band without limits.
OPEN = {LEAST: -np.inf, MOST: np.inf}

Found = tuple[int, int, np.ndarray, np.ndarray]  # ask_id, band, vec_ids, scores


@dataclass(frozen=True)
class Piece:
    """Rows of one task, longest first."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    length: np.ndarray


@dataclass(frozen=True)
class Block:
    """Searches of one task. ``lows`` and ``highs`` hold, for each search, the least and the
    greatest score of each of its bands; ``bands`` their numbers."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    length: np.ndarray
    bands: list[list[int]]
    lows: list[list[int]]
    highs: list[list[int]]


def finite(vector: str) -> Column:
    """Not null or empty, and no null, NaN or infinite component."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad


def whole_rows(vectors: DataFrame, scale: int, label: Column | None = None, one_per_id: bool = False) -> DataFrame:
    """vec_id, label, v and length (of the whole-number vector) of the rows that take part, written.

    Equal rows count once; with ``one_per_id`` the row with the least label and then the least
    vector stands for its id.
    """
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          (F.lit(0) if label is None else label).cast("long").alias("label"),
                          F.col("embedding").alias("v"))
    kept = kept.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("v"))
    if not (size := kept.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()):
        return written(kept.withColumn("length", F.lit(0.0)), "vectors")
    kept = kept.filter(F.size("v") == size["d"])
    if one_per_id:
        kept = kept.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    else:
        kept = kept.dropDuplicates()
    scaled = lambda c: c.cast("double") * scale
    floored = lambda c: F.when(F.abs(scaled(c)) < 2.0 ** 53, F.floor(scaled(c)).cast("double")).otherwise(scaled(c))
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + floored(c) * floored(c))
    return written(kept.withColumn("length", F.sqrt(square)), "vectors")


def cut_lengths(rows: DataFrame, first: int = FIRST_ROWS) -> list[tuple[float, float]]:
    """Rounds as (over, up to), longest first; together they hold every length. Rows of equal
    length stay together, so a round can be larger than planned."""
    n = rows.count()
    sizes, left = [], n
    while left > 0:
        sizes.append(min(left, first * GROWTH ** len(sizes)))
        left -= sizes[-1]
    if len(sizes) < 2:
        return [(-1.0, float("inf"))] if n else []
    below = 1.0 - np.cumsum(sizes[:-1]) / n
    cuts = rows.agg(F.percentile_approx("length", [float(b) for b in below], 10_000)).first()[0]
    edges = [float("inf"), *sorted({float(c) for c in cuts}, reverse=True), -1.0]
    return [(low, high) for high, low in zip(edges, edges[1:], strict=False)]


def matrix(column: pa.ChunkedArray, scale: int) -> np.ndarray:
    joined = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = joined.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat.reshape(len(joined), -1) * scale) if len(joined) else np.zeros((0, 0))


def merge_best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best by score and then smaller id, each id once with its best score."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    _, firsts = np.unique(ids, return_index=True)
    firsts = np.sort(firsts)[:k]
    return ids[firsts], scores[firsts]


def _table(found: Iterator[Found]) -> pa.Table:
    parts = list(found)
    sizes = [len(p[2]) for p in parts]
    joined = lambda k, kind: np.concatenate([p[k] for p in parts]).astype(kind) if parts else np.zeros(0, dtype=kind)
    scores = joined(3, np.float64)
    whole = np.where(scores >= 2.0 ** 63, MOST, np.where(scores <= -2.0 ** 63, LEAST, 0))
    inside = np.abs(scores) < 2.0 ** 63
    whole[inside] = scores[inside].astype(np.int64)
    return pa.table({"ask_id": np.repeat(np.array([p[0] for p in parts], dtype=np.int64), sizes),
                     "band": np.repeat(np.array([p[1] for p in parts], dtype=np.int32), sizes),
                     "vec_id": joined(2, np.int64), "score": whole.astype(np.int64)})


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "ask_id long, band int, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each band of each search."""
    once = found.groupBy("ask_id", "band", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("ask_id", "band").orderBy(F.col("score").desc(), "vec_id")
    return once.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= k).drop("__r")


def search(rows: DataFrame, askers: DataFrame, bands: DataFrame, k: int, scale: int,
           kernel: Callable[[Piece, Block, int], Iterator[Found]], by_label: bool = False,
           first: int = FIRST_ROWS, side_bytes: int = SIDE_BYTES) -> DataFrame:
    """ask_id, band, vec_id and score: the k best rows of each band of each search.

    ``askers`` are rows of ``rows`` (the vectors that search); ``bands`` has ask_id, band, low
    and high: which scores count. With ``by_label`` a search meets rows of its own label only;
    a label with many rows is dealt to several pieces. ``kernel`` gets a piece, a block and k.
    """
    spark = rows.sparkSession
    best = _empty(spark)
    cores = max(2, spark.sparkContext.defaultParallelism)
    width = rows.agg(F.max(F.size("v"))).first()[0]
    for low, high in cut_lengths(rows, first):
        band = rows.filter((F.col("length") > low) & (F.col("length") <= high))
        top, n = band.agg(F.max("length"), F.count("*")).first()
        if not n:
            continue
        side = max(64, side_bytes // (8 * width))
        piece = min(side, max(512, n // (3 * cores)))
        reached = best.groupBy("ask_id", "band").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
        limits = bands.join(reached.filter(F.col("n") >= k), ["ask_id", "band"], "left").select(
            "ask_id", "band", F.greatest("low", F.coalesce("kth", "low")).alias("low"), "high")
        limits = limits.filter(F.col("low") <= F.col("high")).groupBy("ask_id").agg(
            F.sort_array(F.collect_list(F.struct("band", "low", "high"))).alias("bands"), F.min("low").alias("low"))
        reach = F.col("length") * top * (1 + 1e-9) + 1.0
        live = written(askers.join(limits, askers["vec_id"] == limits["ask_id"]).filter(
            F.col("low") <= reach).drop("low", "ask_id"), "live")
        asking = live.count()
        if not asking:
            done(live)
            continue
        blocks = -(-asking // side)
        spread = F.xxhash64("vec_id", "v")
        if by_label:
            sizes = band.groupBy("label").agg(F.ceil(F.count("*") / piece).alias("__pieces"))
            sizes = written(sizes, "labels")
            sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_LABELS else sizes
            stored = band.join(sizes, "label").withColumn("piece", F.pmod(spread, F.col("__pieces")))
            asked = live.join(sizes, "label").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__pieces") - 1)))
            keys = ["label", "piece", "block"]
        else:
            pieces = -(-n // piece)
            stored = band.withColumn("piece", F.pmod(spread, F.lit(pieces)))
            asked = live.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pieces - 1).cast("long"))))
            keys = ["piece", "block"]
        stored = stored.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
            "vec_id", "label", "v", "length", *(c for c in keys if c != "label"))
        asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "v", F.lit(1)), F.lit(blocks)).cast("int")).select(
            "vec_id", "label", "v", "length", "bands", *(c for c in keys if c != "label"))

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return _table(iter(()))
            far = left["length"].to_numpy()
            order = np.lexsort((left["vec_id"].to_numpy(), -far))
            held = Piece(left["vec_id"].to_numpy()[order], left["label"].to_numpy()[order],
                         matrix(left["v"], scale)[order], far[order])
            limits = right["bands"].to_pylist()
            pick = lambda name: [[OPEN.get(b[name], b[name]) for b in one] for one in limits]
            return _table(kernel(held, Block(right["vec_id"].to_numpy(), right["label"].to_numpy(), matrix(right["v"], scale),
                                             right["length"].to_numpy(), pick("band"), pick("low"), pick("high")), k))

        found = stored.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
            meet, "ask_id long, band int, vec_id long, score long")
        now = written(_best(best.unionByName(found), k), "best")
        done(live, *([best] if hasattr(best, "work_path") else []))
        best = now
    return best
