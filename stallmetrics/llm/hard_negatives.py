"""Hard negatives by coordinate pruning over length buckets.

A task cuts its rows, longest first, into buckets of ``BUCKET`` rows and keeps each bucket's
unit vectors as one sorted list per coordinate. A search needs scores of at least t, so unit
vectors within the angle arccos(t / (length of the anchor * greatest length of the bucket));
that fixes for each coordinate the range in which such a vector's value lies. The ``FOCUS``
largest coordinates of the anchor are looked up in the sorted lists, their ranges intersected,
and what is left is scored exactly. Where no range excludes anything the whole bucket is
scored at once. t is the least score that counts, and rises to the k-th best found.

Positives are searched among the rows of the anchor's label, negatives among all rows in one
band of scores for each positive, both in rounds (``length_rounds``). A label that holds most
rows is dealt over many pieces.

Of several rows with one id the one with the least label and then the least vector takes part;
rows without a label take none. A positive whose score is below zero has no negatives, since
the band between half of it and 95 % of it is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stallmetrics.llm.common import written
from stallmetrics.llm.length_rounds import (
    FIRST_ROWS, LEAST, MOST, SIDE_BYTES, Block, Found, Piece, merge_best, search, whole_rows)

BUCKET, BATCH, FOCUS = 1024, 256, 4


class Bucket:
    """Rows of about one length with a sorted list of values for each coordinate."""

    def __init__(self, piece: Piece, start: int, stop: int):
        self.ids, self.labels, self.x = piece.ids[start:stop], piece.labels[start:stop], piece.x[start:stop]
        self.longest, self.shortest = piece.length[start], piece.length[stop - 1]
        length = np.maximum(piece.length[start:stop], 1e-300)[:, None]
        self.unit = self.x / length
        self.order = np.argsort(self.unit, axis=0, kind="stable")
        self.values = np.take_along_axis(self.unit, self.order, axis=0)

    def angle(self, low: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The least cosine that a row needs to reach ``low``; over 1 where none can."""
        far = length * np.where(low >= 0, self.longest, self.shortest)
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = low / far
        return np.where(far > 0, cosine, np.where(low > 0, np.inf, -np.inf))


def ranges(focus: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of a coordinate in a unit vector with at least ``cosine`` to one
    that has the value ``focus`` there."""
    a, t = np.arccos(np.clip(focus, -1, 1)), np.arccos(np.clip(cosine - 1e-9, -1, 1))[:, None]
    return np.cos(np.minimum(np.pi, a + t)) - 1e-7, np.cos(np.maximum(0.0, a - t)) + 1e-7


class _Bands:
    """The k best of each band of each search, and the least score still of use to a search."""

    def __init__(self, block: Block, k: int):
        self.block, self.k = block, k
        self.lows = [np.array(low, dtype=np.float64) for low in block.lows]
        self.highs = [np.array(high, dtype=np.float64) for high in block.highs]
        self.kept: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.low = np.array([low.min() for low in self.lows])

    def add(self, a: int, ids: np.ndarray, scores: np.ndarray) -> None:
        for b in range(len(self.lows[a])):
            inside = (scores >= self.lows[a][b]) & (scores <= self.highs[a][b])
            if not inside.any():
                continue
            had = self.kept.get((a, b), (ids[:0], scores[:0]))
            new = merge_best(np.concatenate([had[0], ids[inside]]), np.concatenate([had[1], scores[inside]]), self.k)
            self.kept[a, b] = new
            if len(new[0]) == self.k:
                self.lows[a][b] = max(self.lows[a][b], new[1][-1])
        self.low[a] = self.lows[a].min()

    def found(self) -> Iterator[Found]:
        for (a, b), (ids, scores) in self.kept.items():
            yield int(self.block.ids[a]), self.block.bands[a][b], ids, scores


def coordinate_search(piece: Piece, block: Block, k: int, same_label: bool) -> Iterator[Found]:
    """The k best rows of the piece in each band of each search of the block."""
    best = _Bands(block, k)
    unit = block.x / np.maximum(block.length, 1e-300)[:, None]
    picked = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
    finished = np.zeros(len(block.ids), dtype=bool)
    for start in range(0, len(piece.ids), BUCKET):
        bucket = Bucket(piece, start, min(start + BUCKET, len(piece.ids)))
        for a0 in range(0, len(block.ids), BATCH):
            asks = a0 + np.flatnonzero(~finished[a0:a0 + BATCH])
            cosine = bucket.angle(best.low[asks], block.length[asks])
            over = cosine > 1 + 1e-9
            finished[asks[over]] = True  # further buckets are shorter
            asks, cosine = asks[~over], cosine[~over]
            if not len(asks):
                continue
            focus = picked[asks]
            low, high = ranges(np.take_along_axis(unit[asks], focus, axis=1), cosine)
            begin, end = np.zeros_like(focus), np.zeros_like(focus)
            for c in np.unique(focus):
                i, j = np.nonzero(focus == c)
                begin[i, j] = np.searchsorted(bucket.values[:, c], low[i, j], "left")
                end[i, j] = np.searchsorted(bucket.values[:, c], high[i, j], "right")
            sizes = end - begin
            whole = (sizes == len(bucket.ids)).all(axis=1)
            if whole.any():
                scores = bucket.x @ block.x[asks[whole]].T
                for a, column in zip(asks[whole].tolist(), scores.T, strict=True):
                    _take(best, bucket, block, a, np.flatnonzero(column >= best.low[a]), column, same_label)
            for i in np.flatnonzero(~whole & (sizes > 0).all(axis=1)).tolist():
                j = int(np.argmin(sizes[i]))
                rows = bucket.order[begin[i, j]:end[i, j], focus[i, j]]
                for other in range(focus.shape[1]):
                    if other != j and sizes[i, other] < len(bucket.ids):
                        value = bucket.unit[rows, focus[i, other]]
                        rows = rows[(value >= low[i, other]) & (value <= high[i, other])]
                scores = np.zeros(len(bucket.ids))
                scores[rows] = bucket.x[rows] @ block.x[asks[i]]
                _take(best, bucket, block, int(asks[i]), rows, scores, same_label)
    yield from best.found()


def _take(best: _Bands, bucket: Bucket, block: Block, a: int, rows: np.ndarray, scores: np.ndarray, same_label: bool) -> None:
    fits = ((bucket.labels[rows] == block.labels[a]) == same_label) & (bucket.ids[rows] != block.ids[a])
    rows = rows[fits]
    if len(rows):
        best.add(a, bucket.ids[rows], scores[rows])


def _by_same_label(piece: Piece, block: Block, k: int) -> Iterator[Found]:
    return coordinate_search(piece, block, k, True)


def _by_other_label(piece: Piece, block: Block, k: int) -> Iterator[Found]:
    return coordinate_search(piece, block, k, False)


def mine(vectors: DataFrame, anchors: Column, label: Column, scale: int = 256, positives: int = 5, negatives: int = 3,
         least: int = 50, most: int = 95, first: int = FIRST_ROWS, side_bytes: int = SIDE_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are the rows that ``anchors`` holds for; a negative's score lies between ``least``
    and ``most`` percent of its positive's.
    """
    rows = whole_rows(vectors, scale, label, one_per_id=True)
    askers = rows.filter(anchors)
    ranked = lambda df, *keys: df.withColumn("rank", F.row_number().over(
        Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")))
    all_scores = askers.select(F.col("vec_id").alias("ask_id"), F.lit(0).alias("band"),
                               F.lit(LEAST).cast("long").alias("low"), F.lit(MOST).cast("long").alias("high"))
    near = search(rows, askers, all_scores, positives, scale, _by_same_label, True, first, side_bytes)
    near = written(ranked(near, "ask_id").select("ask_id", F.col("rank").alias("band"), F.col("vec_id").alias("positive_id"),
                                                 F.col("score").alias("positive_score")), "positives")
    # Hundredths apart, so that no product leaves the range of a long.
    share = lambda percent, more: F.expr(
        f"positive_score div 100 * {percent} + (positive_score % 100 * {percent} + {more}) div 100")
    bands = near.filter(F.col("positive_score") >= 0).select(
        "ask_id", "band", share(least, 99).alias("low"), share(most, 0).alias("high"))
    hard = search(rows, askers, bands, negatives, scale, _by_other_label, False, first, side_bytes)
    return ranked(hard, "ask_id", "band").join(near, ["ask_id", "band"]).select(
        F.col("ask_id").alias("anchor_id"), "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
