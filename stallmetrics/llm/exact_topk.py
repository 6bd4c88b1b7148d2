"""Exact top-k search by inner product: norm-sorted vectors, rotated partial sums, residual bounds.

Rows are processed by descending length, in rounds (``length_rounds``) and within a task in
tiles. Vectors are rotated onto the principal axes of a bounded sample (``SAMPLE_ROWS`` rows
by hash; a rotation changes no inner product, so the sample decides on speed only), which
moves as much of every sum as possible into the leading coordinates. After some leading
coordinates the rest of a sum is at most the product of the lengths of the rests; a pair whose
partial sum and bound together stay below the search's k-th best score is done. What is left
is scored exactly on the whole-number vectors.

A search is an id: neighbours are distinct ids, equal rows count once, and the score of two
ids is the best of their vectors. Rows that take no part are listed in ``length_rounds``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stallmetrics.llm.length_rounds import (
    FIRST_ROWS, LEAST, MOST, SIDE_BYTES, Block, Found, Piece, matrix, merge_best, search, whole_rows)

SAMPLE_ROWS = 4096
#: Shares of the squared length that may be left behind a cut of the rotated coordinates.
RESTS = (0.25, 0.06)
FIRST_TILE, TILE, BATCH = 256, 4096, 256
PAIRS = 1 << 16


def learn_axes(x: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Principal axes as columns, and the cuts behind which the given shares are left."""
    dims = x.shape[1]
    power, axes = np.linalg.eigh(x.T @ x / max(1, len(x)))
    axes, power = axes[:, ::-1], np.maximum(power[::-1], 0.0)
    left = 1.0 - np.cumsum(power) / max(power.sum(), 1e-300)
    cuts = sorted({min(dims, int(np.argmax(left <= share)) + 1) for share in RESTS} - {dims})
    return axes, cuts or [max(1, dims - 1)]


def rests(rotated: np.ndarray, cuts: list[int]) -> list[np.ndarray]:
    """Lengths of what is behind each cut."""
    return [np.sqrt(np.square(rotated[:, c:]).sum(axis=1)) for c in cuts]


class _Best:
    """The k best of each search, and the score that a further row must reach."""

    def __init__(self, block: Block, k: int):
        self.block, self.k = block, k
        self.low = np.array([lows[0] for lows in block.lows], dtype=np.float64)
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, asks: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        good = (scores >= self.low[asks]) & (ids != self.block.ids[asks])
        asks, ids, scores = asks[good], ids[good], scores[good]
        order = np.argsort(asks, kind="stable")
        asks, ids, scores = asks[order], ids[order], scores[order]
        starts = np.flatnonzero(np.diff(asks, prepend=-1))
        for a, s, e in zip(asks[starts].tolist(), starts.tolist(), np.append(starts, len(asks))[1:].tolist(), strict=True):
            had = self.kept.get(a)
            new = (ids[s:e], scores[s:e]) if had is None else (
                np.concatenate([had[0], ids[s:e]]), np.concatenate([had[1], scores[s:e]]))
            self.kept[a] = new = merge_best(*new, self.k)
            if len(new[0]) == self.k:
                self.low[a] = max(self.low[a], new[1][-1])

    def found(self) -> Iterator[Found]:
        for a, (ids, scores) in self.kept.items():
            yield int(self.block.ids[a]), self.block.bands[a][0], ids, scores


def pruned_products(piece: Piece, block: Block, k: int, axes: np.ndarray, cuts: list[int]) -> Iterator[Found]:
    """The k best rows of the piece for each search of the block."""
    xr, qr = piece.x @ axes, block.x @ axes
    x_rest, q_rest = rests(xr, cuts), rests(qr, cuts)
    best = _Best(block, k)
    for a0 in range(0, len(block.ids), BATCH):
        asks = np.arange(a0, min(a0 + BATCH, len(block.ids)))
        start, tile = 0, FIRST_TILE
        while start < len(piece.ids):
            stop, top = min(start + tile, len(piece.ids)), piece.length[start]
            slack = 1e-9 * block.length * top + 1e-6
            asks = asks[best.low[asks] <= block.length[asks] * top + slack[asks]]
            if not len(asks):
                break  # all further rows are shorter
            need = best.low - slack
            partial = xr[start:stop, :cuts[0]] @ qr[asks, :cuts[0]].T
            bound = partial + x_rest[0][start:stop, None] * q_rest[0][None, asks]
            r, a = np.nonzero(bound >= need[asks][None, :])
            if 4 * len(r) > bound.size:  # little to gain by going pair by pair
                scores = piece.x[start:stop] @ block.x[asks].T
                r, a = np.nonzero(scores >= best.low[asks][None, :])
                best.add(asks[a], piece.ids[start + r], scores[r, a])
            else:
                for p in range(0, len(r), PAIRS):
                    rows, ask = start + r[p:p + PAIRS], asks[a[p:p + PAIRS]]
                    sums = partial[r[p:p + PAIRS], a[p:p + PAIRS]]
                    for i, (c, d) in enumerate(zip(cuts, cuts[1:], strict=False), 1):
                        sums = sums + np.einsum("ij,ij->i", xr[rows, c:d], qr[ask, c:d])
                        alive = sums + x_rest[i][rows] * q_rest[i][ask] >= need[ask]
                        rows, ask, sums = rows[alive], ask[alive], sums[alive]
                    best.add(ask, piece.ids[rows], np.einsum("ij,ij->i", piece.x[rows], block.x[ask]))
            start, tile = stop, min(TILE, 4 * tile)
    yield from best.found()


def top_products(vectors: DataFrame, queries: Column, k: int = 10, scale: int = 1024, first: int = FIRST_ROWS,
                 side_bytes: int = SIDE_BYTES) -> DataFrame:
    """query_id, rank, vec_id and score: the k rows of other ids with the greatest inner product,
    ties to the smaller id, for each row that ``queries`` holds for."""
    rows = whole_rows(vectors, scale)
    spark = rows.sparkSession
    sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE_ROWS).select("v").toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    axes, cuts = learn_axes(matrix(sample["v"], scale))
    askers = rows.filter(queries)
    bands = askers.select(F.col("vec_id").alias("ask_id")).distinct().select(
        "ask_id", F.lit(0).alias("band"), F.lit(LEAST).cast("long").alias("low"), F.lit(MOST).cast("long").alias("high"))

    def kernel(piece: Piece, block: Block, k: int) -> Iterator[Found]:
        return pruned_products(piece, block, k, axes, cuts)

    best = search(rows, askers, bands, k, scale, kernel, first=first, side_bytes=side_bytes)
    order = Window.partitionBy("ask_id").orderBy(F.col("score").desc(), "vec_id")
    return best.select(F.col("ask_id").alias("query_id"), F.row_number().over(order).alias("rank"), "vec_id", "score")
