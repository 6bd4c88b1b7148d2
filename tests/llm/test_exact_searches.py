"""Exact top-k search and hard negatives against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallmetrics.llm import exact_topk, hard_negatives, length_rounds, queries

KIND = "vec_id long, embedding array<float>, label int, length string, rank int, score int, v string"


def vectors(spark, ids, x, labels):
    rows = [(None if i is None else int(i), None if v is None else [None if c is None else float(c) for c in v],
             None if y is None else int(y), "a", 1, 2, "b") for i, v, y in zip(ids, x, labels, strict=True)]
    return spark.createDataFrame(rows, KIND)


def data(seed, n=900, dims=16, spread=True):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dims)).astype(np.float32) * rng.lognormal(0, 0.7 if spread else 0, (n, 1)).astype(np.float32)
    x[:, 3:] *= 0.3
    x[n // 2:n // 2 + n // 6] = x[0] + 0.01 * rng.standard_normal((n // 6, dims)).astype(np.float32)  # a group of near copies
    x[-n // 10:] = x[5]  # exact copies under many ids
    return np.arange(n), x, np.where(rng.random(n) < 0.4, 3, rng.integers(0, 8, n))


def plain_topk(ids, x, asks, k, scale):
    whole = np.floor(np.asarray(x, dtype=np.float32).astype(np.float64) * scale).astype(np.int64)
    out = set()
    for q in asks:
        scores = whole @ whole[list(ids).index(q)]
        best = sorted((-s, i) for s, i in zip(scores.tolist(), ids, strict=True) if i != q)[:k]
        out |= {(int(q), r, int(i), -s) for r, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize(("seed", "first", "side"), [(1, 8192, 32 << 20), (2, 64, 32 << 20), (3, 32, 8 * 16 * 64)])
def test_topk_equals_all_pairs(spark, seed, first, side):
    ids, x, labels = data(seed)
    df = vectors(spark, ids, x, labels)
    got = exact_topk.top_products(df, F.col("vec_id") % 20 == 0, 10, 1024, first, side).collect()
    assert {tuple(r) for r in got} == plain_topk(ids, x, ids[ids % 20 == 0], 10, 1024)
    assert len(got) == 10 * 45


def test_topk_prunes(spark):
    """With most of the length in few directions, most pairs end at the bound."""
    ids, x, _ = data(4, 4000)
    whole = np.floor(x.astype(np.float64) * 1024)
    length = np.sqrt((whole ** 2).sum(axis=1))
    order = np.argsort(-length, kind="stable")
    axes, cuts = exact_topk.learn_axes(whole)
    asks = np.arange(0, 4000, 100)
    block = length_rounds.Block(asks, labels=asks, x=whole[asks], length=length[asks], bands=[[0]] * 40,
                                lows=[[-np.inf]] * 40, highs=[[np.inf]] * 40)
    piece = length_rounds.Piece(ids[order], ids[order], whole[order], length[order])
    scored = []
    einsum = np.einsum
    try:
        exact_topk.np.einsum = lambda *a: (scored.append(len(a[1])) if a[1].shape[1] == 16 else None, einsum(*a))[1]
        found = list(exact_topk.pruned_products(piece, block, 10, axes, cuts))
    finally:
        exact_topk.np.einsum = einsum
    assert len(found) == 40
    assert sum(scored) < 0.3 * 40 * 4000


def test_topk_odd_rows(spark):
    x = [[1.0, 2.0], [1.0, 2.0], None, [float("nan"), 1.0], [None, 1.0], [0.0, 0.0], [3.0], [], [float("inf"), 0.0],
         [-1.0, 0.5], [1.0, 2.0], [2.0, 2.0], [1e30, 0.0]]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 1, None, 11]
    df = vectors(spark, ids, x, [None] * len(x))
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in exact_topk.top_products(df, F.col("vec_id") % 5 == 0).collect()}
    score = 1024 * 1024 * 5
    assert got[0, 1] == score
    assert got[0, 5] == 0
    assert got[0, 9] == 0
    assert set(got) == {(0, 1), (0, 5), (0, 9), (0, 11), (5, 0), (5, 1), (5, 9), (5, 11)}
    assert got[5, 11] == 0
    empty = exact_topk.top_products(df.limit(0), F.col("vec_id") % 5 == 0)
    assert (empty.collect(), empty.columns) == ([], ["query_id", "rank", "vec_id", "score"])


def test_topk_several_vectors_of_an_id(spark):
    df = vectors(spark, [0, 0, 1, 1, 2], [[1, 0], [0, 1], [1, 0], [0, 2], [0, 1]], [0] * 5)
    got = [tuple(r) for r in exact_topk.top_products(df, F.col("vec_id") == 0, 2, 1).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2), (0, 2, 2, 1)]


def plain_negatives(ids, x, labels, asks, scale=256):
    whole = np.floor(np.asarray(x, dtype=np.float32).astype(np.float64) * scale).astype(np.int64)
    labels = np.where(ids % 7 == 0, (labels + 1) % 10, labels)
    out = set()
    for a in asks:
        scores = (whole @ whole[a]).tolist()
        same = sorted((-scores[i], i) for i in ids if labels[i] == labels[a] and i != a)[:5]
        for p, pid in same:
            p = -p
            hard = sorted((-scores[i], i) for i in ids if labels[i] != labels[a] and 50 * p <= 100 * scores[i] <= 95 * p)[:3]
            out |= {(int(a), int(pid), r, int(i), p, -s) for r, (s, i) in enumerate(hard, 1)}
    return out


@pytest.mark.parametrize(("seed", "first", "side", "spread"), [
    (1, 8192, 32 << 20, True), (2, 64, 32 << 20, False), (3, 32, 8 * 16 * 64, True)])
def test_negatives_equal_all_pairs(spark, seed, first, side, spread):
    ids, x, labels = data(seed, spread=spread)
    df = vectors(spark, ids, x, labels)
    flipped = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(df, F.col("vec_id") % 25 == 0, flipped, first=first, side_bytes=side).collect()
    want = plain_negatives(ids, x, labels, ids[ids % 25 == 0])
    assert {tuple(r) for r in got} == want
    assert len(got) == len(want) > 50


def test_ranges_hold_every_row_that_reaches_the_score():
    rng = np.random.default_rng(9)
    u = rng.standard_normal((400, 5))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    cosine = u @ u.T
    for low in (-0.9, -0.2, 0.0, 0.4, 0.95, 1.0):
        least, most = hard_negatives.ranges(u, np.full(400, low))
        inside = (u[None] >= least[:, None]) & (u[None] <= most[:, None])
        assert inside.all(axis=2)[cosine >= low].all()
    assert 1 - inside.all(axis=2).mean() > 0.9


def test_negatives_odd_rows(spark):
    x = [[1.0, 1.0], [2.0, 1.0], [1.0, 0.5], [1.0, 0.6], None, [0.0, 0.0], [1.0, None], [1.0, 1.2], [0.9, 0.9], [-1.0, -1.0]]
    ids = [0, 1, 2, 3, 4, 5, 6, 8, None, 9]
    df = vectors(spark, ids, x, [1, 1, 2, 2, 2, 2, 2, None, 2, 1])
    got = hard_negatives.mine(df, F.col("vec_id") == 0, F.col("label"), scale=10, positives=2).collect()
    # positives: 1 (300), 9 (-200: its band is empty); negatives between 150 and 285
    assert {tuple(r) for r in got} == {(0, 1, 1, 3, 300, 160), (0, 1, 2, 2, 300, 150)}
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") == 0, F.col("label")).collect() == []
    twice = df.unionByName(df)
    assert sorted(hard_negatives.mine(twice, F.col("vec_id") == 0, F.col("label"), scale=10, positives=2).collect()) == sorted(got)


def test_queries_on_given_tables(spark):
    """The registered queries return whole results on the smallest tables."""
    sf = "/root/testdata/sf0.001"
    assert queries.op13_exact_topk(spark, sf).count() == 50
    assert queries.op12_hard_negatives(spark, sf).columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
