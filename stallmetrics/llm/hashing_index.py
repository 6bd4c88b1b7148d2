"""Nearest neighbours by multi-index hashing of learned binary codes.

Codes are the signs of rotated principal components; the rotations are learned on a bounded
sample so that the signs lose little (alternating least squares), once per block of bits.
Each code is cut into substrings of eight bits, each with its own index. If two codes differ
in at most R bits, one of the m substrings differs in at most R // m, so probing all buckets
within that distance of each substring retrieves every code within R. What is within R is
then reranked by inner products of the original vectors in double precision.

R is learned on the sample: it covers ``coverage`` of the pairs of a vector and its nearest
ones there; in a larger table the nearest are nearer still. As long as a query has found fewer
than k other ids, R is raised in each shard until that holds k of them or all its rows are in.

Every row is indexed, once: shards of a bounded number of rows stay where they are dealt, each
builds its index, and the queries pass by it in batches. Shards are searched in rounds that
grow by a factor; after a round each query knows its k-th best score, and only better rows
come back, so answers grow with the logarithm of the table and not with the number of shards. Vectors that are null, zero, of another length than the sample's most frequent
one, or with null or non-finite components take no part; a null id takes none either.

Neighbours are ids. Rows that repeat an id with the same vector count once; if an id has
several vectors it asks with each and is found by each, and the score of two ids is the best
of their vectors. Rows are dealt to rounds and shards by id and vector, so the vectors of one
id spread.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stallmetrics.llm.common import done, written

SAMPLE_ROWS = 4096
ROTATIONS = 2
#: Rows of a shard: at most, and where that leaves cores without one.
SHARD_ROWS, LEAST_SHARD = 131_072, 16_384
#: Rows of the first round, and the factor from one round to the next.
FIRST_ROWS, GROWTH = 65_536, 4
_PLACES = 1 << 30
_POPCOUNT = np.array([bin(x).count("1") for x in range(256)], dtype=np.uint8)


@dataclass(frozen=True)
class Coder:
    mean: np.ndarray
    planes: np.ndarray
    radius: int

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Rows of bytes; each byte is a substring."""
        return np.packbits((x - self.mean) @ self.planes > 0, axis=1)


def learn_rotation(x: np.ndarray, seed: int, rounds: int = 30) -> np.ndarray:
    """Principal axes, rotated so that the signs of the projections are close to them."""
    dims = x.shape[1]
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    basis = np.zeros((dims, dims))
    basis[:len(axes)] = axes
    v = x @ basis.T
    rotation, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.sign(v @ rotation).T @ v)
        rotation = (u @ w).T
    return basis.T @ rotation


def learn_coder(x: np.ndarray, k: int, rotations: int = ROTATIONS, coverage: float = 0.95, probes: int = 256) -> Coder:
    mean = x.mean(axis=0)
    planes = np.concatenate([learn_rotation(x - mean, seed) for seed in range(rotations)], axis=1)
    planes = planes[:, :planes.shape[1] // 8 * 8] if planes.shape[1] >= 8 else np.pad(planes, ((0, 0), (0, 8 - planes.shape[1])))
    coder = Coder(mean, planes, 0)
    codes = coder.codes(x)
    scores = x[:probes] @ x.T
    np.fill_diagonal(scores, -np.inf)
    near = np.argsort(-scores, axis=1)[:, :min(k, len(x) - 1)]
    apart = _POPCOUNT[codes[:probes, None, :] ^ codes[near]].sum(axis=2) if near.size else np.zeros(1)
    return Coder(mean, planes, int(np.quantile(apart, coverage)))


def _masks() -> list[np.ndarray]:
    """The bytes with at most r bits, for each r."""
    return [np.flatnonzero(_POPCOUNT <= r).astype(np.uint8) for r in range(9)]


def _words(codes: np.ndarray) -> list[np.ndarray]:
    """Codes as columns of eight bytes, the last filled up with zeros."""
    full = np.pad(codes, ((0, 0), (0, -codes.shape[1] % 8)))
    return list(np.ascontiguousarray(np.ascontiguousarray(full).view(np.uint64).T))


class Index:
    """The substring tables of one shard.

    What the buckets near a byte hold is kept as bits of rows once it has been probed: many queries share a byte,
    and the rows found by any table are the bits found by each, taken together.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(codes[:, j], kind="stable").astype(np.int32) for j in range(codes.shape[1])]
        self.starts = [np.searchsorted(codes[o, j], np.arange(257)) for j, o in enumerate(self.order)]
        self.masks = _masks()
        self.words = _words(codes)
        self.probed: dict[tuple[int, int, int], np.ndarray] = {}

    def probe(self, j: int, byte: int, radius: int) -> np.ndarray:
        """Bits of the rows in the buckets of table ``j`` that differ from a byte in at most ``radius`` bits."""
        if (j, byte, radius) not in self.probed:
            hit = np.zeros(len(self.codes), dtype=bool)
            for b in (byte ^ self.masks[radius]).tolist():
                hit[self.order[j][self.starts[j][b]:self.starts[j][b + 1]]] = True
            self.probed[j, byte, radius] = np.packbits(hit)
        return self.probed[j, byte, radius]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose codes differ from ``code`` in at most ``radius`` bits."""
        m = self.codes.shape[1]
        near = min(8, radius // m)
        if len(self.probed) > 256 * m * 2:  # bits of more than two radii
            self.probed = {key: bits for key, bits in self.probed.items() if key[2] == near}
        hit = np.bitwise_or.reduce([self.probe(j, byte, near) for j, byte in enumerate(code.tolist())])
        hit = np.unpackbits(hit, count=len(self.codes)).view(bool)
        rows = None if 2 * np.count_nonzero(hit) > len(hit) else np.flatnonzero(hit)  # none: too many to be picked out one by one
        apart = 0
        for word, asked in zip(self.words, _words(code[None, :]), strict=True):
            apart = np.bitwise_count((word if rows is None else word[rows]) ^ asked) + (apart if m <= 24 else np.int16(0) + apart)
        return np.flatnonzero(hit & (apart <= radius)) if rows is None else rows[apart <= radius]

    def near(self, code: np.ndarray, radius: int, least: int, groups: np.ndarray | None = None, own: int = -1) -> np.ndarray:
        """The same, with the radius raised until ``least`` rows are found or all are.

        With ``groups``, the number of each row's group from 0, until ``least`` groups are found; rows of ``own`` are left out.
        """

        def found() -> tuple[np.ndarray, int, bool]:
            rows = self.within(code, radius)
            last = len(rows) == len(self.codes)
            if groups is None:
                return rows, len(rows), last
            rows = rows[groups[rows] != own] if own >= 0 else rows
            return rows, np.count_nonzero(np.bincount(groups[rows])) if least else 0, last

        rows, n, last = found()
        while n < least and not last:
            radius += max(1, self.codes.shape[1] // 2)
            rows, n, last = found()
        return rows


def best_of_each(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Places of the best score of each id."""
    order = np.lexsort((-scores, ids))
    return order[np.flatnonzero(np.concatenate([np.ones(min(1, len(order)), dtype=bool), np.diff(ids[order]) != 0]))]


def sound(vector: str) -> Column:
    """No null, NaN or infinite component, and not all zero."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda v: v != 0)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    joined = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = joined.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(joined), -1) if len(joined) else np.zeros((0, 0))


def rounds_of(n: int, first: int = FIRST_ROWS) -> list[tuple[int, int]]:
    """Shares of the rows, in places from 0 to 2**30, that the rounds take."""
    sizes, left = [], n
    while left > 0:
        sizes.append(min(left, first * GROWTH ** len(sizes)))
        left -= sizes[-1]
    ends = [round(int(e) / n * _PLACES) for e in np.cumsum(sizes)]
    return list(zip([0, *ends[:-1]], [*ends[:-1], _PLACES], strict=True))


#: Estimates in single precision are made for vectors up to this length; beyond it their squares might overflow.
LONGEST = 1e15


class _Shard:
    """One shard's rows as they come, and its answers once all are in."""

    def __init__(self, coder: Coder, k: int):
        self.coder, self.k = coder, k
        self.ids: list[np.ndarray] = []
        self.rows: list[np.ndarray] = []
        self.index: Index | None = None

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.ids.append(ids)
        self.rows.append(x)

    def close(self) -> None:
        if self.index is None and self.rows:
            self.id, self.x = np.concatenate(self.ids), np.concatenate(self.rows)
            self.ids, self.rows = [], []
            self.index = Index(self.coder.codes(self.x))
            self.known, self.groups = np.unique(self.id, return_inverse=True)
            self.longest = float(np.sqrt((self.x ** 2).sum(axis=1).max()))
            self.brief = self.x.astype(np.float32) if self.longest < LONGEST else None

    def promising(self, found: np.ndarray, q: np.ndarray, least: float) -> np.ndarray:
        """``found`` without rows that cannot come in: their score in single precision is below the least one needed
        (a query's score so far, or the k-th in this shard) by more than its largest error."""
        length = float(np.sqrt(q @ q))
        if self.brief is None or not length < LONGEST:
            return found
        about = self.brief.take(found, axis=0) @ q.astype(np.float32)
        off = (2 * len(q) + 8) * 2.0 ** -24 * length * self.longest + 1e-20
        if len(found) > self.k and len(self.known) == len(self.id):
            kth = float(np.partition(about, -self.k)[-self.k]) - off
            least = kth if np.isnan(least) else max(least, kth)
        return found if np.isnan(least) else found[about >= least - off]

    def answer(self, asking: np.ndarray, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """query_id, vec_id and score of what is at least as good as each query's score so far (NaN: none yet)."""
        self.close()
        out: list[tuple[np.ndarray, ...]] = []
        if self.index is not None and len(q):
            codes = self.coder.codes(q)
            place = np.minimum(np.searchsorted(self.known, asking), len(self.known) - 1)
            own = np.where(self.known[place] == asking, place, -1)
            for i in range(len(q)):
                need = self.k if np.isnan(least[i]) else 0
                found = self.index.near(codes[i], self.coder.radius, need, self.groups, own[i])
                found = self.promising(found, q[i], least[i])
                scores = np.einsum("ij,j->i", self.x[found], q[i])  # equal rows score alike wherever they stand
                if not need:
                    found, scores = found[better := scores >= least[i]], scores[better]
                if len(self.known) < len(self.id):
                    found, scores = found[best := best_of_each(self.id[found], scores)], scores[best]
                if len(found) > self.k:  # all that tie with the k-th stay until ids decide
                    found, scores = found[least_ := scores >= np.partition(scores, -self.k)[-self.k]], scores[least_]
                best = np.lexsort((self.id[found], -scores))[:self.k]
                out.append((np.full(len(best), asking[i]), self.id[found[best]], scores[best]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)


def nearest(vectors: DataFrame, queries: Column, k: int = 20, sample_rows: int = SAMPLE_ROWS, first: int = FIRST_ROWS,
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found by inner product, for each row that ``queries`` holds for."""
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("embedding").alias("v")).filter(F.col("vec_id").isNotNull() & sound("v"))
    rows = written(rows.dropDuplicates(["vec_id", "v"]), "vectors")
    sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(sample_rows).select("v").toPandas()["v"]
    schema = "query_id long, rank int, vec_id long, score double"
    if sample.empty:
        return spark.createDataFrame([], schema)
    dims = int(sample.map(len).mode()[0])
    coder = learn_coder(np.stack([np.asarray(v, dtype=np.float64) for v in sample if len(v) == dims]), k)
    rows = rows.filter(F.size("v") == dims)
    n = rows.count()
    best = spark.createDataFrame([], "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    def search(batches):
        shard, number = _Shard(coder, k), None
        for batch in batches:
            numbers, kinds = (batch[c].to_numpy() for c in ("shard", "asks"))
            cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(numbers)], strict=True):
                if stop == start:
                    continue
                piece = batch.slice(start, stop - start)
                if numbers[start] != number:
                    shard, number = _Shard(coder, k), numbers[start]
                ids, x = piece["vec_id"].to_numpy(), _matrix(piece["v"])
                if not kinds[start]:
                    shard.add(ids, x)
                    continue
                least = piece["least"].to_numpy(zero_copy_only=False).astype(np.float64)
                for at in range(0, len(ids), 2048):
                    q, v, s = shard.answer(ids[at:at + 2048], x[at:at + 2048], least[at:at + 2048])
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
                                                     names=["query_id", "vec_id", "score"])

    for low, high in rounds_of(n, first):
        held = max(1, round(n * (high - low) / _PLACES))
        shards = max(-(-held // shard_rows), min(spark.sparkContext.defaultParallelism, -(-held // min(shard_rows, LEAST_SHARD))))
        place = F.pmod(F.xxhash64("vec_id", "v", F.lit(3)), F.lit(_PLACES))
        stored = rows.filter((place >= low) & (place < high)).select(
            "vec_id", "v", F.lit(None).cast("double").alias("least"), F.lit(0).alias("asks"),
            F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard"))
        kth = best.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") >= k)
        asking = rows.filter(queries)
        asked = asking.join(kth, asking["vec_id"] == kth["query_id"], "left").select(
            "vec_id", "v", "least", F.lit(1).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
        dealt = stored.unionByName(asked).repartitionById(shards, "shard").sortWithinPartitions("shard", "asks")
        found = dealt.mapInArrow(search, "query_id long, vec_id long, score double")
        both = best.unionByName(found).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        now = written(ranked(both).drop("rank"), "best")
        if hasattr(best, "work_path"):
            done(best)
        best = now
    return ranked(best).select("query_id", "rank", "vec_id", "score")
