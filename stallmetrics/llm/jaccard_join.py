"""N-gram Jaccard join of whole texts, with prefix filters under several global token orders.

A set's prefix under a total order of all tokens is so long that two sets which reach the
threshold must share a token of their prefixes, early enough in both. That holds for every
order, so a pair has to share one under each of them. Three orders are used: the rarest
tokens first; coarse classes of frequency, by hash within them; by hash alone. In all of them a
token of one set alone comes first: it can never be shared, so most sets need no candidates
at all.

Steps: (1) per text its set's hash, size and min-hashes; equal sets become one node, and
tokens that are very common in a batch of texts are noted. (2) One shuffle of (token, set)
finds the tokens of two or more sets and their frequencies; the rows of common tokens are
spread over all partitions. (3) Sets whose prefix holds only unshared tokens drop out. (4)
Pairs that share a token of the first order's prefixes are the candidates; (5) those that
share none of the second's, and then of the third's, are dropped, by joins of (token, set)
rows; (6) the token lists of what is left are joined and intersected exactly. (7) Components
over all verified links.

An extra for large families of altered copies (``stars``, can be switched off): sets are first
paired with the centre of those that have the same min-hash, about one pair a set. These pairs
pass the filters of all orders and the same verification, and sets that they connect need no
further pairs. Components are the same with and without it.

Text without words: an empty set, linked with nothing; a null id stays null. Repeated rows
and equal texts are one node, so their number makes no pairs. Token hashes have 55 bits and
set hashes 64: among n different texts n * n / 2**65 pairs are expected to
be taken for equal, 0.03 at a billion texts. No partner or candidate is
capped; the list of common tokens steers partitioning and order only, and any order gives the same links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from stallmetrics.llm.common import done, sized, texts, under_plain_names, written

WORDS = 5
PERCENT = 75
ORDERS = 3
HASHES = 12
#: A token is common if it is in at least this share of all sets. Their number is bounded by the mean set size over it.
COMMON_SHARE = 0.001
#: Frequencies up to this are told apart; above it, every doubling is a class. The class stands above a token's 56 bits.
EXACT_DF = 64
#: Sets of one token whose rows a task holds back to count them; a larger group counts as most frequent.
EXACT_ROWS = 50_000
#: Words whose hashes a worker remembers, some 200 bytes each.
KNOWN_WORDS = 100_000
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_ODD = [[np.uint64(int(m) * (2 * k + 1) & (1 << 64) - 1) for k in range(HASHES)] for m in _MIX]
_UPPER = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UPPER, bytes(range(97, 123)))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """Hashes of words, computed at first sight."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


class Shingler:
    """Token sets of texts; remembers the hashes of words up to a bound."""

    def __init__(self, words: int = WORDS):
        self.words, self.hashes = words, _Hashes()

    def tokens(self, text: str) -> np.ndarray:
        """The distinct hashes of the text's word n-grams, sorted: 56 bits, of which the lowest is 0."""
        words = text.encode().translate(_LOWER).split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        known = self.hashes
        if len(known) > KNOWN_WORDS:
            known.clear()
        h = np.array([known[w] for w in words], dtype=np.uint64)
        n = min(self.words, len(h))
        rolled = np.full(len(h) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            rolled = rolled * _MIX[0] + h[k:len(h) - n + 1 + k]
        return np.unique(_mixed(rolled) >> np.uint64(9)) << np.uint64(1)


class _Common:
    """Marks the common tokens: their lowest bit is set. A table over the leading bits spares most look-ups."""

    def __init__(self, common: np.ndarray):
        self.common = common
        self.leading = np.zeros(1 << 16, dtype=bool)
        self.leading[common >> np.uint64(40)] = True

    def mark(self, tokens: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.leading[tokens >> np.uint64(40)])
        if len(maybe):
            place = np.searchsorted(self.common, tokens[maybe])
            place[place == len(self.common)] = 0
            tokens[maybe[self.common[place] == tokens[maybe]]] |= np.uint64(1)
        return tokens


def set_hash(tokens: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes()))))


def _min_hashes(tokens: np.ndarray, hashes: int) -> np.ndarray:
    """Tokens are well mixed already: an odd multiplier is a new order of them."""
    return np.array([(tokens * odd).min() for odd in _ODD[0][:hashes]], dtype=np.uint64).view(np.int64)


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    """A row per text, and rows (set null) with the common tokens of each batch."""

    def run(batches):
        own = Shingler(words)
        for batch in sized(batches, "text"):
            sets = [own.tokens(t) for t in texts(batch)]
            keys = [set_hash(s) if len(s) else None for s in sets]
            first = {k: s for k, s in zip(keys, sets, strict=True) if k is not None}
            token, count = (np.unique(np.concatenate(list(first.values())), return_counts=True) if first
                            else (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            often = count >= max(4, len(first) * COMMON_SHARE * 2)
            pad = int(often.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([batch["doc_id"].cast(pa.int64()), pa.nulls(pad, pa.int64())]),
                 pa.array([True] * len(sets) + [False] * pad),
                 pa.array([len(s) for s in sets] + [0] * pad, pa.int64()),
                 pa.array([*keys, *[None] * pad], pa.int64()),
                 pa.array([*[None] * len(sets), *token[often].view(np.int64).tolist()], pa.int64()),
                 pa.array([0] * len(sets) + count[often].tolist(), pa.int64())],
                names=["doc_id", "is_text", "n_shingles", "set_id", "token", "seen"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, is_text boolean, n_shingles long, set_id long, token long, seen long")


def _shared_tokens(docs: DataFrame, words: int, common: np.ndarray) -> DataFrame:
    """(set_id, token) of every token that two or more sets have, its class of frequency in the top bits."""

    def emit(batches):
        own, known = Shingler(words), _Common(common)
        for batch in sized(batches, "text"):
            done, sets, lists = set(), [], []
            for text in texts(batch):
                tokens = own.tokens(text)
                key = set_hash(tokens) if len(tokens) else None
                if key is None or key in done:
                    continue
                done.add(key)
                sets.append(key)
                lists.append(known.mark(tokens) if len(common) else tokens)
            sizes = np.array([len(x) for x in lists], dtype=np.int64)
            flat = np.concatenate(lists).view(np.int64) if lists else np.zeros(0, np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sets, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["set_id", "tokens"])

    def count(batches):
        held: list[np.ndarray] = []  # rows of the last token so far, still uncounted
        large = None  # a token whose rows are passed on as they come
        for batch in batches:
            token = batch["token"].to_numpy(zero_copy_only=False)
            key = batch["set_id"].to_numpy(zero_copy_only=False)
            if not len(token):
                continue
            if held:
                token = np.concatenate([np.full(len(held[1]), held[0][0], dtype=np.int64), token])
                key = np.concatenate([held[1], key])
                held = []
            cuts = np.flatnonzero(np.diff(token)) + 1
            starts = np.concatenate([[0], cuts])
            sizes = np.diff(np.concatenate([starts, [len(token)]]))
            tail = int(sizes[-1])
            if tail <= EXACT_ROWS and token[-1] != large:
                held = [token[-1:].copy(), key[len(key) - tail:].copy()]
                token, key, sizes = token[:len(token) - tail], key[:len(key) - tail], sizes[:-1]
            if len(token):
                yield from _counted(token, key, sizes, large)
            if not held:
                large = token[-1]
        if held:
            yield from _counted(np.full(len(held[1]), held[0][0], dtype=np.int64), held[1], np.array([len(held[1])]), large)

    rows = docs.select("text").mapInArrow(emit, "set_id long, tokens array<long>").select(
        "set_id", F.explode("tokens").alias("token"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, F.when(F.col("token").bitwiseAND(F.lit(1)) == 0, F.col("token"))
                             .otherwise(F.xxhash64("token", "set_id")))
    return dealt.sortWithinPartitions("token").mapInArrow(count, "set_id long, token long")


def _class_of(df: np.ndarray) -> np.ndarray:
    """Frequency classes below 127, in the order of the frequencies. Any order of tokens serves the filter."""
    return np.where(df <= EXACT_DF, df, EXACT_DF + np.log2(np.maximum(df, EXACT_DF) / EXACT_DF).astype(np.int64) + 1)


def _counted(token: np.ndarray, key: np.ndarray, sizes: np.ndarray, large) -> list[pa.RecordBatch]:
    """The rows of tokens with two or more distinct sets; every row of a token has the same class of frequency."""
    df = np.repeat(sizes, sizes)
    frequent = ((token & 1) == 1) | (df > EXACT_ROWS) | ((token == large) if large is not None else False)
    # the same set may come from several batches: a token of one set alone is not shared
    group = np.repeat(np.arange(len(sizes)), sizes)
    least, most = (np.full(len(sizes), fill, dtype=np.int64) for fill in (np.iinfo(np.int64).max, np.iinfo(np.int64).min))
    np.minimum.at(least, group, key)
    np.maximum.at(most, group, key)
    keep = (least < most)[group] | frequent
    ranked = token | np.where(frequent, 126, _class_of(df)) << 56
    return [pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(ranked[keep])], names=["set_id", "token"])] if keep.any() else []


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Tokens that a set of ``n`` must hold in its prefix: two such sets that share none are below the threshold."""
    return n + (-n * percent // 100) + 1


def in_order(tokens: np.ndarray, order: int) -> np.ndarray:
    """Indices of shared tokens, their class of frequency in the top bits, by one of the global orders."""
    tie = tokens.view(np.uint64) * _ODD[1][order]
    f = tokens >> 56
    return np.lexsort((tie, (f, (f > 8).astype(np.int64) + (f > EXACT_DF), np.zeros_like(f))[order]))


def prefix(tokens: np.ndarray, n: int, unshared: int, order: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The shared tokens in a set's prefix under an order, with their places from 1; the unshared ones come before them."""
    first = in_order(tokens, order)[:max(0, prefix_length(n, percent) - unshared)]
    return tokens[first], np.arange(unshared + 1, unshared + 1 + len(first))


def _active(shared: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The sets whose prefixes hold shared tokens, with those tokens, sorted, and the number of the others."""
    lists = shared.groupBy("set_id").agg(F.collect_set("token").alias("rows"))
    known = lists.join(nodes.select("set_id", "n_shingles"), "set_id").filter(
        F.col("n_shingles") - F.size("rows") < F.expr(f"n_shingles + floor(-n_shingles * {percent} / 100D) + 1"))

    def described(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens, mins, weights, own = [], [], [], []
            for row, n in zip(batch["rows"], batch["n_shingles"].to_pylist(), strict=True):
                t = np.sort(row.values.to_numpy())
                own.append(n - len(t))
                weights.append((int((t >> 56).sum()) + own[-1]) / n)
                tokens.append(t)
                mins.append(_min_hashes(t.view(np.uint64), HASHES))
            yield pa.RecordBatch.from_arrays(
                [batch["set_id"], batch["n_shingles"], pa.array(own, pa.int64()), pa.array(weights, pa.float64()),
                 pa.array(mins, pa.list_(pa.int64())), pa.array(tokens, pa.list_(pa.int64()))],
                names=["set_id", "n", "u", "weight", "mins", "tokens"])

    return known.select("set_id", "n_shingles", "rows").mapInArrow(
        described, "set_id long, n long, u long, weight double, mins array<long>, tokens array<long>")


def _prefix_rows(active: DataFrame, order: int, percent: int) -> DataFrame:
    """(token, set_id, n, place) of the prefixes of all sets under one order."""

    def cut(batches):
        for batch in batches:
            found = [prefix(t.values.to_numpy(), n, u, order, percent) for t, n, u in zip(
                batch["tokens"], batch["n"].to_pylist(), batch["u"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["set_id"], batch["n"], pa.array([f[0] for f in found], pa.list_(pa.int64())),
                 pa.array([f[1] for f in found], pa.list_(pa.int64()))], names=["set_id", "n", "token", "place"])

    lists = active.select("set_id", "n", "u", "tokens").mapInArrow(cut, "set_id long, n long, token array<long>, place array<long>")
    return lists.select("set_id", "n", F.explode(F.arrays_zip("token", "place")).alias("p")).select(
        F.col("p.token").alias("token"), "set_id", "n", F.col("p.place").alias("place"))


def _enough(n_a: int, n_b: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """For shared tokens at places ``a`` and ``b`` of an order: could the pair reach the threshold if this is the first?"""
    most = np.minimum(n_a - a, n_b - b) + 1
    return (100 + percent) * most >= percent * (n_a + n_b)


def _enough_rows(percent: int):
    most = F.least(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b")) + 1
    return (100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))


def _ids(pairs: DataFrame) -> DataFrame:
    """The sets that occur in pairs. Spark knows the size of the written ids and joins by it."""
    return written(pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct(), "ids")


def _sharing(pairs: DataFrame, active: DataFrame, order: int, percent: int) -> DataFrame:
    """The pairs that share a prefix token, early enough, under one more order; joined by (token, set) rows."""
    rows = _prefix_rows(active.join(_ids(pairs), "set_id", "left_semi"), order, percent)
    side = {s: rows.select("token", F.col("set_id").alias(s), F.col("n").alias(f"n_{s}"), F.col("place").alias(f"p_{s}")) for s in "ab"}
    met = pairs.join(side["a"], "a").join(side["b"], ["b", "token"]).filter(_enough_rows(percent))
    return met.select("a", "b").distinct()


def _verified(pairs: DataFrame, active: DataFrame, percent: int, orders: tuple[int, ...] = ()) -> DataFrame:
    """The written pairs (a, b) that reach the threshold; before, those that fail the filter of one of
    ``orders`` are dropped.

    Tokens of one set alone cannot be common ones, so the shared ones do. Only sets that
    occur in a pair are shuffled.
    """
    sets = active.join(_ids(pairs), "set_id", "left_semi")
    side = {s: sets.select(F.col("set_id").alias(s), F.col("n").alias(f"n_{s}"), F.col("u").alias(f"u_{s}"),
                           F.col("tokens").alias(f"t_{s}")) for s in "ab"}

    def passes(t_a, t_b, n_a, n_b, u_a, u_b) -> bool:
        for order in orders:
            a, at = prefix(t_a, n_a, u_a, order, percent)
            b, bt = prefix(t_b, n_b, u_b, order, percent)
            _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
            if not _enough(n_a, n_b, at[i], bt[j], percent).any():
                return False
        common = len(np.intersect1d(t_a, t_b, assume_unique=True))
        return 100 * common >= percent * (n_a + n_b - common)

    def check(batches):
        for batch in batches:
            sizes = zip(*(batch[c].to_pylist() for c in ("n_a", "n_b", "u_a", "u_b")), strict=True)
            keep = [row for row, k in enumerate(sizes) if passes(
                *(batch[c][row].values.to_numpy() for c in ("t_a", "t_b")), *k)]
            if keep:
                yield batch.select(["a", "b"]).take(pa.array(keep))

    return pairs.join(side["a"], "a").join(side["b"], "b").mapInArrow(check, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that links reach, by passing on minima and following labels to their labels."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    kept = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
        "node", F.least("node", "least").alias("label")), "labels")
    while True:
        labels = kept.select("node", "label")
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near"))
        passed = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        moved = written(passed.join(up, "label").select(
            "node", F.least("label", "up").alias("label"), (F.least("label", "up") != F.col("old")).alias("moved")), "labels")
        done(kept)
        kept = moved
        if moved.filter("moved").isEmpty():
            done(both)
            return moved.select("node", "label")


def _compatible(percent: int):
    """Can the pair reach the threshold? ``u`` tokens of each set are its own alone: never in the intersection, always in the union."""
    most = F.least(F.col("n_a") - F.col("u_a"), F.col("n_b") - F.col("u_b"))
    return 100 * most >= percent * F.greatest(F.col("n_a") + F.col("u_b"), F.col("n_b") + F.col("u_a"))


def _stars(active: DataFrame, percent: int, hashes: int) -> DataFrame:
    """Pairs of a set and the centre of those with the same min-hash, if at least half of their min-hashes agree.

    The centre has the tokens of the highest mean frequency: of a text and its altered copies
    that is the text itself, which is nearer to each copy than the copies are to each other.
    """
    rows = active.select("set_id", "n", "u", "mins", "weight", F.posexplode("mins").alias("k", "least"))
    centres = rows.groupBy("k", "least").agg(
        F.max(F.struct("weight", "set_id", "n", "u", "mins")).alias("c"), F.count("*").alias("size")).filter("size > 1")
    pairs = rows.join(centres, ["k", "least"]).filter(F.col("set_id") != F.col("c.set_id")).select(
        F.least("set_id", "c.set_id").alias("a"), F.greatest("set_id", "c.set_id").alias("b"), F.col("n").alias("n_b"),
        F.col("c.n").alias("n_a"), F.col("u").alias("u_b"), F.col("c.u").alias("u_a"),
        F.size(F.filter(F.arrays_zip(F.col("mins").alias("x"), F.col("c.mins").alias("y")), lambda z: z["x"] == z["y"])).alias("agree"))
    return pairs.filter(_compatible(percent) & (F.col("agree") * 2 >= hashes)).select("a", "b").distinct()


def _candidates(active: DataFrame, labels: DataFrame | None, percent: int, order: int = 0) -> DataFrame:
    """Pairs of sets that share a prefix token under one order; with ``labels`` only of different components.

    If a token is the first that a pair shares in some order, the pair shares at most that
    one and what follows it on either side. A token counts only if that is enough.
    """
    rows = _prefix_rows(active, order, percent)
    if labels is None:
        rows = rows.withColumn("label", F.col("set_id"))
    else:
        rows = rows.join(labels, rows["set_id"] == labels["node"], "left").select(
            "token", "set_id", "n", "place", F.coalesce("label", "set_id").alias("label"))
    several = rows.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("token")
    rows = written(rows.join(several, "token", "left_semi"), "postings")
    left, right = (rows.select("token", F.col("set_id").alias(s), F.col("n").alias(f"n_{s}"), F.col("place").alias(f"p_{s}"),
                               F.col("label").alias(f"l_{s}")) for s in "ab")
    met = left.join(right, [left["token"] == right["token"], F.col("a") < F.col("b"), F.col("l_a") != F.col("l_b"),
                            _enough_rows(percent)])
    return met.select("a", "b").distinct()


def linked_pairs(active: DataFrame, percent: int, orders: int, stars: bool) -> DataFrame:
    """All verified links that the components need."""
    labels, found = None, None
    if stars:
        pairs = written(_stars(active, percent, HASHES), "stars")
        found = written(_verified(pairs, active, percent, tuple(range(orders))), "stars")
        done(pairs)
        labels = components(found)
    pairs = written(_candidates(active, labels, percent), "candidates")
    for order in range(1, orders):
        fewer = written(_sharing(pairs, active, order, percent), "candidates")
        done(pairs)
        pairs = fewer
    links = written(_verified(pairs, active, percent), "pairs")
    return links if found is None else found.union(links)


def common_tokens(sketches: DataFrame) -> np.ndarray:
    """Tokens of a thousandth of all sets or more; their number is bounded by the mean size of a set over that share."""
    n = sketches.filter("is_text").count()
    rows = sketches.filter(~F.col("is_text")).groupBy("token").agg(F.sum("seen").alias("seen")).filter(
        F.col("seen") >= max(64, n * COMMON_SHARE)).select("token").toPandas()
    return np.sort(rows["token"].to_numpy().astype(np.int64).view(np.uint64))


def link_texts(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, orders: int = ORDERS, stars: bool = True) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``, with the set_id of its text and first_set, that of
    its component's first row: the least by id, then by set. Components that share a repeated id differ by first_set."""
    sketches = written(_sketches(docs, words), "sketches")
    rows = sketches.filter("is_text").select("doc_id", "n_shingles", "set_id")
    nodes = sketches.filter("set_id IS NOT NULL").groupBy("set_id").agg(
        F.min("doc_id").alias("first_id"), F.min("n_shingles").alias("n_shingles"))
    shared = _shared_tokens(docs, words, common_tokens(sketches))
    active = written(_active(shared, nodes, percent), "active")
    labels = components(linked_pairs(active, percent, orders, stars))
    done(active)
    firsts = sketches.filter("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("first_id"))
    named = firsts.join(labels, F.col("set_id") == F.col("node"), "left")
    first = F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "set_id")).alias("first")
    least = labels.join(firsts, F.col("set_id") == F.col("node")).groupBy("label").agg(first).select(
        "label", F.col("first.first_id").alias("least_id"), F.col("first.set_id").alias("least_set"))
    classes = named.join(least, "label", "left").select("set_id", F.coalesce("least_id", "first_id").alias("component_id"),
                                                        F.coalesce("least_set", "set_id").alias("first_set"))
    return rows.join(classes, "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "set_id", "first_set")


def _with_sets(docs: DataFrame, words: int) -> DataFrame:
    """``docs`` with the ``__set_id`` of each text, null without words."""

    def run(batches):
        own = Shingler(words)
        for batch in sized(batches, "text"):
            sets = [own.tokens(t) for t in texts(batch)]
            keys = pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*batch.schema.names, "__set_id"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("__set_id", LongType())]))


def first_of_each(docs: DataFrame, linked: DataFrame, words: int = WORDS) -> DataFrame:
    """The documents that are the first of their component, one row each.

    An id that occurs once is decided by the id. Of a repeated id, the rows whose text is the
    first of its component stay, one of each text, and one without words; the row that stays
    does not depend on the order of the rows. Rows without an id cannot be named as the first
    of others: one of each component stays, and all without words. What goes is written first:
    Spark then knows its size and chooses the join by it. Further columns may have any names.
    """
    return under_plain_names(docs, lambda plain: _first_of_each(plain, linked, words))


def _first_of_each(docs: DataFrame, linked: DataFrame, words: int) -> DataFrame:
    gone = written(linked.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    odd = written(linked.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("odd_id")), "odd")
    left = docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
    if odd.isEmpty():
        return left
    is_odd = docs["doc_id"].eqNullSafe(odd["odd_id"])
    rows = _with_sets(docs.join(odd, is_odd, "left_semi"), words)
    known = linked.join(odd, linked["doc_id"].eqNullSafe(odd["odd_id"]), "left_semi").filter("set_id IS NOT NULL")
    stay = written(known.filter("doc_id = component_id AND set_id = first_set").select("doc_id", "set_id").distinct().unionByName(
        known.filter("doc_id IS NULL").groupBy("first_set").agg(F.min("set_id").alias("set_id")).select(
            F.lit(None).cast("long").alias("doc_id"), "set_id")).select(F.col("doc_id").alias("stay_id"), F.col("set_id").alias("stay_set")), "stay")
    first = rows.join(stay, rows["doc_id"].eqNullSafe(stay["stay_id"]) & (rows["__set_id"] == stay["stay_set"]), "left_semi")
    wordless = rows.filter("__set_id IS NULL")
    order = Window.partitionBy("doc_id", "__set_id").orderBy(F.to_json(F.struct(*docs.columns)))
    one = first.unionByName(wordless.filter("doc_id IS NOT NULL")).withColumn("__row", F.row_number().over(order)).filter("__row = 1")
    return left.join(odd, is_odd, "left_anti").unionByName(one.select(*docs.columns)).unionByName(
        wordless.filter("doc_id IS NULL").select(*docs.columns))
