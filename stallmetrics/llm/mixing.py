"""Mixing sources to target weights by iterative proportional fitting.

Spark sums the tokens of every (source, lang, topic) cell that occurs, and the fit runs on
that list in the driver: it grows with the cells, not with the rows. The cells with their
probabilities are written and joined to the documents, and each document is then kept with
its cell's calibrated probability, decided by a hash of its id and text.

Values that the targets do not name are cells of their own and have their targets from the
sums: see ``aims_of``. Null and the empty string are one value, without a name.

Empty text: no tokens, the cell's probability applies all the same. A margin value without
tokens has its weight spread over the rest; a cell without tokens stays empty. Repeated
rows share their decision.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.llm.common import done, under_plain_names, written

MARGINS = ("source", "lang", "topic")
_REST = ""
_BUCKETS = 1 << 30


def rake_cells(tokens: np.ndarray, places: list[np.ndarray], targets: list[np.ndarray], rounds: int = 200,
               tolerance: float = 1e-9) -> tuple[np.ndarray, float]:
    """Weights of listed cells, in proportion to ``tokens``, whose margins are ``targets`` (sums of 1), and the
    largest share by which a margin was missed in the last round.

    ``places`` has for each margin the index of every cell's value."""
    moved = 0.0
    if not tokens.sum():
        return np.zeros(tokens.shape), moved
    fitted = tokens / tokens.sum()
    for _ in range(rounds):
        moved = 0.0
        for place, target in zip(places, targets, strict=True):
            now = np.bincount(place, fitted, len(target))
            aim = np.where(now > 0, target, 0.0)
            if not aim.sum():
                continue
            aim = aim / aim.sum()
            ratio = np.divide(aim, now, out=np.zeros_like(now), where=now > 0)
            moved = max(moved, float(np.abs(aim - now).max()))
            fitted = fitted * ratio[place]
        if moved < tolerance:
            break
    return fitted, moved


def aims_of(amounts: np.ndarray, given: np.ndarray, nameless: np.ndarray) -> np.ndarray:
    """Target shares of a margin's values, from their tokens and the ``given`` ones (NaN: not named by the targets).

    What the given ones leave of 1 is dealt to the others: the nameless value takes the part
    that it has among their tokens, and the rest go by tempered shares, by the square root
    where a value is above their mean. A rare value is not raised against the others, for it
    would press down the probabilities of all. If nothing is left, the others keep their
    measured shares and the given ones divide what remains.
    """
    share = amounts / amounts.sum() if amounts.sum() else np.zeros(len(amounts))
    other = np.isnan(given)
    named = np.where(other, 0.0, given)
    left = 1.0 - named.sum()
    if left < 1e-9:
        return np.where(other, share, named / named.sum() * (1.0 - share[other].sum()))
    weight = np.where(other, share, 0.0)
    dealt = other & ~nameless & (share > 0)
    if dealt.any():
        tempered = np.minimum(share, np.sqrt(share * share[dealt].mean()))
        weight[dealt] = tempered[dealt] * (share[dealt].sum() / tempered[dealt].sum())
    return named + (left * weight / weight.sum() if weight.sum() else 0.0)


def _chances(amounts: np.ndarray, fitted: np.ndarray, rate: float) -> np.ndarray:
    """The cell that is short of most tokens is kept whole; cells without tokens too."""
    ratio = np.divide(fitted, amounts, out=np.zeros(amounts.shape), where=amounts > 0)
    most = ratio.max(initial=0.0)
    return np.where(amounts > 0, ratio / most, 1.0) * rate if most else np.full(amounts.shape, rate)


def word_tokens() -> Column:
    """White-space separated words of ``text`` as its token weight."""
    return F.size(F.array_remove(F.split(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def _value(column: str) -> Column:
    return F.nullif(F.col(column).cast("string"), F.lit(_REST))


def cell_chances(rows: DataFrame, targets: dict[str, dict[str, float]], columns: dict[str, str], tokens: str,
                 rate: float = 1.0) -> DataFrame:
    """Probability of keeping a document, ``__chance``, for every cell that occurs in ``rows``; each value is one of its own."""
    sums = rows.groupBy(*(_value(columns[m]).alias(f"__{m}_cell") for m in MARGINS)).agg(
        F.sum(F.col(tokens)).cast("double").alias("n")).collect()
    amounts = np.array([r["n"] or 0.0 for r in sums], dtype=float)
    places, aims = [], []
    for k, m in enumerate(MARGINS):
        values = {v: i for i, v in enumerate(dict.fromkeys([*(v for v in targets[m] if v != _REST), None, *(r[k] for r in sums)]))}
        place = np.array([values[r[k]] for r in sums], dtype=np.int64)
        given = np.array([float(targets[m].get(v, np.nan)) for v in values])
        places.append(place)
        aims.append(aims_of(np.bincount(place, amounts, len(values)), given, np.array([v is None for v in values])))
    chance = _chances(amounts, rake_cells(amounts, places, aims)[0], rate)
    schema = ", ".join([*(f"__{m}_cell string" for m in MARGINS), "__chance double"])
    listed = [(*r[:len(MARGINS)], c) for r, c in zip(sums, chance.tolist(), strict=True)]
    return written(rows.sparkSession.createDataFrame(listed, schema).coalesce(1), "cells")


def with_chance(rows: DataFrame, chances: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``rows`` with the ``__chance`` of their cells."""
    same = [_value(columns[m]).eqNullSafe(F.col(f"__{m}_cell")) for m in MARGINS]
    return rows.join(chances, same, "left").drop(*(f"__{m}_cell" for m in MARGINS))


def draw(seed: int = 7) -> Column:
    """A number in [0, 1) that depends on ``doc_id`` and ``text`` alone, so that rows without an id are
    decided by their texts and equal rows alike."""
    return F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(_BUCKETS)) / F.lit(_BUCKETS)


def keep_drawn(docs: DataFrame, topics: DataFrame, targets: dict[str, dict[str, float]], rate: float = 1.0) -> DataFrame:
    """The documents drawn with the probabilities of their cells, with all their columns, whatever
    the names of further ones. ``topics`` has ``topic_id``, once each, and ``topic``.

    Words are counted before the topics are joined, so texts are shuffled once, with their topics.
    """
    columns = {"source": "source", "lang": "lang", "topic": "topic"}
    named = lambda df: df.join(topics, df["doc_id"] == topics["topic_id"], "left").drop("topic_id")
    light = written(named(docs.select("doc_id", "source", "lang", word_tokens().alias("n_tokens"))), "mix")
    chances = cell_chances(light, targets, columns, "n_tokens", rate)
    done(light)
    return under_plain_names(docs, lambda plain: with_chance(named(plain), chances, columns).filter(
        draw() < F.col("__chance")).drop("topic", "__chance"))
