"""Quality rules as a learned decision list over text statistics.

Sequential covering (grow, prune, remove the covered) finds conjunctions of thresholds that
pick out rejected documents; the list is emitted as ordered Spark conditions. It is fitted
on a bounded sample of labelled rows, everything else covers all rows.

Null or empty text: all statistics are 0, which fails the base rule. Without labels of both
kinds the list is empty and only the base rule decides. Repeated rows are judged one by one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.llm.common import sized, texts, under_plain_names

#: Labelled rows that the list is fitted on, at most.
SAMPLE_ROWS = 20_000
_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_UPPER = bytes(range(65, 91))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper",
          "n_marks", "n_distinct")
_MARKS = b"!?~^_=+"


def text_counts(text: str) -> tuple[int, ...]:
    """The statistics of one text, in the order of ``COUNTS``."""
    data = text.encode()
    words = data.split()
    n = len(words)
    if not n:
        return (0,) * len(COUNTS)
    chars = len(text) - (len(data) - len(data.translate(None, _SPACES)))
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip(_SPACES)]
    letters = len(data) - len(data.translate(None, _LETTERS))
    upper = len(data) - len(data.translate(None, _UPPER))
    marks = len(data) - len(data.translate(None, _MARKS))
    ids: dict[bytes, int] = {}
    number = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    repeated = 0
    if n > 3 and len(ids) < n:
        pair = np.unique(number[:-1] * len(ids) + number[1:], return_inverse=True)[1]
        window = pair[:-1] * len(ids) + number[2:]
        order = np.argsort(window, kind="stable")
        same = window[order][1:] == window[order][:-1]
        twice = np.zeros(n - 2, dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(n, dtype=bool)
        for k in range(3):
            covered[k:n - 2 + k] |= twice
        repeated = int(covered.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines), letters, upper, marks, len(ids)


def text_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of its whole text."""

    def run(batches):
        for batch in sized(batches, "text"):
            found = np.array([text_counts(t) for t in texts(batch)], dtype=np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(found[:, k]) for k in range(len(COUNTS)))], names=["doc_id", *COUNTS])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


#: Name, numerator and denominator of each feature; the value is their quotient (0 over nothing).
FEATURES = (
    ("symbols_per_word", "n_symbols", "n_words"), ("repeat_share", "n_repeat_words", "n_words"),
    ("dup_line_share", "n_dup_lines", "n_lines"), ("word_length", "word_chars", "n_words"),
    ("letter_share", "n_letters", "word_chars"), ("upper_share", "n_upper", "n_letters"),
    ("marks_per_word", "n_marks", "n_words"), ("distinct_share", "n_distinct", "n_words"),
    ("words_per_line", "n_words", "n_lines"),
)


def feature(name: str) -> Column:
    _, top, under = next(f for f in FEATURES if f[0] == name)
    return F.when(F.col(under) > 0, F.col(top) / F.col(under)).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        values = x[:, [f[0] for f in FEATURES].index(self.feature)]
        return values >= self.threshold if self.above else values < self.threshold

    def column(self) -> Column:
        value = feature(self.feature)
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    return reduce(np.logical_and, (c.holds(x) for c in rule), np.ones(len(x), dtype=bool))


def _grow(x: np.ndarray, bad: np.ndarray, most: int, steps: int) -> Rule:
    """Adds the condition with the largest gain of information until no good row is covered."""
    rule: Rule = ()
    inside = np.ones(len(x), dtype=bool)
    while len(rule) < most and (inside & ~bad).any():
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        base, best = np.log2(p / (p + n)), (1e-9, None)
        for k, (name, _, _) in enumerate(FEATURES):
            values = x[inside, k]
            cuts = np.unique(np.quantile(values[bad[inside]], np.linspace(0, 1, steps)))
            good, ill = np.sort(values[~bad[inside]]), np.sort(values[bad[inside]])
            for above in (True, False):
                # thresholds lie between the rows: halfway to the next good value
                for cut in cuts:
                    if above:
                        i = np.searchsorted(good, cut)
                        t = (good[i - 1] + cut) / 2 if i else cut
                        pp, nn = len(ill) - np.searchsorted(ill, t), len(good) - np.searchsorted(good, t)
                    else:
                        i = np.searchsorted(good, cut, side="right")
                        t = (good[i] + cut) / 2 if i < len(good) else np.nextafter(cut, np.inf)
                        pp, nn = np.searchsorted(ill, t), np.searchsorted(good, t)
                    if pp and (gain := pp * (np.log2(pp / (pp + nn)) - base)) > best[0]:
                        best = (gain, Condition(name, above, float(t)))
        if best[1] is None:
            break
        rule += (best[1],)
        inside &= best[1].holds(x)
    return rule


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The leading conditions that do best on rows held out from growing."""

    def worth(r: Rule) -> float:
        inside = _covers(r, x)
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)), default=())


def learn_list(x: np.ndarray, bad: np.ndarray, held_out: np.ndarray, *, precision: float = 0.95, max_rules: int = 12,
               max_conditions: int = 4, steps: int = 24) -> list[Rule]:
    """Ordered rules that reject; each must reach ``precision`` on the held-out rows still uncovered."""
    rules: list[Rule] = []
    left = np.ones(len(x), dtype=bool)
    while len(rules) < max_rules:
        grow, prune = left & ~held_out, left & held_out
        if not (bad & grow).any() or not (bad & prune).any():
            break
        rule = _grow(x[grow], bad[grow], max_conditions, steps)
        rule = _prune(rule, x[prune], bad[prune]) if rule else rule
        if not rule:
            break
        inside = _covers(rule, x)
        hit, out = int((inside & prune & bad).sum()), int((inside & prune).sum())
        if not hit or hit / out < precision or (inside & left & bad).sum() < 5:
            break
        rules.append(rule)
        left &= ~inside
    return rules


def fit_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, **options) -> list[Rule]:
    """The list from the labelled rows with the smallest hashes of doc_id, ``sample_rows`` of them at most.

    Rows with a null id or label are no examples; of repeated labels and documents one is taken.
    """
    chosen = (labels.select(F.col("doc_id").alias("label_id"), F.col("quality").alias("label_quality"))
              .dropna().groupBy("label_id").agg(F.min("label_quality").alias("label_quality"))
              .orderBy(F.xxhash64("label_id"), "label_id").limit(sample_rows))
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen.select("label_id")), F.col("doc_id") == F.col("label_id"), "left_semi")
    rows = (text_stats(picked).groupBy("doc_id").agg(*(F.max(c).alias(c) for c in COUNTS))
            .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
            .select("doc_id", "label_quality", *(feature(f[0]).alias(f[0]) for f in FEATURES)).toPandas())
    if rows.empty:
        return []
    rows = rows.sort_values("doc_id")
    bad = rows["label_quality"].to_numpy() == 0
    held_out = (rows["doc_id"].to_numpy() * 2654435761 >> 7) % 3 == 0
    return learn_list(rows[[f[0] for f in FEATURES]].to_numpy(dtype=float), bad, held_out, **options)


def verdict(rules: list[Rule]) -> Column:
    """False at the first rule that holds, else true."""
    out = None
    for rule in rules:
        condition = reduce(lambda a, b: a & b, (c.column() for c in rule))
        out = F.when(condition, F.lit(False)) if out is None else out.when(condition, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the base counts, base_failed and kept."""
    return text_stats(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules)).alias("kept"))


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of the documents that pass, with all their columns, whatever the names of further ones."""
    return under_plain_names(docs, lambda plain: _keep_good(plain, rules))


def _keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    names = docs.columns

    def run(batches):
        for batch in sized(batches, "text"):
            found = np.array([text_counts(t) for t in texts(batch)], dtype=np.int64).reshape(-1, len(COUNTS))
            packed = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(len(COUNTS))], names=list(COUNTS))
            row = pa.StructArray.from_arrays([batch[n] for n in names], names=names)
            yield pa.RecordBatch.from_arrays([row, packed], names=["row", "stats"])

    kinds = docs.schema.simpleString()
    counted = docs.mapInArrow(run, f"row {kinds}, stats struct<{','.join(f'{c}:bigint' for c in COUNTS)}>")
    kept = counted.select("row", "stats.*").filter(~base_failed() & verdict(rules))
    return kept.select(*(F.col("row").getField(n).alias(n) for n in names))
