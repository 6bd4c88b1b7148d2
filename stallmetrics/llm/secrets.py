"""Secret scans with one combined deterministic automaton.

All rules are compiled into one minimal transition array that reads the bytes of a text
from its end to its start. After that single pass the state at a byte names the rules
that have a match beginning there. From the leftmost such byte of a rule its own anchored
automaton runs to the longest end; the next match begins there or later.

Null or empty text: no spans. Long texts are cut into lanes that give the states of one
whole run. Repeated rows are scanned and returned one by one; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stallmetrics.llm.automaton import SEPARATOR, Automaton, compile_rules, longest, run_lanes
from stallmetrics.llm.common import sized, texts, under_plain_names


@dataclass(frozen=True)
class Rule:
    """``keep``: a found span counts only if it matches this as a whole."""

    kind: str
    pattern: bytes
    keep: bytes | None = None


_KEY = rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]"
#: The first three are the base; their order is the order of kinds. Length checks stand in ``keep`` where the
#: automaton would otherwise have to count several kinds of runs at once.
BASE = (
    Rule("assign", _KEY + b"+", _KEY + b"{6,}"),
    Rule("access", rb"AKIA[A-Z0-9]+", rb"AKIA[A-Z0-9]{16,}"),
    Rule("hex", rb"[0-9a-f]{24,}"),
)
MORE = (
    Rule("private_key", rb"-----BEGIN\x20(?:[A-Z]+\x20)*PRIVATE\x20KEY-----"),
    Rule("forge_token", rb"gh[opsru]_[A-Za-z0-9]+", rb".{34,}"),
    Rule("chat_token", rb"xox[abprs]-[A-Za-z0-9-]+", rb".{15,}"),
    Rule("cloud_key", rb"AIza[A-Za-z0-9_-]+", rb".{39,}"),
    Rule("web_token", rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", rb".{40,}"),
)
RULES = BASE + MORE


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.starts = compile_rules([r.pattern for r in rules], backward=True)
        self.ends: list[Automaton] = [compile_rules([r.pattern], anywhere=False) for r in rules]
        self.keep = [re.compile(r.keep) if r.keep else None for r in rules]

    def scan(self, texts_: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text its spans (start, rule, end) in code points, by start and then rule."""
        raw = [t.encode() for t in texts_]
        found: list[list[tuple[int, int, int]]] = [[] for _ in raw]
        joined = bytes([SEPARATOR]).join(raw)
        states = run_lanes(self.starts, np.frombuffer(joined, dtype=np.uint8)[::-1])[::-1]
        marks = self.starts.accepts[states]
        at = np.flatnonzero(marks)
        if not len(at):
            return found
        begins = np.cumsum([0, *(len(r) + 1 for r in raw)])
        doc = np.searchsorted(begins, at, side="right") - 1
        for k in range(len(self.rules)):
            mine = (marks[at] >> k & 1).astype(bool)
            places, docs = at[mine], doc[mine]
            cuts = np.flatnonzero(np.diff(docs, prepend=-1, append=-1)) if len(docs) else []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                d = int(docs[a])
                self._of_text(k, raw[d], (places[a:b] - begins[d]).tolist(), found[d])
        for d, spans in enumerate(found):
            if spans:
                found[d] = _in_code_points(raw[d], sorted(spans))
        return found

    def _of_text(self, k: int, data: bytes, places: list[int], out: list[tuple[int, int, int]]) -> None:
        i = 0
        while i < len(places):
            end = longest(self.ends[k], data, places[i])
            if self.keep[k] is None or self.keep[k].fullmatch(data, places[i], end):
                out.append((places[i], k, end))
            i = bisect.bisect_left(places, end, i + 1)


def _in_code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if data.isascii():
        return spans
    before = np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)
    return [(int(before[a]) - 1, k, int(before[b - 1])) for a, k, b in spans]


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    """Compiled once per worker process."""
    return Scanner(rules)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and its spans as an array of (kind, start, end), in order."""
    kinds = [r.kind for r in rules]

    def scan(batches):
        for batch in sized(batches, "text"):
            spans = [[{"kind": kinds[k], "start": a, "end": b} for a, k, b in s] for s in scanner(rules).scan(texts(batch))]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(spans, kind)], names=["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        scan, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[secret]") -> str:
    """``text`` with each run of overlapping spans replaced by ``mark``."""
    out, done = [], 0
    for start, _, end in sorted(spans):
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The same rows and columns, secrets in ``text`` replaced; ``n_chars`` follows if it is there.

    A null text stays null and a text without secrets stays as it is, n_chars included. Further
    columns may have any names.
    """
    return under_plain_names(docs, lambda plain: _redact_secrets(plain, rules))


def _redact_secrets(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    names = docs.columns

    def clean(batches):
        for batch in sized(batches, "text"):
            given = texts(batch)
            spans = scanner(rules).scan(given)
            if not any(spans):
                yield batch
                continue
            after = [redact(t, s) if s else None for t, s in zip(given, spans, strict=True)]
            columns = {n: batch[n] for n in names}
            columns["text"] = pa.array(
                [a if a is not None else t for a, t in zip(after, batch["text"].to_pylist(), strict=True)],
                batch["text"].type)
            if "n_chars" in names:
                columns["n_chars"] = pa.array(
                    [len(a) if a is not None else n for a, n in zip(after, batch["n_chars"].to_pylist(), strict=True)],
                    batch["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(clean, docs.schema)


def _joined(spans) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def secret_digests(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and digest of the base kinds, and all spans as text."""
    kinds = [r.kind for r in rules]
    base = len(BASE)

    def digest(batches):
        for batch in sized(batches, "text"):
            spans = scanner(rules).scan(texts(batch))
            named = [[f"{kinds[k]}:{a}:{b}" for a, k, b in s] for s in spans]
            first = [",".join(n for n, (_, k, _) in zip(ns, s, strict=True) if k < base) for ns, s in zip(named, spans, strict=True)]
            counts = [pa.array([sum(k == j for _, k, _ in s) for s in spans], pa.int64()) for j in range(base)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *counts, pa.array([hashlib.sha256(f.encode()).hexdigest() for f in first], pa.string()),
                 pa.array([",".join(ns) for ns in named], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        digest, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
