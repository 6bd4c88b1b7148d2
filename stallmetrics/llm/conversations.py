"""Repair of conversations by a generalised LR parser over the grammar of roles.

The rules (``RULES``) are turned into LR(0) tables. A parser reads the rows of a conversation
and keeps all its stacks at once in one graph: a node is a state above another node, shared by
every stack that has the same states below. Each row can be kept, given another role or
deleted, and rows can be inserted anywhere, each at its cost; stacks whose tops are the same
node are merged into the one with the least (cost, audit). The audit is the list of edits.
Equal costs at one row never have audits of which one begins the other (an inserted row costs
something), so the least audit so far stays the least whatever follows.

Rows are taken by turn (nulls first); rows of one turn follow by role and then by the SHA-256
of the text. A row is blank, a duplicate (role and text seen earlier in its conversation) or
truncated, in this order. Null roles and texts are read as one space, a null turn or conv_id is
a value like others. Copies of one row are counted before they are moved. Role initials other
than those of the grammar cannot be kept.

Size: rows are ordered by range of (conv_id, turn, ...), so a long conversation is many
partitions, and every partition cuts it into segments of ``SEGMENT`` rows. A segment that does
not begin its conversation is parsed from every node that a row can be met in (six for these
rules) and gives one (cost, audit) from each to each; a fold of the segments then chains them.
What one task holds of a conversation is its audits, some twenty characters a row, and the
repaired rows pass by it in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.llm.common import written

#: Left recursive, so that stacks stay short: nothing, or user and assistant in turn after an optional system row.
RULES = (("S", ""), ("S", "T"), ("T", "ua"), ("T", "sua"), ("T", "Tua"))
NAMES = {"u": "user", "a": "assistant"}
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
BLANK_CHARS = " \t\n\x0b\x0c\r"
SEGMENT = 2048
#: Parses of short conversations that a worker remembers, and how long those are.
REMEMBERED, SHORT = 65_536, 64

BLANK, DUPLICATE, CUT, SOUND = "b", "d", "t", "k"
Value = tuple[int, str]


class Tables:
    """LR(0) tables of a grammar: sets of items as states, shifts, and the rules completed in each."""

    def __init__(self, rules: tuple[tuple[str, str], ...], start: str = "S"):
        self.rules, self.start = rules, start
        heads = {head for head, _ in rules}

        def closed(items: Iterable[tuple[int, int]]) -> frozenset:
            found = list(dict.fromkeys(items))
            for rule, dot in found:
                body = rules[rule][1]
                if dot < len(body) and body[dot] in heads:
                    found += [(r, 0) for r, (head, _) in enumerate(rules) if head == body[dot] and (r, 0) not in found]
            return frozenset(found)

        states = [closed((r, 0) for r, (head, _) in enumerate(rules) if head == start)]
        self.goto: list[dict[str, int]] = []
        for state in states:
            after: dict[str, list] = {}
            for rule, dot in sorted(state):
                if dot < len(rules[rule][1]):
                    after.setdefault(rules[rule][1][dot], []).append((rule, dot + 1))
            self.goto.append({})
            for symbol, items in after.items():
                target = closed(items)
                if target not in states:
                    states.append(target)
                self.goto[-1][symbol] = states.index(target)
        self.done = [[r for r, dot in sorted(state) if dot == len(rules[r][1])] for state in states]


class Node:
    """A state above another node; equal stacks are the same node."""

    __slots__ = ("below", "number", "state")

    def __init__(self, state: int, below: Node | None, number: int):
        self.state, self.below, self.number = state, below, number


class Parser:
    """Parses rows, given as (role initial, fault), into tops with their cheapest (cost, audit)."""

    def __init__(self, rules: tuple[tuple[str, str], ...] = RULES, insertable: str = "ua"):
        self.tables, self.insertable = Tables(rules), insertable
        self.nodes: list[Node] = []
        self.known: dict[tuple[int, int], Node] = {}
        self.start = self.node(0, None)
        self.symbols = sorted({c for _, body in rules for c in body} - {head for head, _ in rules})
        self.after: dict[tuple[int, str], tuple[int, ...]] = {}
        self.between: dict[int, dict[int, int]] = {}
        #: The nodes in which a row can be met. Rules that keep no bound on the stack cannot be cut into segments.
        self.entries = [0]
        for n in self.entries:
            for symbol in self.symbols:
                self.entries += [m for m in self.shift(n, symbol) if m not in self.entries]
            if len(self.entries) > 64:
                raise ValueError("the rules allow stacks of any height; write them left recursive")

    def node(self, state: int, below: Node | None) -> Node:
        key = (state, -1 if below is None else below.number)
        if key not in self.known:
            self.known[key] = Node(state, below, len(self.nodes))
            self.nodes.append(self.known[key])
        return self.known[key]

    def reduced(self, node: Node) -> list[Node]:
        """The node and all that its completed rules lead to; without those that can only be reduced."""
        found = [node]
        for top in found:
            for rule in self.tables.done[top.state]:
                head, body = self.tables.rules[rule]
                base = top
                for _ in body:
                    base = base.below
                if head in self.tables.goto[base.state]:
                    found.append(self.node(self.tables.goto[base.state][head], base))
        return [n for n in found if self.tables.goto[n.state] or self.accepts(n)]

    def accepts(self, node: Node) -> bool:
        return any(self.tables.rules[r][0] == self.tables.start for r in self.tables.done[node.state])

    def shift(self, n: int, symbol: str) -> tuple[int, ...]:
        """Nodes after ``symbol`` is read in node ``n``."""
        if (n, symbol) not in self.after:
            node = self.nodes[n]
            state = self.tables.goto[node.state].get(symbol)
            self.after[n, symbol] = () if state is None else tuple(m.number for m in self.reduced(self.node(state, node)))
        return self.after[n, symbol]

    def inserts(self, n: int) -> dict[int, int]:
        """Nodes that inserted rows lead to, with the fewest rows."""
        if n not in self.between:
            found, edge, rows = {n: 0}, [n], 0
            while edge:
                rows += 1
                edge = [m for e in edge for s in self.insertable for m in self.shift(e, s) if found.setdefault(m, rows) == rows]
                edge = list(dict.fromkeys(edge))
            self.between[n] = found
        return self.between[n]

    def widen(self, tops: dict[int, Value]) -> dict[int, Value]:
        """All tops after rows are inserted."""
        out: dict[int, Value] = {}
        for n, (cost, audit) in tops.items():
            for m, rows in self.inserts(n).items():
                value = (cost + INSERT * rows, audit + "I" * rows)
                if m not in out or value < out[m]:
                    out[m] = value
        return out

    def read(self, tops: dict[int, Value], initial: str, fault: str) -> dict[int, Value]:
        """All tops after one row, merged."""
        out = {n: (cost + DELETE, audit + "D") for n, (cost, audit) in tops.items()}
        if fault in (BLANK, DUPLICATE):
            return out
        more = TRUNCATED if fault == CUT else 0
        for n, (cost, audit) in self.widen(tops).items():
            steps = [(m, cost + more, audit + "K") for m in self.shift(n, initial)] if initial in self.symbols else []
            steps += [(m, cost + more + REROLE, audit + "R") for symbol in self.insertable for m in self.shift(n, symbol)]
            for m, c, a in steps:
                if m not in out or (c, a) < out[m]:
                    out[m] = (c, a)
        return out

    def parse(self, rows: Iterable[tuple[str, str]], entry: int = 0) -> dict[int, Value]:
        tops: dict[int, Value] = {entry: (0, "")}
        for initial, fault in rows:
            tops = self.read(tops, initial, fault)
        return tops

    def least(self, tops: dict[int, Value]) -> Value:
        return min(v for n, v in self.widen(tops).items() if self.accepts(self.nodes[n]))


@lru_cache(maxsize=1)
def parser() -> Parser:
    return Parser()


@lru_cache(maxsize=REMEMBERED)
def _remembered(rows: str) -> tuple[tuple[int, int, str], ...]:
    return tuple((n, *v) for n, v in parser().parse(zip(rows[::2], rows[1::2], strict=True)).items())


def exits_of(rows: str, whole: bool) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) of a segment, whose rows are pairs of initial and fault: from the
    start if it begins its conversation, else from every node."""
    if whole and len(rows) <= 2 * SHORT:
        return [(0, *v) for v in _remembered(rows)]
    pairs = list(zip(rows[::2], rows[1::2], strict=True))
    entries = [0] if whole else parser().entries
    return [(e, n, *v) for e in entries for n, v in parser().parse(pairs, e).items()]


def audit_of(segments: list[list[tuple[int, int, int, str]]]) -> Value:
    """Least (cost, audit) of a conversation from the exits of its segments in order.

    Audits at one row compare by their rank among each other, so no audit is copied from segment to segment:
    they end in a row's edit, and none begins another.
    """
    tops, steps = {0: (0, 0)}, []  # node -> (cost, rank of its audit)
    for exits in segments:
        made: dict[int, tuple[int, int, str, int]] = {}
        for entry, node, cost, audit in exits:
            if entry in tops:
                value = (tops[entry][0] + cost, tops[entry][1], audit, entry)
                if node not in made or value[:3] < made[node][:3]:
                    made[node] = value
        ranks = {key: i for i, key in enumerate(sorted({v[1:3] for v in made.values()}))}
        tops = {n: (v[0], ranks[v[1:3]]) for n, v in made.items()}
        steps.append({n: (v[3], v[2]) for n, v in made.items()})
    p = parser()
    ends = []
    for n, (cost, rank) in tops.items():
        ends += [(cost + INSERT * rows, rank, "I" * rows, n) for m, rows in p.inserts(n).items() if p.accepts(p.nodes[m])]
    cost, _, tail, node = min(ends)
    audit = [tail]
    for step in reversed(steps):
        node, piece = step[node]
        audit.append(piece)
    return cost, "".join(reversed(audit))


LIGHT = ["conv_id", "turn", "role", "digest"]
SEGMENTS = ("conv_id long, part int, no int, rows long, blank long, duplicate long, truncated long, illegal long, first string, "
            "last string, first_turn long, last_turn long, turns long, entry array<int>, exit array<int>, cost array<long>, "
            "audit array<string>")
PLANS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
LEGAL = {"su", "ua", "au"}


def prepared(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """conv_id, turn, role and text as the operator reads them, with the text's digest. ``copies`` tells how
    often a row counts (0: it only names its conversation); without it each row counts once."""
    copies = (F.lit(1) if copies is None else copies).cast("long")
    kept = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                       copies.alias("copies"))
    return kept.withColumn("digest", F.unhex(F.sha2("text", 256)))


def light_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows without their texts: how many, whether blank or cut short, whether role and text came earlier."""
    last = F.substring(F.rtrim("text", F.lit(BLANK_CHARS)), -1, 1)
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), SOUND).otherwise(CUT)
    light = rows.select(*LIGHT, "copies", fault.alias("fault")).groupBy(*LIGHT, "fault").agg(F.sum("copies").alias("copies"))
    said = light.filter(F.col("copies") > 0).groupBy("conv_id", "role", "digest").agg(
        F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).filter(F.col("n") > 1).drop("n").alias("s")
    light = light.alias("l")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("conv_id", "role", "digest")]
    again = F.col("s.first").isNotNull() & ~F.col("l.turn").eqNullSafe(F.col("s.first.turn"))
    return light.join(said, same[0] & same[1] & same[2], "left").select("l.*", again.alias("again"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "role", "fault", "copies", "again")), strict=True)


def segments_of(batches: Iterator[pa.RecordBatch], part: int, size: int = SEGMENT) -> Iterator[dict]:
    """One record for each segment of each conversation in a partition that is ordered by conversation."""
    for k, (conv, run) in enumerate(groupby(_runs(batches), key=lambda r: r[0])):
        no, rows, open_ = 0, [], False
        begins = k > 0

        def segment(rows: list[tuple], begins: bool, no: int) -> dict:
            symbols = "".join(i + f for _, i, f in rows)
            turns = [t for t, _, _ in rows if t is not None]
            exits = exits_of(symbols, begins)
            count = {f: sum(r[2] == f for r in rows) for f in (BLANK, DUPLICATE, CUT)}
            return {"conv_id": conv, "part": part, "no": no, "rows": len(rows), "blank": count[BLANK],
                    "duplicate": count[DUPLICATE], "truncated": count[CUT],
                    "illegal": sum(a[1] + b[1] not in LEGAL for a, b in zip(rows, rows[1:], strict=False)),
                    "first": rows[0][1] if rows else "", "last": rows[-1][1] if rows else "",
                    "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
                    "turns": len(set(turns)), "entry": [e[0] for e in exits], "exit": [e[1] for e in exits],
                    "cost": [e[2] for e in exits], "audit": [e[3] for e in exits]}

        for _, turn, role, fault, copies, again in run:
            initial = role[:1] or "\0"
            for c in range(copies):
                if len(rows) == size:
                    yield segment(rows, begins, no)
                    rows, no, begins, open_ = [], no + 1, False, True
                seen = fault != BLANK and (again or c > 0)
                rows.append((turn, initial, DUPLICATE if seen else fault))
        if rows or not open_:
            yield segment(rows, begins, no)


def _as_batches(records: Iterator[dict], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held = []
    for record in records:
        held.append(record)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32()),
          "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (f.split(" ") for f in ddl.split(", "))])


def folded(conv: int | None, segments: list[dict]) -> dict:
    """The plan of one conversation from its segments in order."""
    full = [s for s in segments if s["rows"]]
    cost, audit = audit_of([list(zip(s["entry"], s["exit"], s["cost"], s["audit"], strict=True)) for s in full])
    total = lambda name: sum(s[name] for s in full)
    joints = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(full, full[1:], strict=False))
    timed = [s for s in full if s["turns"]]
    turns = total("turns") - sum(a["last_turn"] == b["first_turn"] for a, b in zip(timed, timed[1:], strict=False))
    gaps = timed[-1]["last_turn"] - timed[0]["first_turn"] + 1 - turns if timed else 0
    return {"conv_id": conv, "gaps": min(gaps, (1 << 63) - 1), "blank": total("blank"), "duplicate": total("duplicate"),
            "truncated": total("truncated"), "illegal": total("illegal") + joints, "cost": cost, "audit": audit}


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (r for b in batches for r in b.to_pylist())
    plans = (folded(conv, list(run)) for conv, run in groupby(rows, key=lambda r: r["conv_id"]))
    return _as_batches(plans, _arrow(PLANS))


def _parts(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def plan_repairs(rows: DataFrame, copies: Column | None = None, size: int = SEGMENT) -> DataFrame:
    """One row per conversation: gaps in its turns, rows with each fault, illegal neighbours, and the
    cheapest repair as cost and audit (K keep, R rerole, D delete, I insert). Rows as in ``prepared``;
    ``size`` rows make a segment."""
    light = light_rows(prepared(rows, copies))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]
    dealt = light.repartitionByRange(_parts(rows), *order).sortWithinPartitions(*order)
    scan = lambda batches: _as_batches(segments_of(batches, TaskContext.get().partitionId(), size), _arrow(SEGMENTS))
    segments = dealt.select("conv_id", "turn", "role", "fault", "copies", "again").mapInArrow(scan, SEGMENTS)
    one = segments.repartition(_parts(rows), "conv_id").sortWithinPartitions("conv_id", "part", "no")
    return written(one.mapInArrow(_fold, PLANS), "plans")


REPAIRED = "conv_id long, place long, role string, text string, edit string"


def repaired_rows(batches: Iterator[pa.RecordBatch], names: dict[str, str] = NAMES) -> Iterator[dict]:
    """Repaired rows from rows ordered by conversation, each conversation's audit before its rows."""
    audit, at, place, conv, role = "", 0, 0, None, ""

    def inserted() -> Iterator[dict]:
        nonlocal at, place, role
        while at < len(audit) and audit[at] == "I":
            role = "a" if role == "u" else "u"
            at, place = at + 1, place + 1
            yield {"conv_id": conv, "place": place, "role": names[role], "text": "", "edit": "I"}

    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("conv_id", "audit", "role", "text", "copies"))
        for one, plan, said, text, copies in zip(*columns, strict=True):
            if plan is not None:
                conv, audit, at, place, role = one, plan, 0, 0, ""
                yield from inserted()
                continue
            for _ in range(copies):
                edit, at = audit[at], at + 1
                if edit != "D":
                    place += 1
                    role = said[:1] if edit == "K" else "a" if role == "u" else "u"
                    yield {"conv_id": conv, "place": place, "role": said if edit == "K" else names[role], "text": text,
                           "edit": edit}
                yield from inserted()


def apply_repairs(rows: DataFrame, plans: DataFrame, copies: Column | None = None) -> DataFrame:
    """conv_id, place (from 1), role, text and edit of every repaired row. Each conversation lies in one
    partition, in order; deleted rows are left out. Every row is read as it passes."""
    heads = plans.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
                         F.lit(0).cast("long").alias("copies"), F.lit(b"").alias("digest"), "audit")
    body = prepared(rows, copies).filter(F.col("copies") > 0).select(
        "conv_id", "turn", "role", "text", "copies", "digest", F.lit(None).cast("string").alias("audit"))
    dealt = heads.unionByName(body).repartition(_parts(rows), "conv_id").sortWithinPartitions(
        "conv_id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "digest")
    apply = lambda batches: _as_batches(repaired_rows(batches), _arrow(REPAIRED))
    return dealt.select("conv_id", "audit", "role", "text", "copies").mapInArrow(apply, REPAIRED)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    rows = (r for b in batches for r in zip(*(b[c].to_pylist() for c in ("conv_id", "role", "text")), strict=True))
    for conv, run in groupby(rows, key=lambda r: r[0]):
        digest = hashlib.sha256()
        for k, (_, role, text) in enumerate(run):
            digest.update(f"{'' if k == 0 else chr(10)}{role}:{text}".encode())
        yield {"conv_id": conv, "sha256": digest.hexdigest()}


def repaired_hashes(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines, from the rows of ``apply_repairs`` as they pass."""
    schema = "conv_id long, sha256 string"
    return repaired.mapInArrow(lambda batches: _as_batches(_hashes(batches), _arrow(schema)), schema)


def repair_digests(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """The plan of every conversation with the hash of its repaired rows (of nothing, where none is left)."""
    plans = plan_repairs(rows, copies)
    hashes = repaired_hashes(apply_repairs(rows, plans, copies)).alias("h")
    none = hashlib.sha256().hexdigest()
    return plans.alias("p").join(hashes, F.col("p.conv_id").eqNullSafe(F.col("h.conv_id")), "left").select(
        "p.*", F.coalesce("h.sha256", F.lit(none)).alias("repaired_sha256"))
