"""Repairs of conversations against a plain search over edits."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from stallmetrics.llm import conversations, queries

KIND = "conv_id long, turn long, role string, text string, copies string, audit int"
SPACE = " \t\n\x0b\x0c\r"
#: Role initials read so far -> what may follow; complete ones are marked.
FOLLOWS = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def cheapest(rows):
    """(cost, audit) by trying every edit at every row, from the last row back."""

    @lru_cache(None)
    def best(i, seen, inserted):
        found = [(0, "")] if i == len(rows) and seen in ("", "a") else []
        if inserted < 4:
            found += [(c + 5, "I" + a) for s in "ua" if s in FOLLOWS[seen] for c, a in [best(i, s, inserted + 1)]]
        if i < len(rows):
            initial, fault = rows[i]
            c, a = best(i + 1, seen, 0)
            found.append((c + 2, "D" + a))
            if fault not in "bd":
                more = 5 if fault == "t" else 0
                if initial in FOLLOWS[seen]:
                    c, a = best(i + 1, FOLLOWS[seen][initial], 0)
                    found.append((c + more, "K" + a))
                for s in "ua":
                    if s in FOLLOWS[seen]:
                        c, a = best(i + 1, s, 0)
                        found.append((c + more + 1, "R" + a))
        return min(found, default=(10**9, ""))

    return best(0, "", 0)


def faults_of(rows):
    said, out = set(), []
    for role, text in rows:
        shown = text.strip(SPACE)
        out.append("b" if not shown else "d" if (role, text) in said else "k" if shown[-1] in ".!?" else "t")
        said.add((role, text))
    return out


def plain_plan(rows):
    """Counts, audit, repaired lines of one conversation; rows are (turn, role, text)."""
    space = lambda t: " " if t is None else t
    rows = sorted(((t, space(r), space(x)) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    faults = faults_of([r[1:] for r in rows])
    initials = [r[1][:1] for r in rows]
    turns = [r[0] for r in rows if r[0] is not None]
    cost, audit = cheapest(tuple(zip(initials, faults, strict=True)))
    lines, i, last = [], 0, ""
    for e in audit:
        if e in "RI":
            last = "a" if last == "u" else "u"
            lines.append(({"u": "user", "a": "assistant"}[last], "" if e == "I" else rows[i][2]))
        elif e == "K":
            last = initials[i]
            lines.append(rows[i][1:])
        i += e != "I"
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
            "illegal": sum(a + b not in ("su", "ua", "au") or not (a and b) for a, b in zip(initials, initials[1:], strict=False)),
            "cost": cost, "audit": audit}, lines


def talk(rng, n, roles=("system", "user", "assistant", "tool", None, "")):
    rows, turn = [], 0
    for k in range(n):
        turn += rng.choice([1, 1, 1, 0, 3])
        role = ("user", "assistant")[k % 2] if rng.random() < 0.6 else rng.choice(roles)
        text = rng.choice(["Yes.", "cut off", "\t\n", "", None, f"Row {rng.randrange(4)}!\n", f"part {k}", f"Well {k}?"])
        rows.append((turn if rng.random() < 0.95 else None, role, text))
    return rows


def frame(spark, talks):
    rows = [(conv, *r, "x", 7) for conv, run in talks.items() for r in run]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, KIND)


def check(spark, talks, size):
    rows = frame(spark, talks)
    plans = conversations.plan_repairs(rows, size=size)
    got = {r["conv_id"]: r.asDict() for r in plans.collect()}
    lines = {}
    for r in conversations.apply_repairs(rows, plans).collect():
        lines.setdefault(r["conv_id"], []).append((r["place"], r["role"], r["text"]))
    assert set(got) == {c for c, run in talks.items() if run}
    for conv, run in talks.items():
        if run:
            want, repaired = plain_plan(run)
            assert {**want, "conv_id": conv} == got[conv], run
            assert [(k, *r) for k, r in enumerate(repaired, 1)] == sorted(lines.get(conv, []))


@pytest.mark.parametrize(("seed", "size"), [(1, 2048), (2, 3), (3, 1)])
def test_repairs_equal_plain_search(spark, seed, size):
    rng = random.Random(seed)
    talks = {k: talk(rng, rng.randrange(1, 9)) for k in range(60)}
    talks |= {None: talk(rng, 6), -5: [(None, None, None)] * 4, 100: talk(rng, 60), 101: [(1, "user", "same.")] * 7}
    talks |= {102: [(k, "assistant", "ok.") for k in range(12)], 103: [(2**62, "user", "a" * 50_000), (-2**62, "user", "b.")]}
    check(spark, talks, size)


def test_one_long_conversation_is_many_segments(spark):
    rng = random.Random(7)
    rows = frame(spark, {1: [(k, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", f"b{k}.", f"c{k}"])) for k in range(3000)],
                         2: [(0, "user", "x.")]})
    whole = {r["conv_id"]: r for r in conversations.plan_repairs(rows, size=10_000).collect()}
    assert whole == {r["conv_id"]: r for r in conversations.plan_repairs(rows, size=17).collect()}
    assert sum(e != "I" for e in whole[1]["audit"]) == 3000


def test_tables_take_other_rules():
    p = conversations.Parser((("S", "T"), ("T", "u"), ("T", "Tu")), "u")
    assert p.least(p.parse([("u", "k"), ("a", "k"), ("u", "k")])) == (1, "KRK")
    assert p.least(p.parse([])) == (5, "I")
    with pytest.raises(ValueError, match="left recursive"):
        conversations.Parser((("S", ""), ("S", "uS")))


def test_digest_query_is_the_contract(spark, tmp_path):
    rng = random.Random(11)
    talks = {k: [(t, rng.choice(["user", "assistant", None]), rng.choice(["Hm. No!", "so", "A.", None])) for t in range(rng.randrange(1, 7) if k % 2 else 1)]
             for k in range(80)}
    talks[None] = [(None, "user", "x.")]
    frame(spark, talks).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r.asDict() for r in queries.op11_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(got) == set(talks)
    dropped = 0
    for conv, run in talks.items():
        after = []
        for turn, role, text in run:
            name = lambda v: " " if v is None else str(v)
            kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
            role, text = name(role), name(text)
            text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
            after += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        dropped += not after
        want, lines = plain_plan(after)
        sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in lines).encode()).hexdigest()
        assert got[conv] == {**want, "conv_id": conv, "repaired_sha256": sha}
    assert dropped


def test_empty_table(spark, tmp_path):
    frame(spark, {1: [(1, "user", "x")]}).limit(0).write.parquet(f"{tmp_path}/conversations.parquet")
    df = queries.op11_conversation_repair(spark, str(tmp_path))
    assert df.collect() == []
    assert df.columns[:3] == ["conv_id", "gaps", "blank"]
