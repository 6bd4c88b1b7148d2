"""Deterministic byte automata from regular expressions.

Rule patterns are parsed to syntax trees, joined into one nondeterministic automaton,
made deterministic by subset construction over byte classes and minimised by partition
refinement. The result is one transition array for all rules together.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre
from re import _parser

import numpy as np

#: Never part of UTF-8: it stands between texts and resets every rule.
SEPARATOR = 0xFF


def _either_case(byte: int) -> set[int]:
    c = chr(byte)
    return {byte, ord(c.swapcase())} if c.isascii() and c.isalpha() else {byte}


class _Builder:
    """Thompson construction; ``backward`` reads every sequence from its end."""

    def __init__(self, backward: bool):
        self.backward, self.empty, self.moves = backward, [], []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, tree, start: int, fold: bool) -> int:
        """Adds a sequence from ``start`` on and returns its last state."""
        for op, arg in reversed(tree) if self.backward else tree:
            start = self._item(op, arg, start, fold)
        return start

    def _bytes(self, op, arg, fold: bool) -> frozenset[int]:
        if op is sre.LITERAL:
            found = {arg}
        elif op is sre.RANGE:
            found = set(range(arg[0], arg[1] + 1))
        elif op is sre.IN:
            if arg[0][0] is sre.NEGATE:
                raise ValueError("negated classes are not supported: a rule must name its bytes")
            found = set().union(*(self._bytes(o, a, fold) for o, a in arg))
        else:
            raise ValueError(f"unsupported in a rule: {op}")
        if fold:
            found = set().union(*map(_either_case, found))
        return frozenset(found - {SEPARATOR})

    def _item(self, op, arg, start: int, fold: bool) -> int:
        if op is sre.SUBPATTERN:
            return self.add(arg[3], start, fold or bool(arg[1] & _parser.SRE_FLAG_IGNORECASE))
        if op is sre.BRANCH:
            end = self.state()
            for tree in arg[1]:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.add(tree, first, fold)].append(end)
            return end
        if op is sre.MAX_REPEAT:
            least, most, tree = arg
            for _ in range(least):
                start = self.add(tree, start, fold)
            if most is sre.MAXREPEAT:
                loop, end = self.state(), self.state()
                self.empty[start] += [loop, end]
                self.empty[self.add(tree, loop, fold)] += [loop, end]
                return end
            end = self.state()
            self.empty[start].append(end)
            for _ in range(most - least):
                start = self.add(tree, start, fold)
                self.empty[start].append(end)
            return end
        end = self.state()
        self.moves[start].append((self._bytes(op, arg, fold), end))
        return end


@dataclass(frozen=True)
class Automaton:
    """``step[state * n_classes + byte_class[byte]]`` is the next state, ``accepts[state]``
    a bit mask of the rules that match there. State 0 is the start."""

    byte_class: np.ndarray
    n_classes: int
    step: np.ndarray
    accepts: np.ndarray


def compile_rules(patterns: list[bytes], backward: bool = False, anywhere: bool = True) -> Automaton:
    """One minimal automaton for all patterns; ``anywhere`` lets a match begin at any byte."""
    nfa = _Builder(backward)
    start = nfa.state()
    final = {}
    for k, pattern in enumerate(patterns):
        first = nfa.state()
        nfa.empty[start].append(first)
        final[nfa.add(_parser.parse(pattern), first, False)] = 1 << k

    sets = sorted({b for moves in nfa.moves for b, _ in moves}, key=sorted)
    signs = [tuple(byte in s for s in sets) for byte in range(256)]
    number = {sign: k for k, sign in enumerate(dict.fromkeys(signs))}
    byte_class = np.array([number[sign] for sign in signs], dtype=np.uint8)
    members = [signs.index(sign) for sign in number]

    closed: dict[int, frozenset[int]] = {}

    def closure(state: int) -> frozenset[int]:
        if state not in closed:
            seen, todo = {state}, [state]
            while todo:
                for nxt in nfa.empty[todo.pop()]:
                    if nxt not in seen:
                        seen.add(nxt)
                        todo.append(nxt)
            closed[state] = frozenset(s for s in seen if nfa.moves[s] or s in final)
        return closed[state]

    begin = closure(start)
    numbers, todo, rows = {begin: 0}, [begin], []
    for states in todo:
        row = []
        for byte in members:
            reached = set(begin) if anywhere else set()
            for s in states:
                for b, nxt in nfa.moves[s]:
                    if byte in b:
                        reached |= closure(nxt)
            key = frozenset(reached)
            if key not in numbers:
                numbers[key] = len(numbers)
                todo.append(key)
            row.append(numbers[key])
        rows.append(row)
    step = np.array(rows, dtype=np.int64)
    accepts = np.array([sum({final[s] for s in states if s in final}) for states in todo], dtype=np.int64)

    block = np.unique(accepts, return_inverse=True)[1].ravel()
    while True:
        finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    order = {b: k for k, b in enumerate(dict.fromkeys(block.tolist()))}  # the start state's block becomes 0
    block = np.array([order[b] for b in block.tolist()])
    one = np.unique(block, return_index=True)[1]
    if len(one) > 0xFFFF:
        raise ValueError("too many states: make the rules' counted repeats shorter")
    return Automaton(byte_class, len(members), block[step][one].astype(np.uint16).ravel(), accepts[one])


def run_lanes(auto: Automaton, data: np.ndarray, lane: int = 2048) -> np.ndarray:
    """The state after each byte of ``data``, as one left-to-right run would give them.

    The bytes are cut into lanes that advance side by side, each from the start state.
    Where the lane before ended elsewhere, a lane is run again from there until it meets
    the states already written, so the result is exact.
    """
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.uint16)
    lanes = -(-n // lane)
    classes = np.full(lanes * lane, auto.byte_class[SEPARATOR], dtype=np.uint8)
    classes[:n] = auto.byte_class[data]
    classes = np.ascontiguousarray(classes.reshape(lanes, lane).T)
    k, step = auto.n_classes, auto.step
    states = np.empty((lane, lanes), dtype=np.uint16)
    now = np.zeros(lanes, dtype=np.int64)
    for i in range(lane):
        np.take(step, now * k + classes[i], out=states[i])
        now = states[i].astype(np.int64)
    begun = np.zeros(lanes, dtype=np.int64)
    while True:
        before = np.concatenate(([0], states[-1, :-1])).astype(np.int64)
        again = np.flatnonzero(before != begun)
        if not len(again):
            break
        begun[again] = before[again]
        now = before[again]
        for i in range(lane):
            now = step[now * k + classes[i, again]].astype(np.int64)
            apart = now != states[i, again]
            if not apart.any():
                break
            states[i, again] = now
            again, now = again[apart], now[apart]
    return states.T.reshape(-1)[:n]


def longest(auto: Automaton, data: bytes, start: int) -> int:
    """End of the longest match of an anchored automaton from ``start`` on, or -1."""
    state, end, k = 0, -1, auto.n_classes
    classes, step, accepts = auto.byte_class, auto.step, auto.accepts
    dead = len(accepts)
    for i in range(start, len(data)):
        after = int(step[state * k + int(classes[data[i]])])
        if accepts[after]:
            end = i + 1
        elif after == state and dead and _is_sink(auto, after):
            break
        state = after
    return end


def _is_sink(auto: Automaton, state: int) -> bool:
    k = auto.n_classes
    return bool((auto.step[state * k:(state + 1) * k] == state).all())
