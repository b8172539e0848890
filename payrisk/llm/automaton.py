"""Small finite automata over bytes: patterns, subset construction, minimisation.

Patterns are built from ``chars``, ``text``, ``seq``, ``either``, ``some``, ``maybe`` and
``many``; each is a function that adds its part to a nondeterministic automaton.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass
class Nfa:
    """States are numbers; ``moves`` by byte, ``free`` without one."""

    moves: list[dict[int, list[int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.moves.append(defaultdict(list))
        self.free.append([])
        return len(self.moves) - 1

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for nxt in self.free[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return frozenset(seen)


Pattern = Callable[[Nfa, int], int]  # adds itself behind a state, returns its end


def chars(allowed: bytes | str) -> Pattern:
    values = allowed.encode() if isinstance(allowed, str) else allowed

    def add(nfa: Nfa, start: int) -> int:
        end = nfa.state()
        for byte in values:
            nfa.moves[start][byte].append(end)
        return end

    return add


def seq(*patterns: Pattern) -> Pattern:
    def add(nfa: Nfa, start: int) -> int:
        for pattern in patterns:
            start = pattern(nfa, start)
        return start

    return add


def text(value: str, any_case: bool = False) -> Pattern:
    return seq(*[chars(c.lower() + c.upper() if any_case else c) for c in value])


def either(*patterns: Pattern) -> Pattern:
    def add(nfa: Nfa, start: int) -> int:
        end = nfa.state()
        for pattern in patterns:
            own = nfa.state()
            nfa.free[start].append(own)
            nfa.free[pattern(nfa, own)].append(end)
        return end

    return add


def maybe(pattern: Pattern) -> Pattern:
    return either(pattern, seq())


def many(pattern: Pattern) -> Pattern:
    """Zero or more."""

    def add(nfa: Nfa, start: int) -> int:
        loop = nfa.state()
        nfa.free[start].append(loop)
        nfa.free[pattern(nfa, loop)].append(loop)
        end = nfa.state()
        nfa.free[loop].append(end)
        return end

    return add


def some(pattern: Pattern, least: int = 1) -> Pattern:
    """``least`` or more."""
    return seq(*[pattern] * least, many(pattern))


@dataclass(frozen=True)
class Dfa:
    """Transition arrays of 256 states each; ``rules`` has the bits of the rules that accept.

    State 0 is the start; ``dead`` is the state from which no rule can accept, or -1.
    """

    table: tuple[tuple[int, ...], ...]
    rules: tuple[int, ...]
    dead: int

    def rows(self) -> list[list]:
        """The arrays linked to one another: row[byte] is the next row, row[256] the rules."""
        linked: list[list] = [[None] * 257 for _ in self.table]
        for own, targets, rule in zip(linked, self.table, self.rules, strict=True):
            own[:256] = [linked[t] for t in targets]
            own[256] = rule
        return linked


def _byte_classes(nfa: Nfa) -> tuple[list[int], list[int]]:
    """(class of every byte, one byte of each class): bytes of a class move alike everywhere."""
    alike: dict[tuple, int] = {}
    moves = [
        tuple((s, tuple(m[byte])) for s, m in enumerate(nfa.moves) if byte in m)
        for byte in range(256)
    ]
    classes = [alike.setdefault(m, len(alike)) for m in moves]
    return classes, [classes.index(c) for c in range(len(alike))]


def _subsets(nfa: Nfa, first: frozenset[int], ends: dict[int, int], always: frozenset[int]):
    """Subset construction: (targets by byte class, rules that accept, class of every byte)."""
    classes, bytes_of = _byte_classes(nfa)
    numbers, todo = {first: 0}, [first]
    table: list[list[int]] = []
    rules: list[int] = []
    for states in todo:
        bits = 0
        for s in states:
            bits |= ends.get(s, 0)
        rules.append(bits)
        row = []
        for byte in bytes_of:
            targets = {t for s in states if byte in nfa.moves[s] for t in nfa.moves[s][byte]}
            nxt = nfa.closure(targets) | always
            if nxt not in numbers:
                numbers[nxt] = len(numbers)
                todo.append(nxt)
            row.append(numbers[nxt])
        table.append(row)
    return table, rules, classes


def determined(patterns: list[Pattern]) -> tuple[list[list[int]], list[int], list[int]]:
    """Tables of an automaton that reads one match from its beginning."""
    nfa = Nfa()
    start = nfa.state()
    ends = {}
    for i, pattern in enumerate(patterns):
        own = nfa.state()
        nfa.free[start].append(own)
        ends[pattern(nfa, own)] = 1 << i
    return _subsets(nfa, nfa.closure([start]), ends, frozenset())


def reversed_anywhere(patterns: list[Pattern]) -> tuple[list[list[int]], list[int], list[int]]:
    """Tables of an automaton that reads a text from its end: after each byte it accepts the
    rules of which a match begins there, wherever that match ends."""
    forward = Nfa()
    begins, finishes = {}, []
    for i, pattern in enumerate(patterns):
        own = forward.state()
        begins[own] = 1 << i
        finishes.append(pattern(forward, own))
    backward = Nfa()
    for _ in forward.moves:
        backward.state()
    for s, moves in enumerate(forward.moves):
        for byte, targets in moves.items():
            for t in targets:
                backward.moves[t][byte].append(s)
        for t in forward.free[s]:
            backward.free[t].append(s)
    always = backward.closure(finishes)
    return _subsets(backward, always, begins, always)


def minimised(table: list[list[int]], rules: list[int], classes: list[int]) -> Dfa:
    """Merge states that no text tells apart, by refining a partition until it is stable."""
    block = list(rules)
    while True:
        names: dict[tuple, int] = {}
        signatures = [(block[s], *[block[t] for t in row]) for s, row in enumerate(table)]
        finer = [names.setdefault(x, len(names)) for x in signatures]
        if len(names) == len(set(block)):
            break
        block = finer
    first_of: dict[int, int] = {}
    for s, b in enumerate(finer):
        first_of.setdefault(b, s)
    merged = tuple(
        tuple(finer[table[first_of[b]][c]] for c in classes) for b in range(len(names))
    )
    kept = tuple(rules[first_of[b]] for b in range(len(names)))
    dead = next((b for b, row in enumerate(merged) if not kept[b] and set(row) == {b}), -1)
    return Dfa(merged, kept, dead)


def compiled(patterns: list[Pattern]) -> Dfa:
    return minimised(*determined(patterns))


def starts_machine(patterns: list[Pattern]) -> Dfa:
    return minimised(*reversed_anywhere(patterns))


def longest(rows: list[list], dead: list | None, data: bytes, start: int) -> int:
    """End of the longest match that begins at ``start``, or -1."""
    row, end = rows[0], -1
    for i in range(start, len(data)):
        row = row[data[i]]
        if row is dead:
            break
        if row[256]:
            end = i + 1
    return end
