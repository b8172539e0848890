"""Secret scans with one combined deterministic automaton.

All rules are compiled by subset construction and minimisation into transition arrays. One
pass over the bytes of a text, from its end to its beginning, runs all rules at once: the
state at a byte has a bit for every rule of which a match begins there. Each rule's matches
are then read off from left to right: the first place not covered yet is a match, and its own
automaton walks to the match's end. So no place is tried in vain, and the time is linear in
the text's length however many places look like a beginning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from payrisk.llm.automaton import (
    Pattern,
    chars,
    compiled,
    either,
    longest,
    many,
    maybe,
    seq,
    some,
    starts_machine,
    text,
)
from payrisk.llm.common import text_or_empty

# The character sets of the rules.
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
VALUE = UPPER + LOWER + DIGITS + "+/_.=-"
HEX = DIGITS + "abcdef"
BASE64URL = UPPER + LOWER + DIGITS + "_-"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is what a match looks like, ``least`` the length it must have to be kept; with
    a ``head`` that holds for what follows it.

    ``begins``, where given, is looked for in place of the pattern: it leaves out places at
    which matches are too short anyway, if these cover no place of a longer one.
    """

    kind: str
    pattern: Pattern
    least: int
    head: Pattern | None = None
    begins: Pattern | None = None


def _assign_head() -> Pattern:
    names = ["password", "passwd", "secret", "token"]
    key = seq(text("api", True), maybe(chars("_")), text("key", True))
    quote, blanks = maybe(chars("\"'")), many(chars(" "))
    return seq(either(*[text(n, True) for n in names], key), quote, blanks, chars(":="), blanks, quote)


HEAD = _assign_head()
# The first three are the base rules, in their order; the others add spans.
RULES = (
    Rule("assign", seq(HEAD, some(chars(VALUE))), 8, HEAD),
    Rule("access", seq(text("AKIA"), some(chars(UPPER + DIGITS))), 16),
    Rule("hex", some(chars(HEX)), 32, begins=some(chars(HEX), 32)),
    Rule("github", seq(text("gh"), chars("pousr"), text("_"), some(chars(UPPER + LOWER + DIGITS))), 40),
    Rule(
        "jwt",
        seq(
            text("eyJ"), some(chars(BASE64URL), 8), text(".eyJ"), some(chars(BASE64URL), 8),
            text("."), some(chars(BASE64URL), 8),
        ),
        1,
    ),
    Rule(
        "private_key",
        seq(text("-----BEGIN "), many(chars(UPPER + DIGITS + " ")), text("PRIVATE KEY-----")),
        1,
    ),
)
BASE = 3


@lru_cache(maxsize=1)
def machines():
    """(rows of the combined automaton, per rule: rows, dead row, head's rows)."""
    whole = starts_machine([r.begins or r.pattern for r in RULES]).rows()
    single = []
    for rule in RULES:
        dfa = compiled([rule.pattern])
        rows = dfa.rows()
        head = compiled([rule.head]) if rule.head else None
        linked = head.rows() if head else None
        heads = (linked, linked[head.dead]) if head else None
        single.append((rows, rows[dfa.dead] if dfa.dead >= 0 else None, heads))
    return whole, single


def beginnings(data: bytes, rows: list[list]) -> list[tuple[int, int]]:
    """(place, bits of the rules of which a match begins there), from left to right."""
    row, found, at = rows[0], [], len(data)
    for byte in reversed(data):
        row = row[byte]
        at -= 1
        if row[256]:
            found.append((at, row[256]))
    return found[::-1]


def rule_spans(data: bytes, number: int, places: list[int]) -> list[tuple[int, int]]:
    """Matches of a rule as byte spans, leftmost and not overlapping; short ones are dropped
    after they have been matched, so what they cover is not matched again."""
    rows, dead, head = machines()[1][number]
    least, spans, upto = RULES[number].least, [], 0
    for at in places:
        if at < upto:
            continue
        upto = longest(rows, dead, data, at)
        value = at if head is None else longest(*head, data, at)
        if upto - value >= least:
            spans.append((at, upto))
    return spans


def spans_of(data: bytes) -> list[tuple[int, int, int]]:
    """(start, rule, end) in code points, ordered by start, then rule."""
    places = beginnings(data, machines()[0])
    if not places:
        return []
    found = [
        (a, number, b)
        for number in range(len(RULES))
        for a, b in rule_spans(data, number, [at for at, bits in places if bits >> number & 1])
    ]
    if not data.isascii():
        upto, code_points = 0, {}
        for edge in sorted({x for a, _, b in found for x in (a, b)}):
            code_points[edge] = code_points.get(upto, 0) + len(data[upto:edge].decode())
            upto = edge
        found = [(code_points[a], number, code_points[b]) for a, number, b in found]
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{RULES[number].kind}:{a}:{b}" for a, number, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [spans_of(x.as_buffer().to_pybytes()) for x in batch.column("text")]
        base = [[s for s in spans if s[1] < BASE] for spans in found]
        counts = [[sum(s[1] == k for s in spans) for spans in base] for k in range(BASE)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *[pa.array(c, pa.int64()) for c in counts],
                pa.array([hashlib.sha256(joined(s).encode()).hexdigest() for s in base], pa.string()),
                pa.array([joined(s) for s in found], pa.string()),
            ],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def scan(docs: DataFrame) -> DataFrame:
    """Counts of the base rules, the digest of their spans, and all spans, per row of ``docs``.

    Null and empty texts have no spans: counts of 0, the digest of the empty text, and empty
    ``spans``. Texts are read whole, in time linear in their length. Repeated rows get equal
    results, an empty table gives an empty table. Only doc_id and text are read; a map without
    a shuffle, row by row the same whatever the partitioning.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        _scan,
        f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    )
