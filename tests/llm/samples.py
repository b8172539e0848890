"""Small documents with everything that tables can hold, and brute-force helpers."""

from __future__ import annotations

import random
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use for columns they add.
CLASHING = ("size", "shard", "slot", "score", "kept", "n_words", "host", "path", "rule", "verdict", "taken")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text or ""))


def crc(doc_id, parts: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % parts


def prose(r: random.Random, n: int, names: int = 400) -> str:
    return " ".join(f"w{r.randrange(names)}" for _ in range(n))


def documents(seed: int = 1) -> list[tuple]:
    """Copies, near copies, repeats, nulls, empty and very long texts, a source of a third."""
    r = random.Random(seed)
    rows = []

    def add(text, lang="en", source=None):
        source = source or ("hot" if len(rows) % 3 == 0 else f"s{len(rows) % 5}")
        rows.append((len(rows), text, lang, source, len(text or "")))

    for _ in range(60):
        add(prose(r, r.randrange(5, 120)))
    base = prose(r, 100, 5000)
    for k in range(30):
        near = base.split()
        for _ in range(k % 4):
            near[r.randrange(len(near))] = f"x{r.randrange(99)}"
        add(" ".join(near).upper() if k % 5 == 0 else " ".join(near))
    for _ in range(20):
        add(base)
    add(None)
    add("")
    add("\n\n \t")
    add("one two")
    add("Ümlaut é 漢字 🙂 " * 5)
    add(prose(r, 20_000, 3000))
    add("same line of words here\n" * 6, None, "null-lang")
    rows.append((len(rows), prose(r, 30), None, None, None))
    return rows
