"""All rules of the secret scan against regular expressions, and its time on long texts."""

from __future__ import annotations

import random
import re
import time

from pyspark.sql import functions as F
from samples import CLASHING, SCHEMA

from payrisk.llm import secret_scan

# Per rule: expression, least length, group that it is measured by.
EXPECTED = {
    "assign": (
        r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8, 1,
    ),
    "access": (r"AKIA[A-Z0-9]+", 16, 0),
    "hex": (r"[0-9a-f]+", 32, 0),
    "github": (r"gh[pousr]_[A-Za-z0-9]+", 40, 0),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 1, 0),
    "private_key": (r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", 1, 0),
}
PIECES = [
    "password", "PassWd", "secret", "token", "api_key", "apikey", ":", "=", " ", '"', "'", "AKIA", "ABC123",
    "0123456789abcdef", "deadbeef", "ghp_", "gho_", "eyJ", ".eyJ", ".", "abcdefgh", "A1_-", "-----BEGIN ",
    "RSA ", "PRIVATE KEY-----", "-----", "\n", "é", "漢", "x", "ABCDEFGHIJKLMNOP", "0" * 20,
]


def expected(text):
    found = []
    for number, rule in enumerate(secret_scan.RULES):
        pattern, least, group = EXPECTED[rule.kind]
        for m in re.finditer(pattern, text):
            if len(m[group]) >= least:
                found.append((m.start(), number, m.end()))
    return sorted(found)


def test_every_rule_equals_its_expression():
    r, hits = random.Random(1), set()
    for _ in range(4000):
        text = "".join(r.choice(PIECES) for _ in range(r.randrange(1, 25)))
        got = secret_scan.spans_of(text.encode())
        assert got == expected(text), text
        hits |= {number for _, number, _ in got}
    assert hits >= {0, 1, 2}
    key = "-----BEGIN EC PRIVATE KEY-----"
    jwt = "eyJabcdefgh.eyJabcdefgh.abcdefghi"
    hub = "ghp_" + "aB3" * 13
    for text in (f"é {key} {jwt} {hub} {hub[:30]}", f"{jwt}.eyJ{jwt}", key * 2):
        assert secret_scan.spans_of(text.encode()) == expected(text) != []


def test_time_grows_with_the_length_only():
    """Texts full of beginnings that lead nowhere."""
    for piece in ("eyJ", "token=", "ghp_", "-----BEGIN ", "AKIA", "0f"):
        text = (piece * (1_000_000 // len(piece)) + " .eyJ").encode()
        started = time.perf_counter()
        secret_scan.spans_of(text)
        assert time.perf_counter() - started < 20


def test_long_empty_and_repeated_rows(spark):
    long = "word " * 300_000 + "password=abcdefgh1 " + "deadbeef" * 6
    rows = [(1, long, "en", "s", 1), (2, None, None, None, None), (3, "", None, None, None), (1, long, "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    more = docs.withColumns({c: F.lit("mine") for c in (*CLASHING, "spans", "n_hex", "base_sha256")})
    got = secret_scan.scan(more).collect()
    assert [r.doc_id for r in got].count(1) == 2 and len(set(got)) == 3
    by_id = {r.doc_id: r for r in got}
    start = 5 * 300_000
    assert by_id[1].spans == f"assign:{start}:{start + 18},hex:{start + 19}:{start + 67}"
    assert by_id[2].spans == by_id[3].spans == "" and by_id[2].base_sha256 == by_id[3].base_sha256
    assert secret_scan.scan(docs.limit(0)).count() == 0
