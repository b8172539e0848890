"""URL filter, sharding, mixing and quality rules against plain Python."""

from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from samples import CLASHING, SCHEMA, WORD, documents, prose, words

from payrisk.llm import mixing, quality, sharding, url_filter


@pytest.fixture(scope="module")
def rows():
    return documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def clashing(docs):
    return docs.withColumns({c: F.lit("mine") for c in CLASHING})


def best_capacity(sizes, shards):
    """Smallest capacity of a contiguous partition, by trying every capacity that can be one."""
    sums = sorted({sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1)})
    for capacity in sums:
        used, load = 1, 0
        for s in sizes:
            if s > capacity:
                break
            if load + s > capacity:
                used, load = used + 1, 0
            load += s
        else:
            if used <= shards:
                return capacity
    return 0


@pytest.mark.parametrize("first_bits, hot", [(2, 1), (14, 1), (3, 400)])
def test_minimax_capacity_is_the_best(spark, monkeypatch, first_bits, hot):
    monkeypatch.setattr(sharding, "FIRST_BITS", first_bits)
    r = random.Random(first_bits)
    pairs = sorted((r.randrange(-(2**63), 2**63), r.randrange(1, 50)) for _ in range(60))
    pairs[7] = (pairs[7][0], pairs[7][1] * hot)
    groups = spark.createDataFrame(pairs, "hash bigint, size bigint")
    for shards in (1, 3, 7):
        capacity, ends = sharding.best_cuts(groups, shards)
        assert capacity == best_capacity([s for _, s in pairs], shards)
        bounds = [-(2**63) - 1, *[e if e is not None else -(2**63) - 1 for e in ends], 2**63]
        loads = [sum(s for h, s in pairs if a < h <= b) for a, b in itertools.pairwise(bounds)]
        assert sum(loads) == sum(s for _, s in pairs) and max(loads) <= capacity


def test_shards_hold_groups_whole_and_slots_have_no_gaps(docs, rows):
    got = sharding.shard_table(docs).collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
    shard_of = defaultdict(set)
    for r in got:
        text = rows[r.doc_id][1] or ""
        assert r.size == len(text.encode()) + 1 and r.law == "bytes" and r.grown_shard is None
        shard_of[text].add(r.shard)
    assert all(len(s) == 1 for s in shard_of.values())
    for shard, slots in itertools.groupby(sorted((r.shard, r.slot) for r in got), key=lambda x: x[0]):
        assert [s for _, s in slots] == list(range(sum(r.shard == shard for r in got)))


def brute_mix(rows):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_ones, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_ones:
        level = left / sum(weight[s] for s in open_ones)
        full = {s for s in open_ones if level * weight[s] > 2 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_ones}
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ones -= full
    return sizes, target


def test_mix_meets_every_budget(docs, rows):
    sizes, target = brute_mix(rows)
    got = mixing.mix_table(docs).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        text, source = rows[r.doc_id][1], rows[r.doc_id][3]
        assert r.size == len(words(text)) and 0 <= r.taken <= 2 * r.size
        assert r.source_size == sizes[source] and r.target == pytest.approx(target[source])
        taken[source] += r.taken
    assert all(taken[s] == round(target[s]) for s in sizes)
    again = mixing.mix_table(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_documents_repeat_what_is_taken(docs):
    taken = {r.doc_id: -(-r.taken // r.size) if r.size else 0 for r in mixing.mix_table(docs).collect()}
    found = Counter(r.doc_id for r in mixing.mixed_documents(docs).select("doc_id").collect())
    assert found == Counter({k: v for k, v in taken.items() if v})
    assert mixing.mixed_documents(docs).columns == docs.columns


def brute_quality(text):
    t = text or ""
    plain = WORD.findall(t)
    windows = Counter(tuple(plain[i : i + 5]) for i in range(len(plain) - 4))
    covered = {j for i in range(len(plain) - 4) if windows[tuple(plain[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if words(x)]
    return (
        len(plain), sum(map(len, plain)), sum(t.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
    )


def test_quality_counts(spark, docs, rows):
    extra = ["a b c d e a b c d e", "a a a a a a a a", "x y z w v q x y z w v r x y z w v", "a|b #c\n\na|b #c\n"]
    more = [(1000 + i, t, "en", "s", 1) for i, t in enumerate(extra)]
    texts = {r[0]: r[1] for r in [*rows, *more]}
    got = quality.quality_table(docs.unionByName(spark.createDataFrame(more, SCHEMA))).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute_quality(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_outliers_go_and_clean_documents_stay(spark):
    r = random.Random(2)
    rows = [(i, prose(r, r.randrange(40, 200), 9000), "en", "hot", 0) for i in range(400)]
    rows += [(400 + i, " ".join(f"ab{k}###" for k in range(80)) + f" {i}", "en", "hot", 0) for i in range(20)]
    kept = {r.doc_id for r in quality.quality_table(spark.createDataFrame(rows, SCHEMA)).filter("kept").collect()}
    assert kept == set(range(400))


def test_moderate_outliers_go(spark):
    """Tables and starred capitals: words like the others', with a symbol every third or so."""
    r = random.Random(12)
    clean = [prose(r, r.randrange(40, 200), 9000) for _ in range(400)]
    tables = [" | ".join(prose(r, r.randrange(2, 4), 9000) for _ in range(r.randrange(20, 50))) for _ in range(20)]
    shouts = [" ".join(w.upper() + "*" * (k % 3 == 0) for k, w in enumerate(prose(r, 80, 9000).split())) for _ in range(20)]
    traces = [f"{prose(r, 90, 9000)} {'# ' * 2}{prose(r, 90, 9000)}" for _ in range(5)]
    texts = [*clean, *traces, *tables, *shouts]
    docs = spark.createDataFrame([(i, t, "en", "hot", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {x.doc_id: x for x in quality.quality_table(docs).collect()}
    assert all(0.2 < x.n_symbols / x.n_words < 0.6 for i, x in got.items() if i >= 405)
    assert {i for i, x in got.items() if x.kept} == set(range(405))


URLS = [
    "http://a.example.net/en/1?x", "https://EXAMPLE.net/en", "http://example.com/de/", "x://b.example.com/de/q#f",
    "http://org/fr/1", "http://a.org/fr/1", "http://notexample.com/de/1", "http://net", "http://net/", "no scheme",
    "", None, "http://a.b.c.net/x/y", "http://free-bets.example.com/en/1", "http://www.free-bets.example.com/de/1",
    "http://net/?net/", "a://b://c.net/x", "http:///path", "http://münchen.net/", "http://example.net.evil.com/en/",
]


def brute_url(url, rules, listed):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", "", None, "allow"
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]

    def best(entries):
        fits = []
        for key, verdict in entries:
            h, _, p = key.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append((len(key), key, verdict))
        return max(fits, default=None)

    rule = best(rules)
    if rule:
        return host, path, rule[1], rule[2]
    hit = best(listed)
    return host, path, None, hit[2] if hit else "allow"


def test_urls_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS * 2)], "page_id int, url string, host string")
    got = {r.page_id: r for r in url_filter.url_table(pages).collect()}
    assert len(got) == 2 * len(URLS)
    for i, url in enumerate(URLS * 2):
        want = brute_url(url, url_filter.RULES, url_filter.LISTED)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want


@pytest.mark.parametrize("broadcast", [1 << 15, 0])
def test_long_lists(spark, monkeypatch, broadcast):
    monkeypatch.setattr(url_filter, "BROADCAST_BLOCKS", broadcast)
    r = random.Random(3)
    hosts = [f"h{i}.{d}" for i in range(300) for d in ("com", "net")]
    listed = [(f"{h}/{'x/' * r.randrange(3)}", r.choice(["allow", "block"])) for h in hosts[::2]]
    rules = [("h0.com/x/", "allow"), ("net/", "block"), ("h4.net/x/x/", "allow")]
    urls = [f"http://{r.choice(['', 'a.', 'b.a.'])}{r.choice(hosts)}/{'x/' * r.randrange(4)}y" for _ in range(500)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    judged = url_filter.filter_urls(
        pages, url_filter.keys_frame(spark, rules), spark.createDataFrame(listed, "key string, verdict string")
    )
    for row in judged.collect():
        assert (row.host, row.path, row.rule, row.verdict) == brute_url(row.url, rules, listed)


def test_empty_tables_and_clashing_columns(spark, docs):
    none = spark.createDataFrame([], SCHEMA)
    for make in (sharding.shard_table, mixing.mix_table, quality.quality_table, mixing.mixed_documents, quality.kept_documents):
        assert make(none).count() == 0
        assert make(clashing(docs)).count() == make(docs).count()
    pages = spark.createDataFrame([], "page_id int, url string")
    assert url_filter.url_table(pages).count() == 0
    assert {r.n_words for r in quality.kept_documents(clashing(docs)).select("n_words").collect()} == {"mine"}
    assert "mine" in {r.size for r in mixing.mixed_documents(clashing(docs)).select("size").collect()}
