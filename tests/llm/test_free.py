"""Near duplicates, leaks, secrets, language, toxicity and byte model against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import CLASHING, SCHEMA, crc, documents, lower, prose, words

from payrisk.llm import decontamination, langid, near_dedup, ppm, secret_scan, toxicity
from payrisk.session import workspace


@pytest.fixture(scope="module")
def rows():
    return documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text, k):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def brute_components(rows, k=4):
    sets = {r[0]: shingle_set(r[1], k) for r in rows}
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((find(i), find(j)))
                    label[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("small_node", "block", "set_bytes"), [(32, 2048, 1 << 24), (2, 8, 1 << 24), (32, 3, 6000)])
def test_near_groups_equal_all_pairs(docs, rows, monkeypatch, small_node, block, set_bytes):
    monkeypatch.setattr(near_dedup, "SMALL_NODE", small_node)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "SET_BYTES", set_bytes)
    want = brute_components(rows)
    got = near_dedup.near_table(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)


@pytest.mark.parametrize(("buckets", "bits"), [(1 << 11, 1 << 15), (1, 4)])
def test_one_document_of_each_near_group_stays(spark, docs, rows, none, monkeypatch, buckets, bits):
    monkeypatch.setattr(near_dedup, "MARK_BUCKETS", buckets)
    monkeypatch.setattr(near_dedup, "BITMAP_BITS", bits)
    doubled = docs.unionByName(docs).withColumns({c: F.lit("mine") for c in CLASHING})
    kept = near_dedup.kept_documents(doubled, words=5)
    want = brute_components(rows, 5)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted({c for _, c in want.values()})
    assert kept.columns == doubled.columns
    single = near_dedup.kept_documents(docs, words=5)
    assert sorted(r.doc_id for r in single.select("doc_id").collect()) == sorted({c for _, c in want.values()})
    assert near_dedup.kept_documents(none).count() == near_dedup.near_table(none).count() == 0


@pytest.mark.parametrize("set_bytes", [1 << 24, 40_000])
def test_families_of_chains_and_many_components(spark, monkeypatch, set_bytes):
    """Texts just above and just below the limit to one another, in one family of many parts."""
    monkeypatch.setattr(near_dedup, "SET_BYTES", set_bytes)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    r = random.Random(8)
    base, rows = prose(r, 150, 10_000).split(), []
    for i in range(90):
        own = list(base)
        for _ in range(r.randrange(0, 9)):
            own[r.randrange(len(own))] = f"y{r.randrange(10_000)}"
        rows.append((i, " ".join(own), None, None, None))
    for i in range(90, 110):  # each an edit of the one before
        own = rows[-1][1].split()
        own[r.randrange(len(own))] = f"z{i}"
        own[r.randrange(len(own))] = f"z{i}"
        rows.append((i, " ".join(own), None, None, None))
    want = brute_components(rows)
    got = near_dedup.near_table(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == want
    assert 1 < len({c for _, c in want.values()}) < 60


@pytest.mark.parametrize("kind", ["int", "string"])
def test_near_groups_with_other_id_types(spark, docs, rows, kind):
    want = brute_components(rows)
    got = near_dedup.near_table(docs.withColumn("doc_id", F.col("doc_id").cast(kind))).collect()
    groups = defaultdict(set)
    for x in got:
        groups[x.component_id].add(int(x.doc_id))
    plain = defaultdict(set)
    for i, (_, c) in want.items():
        plain[c].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


def test_near_groups_leave_no_tables_behind(spark, docs):
    with workspace(spark) as work:
        before = len(work._folders)
        near_dedup.near_table(docs).collect()
        assert len(work._folders) == before + 1
        kept = [f for f in work._folders]
    assert all(not Path(f.removeprefix("file:")).exists() for f in kept)


def edited(r, item, edits):
    out = list(item)
    for _ in range(edits):
        at, kind = r.randrange(len(out)), r.randrange(3)
        if kind == 0:
            out[at] = f"e{r.randrange(999)}"
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, f"e{r.randrange(999)}")
    return out


def edits_by_table(item, words):
    """Fewest edits between the item and any run of the words, by the whole table."""
    row = [0] * (len(words) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(words, 1):
            new.append(min(row[j - 1] + (v != w), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@given(st.lists(st.integers(0, 3), min_size=1, max_size=80), st.lists(st.integers(0, 3), max_size=90))
@settings(max_examples=300, deadline=None)
def test_least_edits_equal_the_whole_table(item, region):
    places = decontamination.word_places(item)
    assert decontamination.least_edits(places, len(item), region) == edits_by_table(item, region)


@pytest.mark.parametrize("kind", ["int", "string"])
def test_leaks_in_documents_with_other_id_types(spark, kind):
    r = random.Random(6)
    item = prose(r, 30, 500)
    rows = [(i, f"{prose(r, 40)} {item if i % 3 == 0 else ''} {prose(r, 9)}", "en", "s", 0) for i in range(12)]
    rows.append((None, item, None, None, None))
    docs = spark.createDataFrame(rows, SCHEMA)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast(kind)).withColumns({c: F.lit("mine") for c in ("start", "n", "edits")})
    benchmark = spark.createDataFrame([("a", item)], "item_id string, text string")
    got = decontamination.leak_table(docs.unionByName(docs), benchmark).collect()
    assert sorted(map(str, (x.doc_id for x in got))) == ["0", "3", "6", "9", "None"]
    clean = decontamination.clean_documents(docs, benchmark)
    assert clean.count() == 8 and clean.columns == docs.columns and dict(clean.dtypes)["doc_id"] == kind


def test_leaks_within_the_limit_are_found_and_no_others(spark):
    r = random.Random(4)
    items = [prose(r, r.randrange(12, 50), 3000).split() for _ in range(25)] + [["one"] * 3, []]
    bench = [(i, " ".join(x) if x else None) for i, x in enumerate(items)]
    rows, planted = [], set()
    for n in range(120):
        text = prose(r, r.randrange(5, 150), 3000).split()
        if n % 2:
            k = r.randrange(25)
            edits = r.choice([0, 1, len(items[k]) * 20 // 100])
            at = r.randrange(len(text) + 1)
            text[at:at] = edited(r, items[k], edits)
            planted.add((n, k))
        joined = " ".join(text)
        rows.append((n, joined.upper() if n % 7 == 0 else joined, "en", "s", 0))
    rows += [(500, None, None, None, None), (501, "", "en", "s", 0), (502, "one one ONE", "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    benchmark = spark.createDataFrame(bench, "item_id bigint, text string")
    got = {(x.doc_id, x.item_id): x for x in decontamination.leak_table(docs, benchmark).collect()}
    assert len(planted - set(got)) <= 1
    for (doc, item), x in got.items():
        text = next(t for i, t, *_ in rows if i == doc)
        assert edits_by_table(items[item], text.lower().split()) == x.edits
        assert 100 * x.edits <= 20 * len(items[item])
    assert (502, 25) in got
    clean = decontamination.clean_documents(docs, benchmark)
    assert {x.doc_id for x in clean.collect()} == {i for i, *_ in rows} - {d for d, _ in got}
    empty = spark.createDataFrame([], SCHEMA)
    assert decontamination.leak_table(empty, benchmark).count() == 0
    assert decontamination.clean_documents(docs, benchmark.limit(0)).count() == len(rows)


def test_long_items_with_a_fifth_of_their_words_deleted_are_found(spark):
    r = random.Random(14)
    items = [prose(r, n, 3000).split() for n in (200, 300, 400) for _ in range(15)]
    rows = []
    for k, item in enumerate(items):
        for kind in range(2):
            edits = len(item) * 20 // 100
            gone = set(r.sample(range(len(item)), edits))
            copy = [w for i, w in enumerate(item) if i not in gone] if kind == 0 else edited(r, item, edits)
            text = [prose(r, 60, 3000), *copy, prose(r, 60, 3000)]
            rows.append((2 * k + kind, " ".join(text), "en", "s", 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id bigint, text string")
    got = {(x.doc_id, x.item_id) for x in decontamination.leak_table(docs, benchmark).collect()}
    assert len({(i, i // 2) for i in range(len(rows))} - got) <= 1
    assert decontamination.clean_documents(docs, benchmark).count() <= 1


ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def brute_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_secret_spans_equal_regular_expressions(spark, rows):
    r = random.Random(5)
    bits = ["token", "api_key", "APIKEY", "Secret", "passwd", "=", ":", " ", '"', "'", "abc", "deadbeef" * 4, "AKIA",
            "AKIAABCDEFGHIJKL", "é", "x", "secret=", "=abcdefgh", "\n", "tokentoken", "ghp_" + "a1" * 18]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(14))) for _ in range(400)] + [x[1] for x in rows]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    got = secret_scan.scan(docs).collect()
    assert len(got) == len(texts)
    for x in got:
        base = brute_spans(texts[x.doc_id] or "")
        assert [x.n_assign, x.n_access, x.n_hex] == [sum(s[1] == k for s in base) for k in range(3)]
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base)
        assert x.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        spans = [tuple(s.split(":")) for s in x.spans.split(",") if s]
        assert ",".join(":".join(s) for s in spans if s[0] in ("assign", "access", "hex")) == joined
    assert "github" in "".join(x.spans for x in got)


def test_language_of_held_out_texts(spark, none):
    r = random.Random(6)
    letters = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}
    vocabulary = {k: ["".join(r.choice(v) for _ in range(6)) for _ in range(30)] for k, v in letters.items()}
    rows = []
    for i in range(240):
        lang = r.choice(list(letters))
        text = " ".join(r.choice(vocabulary[lang]) for _ in range(r.randrange(3, 60)))
        rows.append((i, text, lang if i % 9 else None, "s", 0))
    truth = {i: next(k for k, v in letters.items() if t[0] in v) for i, t, *_ in rows}
    rows += [(900, None, "aa", "s", 0), (901, "123 !?", "aa", "s", 0), (902, "", None, None, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = langid.lang_table(docs).collect()
    assert len(got) == len(rows)
    for x in got:
        assert x.held_out == (crc(x.doc_id, 4) == 2) and 0 <= x.score <= 1
        assert x.lang_pred == ("und" if x.doc_id >= 900 else truth[x.doc_id])
    assert langid.lang_table(none).count() == 0
    nothing = langid.lang_table(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {x.lang_pred for x in nothing.collect()} == {"und"}


def test_copies_of_one_page_fill_no_dictionary(spark, monkeypatch):
    """A third of a language's rows is one page; of long texts not only the beginning is learned."""
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 20)
    monkeypatch.setattr(langid, "SAMPLE_CHARS", 50)
    rows = [(i, "same page", "aa", "s", 0) for i in range(100)]
    rows += [(1000 + i, f"{'head ' * 40}{i} {'tail ' * 40}", "aa", "s", 0) for i in range(60)]
    rows += [(2000, None, "bb", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    learned = langid.dictionaries(docs)
    pieces = learned["aa"].decode().split("\n")
    assert set(learned) == {"aa"} and len(pieces) == 20
    assert pieces.count("same page") <= 1 and any("tail" in p for p in pieces) and any("head" in p for p in pieces)
    assert langid.dictionaries(docs.repartition(5)) == learned


def test_toxic_texts_score_higher(spark, none):
    r = random.Random(7)
    bad = ["zorgblat", "quixnard", "vlumpish"]
    rows, labels, truth = [], [], {}
    for i in range(400):
        text = prose(r, r.randrange(20, 80), 200).split()
        truth[i] = i % 5 == 0
        if truth[i]:
            for _ in range(4):
                text[r.randrange(len(text))] = r.choice(bad)
        rows.append((i, " ".join(text), "en", "s", 0))
        if i % 3:
            labels.append((i, 1, int(truth[i])))
    rows += [(900, None, None, None, None), (901, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels + labels[:5], "doc_id bigint, quality int, toxic int")
    got = {x.doc_id: x for x in toxicity.toxicity_table(docs, marks).collect()}
    assert len(got) == len(rows)
    held = [i for i in truth if got[i].held_out]
    assert all(got[i].held_out == (crc(i, 4) == 2) for i in got)
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in got.values())
    assert sum(got[i].predicted == truth[i] for i in held) > 0.9 * len(held)
    assert got[900].score == got[901].score and got[900].predicted == 0
    assert toxicity.toxicity_table(none, marks).count() == 0
    assert toxicity.toxicity_table(docs, marks.limit(0)).filter("score != 0").count() == 0


def test_near_copies_with_one_insult_do_not_push_out_the_others(spark):
    r = random.Random(15)
    bad = ["zorgblat", "quixnard", "vlumpish", "draggor", "snivelux", "mukwort", "blentig", "crastole", "fughend", "yopplin"]
    rows, labels, truth = [], [], {}
    for i in range(2000):
        text = prose(r, r.randrange(20, 80), 400).split()
        truth[i] = i % 5 == 0
        if truth[i]:
            text[r.randrange(len(text))] = bad[i // 5 % len(bad)]
        rows.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, 1, int(truth[i])))
    page = prose(r, 60, 400).split()
    for i in range(2000, 2700):
        near = list(page)
        near[r.randrange(60)] = f"x{i}"
        rows.append((i, " ".join([*near, *[bad[0]] * 3]), "en", "s", 0))
        labels.append((i, 1, 1))
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, marks)
    lexicon = model.toxic[len(model.ordinary) :].decode().split()
    assert set(bad) <= set(lexicon) and len(set(page) & set(lexicon)) <= 2
    got = {x.doc_id: x for x in toxicity.score(docs, model).collect()}
    held = [i for i in truth if got[i].held_out]
    assert sum(got[i].predicted == truth[i] for i in held) > 0.9 * len(held)
    assert sum(got[i].predicted for i in held if truth[i]) > 0.7 * sum(truth[i] for i in held)


def brute_ppm(train, texts, order):
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    for t in train:
        stream = bytes([255] * order) + t.encode() + b"\xff"
        for i in range(order, len(stream)):
            for k in range(order + 1):
                counts[k][stream[i - k : i]][stream[i]] += 1
    out = []
    for t in texts:
        stream, total = bytes([255] * order) + t.encode() + b"\xff", 0.0
        for i in range(order, len(stream)):
            gone = set()
            for k in range(order, -1, -1):
                left = {s: n for s, n in counts[k].get(stream[i - k : i], {}).items() if s not in gone}
                if not left:
                    continue
                whole = sum(left.values()) + len(left)
                if stream[i] in left:
                    total += math.log10(left[stream[i]] / whole)
                    break
                total += math.log10(len(left) / whole)
                gone |= set(left)
            else:
                total -= math.log10(256 - len(gone))
        out.append(total)
    return out


@pytest.mark.parametrize("block_bytes", [8 << 20, 2000])
def test_byte_model_and_word_model(spark, monkeypatch, none, block_bytes):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", block_bytes)
    texts = [x[1] for x in documents() if len(x[1] or "") < 5000]
    texts += ["Wörter 漢字 ABC abc", "\t", "a"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    train = [t or "" for i, t in enumerate(texts) if crc(i, 5) != 1]
    want = brute_ppm(train, [t or "" for t in texts], ppm.ORDER)
    c = Counter(w for t in train for w in words(t))
    c[None] = len(train)
    n, v = sum(c.values()), len(c)
    got = ppm.score_texts(docs).collect()
    assert len(got) == len(texts)
    for x in got:
        tokens = [*words(texts[x.doc_id]), None]
        assert x.held_out == (crc(x.doc_id, 5) == 1)
        assert (x.n_tokens, x.train_tokens) == (len(tokens), n)
        assert x.n_known == sum(c[w] > 0 for w in tokens)
        assert x.base_score == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens))
        assert x.score == pytest.approx(want[x.doc_id])
    assert ppm.score_texts(none).count() == 0


def test_lower_casing_is_ascii():
    assert lower("ÀBC") == "Àbc"
