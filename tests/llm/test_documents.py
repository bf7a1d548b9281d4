"""Deduplication, decontamination and archives against brute force on small tables."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cobasket.llm import components, decontam, exact_dedup, simhash, warc
from cobasket.session import scratch_path
from .conftest import LONG, TEXTS, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- exact duplicates

def digest_of(n):
    return hashlib.sha256(str(n).encode()).digest()


def test_cuckoo_index_inserts_finds_and_deletes():
    index, live, rng = exact_dedup.CuckooIndex(4), {}, random.Random(2)
    for step in range(6000):
        n = rng.randrange(1500)
        if rng.random() < 0.6:
            live[n] = index.insert(digest_of(n))
        else:
            assert index.delete(digest_of(n)) == (n in live)
            live.pop(n, None)
    assert index.resizes > 3 and len(index) == len(live)
    assert all(index.find(digest_of(n)) == h for n, h in live.items())
    assert all(index.find(digest_of(n)) < 0 for n in range(3000) if n not in live)


def test_equal_fingerprints_are_verified():
    index = exact_dedup.CuckooIndex()
    one, two = digest_of(1), digest_of(1)[:10] + bytes(22)  # same fingerprint, same buckets
    index.insert(one)
    assert index.find(two) < 0 and not index.delete(two) and index.find(one) >= 0


def test_exact_duplicates(spark, docs, none):
    groups = defaultdict(list)
    for i, t in enumerate(TEXTS):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    got = {r.doc_id: r for r in exact_dedup.exact_duplicates(docs).collect()}
    for text, ids in groups.items():
        for i in ids:
            assert (got[i].keep_id, got[i].group_size, got[i].kept) == (min(ids), len(ids), i == min(ids))
            assert got[i].text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert exact_dedup.exact_duplicates(none).count() == 0


def test_large_group_and_small_indexes(spark, monkeypatch):
    """A third of all rows are copies; indexes hold few digests and start anew."""
    monkeypatch.setattr(exact_dedup, "LIVE", 10)
    texts = [f"text {i}" if i % 3 else "copy" for i in range(600)]
    got = exact_dedup.exact_duplicates(table(spark, texts).repartition(5)).collect()
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == {
        i: (0, 200) if i % 3 == 0 else (i, 1) for i in range(600)}


def test_repeated_rows_keep_one(spark):
    rows = spark.createDataFrame([(1, "a", "p"), (1, "a", "p"), (None, "a", "q"), (None, "b", "r"), (2, "b", "s")],
                                 "doc_id long, text string, _sha string")
    found = exact_dedup.exact_duplicates(rows).collect()
    assert sorted(str(r.doc_id) for r in found if r.kept) == ["1", "2"]
    assert {r.group_size for r in found if r.doc_id == 1} == {3}
    left = exact_dedup.drop_duplicates(rows)
    assert left.columns == rows.columns
    assert sorted(tuple(r) for r in left.collect()) == [(1, "a", "p"), (2, "b", "s")]


def test_index_changes(spark):
    def of(*numbers):
        return spark.createDataFrame([(digest_of(n),) for n in numbers], "digest binary")

    index = of(1, 1, 2, 3).groupBy("digest").agg(F.count("*").alias("group_size"))
    found = exact_dedup.update_index(index, of(3, 4, 4), of(1, 2, 4, 9))
    assert {bytes(r.digest): r.group_size for r in found.collect()} == {
        digest_of(1): 1, digest_of(3): 2, digest_of(4): 1}


# ---- near duplicates

def test_masks_cover_every_pair_of_bits():
    tables = simhash.masks(2)
    assert len(tables) == 7
    for i in range(64):
        for j in range(64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in tables)


def brute_print(text):
    words = (text or "").translate(LOWER).encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(prints, radius=2):
    ids, parent = sorted(prints), {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= radius:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def test_near_duplicates(spark, none):
    rng = random.Random(4)
    base = [" ".join(rng.choice("alpha beta gamma delta omega zeta".split()) + str(rng.randrange(30)) for _ in range(400))
            for _ in range(6)]
    near = [t.replace(t.split()[k], "changed", 1) for t in base for k in (1, 2, 200)]
    texts = TEXTS + base + near + [base[0].upper()]
    got = {r.doc_id: r for r in simhash.near_duplicates(table(spark, texts)).collect()}
    prints = {i: brute_print(t) for i, t in enumerate(texts)}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in got.items()} == brute_components(prints)
    assert got[1].component_id == got[2].component_id == 1 and got[1].fingerprint == "0" * 16
    assert simhash.near_duplicates(none).count() == 0
    kept = {r.doc_id for r in simhash.keep_one(table(spark, texts)).collect()}
    assert kept == set(brute_components(prints).values())


def test_links_keep_all_connections(spark):
    """Many fingerprints around few centres: the same components as all pairs give, with few links."""
    rng = random.Random(9)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(80):
            x = centre
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    signed = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    links = simhash.links(signed)
    pairs = [(r.a % 2 ** 64, r.b % 2 ** 64) for r in links.collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    roots = {r.node % 2 ** 64: r.root for r in components.connected_components(links).collect()}
    want = brute_components(dict(enumerate(prints)))
    groups, found = defaultdict(set), defaultdict(set)
    for i, root in want.items():
        groups[root].add(prints[i])
    for p in prints:
        found[roots.get(p, ("alone", p))].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    found = {r.node: r.root for r in components.connected_components(
        spark.createDataFrame(edges + [(None, 3)], "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprint_of_long_text_in_parts(monkeypatch):
    whole = simhash.fingerprint(LONG.encode())
    monkeypatch.setattr(simhash, "PART", 100)
    assert simhash.fingerprint(LONG.encode()) == whole
    assert np.array_equal(simhash.bit_sums(np.array([5, 1], np.uint64))[:3], [2, 0, 1])


# ---- decontamination

def brute_hits(texts, items, n=10):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    grams = defaultdict(set)
    for i, text in items:
        w = cut.findall((text or "").translate(LOWER))
        size = min(n, len(w))
        for k in range(len(w) - size + 1) if size else ():
            grams[tuple(w[k:k + size])].add(str(i))
    out = {}
    for i, text in enumerate(texts):
        w, hit, found = cut.findall((text or "").translate(LOWER)), set(), set()
        for size in {len(g) for g in grams}:
            for k in range(len(w) - size + 1):
                if (own := tuple(w[k:k + size])) in grams:
                    hit.update(range(k, k + size))
                    found |= grams[own]
        out[i] = (len(w), len(hit), sorted(found), bool(hit))
    return out


def leaky(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 9, 10, 11, 25]))) + f" z{i % 4}")
             for i in range(25)] + [(90, None), (91, ""), (92, "..."), (93, "Ünï Çode"), (1, "w1 w2")]
    texts = []
    for i in range(60):
        own = [rng.choice(words) for _ in range(rng.randrange(40))]
        if i % 2:
            own += (rng.choice(items)[1] or "").split()
        texts.append(", ".join(own).upper())
    return texts + ["", None, "ünï çode", "Ünï ÇODE", "Ünï-Çode", " ".join(t for _, t in items if t)], items


@pytest.mark.parametrize("limit", [500_000, 0])
def test_contamination(spark, monkeypatch, limit):
    """With the broadcast lookup, and with the shuffled one."""
    monkeypatch.setattr(decontam, "BROADCAST_GRAMS", limit)
    monkeypatch.setattr(decontam, "BROADCAST_DOCS", limit)
    texts, items = leaky()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated)
           for r in decontam.contamination(table(spark, texts), benchmark).collect()}
    assert got == brute_hits(texts, items)


def test_contamination_of_nothing(spark, docs, none):
    benchmark = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert decontam.contamination(none, benchmark).count() == 0
    clean = decontam.contamination(docs, benchmark.filter("item_id > 1")).collect()
    assert len(clean) == len(TEXTS) and not any(r.contaminated for r in clean)


def test_documents_and_spans_are_removed(spark):
    benchmark = spark.createDataFrame([(1, "secret answer is here")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "-- Well, the SECRET answer, is here! Bye.", 7), (2, "Nothing to see.", 8),
                                  (3, None, 9), (None, "secret answer is here", 1)], "doc_id long, text string, _gone int") \
        .withColumns({"_id": F.lit(1), "_spans": F.lit(2)})
    assert {r.doc_id for r in decontam.drop_contaminated(docs, benchmark).collect()} == {2, 3}
    left = {r.doc_id: r.text for r in decontam.remove_spans(docs, benchmark).collect()}
    assert left[1] == "-- Well, the Bye." and left[2] == "Nothing to see." and left[3] is None


def test_decontamination_runs_no_python(spark, docs):
    benchmark = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    plan = decontam.contamination(docs, benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)


# ---- archives

def pages_of(spark):
    same, big = "<p>" + "same " * 40 + "</p>", "<html>" + "é漢x" * 40_000 + "</html>"
    tricky = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nb" * 3 + "c" * 100
    html = [same, "small", None, "", "small", same, big, big, tricky, "\r\n\r\n", "x" * 99, "x" * 99, "y" * 100, "y" * 100,
            "\r\n\r\nWARC/1.1", LONG]
    rows = [(100 - i, None if i == 3 else f"http://site/{i}\r\nX: y", h, "n") for i, h in enumerate(html)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


@pytest.mark.parametrize("size", [64 << 10, 37])
def test_archive(spark, size):
    rows, pages = pages_of(spark)
    if size < 100:
        rows = [r for r in rows if len(r[2] or "") < 10_000]
        pages = pages.filter(F.length(F.coalesce("html", F.lit(""))) < 10_000)
    path = scratch_path(spark, "archive-test")
    warc.write_archive(pages, path, size=size)
    got = {r.page_id: r for r in warc.read_records(spark, path).collect()}
    first = {}
    for i, _, h, _ in sorted(rows):
        first.setdefault(h or "", i)
    assert len(got) == len(rows)
    for i, _, h, _ in rows:
        raw = (h or "").encode()
        refers = first[h or ""] if len(raw) >= 100 and first[h or ""] != i else None
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert (got[i].record_type, got[i].refers_to) == ("revisit" if refers is not None else "response", refers)
    segments = warc.read_segments(spark, path)
    assert segments.filter(F.octet_length("chunk") > size).isEmpty()
    assert segments.filter("number > 1").count() > 1


def test_archive_of_nothing_and_of_repeated_pages(spark):
    schema = "page_id long, url string, html string"
    path = scratch_path(spark, "archive-none")
    warc.write_archive(spark.createDataFrame([], schema), path)
    assert warc.read_records(spark, path).count() == 0
    path, body = scratch_path(spark, "archive-repeated"), "z" * 200
    warc.write_archive(spark.createDataFrame([(1, "u", body), (1, "u", body), (2, "u", body), (None, "u", body)], schema), path)
    found = sorted((str(r.page_id), r.record_type, r.refers_to) for r in warc.read_records(spark, path).collect())
    assert found == [("1", "response", None), ("1", "response", None), ("2", "revisit", 1), ("None", "response", None)]


def test_damage_is_noticed():
    record = next(warc.records(1, "u", b"hello", hashlib.sha256(b"hello").hexdigest(), None, "0-1"))
    assert warc.parse_record(record)[-1] == b"hello"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"hello", b"hullo"))


# ---- rows, not ids

SHARED = [(3, "one two three four five six seven eight nine ten"), (5, "one two three four five six seven eight nine ten"),
          (5, "something else entirely, in more words than the other one has"),
          (None, "one two three four five six seven eight nine ten"), (None, "a lone text without any id"),
          (7, "a lone text without any id but with one"), (7, "a lone text without any id but with one"), (8, None), (9, "")]


def shared(spark):
    rows = [(i, t, k, str(k), None) for k, (i, t) in enumerate(SHARED)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, id string, kept boolean")


def test_near_copies_go_by_row(spark):
    """Of equal texts the first by id stays, repeated rows and rows without an id included; a clean text that shares an id
    with a copy stays as well."""
    kept = simhash.keep_one(shared(spark))
    assert kept.columns == shared(spark).columns and sorted(r.n_tokens for r in kept.collect()) == [0, 2, 4, 5, 7]
    assert simhash.near_duplicates(shared(spark)).count() == len(SHARED)


def test_contamination_goes_by_text(spark):
    benchmark = spark.createDataFrame([(1, SHARED[0][1]), (None, SHARED[0][1]), (2, "a lone text")], "item_id int, text string")
    docs = shared(spark)
    found = decontam.contamination(docs, benchmark).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"])) for r in found) == sorted(
        (str(i), len(t.replace(",", " ").split()), *((10, ("1",)) if k in (0, 1, 3) else (3, ("2",)) if k in (4, 5, 6) else (0, ())))
        for k, (i, t) in enumerate((i, t or "") for i, t in SHARED))
    kept = decontam.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.n_tokens for r in kept.collect()) == [2, 7, 8]
    cleaned = decontam.remove_spans(docs, benchmark)
    assert cleaned.columns == docs.columns
    assert {r.n_tokens: r.text for r in cleaned.collect()} == {
        k: "" if k in (0, 1, 3) else t and t.replace("a lone text ", "") for k, (_, t) in enumerate(SHARED)}


def test_an_item_of_many_holders_and_a_text_of_many_rows(spark):
    """One n-gram in every item, and one contaminated text in a third of all rows: each row gets its own result."""
    gram = " ".join(f"w{i}" for i in range(10))
    benchmark = spark.createDataFrame([(i, gram) for i in range(300)], "item_id int, text string")
    docs = spark.createDataFrame([(i, f"x {gram} y" if i % 3 == 0 else f"clean {i}") for i in range(300)], "doc_id long, text string")
    found = decontam.contamination(docs, benchmark).collect()
    assert len(found) == 300 and all((len(r["items"]), r.n_hit) == ((300, 10) if r.doc_id % 3 == 0 else (0, 0)) for r in found)
