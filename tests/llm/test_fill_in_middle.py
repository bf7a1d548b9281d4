"""Fill-in-the-middle against a plain loop over the matches of the pattern, and exact round trips."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from cobasket.llm import fill_in_middle as fim
from .conftest import TEXTS, table

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
MORE = ["<P>", "a<S>b", "x <M> y", "<P", "P>", "<<S", "S><M", "<", "é", "\x00", "a\x00\x00b\n\n", "x<SS>y<P P>", "👍👍a", "1:2"] * 7


def brute(key, text, rate=90, spm_rate=20):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, None)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return key, len(units), "plain", None, None, text
    if h[3] % 100 < spm_rate:
        form, out = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, out = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return key, len(units), form, len(prefix), len(middle), out


@pytest.mark.parametrize("segment", [fim.SEGMENT, 1000, 7])
def test_same_as_a_plain_loop(spark, segment):
    texts = TEXTS + MORE if segment > 7 else [t and t[:300] for t in TEXTS] + MORE
    out = fim.restore(fim.transform(table(spark, texts), segment=segment))
    rows = sorted(out.collect())
    assert [tuple(r)[:6] for r in rows] == [brute(i, t) for i, t in enumerate(texts)]
    assert [r.restored for r in rows] == [t or "" for t in texts]
    if segment > 7:
        assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_rates(spark):
    docs = table(spark, [f"some words {i}" for i in range(60)])
    for rate, spm_rate, want in ((0, 50, {"plain"}), (100, 0, {"psm"}), (100, 100, {"spm"})):
        rows = sorted(fim.transform(docs, rate, spm_rate).collect())
        assert {r.form for r in rows} == want
        assert [tuple(r) for r in rows] == [brute(i, f"some words {i}", rate, spm_rate) for i in range(60)]
    assert fim.transform(docs, seed=2).exceptAll(fim.transform(docs)).count() > 0


def test_odd_rows(spark, none):
    docs = spark.createDataFrame([(4, "two words", 0, "x", None)] * 2 + [(4, "three little words", 0, "y", True), (
        None, "no key", 0, None, None), (9, None, 0, None, None)], none.schema)
    rows = [tuple(r) for r in fim.transform(docs).collect()]
    assert sorted(rows, key=str) == sorted([brute(r.doc_id, r.text) for r in docs.collect()], key=str)
    assert fim.transform(none).count() == 0 and fim.restore(fim.transform(none)).columns[-1] == "restored"
    odd = spark.createDataFrame([("psm", None), (None, "x"), ("other", "y")], "form string, output string")
    assert [r.restored for r in fim.restore(odd).collect()] == [None] * 3


def test_a_long_text_is_cut_between_units(spark):
    """Some 5 MB: letters without end, letters beyond ASCII, and words; in segments and at once."""
    text = "a" * 2_100_000 + "é" * 500_000 + " ".join(f"wörd{i}" for i in range(200_000)) + "b" * 1_000_000
    docs = table(spark, ["x", text, "y z"])
    one, two = (fim.transform(docs, 100, segment=s).withColumn("output", F.sha2("output", 256)) for s in (1 << 20, 1 << 30))
    rows = sorted(one.collect())
    assert rows == sorted(two.collect())
    assert tuple(rows[1])[:5] == brute(1, text, 100)[:5] and rows[1].n > 1_500_000


def test_segments_end_between_units():
    text = ("ab" * 50 + "éé,," + "x" * 3).encode() * 30
    for size in (1, 2, 3, 10, 101, 5000):
        parts = list(fim.segments(text, size))
        assert b"".join(parts) == text
        assert [u for p in parts for u in UNIT.findall(p.decode())] == UNIT.findall(text.decode())
