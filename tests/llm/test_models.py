"""The trained operators: held-out accuracy on the given tables, and brute force where there is one."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cobasket.llm import attention_lm, quality, toxicity
from cobasket.llm.common import read
from .conftest import TEXTS, table

SF, WORDS = "/root/testdata/sf0.01", public_tokenizers.path("word_bpe_49k.json")


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in read(spark, SF, "labels").collect()}


# ---- quality

def test_gradients_of_gated_attention():
    """One long fit separates bags by a single marked passage, wherever it is."""
    rng = np.random.default_rng(0)
    bags, y = [], []
    for i in range(120):
        bag = rng.normal(0, 1, (rng.integers(1, 6), 5))
        y.append(i % 2)
        bag[rng.integers(len(bag)), 0] = 4 if i % 2 else -4
        bags.append(bag)
    starts = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
    x, y = np.concatenate(bags), np.array(y, float)
    found = quality.GatedAttention(5).fit(x, starts, y).score(x, starts)
    assert ((found > 0.5) == y).mean() > 0.97


def test_quality_is_learned(spark, labels):
    docs = read(spark, SF, "documents")
    got = {r.doc_id: r for r in quality.judged(docs, read(spark, SF, "labels")).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (fold(i, 4) == 2) and r.predicted == (r.score >= 0.7) for i, r in got.items())
    held = [(got[i].predicted, r.quality) for i, r in labels.items() if r.quality is not None and fold(i, 4) == 2]
    assert sum(a == b for a, b in held) / len(held) > 0.93


def test_quality_of_odd_rows(spark, docs, none):
    marks = spark.createDataFrame([(i, i % 2, 0) for i in range(len(TEXTS))] + [(None, 1, 0), (500, None, 0)],
                                  "doc_id long, quality int, toxic int")
    got = quality.judged(docs, marks).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not (TEXTS[r.doc_id] or "").strip()}) == 1
    assert quality.judged(none, marks).count() == 0
    assert {r.score for r in quality.judged(docs, marks.filter("quality = 1")).collect()} == {0.5}
    kept = quality.keep_good(docs, marks)
    assert kept.columns == docs.columns
    same = docs.withColumn("doc_id", F.lit(5).cast("long"))  # rows are judged by their own texts, whatever their ids
    got = {r.doc_id: r.score for r in got}
    want = sorted((t or "") for i, t in enumerate(TEXTS) if got[i] >= 0.7)
    assert sorted(r.text or "" for r in quality.keep_good(docs, marks).collect()) == want
    model = quality.fit(docs, marks)
    quality_fit, quality.fit = quality.fit, lambda *a, **k: model
    try:
        assert sorted(r.text or "" for r in quality.keep_good(same, marks).collect()) == want
    finally:
        quality.fit = quality_fit


# ---- toxicity

def test_hidden_words_are_restored():
    words = [w.encode() for w in "idiot stupid moron loser trash the quick brown fox was there from with and".split()] * 50
    channel = toxicity.Channel(toxicity.letter_trigrams(words))
    for hidden, plain in {"1d10t": "idiot", "stuuupid": "stupid", "s.t.u.p.i.d": "stupid", "m0r0n": "moron", "l0s3r": "loser",
                          "tr@sh": "trash", "id!ot": "idiot", "st-up-id": "stupid"}.items():
        assert channel.restore(hidden) == plain
    restorer = toxicity.Restorer(channel)
    assert "idiot" in restorer.spaced("he was an i d i o t there")
    assert restorer.spaced("a a a a a a") == []
    assert restorer.words(b"There,") == ("there",)


def test_toxicity_is_learned(spark, labels):
    docs = read(spark, "/root/testdata/sf0.1", "documents")
    marks = read(spark, "/root/testdata/sf0.1", "labels")
    got = {r.doc_id: r for r in toxicity.judged(docs, marks).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (fold(i, 5) == 0) and r.predicted == (r.score >= 0.5) for i, r in got.items())
    held = [(got[r.doc_id].predicted, r.toxic) for r in marks.collect() if r.toxic is not None and fold(r.doc_id, 5) == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert sum(a for a, b in held if b) / sum(b for _, b in held) > 0.85


def test_toxicity_of_odd_rows(spark, docs, none):
    marks = spark.createDataFrame([(i, 1, i % 2) for i in range(len(TEXTS))] + [(None, 1, 0)],
                                  "doc_id long, quality int, toxic int")
    got = toxicity.judged(docs, marks).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.judged(none, marks).count() == 0
    clean = toxicity.judged(docs, marks.filter("toxic = 0")).collect()
    assert not any(r.predicted for r in clean)


# ---- language model

def test_windows_score_every_place_once():
    rng = random.Random(5)
    lengths = np.array([rng.randrange(1, 100) for _ in range(50)])
    start, stop, first = attention_lm.windows(lengths)
    seen = Counter(int(s) + k for s, e, f in zip(start, stop, first) for k in range(int(f), attention_lm.WINDOW)
                   if s + k < e)
    assert seen == Counter(range(int(lengths.sum())))


def test_attention_looks_back_only():
    net = attention_lm.AttentionModel(50)
    ids = np.random.default_rng(1).integers(0, 50, (3, attention_lm.WINDOW))
    other = ids.copy()
    other[:, 9:] = (other[:, 9:] + 1) % 50
    a, b = net.hidden(ids)[-1], net.hidden(other)[-1]
    assert np.allclose(a[:, :9], b[:, :9]) and not np.allclose(a[:, 9:], b[:, 9:])


def test_training_lowers_the_loss():
    rng = np.random.default_rng(2)
    ids = np.cumsum(rng.integers(1, 3, (300, attention_lm.WINDOW + 1)), axis=1) % 20
    net, targets = attention_lm.AttentionModel(20), ids[:, 1:] % 4

    def loss():
        scores, whole = net.class_scores(net.hidden(ids[:, :-1])[-1].reshape(-1, attention_lm.WIDTH))
        return float((whole - scores[np.arange(targets.size), targets.ravel()]).mean())

    before = loss()
    net.fit(ids[:, :-1], targets, steps=150)
    assert loss() < 0.5 * before


def test_shares_add_up_to_one():
    rng = np.random.default_rng(3)
    size, classes = 300, rng.integers(0, attention_lm.CLASSES, 300)
    keys = np.unique(rng.integers(0, size * size, 2000))
    shares = attention_lm.Shares(rng.random((attention_lm.CLASSES + 1, size)) * 9, keys,
                                 rng.integers(1, 9, len(keys)).astype(float), classes)
    for before, first in ((7, False), (7, True), (250, False)):
        logs = shares.log(np.arange(size), np.full(size, before), np.full(size, first))
        total = np.bincount(classes, weights=np.exp(logs), minlength=attention_lm.CLASSES)
        assert np.allclose(total[np.unique(classes)], 1, atol=1e-4)


def test_language_model(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents").unionByName(
        table(spark, TEXTS).selectExpr("doc_id + 100000 AS doc_id", "text"), allowMissingColumns=True)
    rows = docs.select("doc_id", "text").collect()
    got = {r.doc_id: r for r in attention_lm.score(docs, WORDS).collect()}
    lower, counts = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))), Counter()
    split = {r.doc_id: (r.text or "").encode().translate(lower).split() + [None] for r in rows}
    for i, words in split.items():
        if fold(i, 10):
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    for i, words in split.items():
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (fold(i, 10) == 0, len(words), n)
        assert r.n_known == sum(counts[w] > 0 for w in words)
        assert r.base_score == pytest.approx(base) and r.score < 0
    held = [r for i, r in got.items() if r.held_out and i < 100000]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_of_nothing(spark, none):
    assert attention_lm.score(none, WORDS).count() == 0


def test_bounded_choices(spark):
    from pyspark.sql import functions as F

    from cobasket.llm.common import about, most_frequent

    rows = spark.range(20_000)
    assert 850 < about(rows, 1000, 20_000).count() < 1150 and about(rows, 30_000, 20_000).count() == 20_000
    counts = rows.select("id", (F.lit(100_000) / (F.col("id") + 1)).cast("long").alias("n"))
    top = {r.id for r in most_frequent(counts, 500).collect()}
    assert 400 < len(top) <= 500 and top == set(range(len(top)))
    assert most_frequent(counts, 0).count() == 0 and most_frequent(counts, 50_000).count() == 20_000
