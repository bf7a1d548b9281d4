"""The language model is fitted to every training document."""

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from cobasket.llm import attention_lm as lm
from cobasket.llm.common import read
from cobasket.llm.token_files import library_memo

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_classes_and_weights_see_all_documents(spark, monkeypatch):
    """More than 600 documents, and one of more than 50,000 bytes: the neighbours and windows of all are counted."""
    rows = [(i, f"doc {i} has some words") for i in range(700)] + [(1001, "long text " * 6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    train = [r.text for r in lm.training(docs, "doc_id").collect()]
    assert len(train) > 600 and max(map(len, train)) > 50_000
    memo, end = library_memo(WORDS), lm.vocabulary(WORDS)[0] - 1
    split = [t.encode().split() for t in train]
    memo.learn(split)
    ids = [lm.sequence(w, memo.known, end)[0] for w in split]
    met, fitted, seen = [], [], lm.classify

    def classify(company, many, counts, final):
        met.append((company.agg(F.sum("n")).first()[0], counts))
        return seen(company, many, counts, final)

    def fit_rounds(net, texts, classes, end, n_ids):
        fitted.append((texts.count(), n_ids))
        return rounds(net, texts, classes, end, n_ids)

    rounds = lm.fit_rounds
    monkeypatch.setattr(lm, "FIT_STEPS", 4)
    monkeypatch.setattr(lm, "COMPANY", 1 << 17)
    monkeypatch.setattr(lm, "classify", classify)
    monkeypatch.setattr(lm, "fit_rounds", fit_rounds)
    assert lm.score(docs, WORDS).count() == len(rows)
    neighbours, counts = met[0]
    assert neighbours == 2 * sum(len(i) - 1 for i in ids)
    assert np.array_equal(counts, np.bincount(np.concatenate(ids), minlength=end + 1))
    assert fitted == [(len(train), sum(map(len, ids)))]


def test_rounds_lower_the_loss(spark, monkeypatch):
    size, rng = 40, np.random.default_rng(1)
    texts = [np.append(np.cumsum(rng.integers(1, 3, n)) % 20, size - 1) for n in rng.integers(0, 90, 60)]
    rows = spark.createDataFrame([(i, bytearray((t * 2).astype("<u4").tobytes())) for i, t in enumerate(texts)],
                                 "place long, ids binary").repartition(3)
    classes = np.arange(size) % 4
    net = lm.AttentionModel(size)
    shapes = {k: v.shape for k, v in net.p.items()}
    inputs, targets = lm.examples([(t * 2).astype("<u4") for t in texts], classes, size - 1)

    def loss():
        scores, whole = net.class_scores(net.hidden(inputs)[-1].reshape(-1, lm.WIDTH))
        ok = targets.ravel() >= 0
        return float((whole - scores[np.arange(targets.size), targets.ravel()])[ok].mean())

    before = loss()
    monkeypatch.setattr(lm, "FIT_STEPS", 300)
    lm.fit_rounds(net, rows, classes, size - 1, sum(map(len, texts)))
    assert loss() < 0.7 * before and {k: v.shape for k, v in net.p.items()} == shapes
