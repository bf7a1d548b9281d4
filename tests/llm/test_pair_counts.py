"""All pairs of ids count, however few of them travel to the tasks."""

import public_tokenizers
import pytest

from cobasket.llm import attention_lm
from cobasket.llm.common import read
from .conftest import TEXTS, table


def test_scores_count_all_pairs(spark, monkeypatch):
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").unionByName(
        table(spark, TEXTS).selectExpr("doc_id + 100000 AS doc_id", "text"))
    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(attention_lm, "FIT_STEPS", 20)

    def scores(pairs):
        monkeypatch.setattr(attention_lm, "PAIRS", pairs)
        return {r.doc_id: r for r in attention_lm.score(docs, path).collect()}

    whole = scores(1 << 40)
    for pairs in (0, 200):
        got = scores(pairs)
        assert got.keys() == whole.keys()
        for i, r in got.items():
            assert r.score == pytest.approx(whole[i].score, rel=1e-5) and r.n_known == whole[i].n_known
            assert r.base_score == pytest.approx(whole[i].base_score)
