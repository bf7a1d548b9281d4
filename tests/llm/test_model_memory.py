"""What a task of the language model holds beside its input."""

import tracemalloc

import numpy as np
import pyarrow as pa

from cobasket.llm import attention_lm as lm


def test_scoring_holds_little(monkeypatch):
    """The arrays of a block of 524,288 ids, as it was, take 41 MB here, those of one of 131,072 ids 11 MB."""
    rng, size = np.random.default_rng(3), 200
    classes = rng.integers(0, lm.CLASSES, size)
    shares = lm.Shares(rng.integers(1, 9, (lm.CLASSES + 1, size)).astype(float), np.arange(0, size * size, 7),
                       np.ones(len(range(0, size * size, 7))), classes, np.full(size * lm.CLASSES, 9.0))
    model = lm.LanguageModel(lm.AttentionModel(size), classes, shares, size - 1)
    texts = [np.append(rng.integers(0, 2 * size, 499), 2 * size - 1).astype("<u4").tobytes() for _ in range(2000)]
    batch = pa.record_batch({"place": pa.array(range(2000), pa.int64()), "ids": pa.array(texts, pa.binary())})
    whole, peaks = [], []
    for limit in (lm.SCORED_IDS, lm.BLOCK_IDS):
        monkeypatch.setattr(lm, "SCORED_IDS", limit)
        tracemalloc.start()
        scores = {}
        for part in lm.scored(model, iter([batch])):
            scores |= {p: s for p, s in zip(part.column("place").to_pylist(), part.column("score").to_pylist()) if s is not None}
        peaks.append(tracemalloc.get_traced_memory()[1] / 1e6)
        tracemalloc.stop()
        whole.append(scores)
    assert len(whole[0]) == 2000 and np.allclose([whole[0][i] for i in range(2000)], [whole[1][i] for i in range(2000)])
    assert peaks[0] < 25 and peaks[0] < 0.5 * peaks[1], peaks
