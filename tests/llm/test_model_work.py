"""What the language model computes once instead of again and again, and that it is the same."""

from collections import Counter

import numpy as np
import pyarrow as pa

from cobasket.llm import attention_lm as lm
from cobasket.llm.bpe_codec import behind


def test_each_pair_is_looked_up_once(monkeypatch):
    """A block of texts repeats its pairs; before, each place of 20,000 was searched for among the listed pairs."""
    rng, size = np.random.default_rng(4), 50
    classes = rng.integers(0, lm.CLASSES, size)
    keys = np.sort(rng.choice(size * size, 900, replace=False))
    shares = lm.Shares(rng.integers(1, 9, (lm.CLASSES + 1, size)).astype(float), keys, rng.integers(1, 9, 900), classes,
                       rng.integers(0, 3, size * lm.CLASSES).astype(float) * 9)
    ids, before, first = rng.integers(0, size, 20_000), rng.integers(0, size, 20_000), rng.random(20_000) < 0.2
    searched, search = [], np.searchsorted
    monkeypatch.setattr(lm.np, "searchsorted", lambda a, v, *more, **named: searched.append(np.size(v)) or search(a, v, *more, **named))
    logs, (at, pairs, priors) = shares.log_and_rest(ids, before, first)
    monkeypatch.undo()
    assert sum(searched) <= size * size
    counts, open_ = dict(zip(keys.tolist(), shares.counts.tolist())), []
    for i in range(len(ids)):
        share = float(shares.by_class[lm.CLASSES if first[i] else classes[before[i]], ids[i]])
        if not first[i]:
            pair, total = int(before[i] * size + ids[i]), float(shares.totals[before[i] * lm.CLASSES + classes[ids[i]]])
            if pair not in counts and total > 0:
                open_.append((i, pair, lm.PAIR_PRIOR * share))
            share = (counts.get(pair, 0) + lm.PAIR_PRIOR * share) / (total + lm.PAIR_PRIOR)
        assert abs(logs[i] - np.log(share)) < 1e-9
    assert [(i, p) for i, p, _ in open_] == list(zip(at.tolist(), pairs.tolist())) and len(open_) > 1000
    assert np.allclose([p for _, _, p in open_], priors)


def test_gradients_are_those_of_the_loss():
    """By differences, over more windows than are summed at a time, some of them with places behind the end of a text."""
    rng, size = np.random.default_rng(8), 30
    net = lm.AttentionModel(size)
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    ids = rng.integers(0, size - 5, (lm.PART + 9, lm.WINDOW))
    want = np.where(rng.random(ids.size) < 0.2, -1, rng.integers(0, lm.CLASSES, ids.size))

    def loss():
        scores, whole = net.class_scores(net.hidden(ids)[-1].reshape(-1, lm.WIDTH))
        return float((whole - scores[np.arange(want.size), want])[want >= 0].mean())

    found, met = net.gradients(ids, want)
    assert met.tolist() == list(range(size - 5))
    for name, value in net.p.items():
        for _ in range(8):
            at = tuple(rng.integers(0, n - 5 * (name == "E" and i == 0)) for i, n in enumerate(value.shape))
            own = value[at]
            value[at] = own + 1e-4
            up = loss()
            value[at] = own - 1e-4
            down = loss()
            value[at] = own
            assert abs((up - down) / 2e-4 - found[name][at]) < 1e-6, name


def test_sums_of_pairs_are_those_of_plain_loops():
    rng, size = np.random.default_rng(9), 40
    sums, want = lm.CellSums(size), Counter()
    for _ in range(3):
        words = [rng.integers(0, size, n).tolist() for n in rng.integers(0, 6, 200)]
        often = rng.integers(0, 4, 200)
        sums.add(np.array(sum(words, []), np.uint32), np.append(0, np.cumsum([len(w) for w in words])), often)
        for word, n in zip(words, often.tolist()):
            for before, i in zip([None, *word], word):
                want[i if before is None else size + before * size + i] += n
    found = pa.Table.from_batches(sums.given())
    assert dict(zip(found.column("cell").to_pylist(), found.column("tf").to_pylist())) == {k: n for k, n in want.items() if n}
    assert not list(sums.given())


def test_marks_behind_words():
    words = pa.array(["a", "wörd.", "x!?", "", "yes"])
    assert behind(words[1:], np.array([5, 1, 0, 3])).to_pylist() == [b".", b"!?", b"", b""]
    assert behind(pa.array([], pa.string()), np.zeros(0, np.int64)).to_pylist() == []
