"""The trained models number by number, in plain loops."""

import math
import random

import numpy as np
import public_tokenizers
import sentencepiece

from cobasket.llm import attention_lm as lm, quality, token_counts, toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")


# ---- quality

def bags(rng, n=7, features=9):
    sizes = [rng.randrange(1, 6) for _ in range(n)]
    x = np.random.default_rng(rng.randrange(1000)).normal(size=(sum(sizes), features))
    return x, np.cumsum([0, *sizes[:-1]]), sizes


def loop_score(net, rows):
    p, hidden, weights = net.p, [], []
    for row in rows:
        h = [math.tanh(sum(row[i] * p["W"][i, j] for i in range(len(row))) + p["b"][j]) for j in range(quality.HIDDEN)]
        gate = 0.0
        for k in range(quality.ATTENTION):
            t = math.tanh(sum(h[j] * p["V"][j, k] for j in range(quality.HIDDEN)))
            s = 1 / (1 + math.exp(-sum(h[j] * p["U"][j, k] for j in range(quality.HIDDEN))))
            gate += p["u"][k] * t * s
        hidden.append(h)
        weights.append(math.exp(gate))
    z = [sum(a * h[j] for a, h in zip(weights, hidden)) / sum(weights) for j in range(quality.HIDDEN)]
    return 1 / (1 + math.exp(-sum(z[j] * p["w"][j] for j in range(quality.HIDDEN)) - p["c"][0]))


def test_gated_attention_in_loops_and_its_gradients():
    rng = random.Random(4)
    x, starts, sizes = bags(rng)
    net = quality.GatedAttention(x.shape[1])
    net.p["c"][:] = 0.3
    want = [loop_score(net, x[s:s + n]) for s, n in zip(starts, sizes)]
    assert np.allclose(net.score(x, starts), want, atol=1e-9)
    labels = np.array([rng.randrange(2) for _ in sizes], float)

    def loss():
        y = net._forward(x, starts)[-1]
        return -np.mean(labels * np.log(y) + (1 - labels) * np.log(1 - y))

    for name, found in net.gradients(x, starts, labels).items():
        value = net.p[name]
        for _ in range(6):
            at = tuple(rng.randrange(n) for n in value.shape)
            before = value[at]
            value[at] = before + 1e-5
            up = loss()
            value[at] = before - 1e-5
            down = loss()
            value[at] = before
            assert abs((up - down) / 2e-5 - found[at]) < 1e-6, name


# ---- language model

def loop_logs(model, ids, first):
    """The natural logarithm of each id, its window's attention in loops."""
    net, n, d = model.net, len(ids), lm.WIDTH
    before = [model.end, *ids[:-1]]
    p = {k: v.astype(float) for k, v in net.p.items()}
    start, stop, scored = lm.windows(np.array([n]))
    out = []
    for t in range(n):
        w = max(i for i in range(len(start)) if start[i] + scored[i] <= t and (t < start[i] + lm.WINDOW))
        place = t - start[w]
        x = [p["E"][before[start[w] + i]] + p["P"][i] for i in range(place + 1)]
        q, keys, values = x[-1] @ p["A"][:, :d], [v @ p["A"][:, d:2 * d] for v in x], [v @ p["A"][:, 2 * d:] for v in x]
        weights = [math.exp(float(q @ k) * d ** -0.5) for k in keys]
        state = x[-1] + sum(a * v for a, v in zip(weights, values)) / sum(weights) @ p["O"]
        scores = state @ p["C"] + p["b"]
        own = model.classes[ids[t]]
        shares = model.shares
        share = float(shares.by_class[lm.CLASSES if first[t] else model.classes[before[t]], ids[t]])
        if not first[t]:
            pair = before[t] * shares.size + ids[t]
            count = dict(zip(shares.keys.tolist(), shares.counts.tolist())).get(pair, 0)
            total = float(shares.totals[before[t] * lm.CLASSES + own])
            share = (count + lm.PAIR_PRIOR * share) / (total + lm.PAIR_PRIOR)
        out.append(scores[own] - math.log(sum(map(math.exp, scores))) + math.log(share))
    return out


def test_a_text_is_scored_id_by_id():
    rng, size = np.random.default_rng(2), 60
    classes = rng.integers(0, lm.CLASSES, size)
    cells = rng.integers(0, 50, (lm.CLASSES + 1, size)).astype(float)
    keys = np.sort(rng.choice(size * size, 300, replace=False))
    model = lm.LanguageModel(lm.AttentionModel(size), classes, lm.Shares(cells, keys, rng.integers(1, 9, 300), classes), size - 1)
    texts, firsts = [], []
    for n in (1, 2, 15, 16, 17, 28, 29, 40, 70):
        ids = rng.integers(0, size, n).astype(np.int32)
        first = rng.random(n) < 0.4
        first[0] = True
        texts.append(ids)
        firsts.append(first)
    found, _ = model.log10(texts, firsts)
    for ids, first, score in zip(texts, firsts, found):
        want = sum(loop_logs(model, ids.tolist(), first.tolist())) / math.log(10)
        assert abs(score - want) < 1e-3 + 1e-5 * abs(want)


# ---- toxicity

def all_paths(channel, token):
    """Every way of reading a token: cost and word."""
    def go(i, a, b, last, cost, word):
        if i == len(token):
            yield cost + channel.cost[a, b, 0], word
            return
        char = token[i]
        plain = "a" <= char <= "z"
        for letter in (char if plain else "") + toxicity.LOOKS.get(char, ""):
            c = ord(letter) - 96
            more = channel.cost[a, b, c] + (0 if letter == char else toxicity.LOOK_COST)
            yield from go(i + 1, b, c, char, cost + more, word + letter)
        if char == last and char not in toxicity.SEPARATORS:
            yield from go(i + 1, a, b, char, cost + toxicity.REPEAT_COST / 3, word)
        if char in toxicity.SEPARATORS:
            yield from go(i + 1, a, b, last, cost + toxicity.SKIP_COST, word)
        elif not plain:
            yield from go(i + 1, b, 0, char, cost + toxicity.FOREIGN_COST, word + char)

    return list(go(0, 0, 0, "", 0.0, ""))


def test_restoring_is_the_cheapest_of_all_paths():
    rng = random.Random(6)
    words = ["idiot", "stupid", "moron", "the", "quick", "brown", "trash", "ass"]
    channel = toxicity.Channel(toxicity.letter_trigrams([w.encode() for w in words] * 30))
    for _ in range(400):
        word = rng.choice(words)
        token = "".join(rng.choice([c, c, c, c + c, c + rng.choice(".-1!"), {"i": "1", "o": "0", "s": "$", "t": "7"}.get(c, c), "é"])
                        for c in word)[:9]
        paths = all_paths(channel, token)
        least = min(cost for cost, _ in paths)
        assert channel.restore(token) in {w for cost, w in paths if cost <= least + 1e-9}
    assert channel.restore("") == ""


def test_long_tokens_take_time_in_proportion():
    rng = random.Random(1)
    channel = toxicity.Channel(toxicity.letter_trigrams([b"some", b"words"] * 20))
    token = "".join(rng.choice("abcdefghij0123456789+/") for _ in range(300_000))
    assert 200_000 < len(channel.restore(token)) <= 300_000
    transducer = token_counts.compile_model(PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [token, "a" * 200_000, "words and " + token[:100_000] + " more words", "é" * 50_000 + " " + token[:30_000], "x"]
    assert token_counts.count_texts(transducer, [t.encode() for t in texts]) == [len(library.encode(t)) for t in texts]
    assert token_counts.count_texts(transducer, [token.encode()], limit=40_000) == [len(library.encode(token))]


def test_short_and_spaced_words_are_evidence():
    assert toxicity.stems("ass") == {"ass$"} and toxicity.stems("a") == set() and "assh" in toxicity.stems("asshole")
    words = ["the", "cat", "sat", "mud", "mudd"] * 30
    channel = toxicity.Channel(toxicity.letter_trigrams([w.encode() for w in words]))
    model = toxicity.Model(channel, {"mud$": 5.0}, np.array([-3.0, 2.0, 0.0, 0.0]))
    clean, plain, hidden, run = (model.score(t) for t in (b"the cat sat muddy", b"the mud sat", b"the cat m.u.d", b"the cat m u d sat"))
    assert clean < 0.5 < min(plain, hidden, run)
