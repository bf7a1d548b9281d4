"""Scores of texts under a causal self-attention model on subword ids.

A text is the subword ids of its words and one end id. The model is one layer of causal self-attention, trained in
numpy, that predicts the class of the next id from the ids before; an id's probability is that of its class times its
share of the class, given the id before it inside its word. The shares come from the counts of all training words: by
classes of the id before in a table of fixed size, and by the id itself. Counts of all pairs of ids are stored; at most
:data:`PAIRS` frequent ones travel to the tasks, and the others that a text meets are added by a join. Texts are cut into
overlapping windows: each id is scored once, in the window that gives it at least ``WINDOW - STRIDE`` ids of context or all there are.

Everything is learned from all training documents, whatever their number and length. Classes come from the neighbours
of each id, counted by Spark. Attention weights are fitted in :data:`ROUNDS`: the tasks go through all windows of the
round's documents from the same weights, and Spark adds up their changes for the mean, so that only tables of the size of
the vocabulary reach the driver. Texts are turned into ids once and stored. The :data:`FREQUENT` most frequent words travel
to the tasks; the others are looked up by a join, once per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, log, log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from cobasket.llm.bpe_codec import laid_out
from cobasket.llm.common import coded_words, crc_mod, id_and_text, most_frequent, record_batch, slices, written
from cobasket.llm.token_files import library_memo

FOLDS, HELD_OUT = 10, 0
WINDOW, STRIDE = 16, 12
WIDTH, CLASSES = 16, 32
FIT_STEPS, BATCH = 700, 256  # steps in all at least: a smaller corpus is gone through again and again
ROUNDS = (1, 3, 4, 8)  # shares of the training documents of a larger one; each document is in one round
COMPANY = 300  # most frequent ids, as neighbours
BLOCK_IDS = 1 << 19
FREQUENT = 300_000
CELLS = 1 << 20  # sums that a task holds before it gives them out
COUNTED = 1 << 20  # words, distinct in their blocks, that a task holds before it gives out what it has
SCORED_IDS = 1 << 17  # ids that a task scores at a time
SCORED = 256  # windows at a time: their arrays stay in a core's cache
PART = 64  # of a batch's windows, for the same reason
PAIRS = 500_000
LIMIT = 60.0  # attention scores and class scores stay below, so exponentials need no shift
SMOOTH, PRIOR, PAIR_PRIOR = 0.1, 20.0, 10.0

COUNTS = pa.schema([("word", pa.binary()), ("n", pa.int64())])


def training(docs: DataFrame, id_col: str) -> DataFrame:
    """Rows without a key have the checksum null, and aren't training rows."""
    return docs.filter(crc_mod(id_col, FOLDS) != HELD_OUT)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word (bytes), n: over all training documents, counted in the tasks before anything is moved."""
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for rows in slices(batches, "text"):
            _, codes, words = coded_words(rows.column("text"))
            found.append((words.cast(pa.binary()), np.bincount(codes, minlength=len(words))))
            held += len(words)
            if held >= COUNTED:
                yield together(found)
                found, held = [], 0
        if found:
            yield together(found)

    def together(found: list[tuple[pa.Array, np.ndarray]]) -> pa.RecordBatch:
        words = pa.concat_arrays([w for w, _ in found]).dictionary_encode()
        n = np.bincount(words.indices.to_numpy(), np.concatenate([n for _, n in found]), len(words.dictionary))
        return record_batch(COUNTS, words.dictionary, n.astype(np.int64))

    rows = id_and_text(training(docs, id_col), id_col, text_col)
    return rows.mapInArrow(mapped, "word binary, n long").filter("n > 0").groupBy("word").agg(F.sum("n").alias("n"))


def id_blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_IDS) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Places and marked ids (id x 2 + whether it begins a word) of consecutive texts, about ``limit`` ids at a time."""
    library_memo.cache_clear()  # the words it holds aren't needed by tasks that have ids
    pa.default_memory_pool().release_unused()
    for rows in slices(batches, "ids", 4 * limit):
        _, offsets, data = rows.column("ids").buffers()
        ends = np.frombuffer(offsets, np.int32)[rows.column("ids").offset:][:rows.num_rows + 1]
        flat = np.frombuffer(data, "<u4", (ends[-1] - ends[0]) // 4, ends[0])
        yield rows.column("place").to_pylist(), np.split(flat, (ends[1:-1] - ends[0]) // 4)


def merged(keys: np.ndarray, n: np.ndarray, more: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of both in order, and the sums of their counts."""
    keys, n = np.concatenate([keys, more]), np.concatenate([n, often])
    order = np.argsort(keys)
    keys = keys.take(order)
    groups = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))[:len(keys)]
    return keys[groups], np.add.reduceat(n.take(order), groups) if len(groups) else n


def company_counts(texts: DataFrame, company: np.ndarray, size: int) -> DataFrame:
    """at, n: how often each id has each of the ids in ``company`` before and behind it in all of the texts. ``at`` is the
    id x 2 x the number of those, plus the place of the neighbour, those behind after those before."""
    schema = pa.schema([("at", pa.int64()), ("n", pa.int64())])
    many = len(company)
    kind = np.int32 if size * 2 * many < 1 << 31 else np.int64  # faster to sort, and smaller
    place = np.full(size, -1, kind)
    place[company] = np.arange(many)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = np.zeros(0, kind), np.zeros(0, np.int64)
        for _, marked in id_blocks(batches, 2 * BLOCK_IDS):
            ids = (np.concatenate(marked) >> 1).astype(kind)
            inner = np.ones(len(ids) - 1, bool)
            inner[np.cumsum([len(m) for m in marked])[:-1] - 1] = False
            left, right = ids[:-1][inner], ids[1:][inner]
            before, behind = place[left], place[right]
            cells = np.concatenate([(right * kind(2 * many) + before)[before >= 0],
                                    (left * kind(2 * many) + kind(many) + behind)[behind >= 0]])
            keys, n = merged(keys, n, *np.unique(cells, return_counts=True))
            if len(keys) >= CELLS:
                yield record_batch(schema, keys.astype(np.int64), n)
                keys, n = keys[:0], n[:0]
        yield record_batch(schema, keys.astype(np.int64), n)

    return texts.mapInArrow(mapped, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))


def classify(company: DataFrame, many: int, counts: np.ndarray, final: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """A class for each id: by the company they keep (k-means over :func:`company_counts`), those met less than four times
    in all training documents by whether they end a word. The table on the driver has a row for each known id, and its
    counts are fetched in parts."""
    known = np.flatnonzero(counts >= 4)
    row = np.full(len(counts), -1)
    row[known] = np.arange(len(known))
    table = np.zeros((len(known), 2 * many + 1), np.float32)
    for part in range(8):
        found = company.filter(F.col("at") % 8 == part).toArrow()
        own, column = np.divmod(found.column("at").to_numpy(), max(1, 2 * many))
        ok = row[own] >= 0
        table[row[own[ok]], column[ok]] = found.column("n").to_numpy()[ok]
    np.sqrt(table, out=table)
    table /= np.sqrt(np.einsum("ij,ij->i", table, table))[:, None] + 1e-6
    table[:, -1] = 0.7 * final[known]
    k = classes - 2
    out = np.where(final, k, k + 1)
    if len(known) >= k:
        centres = table[np.random.default_rng(3).choice(len(known), k, replace=False)]
        for _ in range(12):
            nearest = (table @ centres.T - 0.5 * (centres ** 2).sum(axis=1)).argmax(axis=1)
            for c in range(k):
                if (nearest == c).any():
                    centres[c] = table[nearest == c].mean(axis=0)
        out[known] = nearest
    return out


class AttentionModel:
    """One attention layer over the ids before, and a softmax over classes of the next."""

    def __init__(self, size: int, classes: int = CLASSES, width: int = WIDTH, window: int = WINDOW, seed: int = 5):
        rng = np.random.default_rng(seed)
        init = lambda *shape: (rng.normal(0, width ** -0.5, shape)).astype(np.float32)
        self.window, self.width = window, width
        self.p = {"E": init(size, width), "P": 0.1 * init(window, width), "A": init(width, 3 * width),
                  "O": 0.3 * init(width, width), "C": init(width, classes), "b": np.zeros(classes, np.float32)}
        self.mask = np.tril(np.ones((window, window), np.float32))

    def through(self) -> np.ndarray:
        """From an embedding to its query, which holds the scale of the scores, key, and value behind the output matrix."""
        p, d = self.p, self.width
        return np.concatenate([p["A"][:, :d] * np.float32(d ** -0.5), p["A"][:, d:2 * d], p["A"][:, 2 * d:] @ p["O"]], axis=1)

    def hidden(self, ids: np.ndarray, through: np.ndarray | None = None) -> tuple:
        """``ids`` (windows x window) to states; what comes after a position never reaches it."""
        p, d, through = self.p, self.width, self.through() if through is None else through
        x = p["E"].take(ids, axis=0)
        x += p["P"]
        qkv = (x.reshape(-1, d) @ through).reshape(*ids.shape, 3 * d)
        a = np.matmul(qkv[:, :, :d], qkv[:, :, d:2 * d].transpose(0, 2, 1))
        self._weights(a, self.mask)
        a /= self._row_sums(a)
        h = np.matmul(a, qkv[:, :, 2 * d:])
        h += x
        return x, qkv, a, h

    @staticmethod
    def _weights(s: np.ndarray, mask: np.ndarray) -> None:
        """Scores to weights that don't add up to one yet."""
        np.clip(s, -LIMIT, LIMIT, out=s)
        np.exp(s, out=s)
        s *= mask

    @staticmethod
    def _row_sums(s: np.ndarray) -> np.ndarray:
        return (s.reshape(-1, s.shape[-1]) @ np.ones(s.shape[-1], np.float32)).reshape(*s.shape[:-1], 1)

    def class_scores(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the classes and the logarithm of the sum of their exponentials."""
        out = self._scores(states)
        return out, np.log(self._row_sums(np.exp(out))[:, 0])

    def _scores(self, states: np.ndarray) -> np.ndarray:
        out = states @ self.p["C"]
        out += self.p["b"]
        return np.clip(out, -LIMIT, LIMIT, out=out)

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """What an id and a place add to query, key, value (through the output matrix) and state, side by side."""
        through = np.concatenate([self.through(), np.eye(self.width, dtype=np.float32)], axis=1)
        return self.p["E"] @ through, self.p["P"] @ through

    def states(self, ids: np.ndarray, table: tuple[np.ndarray, np.ndarray], begin: int = 0) -> np.ndarray:
        """The states of :meth:`hidden` from place ``begin`` on, with what :meth:`table` holds computed already."""
        d = self.width
        row = table[0].take(ids, axis=0)
        row += table[1]
        s = np.matmul(row[:, begin:, :d], row[:, :, d:2 * d].transpose(0, 2, 1))
        self._weights(s, self.mask[begin:])
        out = np.matmul(s, row[:, :, 2 * d:3 * d])
        out /= self._row_sums(s)
        out += row[:, begin:, 3 * d:]
        return out

    def fit(self, inputs: np.ndarray, targets: np.ndarray, steps: int = FIT_STEPS, rate: float = 0.01) -> None:
        """Adam on the log loss, through all windows again and again; targets of -1 don't count."""
        adam, taken = Adam(self), 0
        while taken < steps:
            for rows in shuffled(len(inputs), adam.rng)[:steps - taken]:
                taken += 1
                adam.step(inputs[rows], targets[rows].ravel(), rate * min(1.0, 2 * (1 - taken / (steps + 1))))

    def gradients(self, ids: np.ndarray, want: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """The gradient of the mean log loss by parameter, that of the embeddings for the ids that are returned alone. Summed
        over :data:`PART` windows at a time, whose arrays stay in a core's cache."""
        want, share = want.reshape(ids.shape), np.float32(1 / max(1, np.count_nonzero(want >= 0)))
        dx, g, d, through = np.empty((*ids.shape, self.width), np.float32), {}, self.width, self.through()
        for at in range(0, len(ids), PART):
            for name, part in self._sums(ids[at:at + PART], want[at:at + PART].ravel(), share, through, dx[at:at + PART]):
                g[name] = g[name] + part if at else part
        dq, dk, dv = (g["A"][:, i * d:(i + 1) * d] for i in range(3))
        g["O"] = self.p["A"][:, 2 * d:].T @ dv
        g["A"] = np.concatenate([dq * np.float32(d ** -0.5), dk, dv @ self.p["O"].T], axis=1)
        g["P"] = dx.sum(axis=0)
        order = np.argsort(ids.astype(np.uint16) if len(self.p["E"]) <= 1 << 16 else ids, axis=None, kind="stable")
        own = ids.ravel().take(order)
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        g["E"] = np.add.reduceat(dx.reshape(-1, d).take(order, axis=0), starts)
        return g, own[starts]

    def _sums(self, ids: np.ndarray, want: np.ndarray, share: np.float32, through: np.ndarray, out: np.ndarray) -> tuple:
        """What windows add to the gradients of C, b and ``through`` (as A), and that of their embeddings in ``out``."""
        d = self.width
        x, qkv, a, h = self.hidden(ids, through)
        q, k, v = (qkv[:, :, i * d:(i + 1) * d] for i in range(3))
        flat, rows = h.reshape(-1, d), np.flatnonzero(want >= 0)
        y = self._scores(flat)
        np.exp(y, out=y)
        factor = share / self._row_sums(y)
        if len(rows) < len(want):
            factor[want < 0] = 0
        y *= factor
        y.reshape(-1)[rows * y.shape[1] + want[rows]] -= share
        dx = y @ self.p["C"].T
        dh = dx.reshape(x.shape)
        da = np.matmul(dh, v.transpose(0, 2, 1))
        da *= a
        da -= a * self._row_sums(da)
        dqkv = np.empty_like(qkv)
        np.matmul(da, k, out=dqkv[:, :, :d])
        np.matmul(da.transpose(0, 2, 1), q, out=dqkv[:, :, d:2 * d])
        np.matmul(a.transpose(0, 2, 1), dh, out=dqkv[:, :, 2 * d:])
        dqkv = dqkv.reshape(-1, 3 * d)
        np.add(dh, (dqkv @ through.T).reshape(x.shape), out=out)
        return ("C", flat.T @ y), ("b", np.ones(len(y), np.float32) @ y), ("A", x.reshape(-1, d).T @ dqkv)

    def packed(self) -> np.ndarray:
        """All parameters as rows of ``width`` numbers, the embeddings first."""
        return np.concatenate([self.p[k].reshape(-1, self.width) for k in ("E", "P", "A", "O", "C", "b")])

    def unpack(self, rows: np.ndarray) -> None:
        at = 0
        for k in ("E", "P", "A", "O", "C", "b"):
            n = self.p[k].size // self.width
            self.p[k] = rows[at:at + n].reshape(self.p[k].shape).astype(np.float32)
            at += n


def shuffled(n: int, rng: np.random.Generator) -> list[np.ndarray]:
    """All of ``n`` places in batches, in random order."""
    return np.array_split(rng.permutation(n), range(BATCH, n, BATCH))


class Adam:
    """Steps of a model. Embeddings that a batch doesn't meet rest."""

    def __init__(self, net: AttentionModel):
        self.net, self.rng, self.taken = net, np.random.default_rng(11), 0
        self.others = [k for k in net.p if k != "E"]  # small: in one piece
        self.ends = np.cumsum([net.p[k].size for k in self.others])
        self.embeddings = np.zeros((len(net.p["E"]), 2 * net.width), np.float32)  # both means side by side
        self.rest = np.zeros(2 * self.ends[-1], np.float32)

    def step(self, ids: np.ndarray, want: np.ndarray, pace: float) -> None:
        self.taken += 1
        p, (g, met) = self.net.p, self.net.gradients(ids, want)
        means = self.embeddings.take(met, axis=0)
        p["E"][met] -= self.change(means, g["E"], pace)
        self.embeddings[met] = means
        parts = self.change(self.rest, np.concatenate([g[k].ravel() for k in self.others]), pace)
        for k, part in zip(self.others, np.split(parts, self.ends[:-1])):
            p[k] -= part.reshape(p[k].shape)

    def change(self, means: np.ndarray, g: np.ndarray, pace: float) -> np.ndarray:
        """Moves the means of gradients and of their squares, the halves of the last axis; what to take off the values."""
        half = g.shape[-1]
        first, second = means[..., :half], means[..., half:]
        first += 0.1 * (g - first)
        g *= g
        g -= second
        g *= 0.002
        second += g
        np.multiply(second, 1 / (1 - 0.998 ** self.taken), out=g)
        np.sqrt(g, out=g)
        g += 1e-8
        return np.divide((pace / (1 - 0.9 ** self.taken)) * first, g, out=g)


def windows(lengths: np.ndarray, window: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sequences laid end to end: the start of each window, the end of its sequence, and from which place in it on
    its ids are scored. Together the windows score every id once."""
    per = np.maximum(1, -(-(lengths - window) // stride) + 1)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(lengths)), per)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    return (ends - lengths)[owner] + number * stride, ends[owner], np.where(number > 0, window - stride, 0)


class LanguageModel:
    """The attention model, the classes, and the shares of ids in their classes."""

    def __init__(self, net: AttentionModel, classes: np.ndarray, shares: Shares, end: int):
        self.net, self.classes, self.shares, self.end = net, classes, shares, end
        self.table: tuple[np.ndarray, np.ndarray] | None = None  # made by the task that scores

    def log10(self, sequences: list[np.ndarray], firsts: list[np.ndarray]) -> tuple[np.ndarray, tuple]:
        """log10 probability of each sequence of ids, the last of which is the end id, with no count for pairs that
        aren't listed; and those that may have one: sequence, pair, how often, what the count is added to."""
        lengths = np.array([len(s) for s in sequences])
        ids = np.concatenate(sequences)
        before = shifted(ids, lengths, self.end)
        logs, (at, pairs, priors) = self.shares.log_and_rest(ids, before, np.concatenate(firsts))
        owners = np.searchsorted(np.cumsum(lengths), at, side="right")
        cells, where, times = np.unique(owners * self.shares.size ** 2 + pairs, return_index=True, return_counts=True)
        if self.table is None:
            self.table = self.net.table()
        own = self.classes.take(ids)
        start, stop, scored = windows(lengths)
        inside = start + WINDOW <= stop
        for begin in (0, WINDOW - STRIDE):
            for whole in (True, False):  # windows that go beyond the end of a text apart
                of = np.flatnonzero((scored == begin) & (inside == whole))
                for at in range(0, len(of), SCORED):
                    index = start[of[at:at + SCORED], None] + np.arange(WINDOW)
                    h = self.net.states(before.take(index, mode="clip"), self.table, begin)
                    rows, h = index[:, begin:].ravel(), h.reshape(-1, h.shape[-1])
                    if not whole:
                        ok = (index[:, begin:] < stop[of[at:at + SCORED], None]).ravel()
                        rows, h = rows[ok], h[ok]
                    out, sums = self.net.class_scores(h)
                    logs[rows] += out.ravel().take(np.arange(len(rows)) * out.shape[1] + own.take(rows)) - sums
        return np.add.reduceat(logs, np.cumsum(lengths) - lengths) / log(10), (owners[where], pairs[where], times,
                                                                               priors[where])


class Shares:
    """The share of an id in its class: by the class of the id before it in the word (last row: none before), refined
    by counts of pairs of ids. ``keys`` are the pairs (before x size + id) in order. Without ``totals``, the counts of all
    pairs by id before and class, pairs that aren't listed count as none on both sides, so shares always add up to one;
    with them, shares add up to one when the counts of the rest are added."""

    def __init__(self, cells: np.ndarray, keys: np.ndarray, counts: np.ndarray, classes: np.ndarray,
                 totals: np.ndarray | None = None):
        self.size, self.classes, self.keys = cells.shape[1], classes, keys
        self.counts = counts.astype(np.float32)
        whole = self._normal(cells.sum(axis=0) + SMOOTH)
        self.by_class = np.stack([self._normal(row + PRIOR * whole) for row in cells]).astype(np.float32)
        before, ids = np.divmod(keys, self.size)
        self.known: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        self.complete = totals is None
        self.totals = totals.astype(np.float32) if totals is not None else np.bincount(before * CLASSES + classes[ids], weights=counts, minlength=self.size * CLASSES) \
            .astype(np.float32)

    def _normal(self, values: np.ndarray) -> np.ndarray:
        return values / np.bincount(self.classes, weights=values, minlength=CLASSES)[self.classes]

    def log(self, ids: np.ndarray, before: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.log_and_rest(ids, before, first)[0]

    def log_and_rest(self, ids: np.ndarray, before: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Logarithms of the shares, and the pairs that aren't listed but may have a count: place, pair, and what the
        count is added to."""
        if self.known is None:
            self.known = self._known()
        first_logs, pair_logs, keys = self.known
        out = first_logs.take(ids)
        rest = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        at = np.flatnonzero(~first)
        if not len(at):
            return out, rest
        key = before.take(at).astype(keys.dtype)
        key *= keys.dtype.type(self.size)
        key += ids.take(at).astype(keys.dtype)
        order = np.argsort(key)  # texts repeat pairs: each one is looked up once
        key = key.take(order)
        begin = np.append(True, key[1:] != key[:-1])
        distinct, number = key[begin], np.cumsum(begin) - 1
        found = np.searchsorted(keys, distinct)
        listed = keys.take(found, mode="clip") == distinct if len(keys) else np.zeros(len(distinct), bool)
        logs = pair_logs.take(found, mode="clip") if len(keys) else np.zeros(len(distinct))
        others = np.flatnonzero(~listed)
        if len(others):
            pairs = distinct[others].astype(np.int64)
            prior, own = np.divmod(pairs, self.size)
            share, totals = self._share(own, prior)
            logs[others] = np.log(PAIR_PRIOR * share / (totals + PAIR_PRIOR))
            if not self.complete:
                priors = np.full(len(distinct), -1.0)
                priors[others[totals > 0]] = PAIR_PRIOR * share[totals > 0]
                open_ = np.flatnonzero(priors.take(number) >= 0)
                open_ = open_[np.argsort(order[open_])]
                rest = at[order[open_]], key[open_].astype(np.int64), priors[number[open_]]
        out[at[order]] = logs.take(number)
        return out, rest

    def _share(self, ids: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shares by class, and how often the id before has any of the class behind it."""
        return (self.by_class[self.classes[before], ids].astype(np.float64),
                self.totals[before * CLASSES + self.classes[ids]])

    def _known(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By id at the beginning of a word and by listed pair: the logarithm of the share; and the pairs, as small as they
        can be. Made by the task that scores."""
        kind = np.uint32 if self.size ** 2 <= 1 << 32 else np.int64  # faster to search
        before, ids = np.divmod(self.keys, self.size)
        share, totals = self._share(ids, before)
        return (np.log(self.by_class[CLASSES].astype(np.float64)),
                np.log((self.counts + PAIR_PRIOR * share) / (totals + PAIR_PRIOR)), self.keys.astype(kind))


def sequence(words: list[bytes], known: dict[bytes, bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a text and which of them begin a word."""
    parts = [known[w] for w in words]
    ids = np.frombuffer(b"".join(parts) + np.array([end], "<u4").tobytes(), "<u4").astype(np.int32)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    first = np.zeros(len(ids), bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    first[-1] = True
    return ids, first


def marked_words(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A table of words' ids as ids x 2 + whether they begin a word; some words have no ids."""
    out = ids * np.uint32(2)
    out[starts[:-1][np.diff(starts) > 0]] += 1
    return out, starts


def vocabulary(tokenizer: str) -> tuple[int, np.ndarray]:
    """The number of ids, and which of them end a word."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer)
    final = np.zeros(library.get_vocab_size(), np.float32)
    for token, i in library.get_vocab().items():
        final[i] = token.endswith("</w>")
    return len(final), final


def fit(texts: DataFrame, sums: DataFrame, n_docs: int, tokenizer: str) -> tuple[LanguageModel, DataFrame]:
    """The model from the ids of all training documents (place, ids) and the sums of :class:`CellSums` over their words, and
    the counts of all pairs of ids."""
    size, final = vocabulary(tokenizer)
    end = size - 1
    firsts, whole = (by_number(rows, size) for rows in (
        sums.filter(F.col("cell") < size), sums.groupBy((F.col("cell") % size).alias("cell")).agg(F.sum("n").alias("n"))))
    firsts[end] += n_docs
    whole[end] += n_docs
    company = np.argsort(-whole, kind="stable")[:COMPANY]
    classes = classify(written(company_counts(texts, company, size), "company"), len(company), whole, final)
    net = AttentionModel(size)
    fit_rounds(net, texts, classes, end, int(whole.sum()))
    shares, pairs = count_shares(sums, firsts, classes, size)
    return LanguageModel(net, classes, shares, end), pairs


def by_number(rows: DataFrame, size: int) -> np.ndarray:
    """The second column at the places that the first one gives."""
    table, out = rows.toArrow(), np.zeros(size)
    out[table.column(0).to_numpy()] = table.column(1).to_numpy()
    return out


def fit_rounds(net: AttentionModel, texts: DataFrame, classes: np.ndarray, end: int, n_ids: int,
               rate: float = 0.01) -> None:
    """Fit the net to all windows of all texts (place, ids). In a round each task goes on from the same weights, through
    all of its windows; the weights move by the mean of the tasks' changes, that of an embedding weighed by how often the
    task met the id. A task gives out the rows it changed, and what reaches the driver has the size of the weights. Less
    text than the least number of steps takes, some ten megabytes, is one round in one task, again and again."""
    names = [f"d{i}" for i in range(net.width)]
    schema = pa.schema([("key", pa.int64()), ("weight", pa.float64()), *((n, pa.float64()) for n in names)])
    again = max(1, ceil(FIT_STEPS * BATCH * WINDOW / max(1, n_ids)))
    rounds, steps = (ROUNDS, 0) if again == 1 else ((1,), again * ceil(n_ids / (BATCH * WINDOW)))
    limit = BLOCK_IDS if again == 1 else n_ids
    slot, done = F.pmod(F.xxhash64("place"), F.lit(sum(rounds))), 0
    for number, share in enumerate(rounds):
        given = texts.sparkSession.sparkContext.broadcast((net, classes))
        pace = rate * (1 - number / len(rounds))

        def mapped(batches: Iterator[pa.RecordBatch], given=given, pace=pace) -> Iterator[pa.RecordBatch]:
            start_net, of = given.value
            own = AttentionModel(len(of))
            base = start_net.packed()
            own.unpack(base.copy())
            adam, met = Adam(own), np.zeros(len(of))
            for _, marked in id_blocks(batches, limit):
                inputs, targets = examples(marked, of, end)
                met += np.bincount(inputs[targets >= 0], minlength=len(of))
                for _ in range(again):
                    for rows in shuffled(len(inputs), adam.rng):
                        slower = max(0.02, min(1.0, 2 * (1 - adam.taken / (steps + 1)))) if steps else 1.0
                        adam.step(inputs.take(rows, axis=0), targets.take(rows, axis=0).ravel(), pace * slower)
            weight = np.concatenate([met, np.full(len(base) - len(met), met.sum())])
            keys = np.flatnonzero(weight)
            change = (own.packed()[keys].astype(float) - base[keys]) * weight[keys, None]
            yield record_batch(schema, keys, weight[keys], *change.T)

        rows = texts.filter((slot >= done) & (slot < done + share))
        sums = (rows.coalesce(1) if again > 1 else rows).mapInArrow(mapped, ", ".join(["key long", "weight double", *(f"{n} double" for n in names)])) \
            .groupBy("key").agg(F.sum("weight").alias("weight"), *(F.sum(n).alias(n) for n in names)).toArrow()
        whole = net.packed()
        change = np.stack([sums.column(n).to_numpy() for n in names], axis=1)
        whole[sums.column("key").to_numpy()] += change / sums.column("weight").to_numpy()[:, None]
        net.unpack(whole)
        given.unpersist()
        done += share


def examples(marked: list[np.ndarray], classes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the ids before, and the classes to predict; -1 behind the end of a text."""
    ids = (np.concatenate(marked) >> 1).astype(np.int64)
    lengths = np.array([len(m) for m in marked])
    before = shifted(ids, lengths, end)
    start, stop, _ = windows(lengths, WINDOW, WINDOW)
    index = start[:, None] + np.arange(WINDOW)
    targets = classes.take(ids).take(index, mode="clip")
    cut = np.flatnonzero(start + WINDOW > stop)  # these go beyond the end of a text
    behind = index[cut] >= stop[cut, None]
    targets[cut] = np.where(behind, -1, targets[cut])
    inputs = before.take(index, mode="clip")
    inputs[cut] = np.where(behind, before[0], inputs[cut])
    return inputs, targets


def shifted(ids: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    """The id before each one; the end id begins each text."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.cumsum(lengths) - lengths] = end
    return before


class CellSums:
    """cell, n: how often each id begins a word (cell: the id) and how often it follows another inside one (cell: ``size`` +
    the other x ``size`` + the id). Added up over the words that a task meets, given out when there are :data:`CELLS`."""

    def __init__(self, size: int):
        self.size, self.cells, self.n = size, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, starts: np.ndarray, n: np.ndarray) -> None:
        """Words, each one's ids between its start and the next, that occur ``n`` times."""
        begin, stop = starts[:-1], starts[1:]
        kind = np.uint32 if self.size * (self.size + 1) <= 1 << 32 else np.int64  # faster to sort
        flat = ids[:starts[-1]].astype(kind)
        cells = flat.copy()
        cells[1:] += (flat[:-1] + kind(1)) * kind(self.size)
        first = begin[stop > begin]
        cells[first] = flat[first]
        often = np.repeat(n, stop - begin)
        met = np.flatnonzero(often)
        self.cells, self.n = merged(self.cells.astype(kind), self.n, cells.take(met), often.take(met))

    def given(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.cells) >= least:
            yield part_batch(ENCODED, len(self.cells), cell=self.cells, tf=self.n)
            self.__init__(self.size)


def count_shares(sums: DataFrame, firsts: np.ndarray, classes: np.ndarray, size: int) -> tuple[Shares, DataFrame]:
    """The shares from the counts of :class:`CellSums`, and the counts of all pairs (pair, n). Some 2 x (classes + 1) x ids
    sums and :data:`PAIRS` pairs reach the driver."""
    pairs = sums.filter(F.col("cell") >= size).select((F.col("cell") - size).alias("pair"), "n")
    cells = np.concatenate([pair_sums(pairs, lambda before, ids: classes[before] * size + ids, size, CLASSES * size), firsts])
    table = most_frequent(pairs, PAIRS).toArrow()
    keys = table.column("pair").to_numpy()
    order = np.argsort(keys)
    totals = None if pairs.count() == len(keys) else \
        pair_sums(pairs, lambda before, ids: before * CLASSES + classes[ids], size, size * CLASSES)
    return Shares(cells.reshape(CLASSES + 1, size), keys[order], table.column("n").to_numpy()[order], classes, totals), pairs


def pair_sums(pairs: DataFrame, place: Callable[[np.ndarray, np.ndarray], np.ndarray], vocabulary: int, size: int) -> np.ndarray:
    """The counts of all pairs by a place that follows from the id before and the id: a table of fixed size."""
    schema = pa.schema([("at", pa.int64()), ("n", pa.int64())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield record_batch(schema, place(*np.divmod(batch.column("pair").to_numpy(), vocabulary)), batch.column("n"))

    return by_number(pairs.mapInArrow(mapped, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")), size)


ENCODED = pa.schema([("place", pa.int64()), ("id", pa.int64()), ("fold", pa.int64()), ("n_tokens", pa.int64()),
                     ("n_known", pa.int64()), ("base", pa.float64()), ("ids", pa.binary()), ("word", pa.binary()),
                     ("tf", pa.int64()), ("cell", pa.int64())])
PASSED = pa.schema([("place", pa.int64()), ("score", pa.float64()), ("pair", pa.int64()), ("tf", pa.int64()),
                    ("prior", pa.float64())])


def part_batch(schema: pa.Schema, n: int, **columns: list | np.ndarray | pa.Array) -> pa.RecordBatch:
    """``n`` rows of ``schema`` with nulls in the columns not given."""
    return pa.record_batch([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
                            for f in schema], schema=schema)


def scored(lm: LanguageModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """place, score of texts (place, ids), and place, pair, tf, prior of pairs that may have a count. Small blocks: a core's
    arrays take some ten megabytes."""
    for places, marked in id_blocks(batches, SCORED_IDS):
        found, (owners, pair, tf, prior) = lm.log10([(m >> 1).astype(np.int32) for m in marked],
                                                    [(m & 1).astype(bool) for m in marked])
        yield part_batch(PASSED, len(places), place=places, score=found)
        if len(owners):
            yield part_batch(PASSED, len(owners), place=np.array(places, np.int64)[owners], pair=pair, tf=tf, prior=prior)


def score(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``base_score`` is the smoothed unigram score of the words and the end, ``score`` that of the model. Null and empty
    texts are an end alone; a repeated row counts again in training and gives a repeated result; an empty table gives
    none, and without any training row every word is unknown. Rows without a key aren't in either fold: ``held_out`` is
    null. Other columns are not read.
    """
    counts = written(word_counts(docs, id_col, text_col), "word-counts")
    n_docs = training(docs, id_col).count()
    size = vocabulary(tokenizer)[0]
    end = size - 1  # the tokenizer's own end of text
    n_words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n, v = n_words + n_docs, distinct + (n_docs > 0)
    below = n + SMOOTH * (v + 1)
    top = most_frequent(counts, FREQUENT).toArrow()  # of some bytes each
    costs = np.log10((top.column("n").to_numpy() + SMOOTH) / below)
    frequent = docs.sparkSession.sparkContext.broadcast((top.column("word").combine_chunks(), np.append(costs, 0)))
    end_base = log10((n_docs + SMOOTH) / below)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (of, cost), memo, sums = frequent.value, library_memo(tokenizer), CellSums(size)
        for part in slices(batches, "text"):
            sizes, codes, words = coded_words(part.column("text"))
            ids, starts = memo.table(words, end)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            learned = pc.not_equal(part.column("fold"), HELD_OUT).fill_null(False).to_numpy(zero_copy_only=False)
            sums.add(ids, starts[:-1], np.bincount(codes[learned[owner]], minlength=len(words)))
            yield from sums.given(CELLS)
            ids, n_ids = laid_out(*marked_words(ids, starts), codes, sizes)
            words = words.cast(pa.binary())
            at, met = np.full(len(words), -1), pc.index_in(of, value_set=words).fill_null(-1).to_numpy()  # fewer words to hash
            at[met[met >= 0]] = np.flatnonzero(met >= 0)
            rare = (at < 0)[codes]
            base = end_base + np.bincount(owner, cost[at][codes], len(sizes))
            known = int(n_docs > 0) + np.bincount(owner[~rare], minlength=len(sizes))
            texts = pa.Array.from_buffers(pa.binary(), len(sizes), [
                None, pa.py_buffer(np.append(0, np.cumsum(4 * n_ids)).astype(np.int32)), pa.py_buffer(ids)])
            yield part_batch(ENCODED, len(sizes), place=part.column("place"), id=part.column("id"), fold=part.column("fold"),
                             n_tokens=sizes + 1, n_known=known, base=base, ids=texts)
            if rare.any():
                cells, tf = np.unique(owner[rare] * len(words) + codes[rare], return_counts=True)
                own, word = np.divmod(cells, len(words))
                yield part_batch(ENCODED, len(cells), place=part.column("place").take(pa.array(own)),
                                 word=words.take(pa.array(word)), tf=tf)
        yield from sums.given()

    rows = id_and_text(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("place"), F.col("id").cast("long").alias("id"), "text",
        crc_mod("id", FOLDS).cast("long").alias("fold"))
    stored = written(rows.mapInArrow(encoded, "place long, id long, fold long, n_tokens long, n_known long, base double, "
                                              "ids binary, word binary, tf long, cell long"), "encoded")
    texts = stored.filter("ids is not null")
    sums = written(stored.filter("cell is not null").groupBy("cell").agg(F.sum("tf").alias("n")), "id-counts")
    fitted, pairs = fit(texts.filter(F.col("fold") != HELD_OUT).select("place", "ids"), sums, n_docs, tokenizer)
    model = docs.sparkSession.sparkContext.broadcast(fitted)

    passed = written(texts.select("place", "ids").mapInArrow(
        lambda batches: scored(model.value, batches), "place long, score double, pair long, tf long, prior double"), "scored")
    whole = texts.select("place", "id", "n_tokens", "n_known", "base").unionByName(
        passed.filter("pair is null").select("place", "score"), allowMissingColumns=True)
    rare = stored.filter("word is not null").select("place", "word", "tf").join(counts, "word", "left").select(
        "place", F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("n_tokens"),
        F.when(F.col("n") > 0, F.col("tf")).otherwise(0).alias("n_known"),
        (F.col("tf") * F.log10((F.coalesce("n", F.lit(0)) + SMOOTH) / below)).alias("base"),
        F.lit(None).cast("double").alias("score"))
    if not fitted.shares.complete:
        more = passed.filter("pair is not null").join(pairs, "pair").select(
            "place", F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("n_tokens"),
            F.lit(0).alias("n_known"), F.lit(0.0).alias("base"),
            (F.col("tf") * F.log10(1 + F.col("n") / F.col("prior"))).alias("score"))
        rare = rare.unionByName(more)
    out = whole.unionByName(rare).groupBy("place").agg(
        F.max("id").alias("id"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("base").alias("base_score"), F.sum("score").alias("score"))
    return out.select(F.col("id").alias(id_col), (crc_mod("id", FOLDS) == HELD_OUT).alias("held_out"), "n_tokens",
                      "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
