"""Quality scores by multiple-instance learning with gated attention.

A document is a bag of passages of :data:`PASSAGE` words. Each passage is encoded from its characters and its repeated
words; a gated attention net, learned from the labels of whole documents, gives the weight of each passage, and a
logistic layer scores the weighted sum. So a label is never copied to passages, and a long document is judged by the
passages that matter.

The model is fitted on the driver to about :data:`FIT_DOCS` labelled rows of at most :data:`FIT_BYTES` bytes each, chosen
by the hash of their key; scoring reads every text whole, in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cobasket.llm.common import about, blocks, crc_mod, id_and_text, record_batch

PASSAGE = 64  # words
FIT_DOCS = 3000
FIT_BYTES = 200_000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
HIDDEN, ATTENTION, STEPS, RATE = 24, 12, 400, 0.02
BLOCK = 1 << 20

_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_KINDS = len(_PUNCTUATION) + 6
FEATURES = _KINDS + 5


def _kinds() -> np.ndarray:
    """The kind of each byte: white space, letters in two cases, digits, bytes beyond ASCII, each mark, the rest."""
    kinds = np.full(256, 5)
    kinds[list(b" \t\n\r\x0b\x0c")] = 0
    kinds[list(range(65, 91))], kinds[list(range(97, 123))], kinds[list(range(48, 58))] = 1, 2, 3
    kinds[128:] = 4
    kinds[list(_PUNCTUATION)] = 6 + np.arange(len(_PUNCTUATION))
    return kinds


KINDS = _kinds()


def passages(text: bytes, size: int = PASSAGE) -> np.ndarray:
    """A row of features for each passage: shares of the kinds of bytes, repeated words, word length, lines. A text
    without words is one passage of zeros."""
    words = text.split()
    if not words:
        return np.zeros((1, FEATURES), np.float32)
    n = -(-len(words) // size)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.arange(len(words)) // size
    size_of = np.bincount(owner, weights=lengths, minlength=n)
    letters = np.frombuffer(b"".join(words), np.uint8)
    of = np.repeat(np.arange(n), size_of.astype(np.int64))
    shares = np.bincount(of * _KINDS + KINDS[letters], minlength=n * _KINDS).reshape(n, _KINDS) / size_of[:, None]
    count = np.bincount(owner, minlength=n)
    distinct = np.array([len(set(words[i:i + size])) for i in range(0, len(words), size)])
    same = np.fromiter(map(bytes.__eq__, words[1:], words), bool, len(words) - 1)
    more = np.stack([distinct / count, np.bincount(owner[1:], weights=same, minlength=n) / count,
                     size_of / count / 10, count / size, np.full(n, min(1.0, text.count(b"\n") / len(words) * 8))])
    return np.concatenate([np.sqrt(shares), more.T], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class GatedAttention:
    """score = sigmoid(w . sum_i a_i h_i + c), h = tanh(x W), a = softmax over a bag of u . (tanh(h V) * sigmoid(h U))."""

    def __init__(self, features: int, seed: int = 7):
        rng = np.random.default_rng(seed)

        def init(a: int, b: int) -> np.ndarray:
            return rng.normal(0, a ** -0.5, (a, b))

        self.p = {"W": init(features, HIDDEN), "b": np.zeros(HIDDEN), "V": init(HIDDEN, ATTENTION),
                  "U": init(HIDDEN, ATTENTION), "u": init(ATTENTION, 1)[:, 0], "w": init(HIDDEN, 1)[:, 0],
                  "c": np.zeros(1)}
        self.mean, self.scale = np.zeros(features), np.ones(features)

    def _forward(self, x: np.ndarray, starts: np.ndarray) -> tuple:
        p, sizes = self.p, np.diff(np.append(starts, len(x)))
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["u"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        return h, t, s, a, z, sizes, _sigmoid(z @ p["w"] + p["c"])

    def score(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores of bags: rows of ``x`` from each start to the next, rounded past what the order of sums may change."""
        return np.round(self._forward((x - self.mean) / self.scale, starts)[-1], 10)

    def gradients(self, x: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss, by parameter; ``x`` is scaled already."""
        p = self.p
        h, t, s, a, z, sizes, y = self._forward(x, starts)
        dz = (y - labels)[:, None] / len(labels)
        g = {"w": z.T @ dz[:, 0], "c": dz.sum(axis=0)}
        dz = np.repeat(dz * p["w"], sizes, axis=0)
        da = (dz * h).sum(axis=1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
        dt, ds = de[:, None] * p["u"] * s * (1 - t * t), de[:, None] * p["u"] * t * s * (1 - s)
        g |= {"u": (t * s).T @ de, "V": h.T @ dt, "U": h.T @ ds}
        dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
        return g | {"W": x.T @ dh, "b": dh.sum(axis=0)}

    def fit(self, x: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> GatedAttention:
        """Full-batch Adam on the log loss with a small penalty."""
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 0.05
        x, p = (x - self.mean) / self.scale, self.p
        first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        for step in range(1, STEPS + 1):
            g = self.gradients(x, starts, labels)
            for k, v in p.items():
                grad = g[k] + 1e-4 * v
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                v -= RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", fit_docs: int = FIT_DOCS, fit_bytes: int = FIT_BYTES) -> GatedAttention | None:
    """A model from rows outside the held-out fold; None without any labelled row of each kind."""
    key = F.col(id_col)
    chosen = (labels.filter(F.col(label_col).isNotNull() & key.isNotNull() & (crc_mod(id_col, FOLDS) != HELD_OUT))
              .select(key.cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).distinct())
    chosen = about(chosen, fit_docs, chosen.count())
    rows = id_and_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("long")) \
        .filter(F.octet_length("text") <= fit_bytes)
    schema = pa.schema([("label", pa.int32()), ("features", pa.binary())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield record_batch(schema, batch.column("label"),
                               [passages(t.as_py() or b"").tobytes() for t in batch.column("text")])

    found = rows.join(F.broadcast(chosen), "id").select("id", "label", "text")  # about fit_docs rows of two numbers
    bags = found.select("label", "text").mapInArrow(mapped, "label int, features binary").collect()
    bags.sort(key=lambda row: (row[0], bytes(row[1])))  # the same model whatever order the rows came in
    y = np.array([row[0] for row in bags], float)
    if not len(y) or y.min() == y.max():
        return None
    x = [np.frombuffer(row[1], np.float32).reshape(-1, FEATURES) for row in bags]
    starts = np.concatenate([[0], np.cumsum([len(b) for b in x])[:-1]])
    return GatedAttention(FEATURES).fit(np.concatenate(x).astype(float), starts, y)


def _scored(model: GatedAttention, texts: list[bytes]) -> np.ndarray:
    bags = [passages(t) for t in texts]
    return model.score(np.concatenate(bags), np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]]))


SCORES = pa.schema([("id", pa.int64()), ("score", pa.float64())])


def scores(docs: DataFrame, model: GatedAttention | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score of every row; 0.5 without a model. Null and empty texts are one empty passage; repeated rows give
    repeated results; an empty table none. Other columns are not read."""
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in blocks(batches, BLOCK):
            if model is None:
                yield record_batch(SCORES, keys, [0.5] * len(keys))
                continue
            yield record_batch(SCORES, keys, _scored(model, texts))

    rows = id_and_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(mapped, "id long, score double").withColumnRenamed("id", id_col)


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **columns: str) -> DataFrame:
    """id, held_out, score, predicted of every row: learned from ``labels`` outside the held-out fold."""
    id_col = columns.get("id_col", "doc_id")
    found = scores(docs, fit(docs, labels, **columns), **{k: v for k, v in columns.items() if k != "label_col"})
    return found.select(id_col, (crc_mod(id_col, FOLDS) == HELD_OUT).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't rejected, with all columns. Each row is judged by its own text, where it is read,
    whatever its id. Without a model, from no label or labels of one kind outside the held-out fold, nothing is
    rejected."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    if model is None:
        return docs
    at = docs.columns.index(text_col)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.record_batch([pa.array(range(batch.num_rows)), batch.column(at).cast(pa.binary())],
                                   names=["id", "text"])
            kept = [scored >= threshold for _, texts in blocks(iter([rows]), BLOCK) for scored in _scored(model, texts)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(mapped, docs.schema)
