"""Toxicity of texts restored through a noisy channel.

Writers hide words by look-alike characters, by blanks or marks between letters, and by repeating letters. A token that
shows such signs becomes a lattice: at each character, the letters that it may stand for, or nothing. Viterbi decoding
under a character trigram model, learned from the words of all training documents, finds the likeliest plain word. The
restored words are then looked up among word stems that labelled documents show to be toxic, and a logistic layer turns
a document's strongest evidence into a score.

Trigram counts are summed by Spark over all training texts (27 letters, so a table of fixed size). Stems are learned
from about :data:`FIT_DOCS` labelled rows. A word that is parted by single blanks into longer pieces isn't looked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cobasket.llm.common import about, blocks, crc_mod, id_and_text, record_batch

FIT_DOCS = 20_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5
MIN_TOXIC = 4  # toxic documents that a stem must be in
STEM = (4, 12)  # letters of a stem
MEMO = 300_000
LETTERS = 27  # a-z, and the edge of a word

# What a character may stand for besides itself.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e"}
SEPARATORS = set(" .-_*~'`,/\\|+:;")

# Costs of the channel, in natural logarithms.
LOOK_COST, SKIP_COST, REPEAT_COST, FOREIGN_COST = 1.0, 0.7, 1.5, 12.0

_LOOK_MARKS = "@$!|+(€"
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "€«»„“”’…¿¡"
_EDGE_MARKS = "".join(c for c in _MARKS if c not in _LOOK_MARKS)
_REPEAT = re.compile(r"(.)\1\1")
_ODD = re.compile(r"[a-z][^a-z\u0080-￿]+[a-z]|[0-9@$!|+(€][a-z]|[a-z][0-9@$!€]")
_SPACED = re.compile(r"(?:(?<=\s)|^)(?:[^\s] +){2,}[^\s](?=\s|$)")


def letter_trigrams(words: list[bytes]) -> np.ndarray:
    """Counts of letter trigrams, word edges included; other characters part words."""
    flat = np.frombuffer(b" " + b" ".join(words).lower() + b" ", np.uint8).astype(np.int32)
    code = np.where((flat >= 97) & (flat <= 122), flat - 96, 0)
    double = np.concatenate([[0], code])  # an edge counts before the first letter as well
    tri = (double[:-2] * LETTERS + double[1:-1]) * LETTERS + double[2:]
    return np.bincount(tri[(double[1:-1] > 0) | (double[2:] > 0)], minlength=LETTERS ** 3)


class Channel:
    """Restores tokens under letter trigram counts."""

    def __init__(self, counts: np.ndarray):
        table = counts.reshape(LETTERS, LETTERS, LETTERS).astype(float)
        pairs, ones = table.sum(axis=0), table.sum(axis=(0, 1))
        one = (ones + 1) / (ones + 1).sum()
        two = (pairs + 5 * one) / (pairs.sum(axis=1, keepdims=True) + 5)
        three = (table + 5 * two) / (table.sum(axis=2, keepdims=True) + 5)
        self.cost = -np.log(three)

    def restore(self, token: str) -> str:
        """The likeliest plain word. A letter beyond a-z stands for itself, at a price; nothing else is dropped free.
        Paths share their beginnings as links back, so a token of any length takes time in proportion."""
        best: dict[tuple, tuple[float, tuple | None]] = {(0, 0, ""): (0.0, None)}
        for char in token:  # keys: two letters before, last source character; values: cost, (letter, link back)
            step: dict[tuple, tuple[float, tuple | None]] = {}

            def offer(key: tuple, cost: float, path: tuple | None, letter: str = "") -> None:
                if key not in step or cost < step[key][0]:
                    step[key] = cost, (letter, path) if letter else path

            plain = "a" <= char <= "z"
            for (a, b, last), (cost, path) in best.items():
                for letter in (char if plain else "") + LOOKS.get(char, ""):
                    c = ord(letter) - 96
                    offer((b, c, char), cost + self.cost[a, b, c] + (0 if letter == char else LOOK_COST), path, letter)
                if char == last and char not in SEPARATORS:
                    offer((a, b, char), cost + REPEAT_COST / 3, path)
                if char in SEPARATORS:
                    offer((a, b, last), cost + SKIP_COST, path)
                if not plain and char not in SEPARATORS:
                    offer((b, 0, char), cost + FOREIGN_COST, path, char)
            best = step
        if not best:
            return ""
        path = min(((cost + self.cost[a, b, 0], path) for (a, b, _), (cost, path) in best.items()), key=lambda end: end[0])[1]
        letters = []
        while path is not None:
            letter, path = path
            letters.append(letter)
        return "".join(reversed(letters))


class Restorer:
    """Words of a text with hidden ones restored; remembers tokens."""

    def __init__(self, channel: Channel):
        self.channel, self.known = channel, {}

    def words(self, token: bytes) -> tuple[str, ...]:
        found = self.known.get(token)
        if found is None:
            text = token.decode().lower().strip(_EDGE_MARKS)
            plain = text.strip(_MARKS)
            if _REPEAT.search(plain) or not (plain == text and plain.isalpha()) and _ODD.search(text):
                restored = [self.channel.restore(t) for t in dict.fromkeys((text, plain))]
                found = tuple(dict.fromkeys(w for w in (plain, *restored) if w))
            else:
                found = (plain,) if plain else ()
            if len(self.known) > MEMO:
                self.known.clear()
            self.known[token] = found
        return found

    def spaced(self, text: str) -> list[str]:
        """What runs of single characters spell."""
        out = []
        for run in _SPACED.finditer(text):
            letters = run.group().lower().split()
            if len(set(letters)) > 1:
                for at in range(0, len(letters), 200):  # a run's parts overlap by more than a word
                    out.append(self.channel.restore("".join(letters[at:at + 240])))
        return out


def stems(word: str) -> set[str]:
    """The beginnings of a word, itself included; a word of two or three letters as a whole, with an end mark."""
    if len(word) < STEM[0]:
        return {f"{word}$"} if len(word) > 1 else set()
    return {word[:n] for n in range(STEM[0], min(len(word), STEM[1]) + 1)}


class Model:
    """Stems with their evidence, and the logistic layer."""

    def __init__(self, channel: Channel, evidence: dict[str, float], weights: np.ndarray):
        self.channel, self.evidence, self.weights = channel, evidence, weights
        self.heads = {stem[:STEM[0]] for stem in evidence}
        self._restorer: Restorer | None = None
        self._memo: dict[bytes, tuple[str, float] | None] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_restorer": None, "_memo": {}}

    def _best(self, words: Iterable[str]) -> tuple[str, float] | None:
        """The strongest stem that any of the words begins with."""
        hits = [(self.evidence[s], s) for word in words if len(word) < STEM[0] or word[:STEM[0]] in self.heads
                for s in stems(word) if s in self.evidence]
        return max(hits)[::-1] if hits else None

    def _of(self, token: bytes) -> tuple[str, float] | None:
        if token not in self._memo:
            if len(self._memo) > MEMO:
                self._memo.clear()
            self._memo[token] = self._best(self._restorer.words(token))
        return self._memo[token]

    def features(self, text: bytes) -> np.ndarray:
        """1, the strongest evidence, the sum of each stem's, and how much of the text it is."""
        if self._restorer is None:
            self._restorer = Restorer(self.channel)
        tokens = text.split()
        memo = self._memo
        hits = {}
        for token in set(tokens):
            hit = memo[token] if token in memo else self._of(token)
            if hit:
                hits[hit[0]] = hit[1]
        if len(tokens) > 3:
            for spelled in self._restorer.spaced(text.decode()):
                if hit := self._best(spelled[i:] for i in range(len(spelled))):
                    hits[hit[0]] = hit[1]
        return np.array([1.0, max(hits.values(), default=0.0), min(4.0, log(1 + sum(hits.values()))), min(5, len(hits)) / 5])

    def score(self, text: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ self.weights, -30, 30))))


def channel_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Letter trigrams of all training documents: a fixed number of sums."""
    schema = pa.schema([("at", pa.int32()), ("n", pa.int64())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(LETTERS ** 3, np.int64)
        for _, texts in blocks(batches):
            sums += letter_trigrams(texts)
        at = np.flatnonzero(sums)
        yield record_batch(schema, at.astype(np.int32), sums[at])

    rows = id_and_text(docs.filter(crc_mod(id_col, FOLDS) != HELD_OUT), id_col, text_col)
    out = np.zeros(LETTERS ** 3, np.int64)
    for at, n in rows.mapInArrow(mapped, "at int, n long").groupBy("at").agg(F.sum("n")).collect():
        out[at] = n
    return out


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        fit_docs: int = FIT_DOCS) -> Model:
    """A model from rows outside the held-out fold. Without labels of both kinds, every score is 0.5 or less."""
    channel = Channel(channel_counts(docs, id_col, text_col))
    key = F.col(id_col)
    chosen = (labels.filter(F.col(label_col).isNotNull() & key.isNotNull() & (crc_mod(id_col, FOLDS) != HELD_OUT))
              .select(key.cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).distinct())
    chosen = about(chosen, fit_docs, chosen.count())
    rows = id_and_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("long")) \
        .join(F.broadcast(chosen), "id")  # about fit_docs rows of two numbers
    schema = pa.schema([("stem", pa.string()), ("label", pa.int32()), ("n", pa.int64())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, counts = Restorer(channel), {}
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label").to_pylist()):
                raw = text.as_py() or b""
                found = set().union(*(stems(w) for t in set(raw.split()) for w in restorer.words(t)),
                                    *map(stems, restorer.spaced(raw.decode())))
                for stem in found:
                    counts[stem, label] = counts.get((stem, label), 0) + 1
            if len(counts) > 2 * MEMO:
                yield record_batch(schema, *zip(*((s, y, n) for (s, y), n in counts.items())))
                counts = {}
        if counts:
            yield record_batch(schema, *zip(*((s, y, n) for (s, y), n in counts.items())))

    sums = rows.select("text", "label").mapInArrow(mapped, "stem string, label int, n long").groupBy("stem").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("label") == 1, 0).otherwise(F.col("n"))).alias("clean"))
    n_toxic, n_clean = chosen.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") != 1)).first()
    odds = F.log((F.col("toxic") + 0.1) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    top = (sums.filter(F.col("toxic") >= MIN_TOXIC).withColumn("odds", odds).filter("odds > 2.5")
           .orderBy(F.desc("odds"), "stem").collect())  # of about fit_docs rows
    model = Model(channel, {row["stem"]: row["odds"] for row in top}, np.array([-3.0, 0.0, 0.0, 0.0]))
    if not n_toxic or not n_clean:
        return model
    points = pa.schema([("label", pa.int32()), ("features", pa.binary())])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield record_batch(points, batch.column("label"),
                               [model.features(t.as_py() or b"").tobytes() for t in batch.column("text")])

    found = rows.select("text", "label").mapInArrow(measured, "label int, features binary").collect()
    if not found:
        return model
    found.sort(key=lambda row: (row[0], bytes(row[1])))
    x, y = np.array([np.frombuffer(r[1]) for r in found]), np.array([r[0] for r in found], float)
    w = model.weights.copy()
    for _ in range(60):  # Newton's method with a small penalty and bounded steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, x.T @ (p - y) + 0.1 * w)
        w -= step / max(1.0, float(np.linalg.norm(step)))
    model.weights = w
    return model


SCORES = pa.schema([("id", pa.int64()), ("score", pa.float64())])


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score of every row. Null and empty texts show nothing and get the score of a clean text; repeated rows give
    repeated results; an empty table none. Other columns are not read."""
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in blocks(batches):
            yield record_batch(SCORES, keys, [model.score(t) for t in texts])

    rows = id_and_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(mapped, "id long, score double").withColumnRenamed("id", id_col)


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted of every row: learned from ``labels`` outside the held-out fold."""
    found = scores(docs, fit(docs, labels, id_col=id_col, text_col=text_col), id_col, text_col)
    return found.select(id_col, (crc_mod(id_col, FOLDS) == HELD_OUT).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))
