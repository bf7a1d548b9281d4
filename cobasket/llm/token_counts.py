"""Token counts from a compiled tokenizer, without building the tokens.

A sentencepiece model of merges is compiled into a deterministic transducer (``transducer.py``) whose transitions
carry the change of the token count. Text is cut into chunks at any character; a chunk in which no word starts is joined
to the one before it, so a stretch without blanks is one chunk however long it is. A chunk acts on the state before it as
a map: up to its first place where a word starts, the map depends on that state (the chunk's head); from there on it is
constant, as no token spans the start of a word. All constant parts run side by side, one symbol of each chunk at a
time; a parallel prefix scan then composes the maps of a text's chunks and gives the count at the end of each. Symbols of
a constant part run once, those of a head, which is shorter than a chunk but for a text's first, once for each step of
the scan; that first head is resolved before the scan. Where few stretches are left that are longer than the others, they
run number by number.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cobasket.llm.common import BLOCK_BYTES, blocks, id_and_text, record_batch
from cobasket.llm.transducer import MergeAutomaton, Merges, Transducer

SPACE = 0x2581  # how the model writes a blank
CHUNK = 512  # characters


@lru_cache(maxsize=4)
def compile_model(model_file: str) -> Transducer:
    """The transducer of a sentencepiece merge model with byte fallback and identity normalisation."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    base, ranked = {}, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i):
            continue
        if any(a != chr(SPACE) and b == chr(SPACE) for a, b in zip(piece, piece[1:])):
            raise ValueError("a piece spans the start of a word")
        if len(piece) == 1:
            base[ord(piece)] = i
        else:
            ranked.append((tuple(map(ord, piece)), i, -model.get_score(i)))
    return Transducer(MergeAutomaton(Merges.from_ranks(base, ranked)), unknown=lambda c: len(chr(c).encode()))


class ChunkMaps:
    """The maps of consecutive chunks: where the head is, whether a word starts inside, and if so, the state and the
    count that the rest leads to. Arrays, one entry a chunk. Composition is associative."""

    def __init__(self, transducer: Transducer, text: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                 syncs: np.ndarray):
        self.transducer, self.text = transducer, text
        at = np.searchsorted(syncs, starts)
        first = np.append(syncs, len(text))[at]
        self.head, self.body = starts, np.minimum(first, ends)
        self.synced = self.body < ends
        self.state, self.count = transducer.run(text, self.body, ends - self.body)

    def after(self, rows: np.ndarray, state: np.ndarray, count: np.ndarray, synced: np.ndarray, head: np.ndarray,
              body: np.ndarray) -> None:
        """Compose each of ``rows`` with a map before it; that one's values are given."""
        run = rows[synced]
        end, more = self.transducer.run(self.text, self.head[run], self.body[run] - self.head[run], state[synced])
        self.state[run] = np.where(self.synced[run], self.state[run], end)
        self.count[run] += count[synced] + more
        self.synced[run] = True
        self.head[rows] = head
        self.body[run] = body[synced]  # where the one before is all head, the two heads make one

    def scan(self, strand: np.ndarray, carried: np.ndarray) -> None:
        """Inclusive prefix composition within each strand. ``carried`` is the state before its first chunk."""
        first = np.searchsorted(strand, np.arange(len(carried)))
        start = self.head[first].copy()
        self.after(first, carried, np.zeros(len(first), np.int64), np.ones(len(first), bool), start, start)
        place = np.arange(len(strand)) - first[strand]
        distance = 1
        while len(place) and distance <= place.max():
            rows = np.flatnonzero(place >= distance)
            before = rows - distance
            self.after(rows, *(x[before] for x in (self.state, self.count, self.synced, self.head, self.body)))
            distance *= 2


def count_strands(transducer: Transducer, strands: list[np.ndarray], carried: np.ndarray, chunk: int = CHUNK):
    """End states and token counts of texts or parts of texts, as arrays of code points, none empty."""
    lengths = np.array([len(s) for s in strands])
    text = np.concatenate(strands)
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    sync = np.empty(len(text), bool)
    sync[0] = False
    sync[1:] = (text[1:] == SPACE) & (text[:-1] != SPACE)
    sync[begin] = False  # what stands before is in another strand
    starts = np.unique(np.concatenate([begin, np.arange(0, len(text), chunk)]))
    syncs = np.flatnonzero(sync)
    held = np.searchsorted(syncs, np.append(starts[1:], len(text))) > np.searchsorted(syncs, starts)
    starts = starts[held | np.isin(starts, begin)]  # a chunk without a word start goes on the one before
    maps = ChunkMaps(transducer, text, starts, np.append(starts[1:], len(text)), syncs)
    strand = np.searchsorted(begin, starts, side="right") - 1
    maps.scan(strand, carried)
    last = np.searchsorted(strand, np.arange(len(begin)), side="right") - 1
    return maps.state[last], maps.count[last]


def code_points(text: str, first: bool) -> np.ndarray:
    return np.frombuffer(((chr(SPACE) if first else "") + text.replace(" ", chr(SPACE))).encode("utf-32-le"), np.uint32)


def count_texts(transducer: Transducer, texts: list[bytes], limit: int = BLOCK_BYTES) -> list[int]:
    """Token counts of texts. Those longer than ``limit`` go through in parts, the state carried from part to part."""
    out = [0] * len(texts)
    whole = [i for i, text in enumerate(texts) if 0 < len(text) <= limit]
    if whole:
        _, counts = count_strands(transducer, [code_points(texts[i].decode(), True) for i in whole],
                                  np.zeros(len(whole), np.int32))
        for i, n in zip(whole, counts.tolist()):
            out[i] = n
    for i, text in enumerate(texts):
        if len(text) > limit:
            state, at = np.zeros(1, np.int32), 0
            while at < len(text):
                end = min(at + limit, len(text))
                while end < len(text) and text[end] & 0xC0 == 0x80:  # not inside a character
                    end -= 1
                state, n = count_strands(transducer, [code_points(text[at:end].decode(), at == 0)], state)
                out[i] += int(n[0])
                at = end
    transducer.trim()
    return out


COUNTED = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def count_tokens(docs: DataFrame, model_file: str, over: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit, as the model's library counts without added special tokens.

    One pass, no shuffle: a chunk's map is a few numbers, composed in the task that reads the text. Null and empty
    texts have no tokens; a repeated row gives a repeated result; an empty table gives none; other columns are not
    read. A text of any length is held once, and its working arrays a part at a time. The key must be an integer.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = compile_model(model_file)
        for keys, texts in blocks(batches):
            yield record_batch(COUNTED, keys, [len(t) for t in texts], count_texts(transducer, texts))

    rows = id_and_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return (rows.mapInArrow(counted, "id long, n_bytes long, n_tokens long")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > over).alias("over_limit")))
