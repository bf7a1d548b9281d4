"""Encoding and decoding with a merge automaton compiled from a tokenizer file.

The merges of a word tokenizer (words end in ``</w>``) become an automaton by one gadget each (``transducer.py``); its
symbol automaton then encodes words by table lookups: forward over the bytes of many words side by side, noting the
last token of each prefix, and back from each word's end along the noted tokens. Decoding emits the labels of the arcs
that the ids name. Texts are split into words as the tokenizer file says. A word's ids don't depend on its
neighbours, so a task encodes each distinct word about once.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from cobasket.llm.common import blocks, id_and_text, record_batch
from cobasket.llm.transducer import MergeAutomaton, Merges, Transducer

TOGETHER = 16_384  # new pieces encoded at a time
MEMO = 250_000  # pieces in a generation of what a worker remembers
CELLS = 1 << 20  # (words x bytes) encoded side by side
LATIN_END = "\u0250"
FINAL = 256  # added to the symbol of a word's last byte

# The patterns by which this kind of tokenizer file splits text into words.
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
WORD_PATTERN = ENDINGS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_PATTERN = ENDINGS + r"|[a-z]+|[0-9]|[^\sa-z0-9]+"


def byte_letters() -> list[str]:
    """How vocabulary files write the 256 bytes: printable Latin-1 as itself, the others from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        patterns = [p.get("pattern", {}).get("Regex") for p in spec["pre_tokenizer"]["pretokenizers"]]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if patterns != [WORD_PATTERN, None] or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
            raise ValueError("the file asks for another way of splitting, normalising or decoding")
        vocab = model["vocab"]
        letters = byte_letters()
        base = {b: vocab[c] for b, c in enumerate(letters)}
        base |= {FINAL + b: vocab[c + suffix] for b, c in enumerate(letters)}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = Merges.from_list(base, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        self.transducer = Transducer(MergeAutomaton(self.merges))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels: dict[int, bytes] = {i: t.encode() for t, i in vocab.items()}
        self.labels |= {i: t.encode() for t, i in self.special.items()}
        self.sizes = np.zeros(max(self.labels) + 1, np.int32)
        for token, symbols in self.merges.spell.items():
            self.sizes[token] = len(symbols)
        self._specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._words = regex.compile(WORD_PATTERN)
        self._ascii_words = re.compile(ASCII_PATTERN.encode())
        from tokenizers import Tokenizer  # the file's own normaliser and splitter, for text beyond ASCII

        library = Tokenizer.from_file(path)
        self._normalizer, self._splitter = library.normalizer, library.pre_tokenizer
        self._bytes = {c: b for b, c in enumerate(letters)}

    def split(self, piece: bytes) -> list[bytes | int]:
        """Words of a piece of text, normalised; a special token comes as its id."""
        if piece.isascii() and b"<|" not in piece:
            return self._ascii_words.findall(piece.lower())
        out: list[bytes | int] = []
        text = piece.decode()
        for part in self._specials.split(text) if self._specials else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                part = self._normalizer.normalize_str(part)
                if max(part, default="") < LATIN_END:
                    out += [w.encode() for w in self._words.findall(part)]
                else:  # what counts as a letter there depends on the library's version of Unicode
                    out += [bytes(map(self._bytes.__getitem__, w)) for w, _ in self._splitter.pre_tokenize_str(part)]
        return out

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, which must not be empty, as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        first = 0
        while first < len(order):
            last = first + 1  # a group's matrix is as wide as its longest word
            while last < len(order) and (last - first + 1) * len(words[order[last]]) <= CELLS:
                last += 1
            group = order[first:last]
            for i, ids in zip(group, self._encode_group([words[i] for i in group])):
                out[i] = ids
            first = last
        self.transducer.trim()
        return out

    def _encode_group(self, words: list[bytes]) -> Iterator[bytes]:
        symbols = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        lengths = np.array([len(w) for w in words])
        ends = np.cumsum(lengths)
        symbols[ends - 1] += FINAL
        noted = np.empty((int(lengths.max()), len(words)), np.int32)

        def note(i: int, which: np.ndarray, last: np.ndarray) -> None:
            noted[i, which] = last

        _, counts = self.transducer.run(symbols, ends - lengths, lengths, each=note)
        stops = np.cumsum(counts)
        ids = np.empty(int(stops[-1]), "<u4")
        at, left, which = stops - 1, lengths.copy(), np.arange(len(words))
        while len(which):  # one token of every word at a time, from the end
            tokens = noted[left[which] - 1, which]
            ids[at[which]] = tokens
            at[which] -= 1
            left[which] -= self.sizes[tokens]
            which = which[left[which] > 0]
        flat, begin = ids.tobytes(), 0
        for stop in (4 * stops).tolist():
            yield flat[begin:stop]
            begin = stop

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of distinct pieces of text, each without ASCII white space."""
        split = [self.split(p) for p in pieces]
        words = list({w for part in split for w in part if isinstance(w, bytes)})
        ids: dict[bytes | int, bytes] = dict(zip(words, self.encode_words(words)))
        ids |= {i: np.array([i], "<u4").tobytes() for i in self.special.values()}
        return [b"".join([ids[w] for w in part]) for part in split]

    def decode(self, ids: np.ndarray) -> bytes:
        """The labels of the ids, joined by blanks as the library does for a file without a decoder."""
        return b" ".join(map(self.labels.__getitem__, ids.tolist()))


class Memo:
    """Encodes texts piece by piece between ASCII white space, which no token spans, and remembers pieces in two
    generations of ``limit`` each: when the younger is full, the older is forgotten, but for what was used since.

    Pieces that differ in the case of ASCII letters share an entry, and the ASCII marks that end a word have one of
    their own: the tokenizer lowers case, and parts marks from an ASCII or Latin-1 letter or a digit before them.
    """

    # The marks that end a word; a first mark comes first in the pattern, so that a search skips to one.
    _MARK = rb"[!-/:-@\[-`{-~]"
    MARK = re.compile(_MARK + rb"(?:(?<=[a-z0-9].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))" + _MARK + rb"*(?=\s|\Z)")

    MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
    LETTER = re.compile(rb"(?:[a-z0-9]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])\Z")
    LAST_LETTER = "[a-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]\\z"  # the same for Arrow

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], limit: int = MEMO):
        self.encode, self.limit = encode, limit
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def split(self, text: bytes) -> list[bytes]:
        if b"<|" in text:  # special tokens have a case, and marks
            return text.split()
        return self.MARK.sub(rb" \g<0>", text.lower()).split()

    def parts(self, piece: bytes) -> tuple[bytes, ...]:
        """What a piece's ids are put together from: its letters and its marks at the end, or itself."""
        stem = piece.rstrip(self.MARKS)
        if len(stem) == len(piece) or not self.LETTER.search(stem) or b"<|" in piece:
            return (piece,)
        return stem, piece[len(stem):]

    def learn(self, split: list[list[bytes]]) -> None:
        """Make the ids of all these pieces known. A new piece that still has its marks is put together."""
        need = set().union(*split)
        if len(self.known) > self.limit:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        made, new = [], set()
        for piece in need - known.keys():
            ids = older.get(piece)
            if ids is not None:
                known[piece] = ids
                continue
            parts = self.parts(piece)
            if len(parts) > 1:
                made.append((piece, *parts))
            for part in parts:
                if part not in known:
                    ids = older.get(part)
                    if ids is None:
                        new.add(part)
                    else:
                        known[part] = ids
        rows = sorted(new)
        for at in range(0, len(rows), TOGETHER):
            batch = rows[at:at + TOGETHER]
            known.update(zip(batch, self.encode(batch)))
        for piece, stem, marks in made:
            known[piece] = known[stem] + known[marks]

    def encode_texts(self, texts: list[bytes]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        self.learn(split)
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]

    def whole(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pieces, each one encoded as it is."""
        if len(self.known) > self.limit:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        found = list(map(known.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for piece in [pieces[i] for i in missing]:
            ids = older.get(piece)
            if ids is None:
                new.append(piece)
            else:
                known[piece] = ids
        for at in range(0, len(new), TOGETHER):
            batch = new[at:at + TOGETHER]
            known.update(zip(batch, self.encode(batch)))
        for i in missing:
            found[i] = known[pieces[i]]
        return found

    def table(self, words: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words (string) and ``end`` behind them, laid end to end, and where those of each begin. The
        marks that end a word are looked up by themselves, as in :meth:`parts`."""
        stems = pc.ascii_rtrim(words, characters=self.MARKS.decode())
        parted = pc.and_(pc.and_not(pc.less(pc.binary_length(stems), pc.binary_length(words)), pc.match_substring(words, "<|")),
                         pc.match_substring_regex(stems, self.LAST_LETTER))
        marks = behind(words.filter(parted), pc.binary_length(stems.filter(parted)).to_numpy()).dictionary_encode()
        stems, parted = pc.if_else(parted, stems, words).dictionary_encode(), parted.to_numpy(zero_copy_only=False)
        pieces = [*stems.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False), *marks.dictionary.to_pylist()]
        ids = [*self.whole(pieces), np.array([end], "<u4").tobytes()]  # marks may be pieces of their own, too
        begin = np.arange(len(words)) + np.cumsum(parted) - parted
        codes = np.full(len(words) + len(marks) + 1, len(ids) - 1)
        codes[begin] = stems.indices.to_numpy()
        codes[begin[parted] + 1] = marks.indices.to_numpy() + len(stems.dictionary)
        starts = np.append(0, np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))) // 4
        flat, stops = taken(np.frombuffer(b"".join(ids), "<u4"), starts, codes)
        return flat, np.concatenate([stops[begin], stops[-2:]])


def behind(words: pa.Array, skipped: np.ndarray) -> pa.Array:
    """What words (string) hold behind their first ``skipped`` bytes."""
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64) \
        if len(words) else np.zeros(1, np.int64)
    sizes = np.diff(offsets) - skipped
    starts = np.append(0, np.cumsum(sizes))
    places = np.repeat(offsets[:-1] + skipped - starts[:-1], sizes) + np.arange(starts[-1])
    found = np.frombuffer(data, np.uint8).take(places) if len(places) else np.zeros(0, np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(found)])


def taken(ids: np.ndarray, starts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the entries of a table that ``codes`` names, end to end, and where those of each begin and the last end."""
    entries = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(starts * 4)), pa.py_buffer(np.ascontiguousarray(ids))])
    _, offsets, data = entries.take(pa.array(codes)).buffers()
    stops = np.frombuffer(offsets, np.int64, len(codes) + 1) // 4
    return np.frombuffer(data, "<u4", stops[-1]) if stops[-1] else np.zeros(0, "<u4"), stops


def laid_out(ids: np.ndarray, starts: np.ndarray, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts, end to end, and how many each has: those of its words, ``sizes`` of them, whose entries in the table
    ``codes`` names, and those of the table's last entry."""
    ends = np.cumsum(sizes + 1)
    places = np.full(len(codes) + len(sizes), len(starts) - 2)
    inner = np.ones(len(places), bool)
    inner[ends - 1] = False
    places[inner] = codes
    flat, stops = taken(ids, starts, places)
    return flat, np.diff(stops[np.append(0, ends)])


@lru_cache(maxsize=2)
def compile_codec(path: str) -> tuple[Codec, Memo]:
    codec = Codec(path)
    return codec, Memo(codec.encode_pieces)


ENCODED = pa.schema([("id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])
DIGESTS = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string())])


def _encoded(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes], list[bytes]]]:
    codec, memo = compile_codec(path)
    for keys, texts in blocks(batches):
        ids = memo.encode_texts(texts)
        yield keys, ids, [codec.decode(np.frombuffer(i, "<u4")) for i in ids]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids (array<int>), decoded (string), as the library encodes without adding special tokens, and
    decodes without skipping any.

    One pass, no shuffle. Null and empty texts give no ids and an empty string; a repeated row gives a repeated
    result; an empty table gives none; other columns are not read. Working memory is a few times the longest text.
    """
    schema = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, decoded in _encoded(path, batches):
            yield record_batch(schema, keys, [np.frombuffer(i, "<i4") for i in ids], [d.decode() for d in decoded])

    rows = id_and_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(mapped, "id long, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`encode` with digests in place of ids and text: id, n_tokens, ids_sha256, decoded_sha256.

    The ids are digested as little-endian unsigned 32-bit integers. The same cases hold; the digests are taken in the
    task, so neither ids nor text leave it.
    """
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, decoded in _encoded(path, batches):
            yield record_batch(DIGESTS, keys, [len(i) // 4 for i in ids],
                               [hashlib.sha256(i).hexdigest() for i in ids],
                               [hashlib.sha256(d).hexdigest() for d in decoded])

    rows = id_and_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return (rows.mapInArrow(mapped, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
            .withColumnRenamed("id", id_col))
