"""Fill-in-the-middle transformation of texts, as a pipeline of Arrow kernels.

A text is cut into units: runs of ASCII letters, and single other characters. The units of a batch of texts are list
arrays over the texts' own bytes. They are flattened together with the index of the text that each is of; a unit's
ordinal in its text says whether it is of the prefix, the middle or the suffix; the units of a role are filtered, made
lists again and joined. The pieces of a text are then joined in the order of its form, element by element. Nothing is
done unit by unit in Python.

Where a text is cut, and which form it gets, follows from the SHA-256 digest of its key alone, so a task that runs again
gives the same. A text longer than :data:`SEGMENT` goes through the pipeline in segments that end between units; its
pieces are the joined pieces of its segments.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cobasket.llm.common import blocks

# What marks the pieces.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

RATE = 90  # percent of texts that are transformed
SPM_RATE = 20  # percent of those that put the suffix first
SEED = 1
SEGMENT = 1 << 20  # bytes that go through the pipeline at a time
TEXT = pa.large_string()

_NO_LETTER = re.compile(rb"[^A-Za-z]")


class Draws(NamedTuple):
    """Four unsigned numbers for each text."""

    first: np.ndarray
    second: np.ndarray
    form: np.ndarray
    order: np.ndarray


def draws(key: Column, seed: int = SEED) -> Column:
    """The first four groups of eight digits of the hexadecimal SHA-256 digest of ``seed:key``. A null key is empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Which bytes begin a unit. The first byte's answer holds if no letter comes before."""
    letter = ((data | 32) - np.uint8(97)) < 26
    starts = (data & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return starts


def unit_lists(texts: list[bytes]) -> pa.LargeListArray:
    """The units of each text, as lists over one buffer."""
    whole = b"".join(texts)
    ends = np.cumsum([0, *map(len, texts)])
    starts = unit_starts(np.frombuffer(whole, np.uint8))
    starts[ends[:-1][ends[:-1] < len(whole)]] = True
    at = np.flatnonzero(starts)
    offsets = np.append(at, len(whole)).astype(np.int64)
    units = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(whole))
    return pa.LargeListArray.from_arrays(pa.array(np.searchsorted(at, ends)), units)


def pieces(lists: pa.LargeListArray, base: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of each list of units. Its ordinals go on from ``base``; units from ``low`` on are the
    middle's, from ``high`` on the suffix's."""
    parents = pc.list_parent_indices(lists)
    first = pc.take(pc.subtract(pa.array(base), lists.offsets[:-1]), parents)
    ordinals = pc.add(pa.array(np.arange(len(parents))), first)
    units = pc.list_flatten(lists)
    before = pc.less(ordinals, pc.take(pa.array(low), parents))
    after = pc.greater_equal(ordinals, pc.take(pa.array(high), parents))
    out = []
    for role in (before, pc.invert(pc.or_(before, after)), after):
        chosen = pc.filter(parents, role)
        sizes = np.bincount(chosen.to_numpy(), minlength=len(lists))
        again = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes))), pc.filter(units, role))
        out.append(pc.binary_join(again, pa.scalar("", TEXT)))
    return out


def segments(text: bytes, size: int = SEGMENT) -> Iterator[bytes]:
    """The text in parts of about ``size`` bytes that end between units."""
    at = 0
    while at < len(text):
        end = min(at + size, len(text))
        if end < len(text):
            while end < len(text) and text[end] & 0xC0 == 0x80:
                end += 1
            if text[end - 1:end].isalpha() and text[end - 1] < 128:  # a run of letters may go on
                found = _NO_LETTER.search(text, end)
                end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def cut(texts: list[bytes], drawn: Draws, size: int = SEGMENT) -> tuple[np.ndarray, list[pa.Array]]:
    """How many units each text has, and its prefix, middle and suffix."""
    if sum(map(len, texts)) <= size or len(texts) > 1:
        lists = unit_lists(texts)
        n = pc.list_value_length(lists).to_numpy().astype(np.int64)
        low, high = cuts(n, drawn)
        return n, pieces(lists, np.zeros(len(n), np.int64), low, high)
    parts = list(segments(texts[0], size))  # one long text
    sizes = np.array([np.count_nonzero(unit_starts(np.frombuffer(p, np.uint8))) for p in parts])
    n = sizes.sum(keepdims=True)
    low, high = cuts(n, drawn)
    found = [pieces(unit_lists([p]), np.array([base]), low, high) for p, base in zip(parts, np.cumsum(sizes) - sizes)]
    whole = pa.array([0, len(parts)], pa.int64())
    return n, [pc.binary_join(pa.LargeListArray.from_arrays(whole, pa.concat_arrays(list(role))), pa.scalar("", TEXT))
               for role in zip(*found)]


def cuts(n: np.ndarray, drawn: Draws) -> tuple[np.ndarray, np.ndarray]:
    one, two = drawn.first % (n + 1), drawn.second % (n + 1)
    return np.minimum(one, two), np.maximum(one, two)


def marked(texts: pa.Array) -> pa.Array:
    found = [pc.match_substring(texts, mark) for mark in (PREFIX, SUFFIX, MIDDLE)]
    return pc.or_(pc.or_(found[0], found[1]), found[2])


def joined(form: pa.Array, texts: pa.Array, prefix: pa.Array, middle: pa.Array, suffix: pa.Array) -> pa.Array:
    """The output of each text."""
    psm = pc.equal(form, PSM)
    first, second = (pc.if_else(psm, a, b) for a, b in ((PREFIX, SUFFIX), (SUFFIX, PREFIX)))
    one, two = pc.if_else(psm, prefix, suffix), pc.if_else(psm, suffix, prefix)
    whole = pc.binary_join_element_wise(first.cast(TEXT), one, second.cast(TEXT), two, pa.scalar(MIDDLE, TEXT), middle,
                                        pa.scalar("", TEXT))
    return pc.if_else(pc.equal(form, PLAIN), texts, whole)


def rebuilt(form: pa.Array, outputs: pa.Array) -> pa.Array:
    """The text of each output. No piece holds a mark, so the first one found is the one that was put there."""
    order, found = [], []
    for kind, second in ((PLAIN, None), (PSM, SUFFIX), (SPM, PREFIX)):
        at = np.flatnonzero(pc.equal(form, kind).to_numpy(zero_copy_only=False))
        part = outputs.take(pa.array(at))
        order.append(at)
        if second is None:
            found.append(part)
            continue
        halves = pc.split_pattern(part, second, max_splits=1)
        rest = pc.split_pattern(pc.list_element(halves, 1), MIDDLE, max_splits=1) if len(at) else halves
        one, two, three = ((pc.list_element(halves, 0), pc.list_element(rest, 0), pc.list_element(rest, 1)) if len(at)
                           else [part] * 3)
        one = pc.replace_substring(one, PREFIX if kind == PSM else SUFFIX, "", max_replacements=1)
        before, after = (one, two) if kind == PSM else (two, one)
        found.append(pc.binary_join_element_wise(before, three, after, pa.scalar("", TEXT)))
    back = np.argsort(np.concatenate(order), kind="stable")
    return pa.concat_arrays(found).take(pa.array(back))


OUTPUT = "id long, n long, form string, prefix_chars long, middle_chars long, output string"


def transform(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED, id_col: str = "doc_id",
              text_col: str = "text", segment: int = SEGMENT) -> DataFrame:
    """Per row: id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain), output.

    One pass, no shuffle. Null and empty texts have no units and stay plain and empty, as does the text that holds a
    mark itself; a repeated row gives a repeated result, and so do rows that share an id, each cut by its own length; a
    row without an id draws as an empty key. An empty table gives none; other columns are not read. Working memory is a
    few times the longest text, and its units' arrays a segment at a time. The key must be an integer.
    """
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = 0
            for keys, raw in blocks(iter([batch]), segment):
                numbers = pc.list_flatten(batch.column("draws").slice(begin, len(keys))).to_numpy().reshape(-1, 4)
                begin += len(keys)
                drawn = Draws(*numbers.T)
                n, (prefix, middle, suffix) = cut(raw, drawn, segment)
                offsets = pa.py_buffer(np.cumsum([0, *map(len, raw)]).astype(np.int64))
                texts = pa.LargeStringArray.from_buffers(len(raw), offsets, pa.py_buffer(b"".join(raw)))
                stays = pc.or_(marked(texts), pa.array((n == 0) | (drawn.form % 100 >= rate)))
                form = pc.if_else(stays, PLAIN, pc.if_else(pa.array(drawn.order % 100 < spm_rate), SPM, PSM))
                sizes = [pc.if_else(stays, pa.scalar(None, pa.int64()), pc.utf8_length(p)) for p in (prefix, middle)]
                yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(n), form, *sizes,
                                       joined(form, texts, prefix, middle, suffix).cast(pa.string())],
                                      names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
                       .alias("text"), draws(F.col(id_col), seed).alias("draws"))
    return rows.mapInArrow(mapped, OUTPUT).withColumnRenamed("id", id_col)


def restore(outputs: DataFrame, name: str = "restored") -> DataFrame:
    """``outputs`` (with columns form and output) and the exact text that each was made of, as column ``name``. Null and
    other forms give null."""
    schema = StructType([*outputs.schema.fields, StructField(name, StringType())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            form, texts = batch.column("form"), batch.column("output").cast(TEXT)
            known = np.flatnonzero(pc.fill_null(pc.is_in(form, pa.array([PLAIN, PSM, SPM])), False)
                                   .to_numpy(zero_copy_only=False))
            found = rebuilt(form.take(pa.array(known)), texts.take(pa.array(known)))
            back = np.full(batch.num_rows, -1)
            back[known] = np.arange(len(known))
            at = pa.array(back, mask=back < 0)
            yield batch.append_column(name, found.take(at).cast(pa.string()))

    return outputs.mapInArrow(mapped, schema)
