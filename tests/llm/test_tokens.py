"""Token counts, the codec and token files against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cobasket.llm import bpe_codec, token_counts, token_files
from cobasket.llm.transducer import MergeAutomaton, Merges, Transducer
from cobasket.session import scratch_path
from .conftest import TEXTS

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


def random_texts(n, seed=1):
    rng = random.Random(seed)
    parts = ["the", "ing", " ", "  ", "a", "aa", "é", "ß", "漢", "🙂", "'s", "3", "%%", "\n", "\t", "▁", "<|endoftext|>", "ch",
             "tion", "ción", "Th", "x", "!?", "ó", "É", "×", "÷", ".,", "'", "'S", "_", "<|", "|>", "&&&", " ", "​", "Σ"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_merges_of_a_toy_vocabulary():
    """All strings up to seven symbols, by the automaton and by plain merging."""
    base = {0: 0, 1: 1}
    merges = Merges.from_list(base, [(0, 0, 2), (0, 1, 3), (2, 3, 4), (1, 1, 5), (3, 5, 6), (2, 2, 7), (4, 4, 8)])
    automaton = MergeAutomaton(merges)
    transducer = Transducer(automaton)
    for length in range(1, 8):
        for code in range(2 ** length):
            symbols = tuple(code >> i & 1 for i in range(length))
            parts = [base[s] for s in symbols]
            while ranked := [(merges.pairs[p][0], i) for i, p in enumerate(zip(parts, parts[1:])) if p in merges.pairs]:
                i = min(ranked)[1]
                parts[i:i + 2] = [merges.pairs[parts[i], parts[i + 1]][1]]
            _, count = transducer.run(np.array(symbols), np.array([0]), np.array([length]))
            assert count[0] == len(parts)
            assert all(automaton.follows(a, b) for a, b in zip(parts, parts[1:]))


def test_tables_are_emptied_when_full():
    merges = Merges.from_list({0: 0, 1: 1}, [(0, 1, 2), (2, 2, 3)])
    transducer = Transducer(MergeAutomaton(merges), max_transitions=1)
    for _ in range(3):
        _, count = transducer.run(np.array([0, 1, 0, 1, 0]), np.array([0]), np.array([5]))
        assert count[0] == 2
        transducer.trim()
        assert transducer.n == 0


@pytest.mark.parametrize("chunk", [3, 50, 512])
def test_counts_of_random_texts(pieces, chunk):
    texts = [t for t in random_texts(600) + [" " * 90 + "x", "a" * 500, "▁" * 40] if t]
    transducer = token_counts.compile_model(PIECES)
    _, found = token_counts.count_strands(transducer, [token_counts.code_points(t, True) for t in texts],
                                          np.zeros(len(texts), np.int32), chunk)
    assert found.tolist() == [len(x) for x in pieces.encode(texts)]


def test_long_texts_go_through_in_parts(pieces):
    texts = [t for t in TEXTS if t]
    found = token_counts.count_texts(token_counts.compile_model(PIECES), [t.encode() for t in texts], limit=100)
    assert found == [len(x) for x in pieces.encode(texts)]


def test_count_tokens(spark, docs, none, pieces):
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, PIECES, over=100).collect()}
    for i, text in enumerate(TEXTS):
        n = len(pieces.encode(text or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), n, n > 100)
    assert token_counts.count_tokens(none, PIECES).count() == 0
    assert token_counts.count_tokens(docs.unionByName(docs), PIECES).count() == 2 * len(TEXTS)


def test_codec_on_random_texts(words):
    texts = random_texts(1500, 2) + ["x" + chr(c) + "1" for c in range(1, 0x3000)]
    codec, _ = bpe_codec.compile_codec(WORDS)
    found = bpe_codec.Memo(codec.encode_pieces, 500).encode_texts([t.encode() for t in texts])
    for text, ids, want in zip(texts, found, words.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, text
        assert codec.decode(np.frombuffer(ids, "<u4")).decode() == words.decode(want.ids, skip_special_tokens=False)


def test_encode(spark, docs, none, words):
    got = {r.doc_id: r for r in bpe_codec.encode(docs, WORDS).collect()}
    digests = {r.doc_id: r for r in bpe_codec.encode_digests(docs, WORDS).collect()}
    for i, text in enumerate(TEXTS):
        ids = words.encode(text or "", add_special_tokens=False).ids
        decoded = words.decode(ids, skip_special_tokens=False)
        assert got[i].ids == ids and got[i].decoded == decoded
        assert digests[i].n_tokens == len(ids)
        assert digests[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe_codec.encode(none, WORDS).count() == 0


def test_token_files(spark, docs, none, words):
    path = scratch_path(spark, "tokens-test")
    token_files.write_tokens(docs.repartition(3), WORDS, path)
    got = {r.doc_id: r for r in token_files.summary(token_files.read_tokens(spark, path)).collect()}
    start = 0
    for i, text in enumerate(TEXTS):
        ids = words.encode(text or "", add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens) == (start, len(ids))
        assert got[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    empty = scratch_path(spark, "tokens-none")
    token_files.write_tokens(none, WORDS, empty)
    assert token_files.summary(token_files.read_tokens(spark, empty)).count() == 0


def test_token_files_read_selectively(spark, docs):
    path = scratch_path(spark, "tokens-plan")
    token_files.write_tokens(docs, WORDS, path)
    plan = token_files.read_tokens(spark, path).filter("doc_id = 3").select("n_tokens")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,3)" in plan and "ids" not in plan.rpartition("ReadSchema")[2]


def test_token_files_with_repeated_keys(spark):
    path = scratch_path(spark, "tokens-ties")
    rows = spark.createDataFrame([(5, "b c"), (5, "a"), (None, "z"), (5, "b c")], "doc_id long, text string")
    token_files.write_tokens(rows, WORDS, path)
    rows = sorted((r.start, r.doc_id, r.n_tokens) for r in token_files.summary(
        token_files.read_tokens(spark, path)).collect())
    assert rows == [(0, None, 2), (2, 5, 2), (4, 5, 3), (7, 5, 3)]
