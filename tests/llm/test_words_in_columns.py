"""Words of whole columns: the same ids as the library's, at less cost."""

import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from cobasket.llm import token_files
from cobasket.llm.bpe_codec import laid_out
from cobasket.llm.common import coded_words, slices

WORDS = public_tokenizers.path("word_bpe_49k.json")
LETTERS = "abcxyzABZ019'.,!?-_<|>" + "ßàöøÿÀÖØÞ×÷ªµ" + "éİẞ  \u0085\u001c漢я🙂" + "    \t\n\x0b\r"


def random_texts(rng, n):
    out = ["", " ", "a", "<|endoftext|>", "don't we'll 'S x's! (a.b.) é. É. ß, Straße!! 3rd. a.,b", "THE <|startoftext|>The!", "\x0b a"]
    return out + ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_ids_of_columns_are_the_library_s():
    texts = random_texts(random.Random(3), 3000)
    library, memo = Tokenizer.from_file(WORDS), token_files.library_memo(WORDS)
    batch = pa.record_batch({"text": pa.array([t.encode() for t in texts], pa.binary())}).slice(1)
    at = 1
    for rows in slices(iter([batch]), "text", 4000):
        sizes, codes, words = coded_words(rows.column("text"), "<|")
        ids, sizes = laid_out(*memo.table(words, 2), codes, sizes)
        ends = np.cumsum(sizes)
        for begin, end in zip(ends - sizes, ends):
            assert ids[begin:end].tolist() == [*library.encode(texts[at], add_special_tokens=False).ids, 2], texts[at]
            at += 1
    assert at == len(texts)


def test_words_of_columns_are_those_of_split():
    texts = [t.encode() for t in random_texts(random.Random(4), 500)]
    sizes, codes, words = coded_words(pa.array(texts, pa.binary()))
    words, ends = words.cast(pa.binary()).to_pylist(), np.cumsum(sizes)
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    for text, begin, end in zip(texts, ends - sizes, ends):
        assert [words[c] for c in codes[begin:end]] == text.translate(lower).split()


def test_new_words_cost_less_than_before():
    """Most CPU time of op7_token_files went into normalising and splitting words that have nothing to normalise or split."""
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyzéèç") for _ in range(rng.randrange(4, 12))) for _ in range(20_000)})
    library, memo = Tokenizer.from_file(WORDS), token_files.library_memo(WORDS)
    texts = ["<|endoftext|>".join(words[at:at + 512]) for at in range(0, len(words), 512)]  # as it was

    def seconds(work):
        took = []
        for _ in range(3):
            began = time.process_time()
            work()
            took.append(time.process_time() - began)
        return min(took)

    alone = [w.encode() for w in words]
    before = seconds(lambda: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)])
    assert seconds(lambda: memo.encode(alone)) < 0.75 * before
