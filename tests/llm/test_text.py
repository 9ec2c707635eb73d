import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fareline.llm import tokens
from fareline.llm.text import ASCII_ALNUM_OR_BEYOND, SPACE, Texts, equal_ranges, hash_words, hashes, slices, spans
from fareline.llm.tokens import PieceEncoder
from tests.llm.brute import plain_words, spaced_words

ODD = ["", None, " ", "a", "A b\nC", "x" * 5000, "é ÉÀ ÿ 1a", "\x00\x01", "a b 　 c", "  lead", "trail  ", "\n\n", "Ünï cødé"]


@pytest.mark.parametrize("inside, words", [(~SPACE, spaced_words), (ASCII_ALNUM_OR_BEYOND, plain_words)])
def test_words_and_hashes(inside, words):
    texts = Texts(pa.array(ODD * 3).slice(2, 30))
    starts, ends, first = spans(texts, inside)
    given = (ODD * 3)[2:32]
    wanted = [words(t) for t in given]
    assert np.diff(first).tolist() == [len(w) for w in wanted]
    flat = [w.encode() for ws in wanted for w in ws]
    assert (hashes(texts.data, starts, ends, lower=True) == hash_words(flat)).all()
    assert len(set(hash_words(sorted(set(flat))).tolist())) == len(set(flat))


def thue_morse(n):
    """Two words whose sums of powers agree modulo 2^64 whatever the base."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("size", [8, 64, 256, 1024, 4096])
def test_words_of_even_structure_differ(size):
    assert len(set(hash_words([w.encode() for w in thue_morse(size)]).tolist())) == 2


def test_equal_ranges():
    one = np.frombuffer(b"abcdefghijkl" + b"x" * 300 + b"y", np.uint8)
    two = np.frombuffer(b"--abcdefghiJkl" + b"x" * 301, np.uint8)
    at, to, lengths = np.array([0, 0, 0, 12, 12, 5]), np.array([2, 2, 0, 14, 14, 7]), np.array([9, 10, 0, 300, 301, 0])
    assert equal_ranges(one, at, two, to, lengths).tolist() == [True, False, True, True, False, True]


def test_pieces_that_share_a_hash_keep_their_ids(monkeypatch):
    monkeypatch.setattr(tokens, "hashes", lambda data, starts, stops: (stops - starts).astype(np.uint64))
    encode = PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    given = ["one two six ten", "ten six", *thue_morse(1024), "two one"]
    for _ in range(2):
        ids, bounds, _, _ = encode.encode(Texts(pa.array(given)), 7)
        for k, text in enumerate(given):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == [*whole.encode(text).ids, 7]


def test_slices_hold_whole_documents():
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "c" * 100, "", "d"]), pa.array(range(5))], ["t", "n"])
    parts = [part.column("n").to_pylist() for part, _ in slices(batch, "t", 10)]
    assert [n for p in parts for n in p] == [0, 1, 2, 3, 4] and [2, 3] in parts or [2] in parts
    assert list(slices(batch.slice(0, 0), "t")) == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_piecewise_ids_are_those_of_whole_texts(name):
    rng = random.Random(3)
    bits = [" ", "  ", "\n", "\t", " ", " ", "　", "\x85", "a", "B", "é", "́", "'s", "'LL", "12", "!?", "<|endoftext|>", "\x01", "Σ", "ǆ", "日本"]
    given = ODD + ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(300)]
    encode = PieceEncoder(public_tokenizers.path(name))
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    for _ in range(2):  # the second time from the table of pieces
        ids, bounds, _, _ = encode.encode(Texts(pa.array(given)), 7)
        for k, text in enumerate(given):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == [*whole.encode(text or "", add_special_tokens=False).ids, 7], repr(text)
