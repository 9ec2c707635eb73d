"""Alignment of two tokenizers against a plain form that encodes whole texts and compares all byte ranges."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fareline.llm.token_pairs import align_corpus, byte_values

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", None, " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "x" * 3000, "Ünï cødé 日本語 🎈", "\x00\x01", "a\u00a0 b", "\u2581", "no \u2581 mark",
    "<s> hi </s>", "<|endoftext|> x", "<0x0A>", "tab\tand\r\nend ", "ＡＢ ｃ", "e\u0301 é", "it's 12,345.67!!", "a\u3000 b", "the same", "the same",
]


def plain(rows):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    values, names = byte_values(), a.get_vocab()
    a_bytes = {i: bytes(values[c] for c in t) for t, i in names.items() if all(c in values for c in t)}

    def b_byte(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("\u2581", " ").encode()

    def ranges(ids, to_bytes):
        at, out = 0, []
        for i in ids:
            out.append((i, at, at + len(to_bytes(i))))
            at = out[-1][2]
        return out

    linked, tokens = [], []
    for _, text in rows:
        one, two = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        body = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in one) != body or b"".join(b_byte(i) for i in two) != body:
            one, two = [], []
        one, two = ranges(one, a_bytes.get), ranges(two, b_byte)
        linked.append([(x[0], y[0]) for x in one for y in two if x[1] < y[2] and y[1] < x[2]])
        tokens.append((one, two))
    counts = Counter(p for links in linked for p in links)
    highest = {}
    for (_, y), n in counts.items():
        highest[y] = max(n, highest.get(y, 0))
    out = []
    for (i, _), links, (one, two) in zip(rows, linked, tokens, strict=True):
        ends = sorted({x[2] for x in one} & {y[2] for y in two})
        groups, begin = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(x[0]) for x in side if begin < x[2] <= end) for side in (one, two)))
            begin = end
        out.append(
            (i, len(one), len(two), len(groups), len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        )
    return out, counts


ROWS = [(k if k % 7 else None, t) for k, t in enumerate(ODD)] + [(100, "the same"), (100, "the same"), (100, "other words")]


@pytest.mark.parametrize("head", [1_000_000, 3])
def test_measures_and_counts(frame, head):
    docs = frame("doc_id long, text string, key string, n int", *[(i, t, "x", 1) for i, t in ROWS])
    measures, pairs = align_corpus(docs, A, B, head_pairs=head)
    wanted, counts = plain(ROWS)
    assert measures.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert sorted(map(str, (tuple(r) for r in measures.collect()))) == sorted(map(str, wanted))
    assert {(r.a, r.b): r["count"] for r in pairs.collect()} == counts


def test_given_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").where("length(text) < 3000")
    wanted, _ = plain([tuple(r) for r in docs.collect()])
    assert sorted(tuple(r) for r in align_corpus(docs, A, B)[0].collect()) == sorted(wanted)


def test_hot_text_and_empty_table(frame, monkeypatch):
    monkeypatch.setattr("fareline.llm.token_pairs.HOT_COPIES", 5)
    rows = [(k % 40, "same words here") for k in range(60)] + [(k, None) for k in range(9)] + [(7, "one more")]
    wanted, _ = plain(rows)
    got = align_corpus(frame("doc_id long, text string", *rows), A, B)[0]
    assert sorted(tuple(r) for r in got.collect()) == sorted(wanted)
    assert align_corpus(frame("doc_id long, text string"), A, B)[0].collect() == []
