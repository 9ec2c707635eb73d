import random

import numpy as np
import pytest

from fareline.llm.fm_index import FMIndex, WaveletMatrix, find_leaks, remove_leaks, suffix_array
from tests.llm.brute import leaks, plain_words


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_ranks_and_search(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, (2, 3, 50)[seed % 3], 400)
    if seed == 5:
        text[:] = 1
    assert suffix_array(text).tolist() == sorted(range(400), key=lambda k: text[k:].tolist())
    matrix = WaveletMatrix(text, 50)
    ends, symbols = rng.integers(0, 401, 200), rng.integers(0, 50, 200)
    assert matrix.rank(symbols, ends).tolist() == [int((text[:e] == s).sum()) for s, e in zip(symbols, ends, strict=True)]
    assert matrix.symbol(np.arange(400)).tolist() == text.tolist()
    index = FMIndex(text, 50)
    phrases = np.array([text[k : k + 3] for k in range(0, 390, 13)] + [[49, 49, 49]])
    low, high = index.search(phrases, np.full(len(phrases), 3))
    for p, a, b in zip(phrases.tolist(), low.tolist(), high.tolist(), strict=True):
        assert sorted(index.locate(np.arange(a, b)).tolist()) == [k for k in range(398) if text[k : k + 3].tolist() == p]


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(2)
    word = lambda: rng.choice("the of and Ante béta c3 d e f g h".split())
    texts = [" ".join(word() for _ in range(rng.choice((0, 3, 9, 10, 40, 300)))) for _ in range(60)]
    items = [(str(k), " ".join(word() for _ in range(n))) for k, n in enumerate((1, 2, 9, 10, 11, 30, 30))]
    items += [("a", None), ("b", "..."), (None, "the of"), ("0", items[3][1]), ("c", "nowhere seen")]
    one, other = ("".join("ab"[(bin(k).count("1") + t) % 2] for k in range(1024)) for t in (0, 1))
    items += [("even", one)]
    texts += [one, other, f"the {other} of"]
    texts += ["x " + items[5][1].upper().replace(" ", ", ") + " y", items[6][1], items[6][1] + "." + items[5][1], None, "", "!?", "the " * 5000]
    return list(enumerate(texts)), items


@pytest.mark.parametrize("block_chars", [10_000_000, 60])
def test_hits_against_brute_force(frame, tables, block_chars):
    texts, items = tables
    docs = frame("doc_id long, text string, spans string, items int, item_id int", *[(i, t, "s", 1, 2) for i, t in texts])
    bench = frame("item_id string, text string, extra int", *[(i, t, 0) for i, t in items])
    got = {r.doc_id: r for r in find_leaks(docs, bench, block_chars=block_chars).collect()}
    by_item = [{i: t} for i, t in items]
    for i, text in texts:
        hit, found = [False] * len(plain_words(text)), set()
        for one in by_item:
            h, f = leaks(text, one)
            hit, found = [a or b for a, b in zip(hit, h, strict=True)], found | (f - {None})
        mine = [False] * got[i].n_words
        for s in got[i].spans:
            mine[s.first : s.last] = [True] * (s.last - s.first)
        assert (got[i].n_words, mine, list(got[i]["items"])) == (len(hit), hit, sorted(found)), i


def test_removal(frame):
    leak = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Keep this. {leak.title()}! And that.", 5), (2, leak, 1), (3, "clean text", 10), (4, None, None), (5, "", 0), (3, "clean text", 10)]
    docs = frame("doc_id long, text string, n_chars long", *rows)
    bench = frame("item_id long, text string", (1, leak))
    got = sorted(map(tuple, remove_leaks(docs, bench).collect()), key=str)
    cut = "Keep this. \n! And that."
    assert got == sorted([(1, cut, len(cut)), (3, "clean text", 10), (3, "clean text", 10), (4, None, None), (5, "", 0)], key=str)
    assert find_leaks(docs, bench.limit(0)).where("size(spans) > 0").count() == 0
    assert find_leaks(docs.limit(0), bench).collect() == []
