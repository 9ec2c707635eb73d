import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fareline.llm.direct_codes import DirectCodes, dump_codes, read_tokens, write_tokens
from fareline.llm.packing import K1, B, BM25, fill_windows, numbered, pack

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ROWS = [(5, "five words are in here"), (2, None), (9, ""), (2, "again the id"), (7, "long " * 6000), (None, "no id"), (5, "five words are in here")]


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
@pytest.mark.parametrize("top", [3, 256, 257, 60_000, 2**24])
def test_every_token_is_addressable(n, top):
    ids = np.random.default_rng(n).integers(0, top, n)
    codes = DirectCodes(dump_codes(ids))
    assert codes.all().tolist() == ids.tolist() == codes[np.arange(n)].tolist()
    with pytest.raises(IndexError):
        codes[n]


def test_round_trip_of_a_folder(frame, spark, path):
    write_tokens(frame("doc_id long, text string, shard int, codes int", *[(*r, 1, 2) for r in ROWS]), out := path(), BYTES, end=2)
    got = sorted(read_tokens(spark, out).collect(), key=lambda r: r.start)
    whole = Tokenizer.from_file(BYTES)
    assert [r.doc_id for r in got] == [None, 2, 2, 5, 5, 7, 9]
    texts, at = {}, 0
    for i, t in ROWS:
        texts.setdefault(i, []).append([*whole.encode(t or "", add_special_tokens=False).ids, 2])
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        texts[r.doc_id].remove(ids)
        assert (r.start, r.n_tokens) == (at, len(ids))
        at += len(ids)
    write_tokens(frame("doc_id long, text string"), out := path(), BYTES, end=2)
    assert read_tokens(spark, out).collect() == []


def test_packing_covers_every_token_once(frame):
    rows = [*ROWS, *[(100 + k, f"topic{k % 3} shared words number {k} " * (k + 1)) for k in range(40)]]
    got = pack(frame("doc_id long, text string, ids int, offset int", *[(*r, 0, 0) for r in rows]), WORDS, end=1, window=64).collect()
    whole = Tokenizer.from_file(WORDS)
    ids = [[*whole.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows]
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == np.cumsum([0, *[r.length for r in parts]])[:-1].tolist()
        size = sum(r.length for r in parts)
        assert size == 64 or size & (size - 1) == 0
    once = [p for p in pieces.values() if len({r.start for r in p}) == len(p)]
    joined = [str(np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(p, key=lambda r: r.start)]).tolist()) for p in once]
    assert set(joined) <= set(map(str, ids)) and len(once) >= len(pieces) - 1
    assert sum(r.length for r in got) == sum(map(len, ids))
    assert pack(frame("doc_id long, text string"), WORDS, end=1).collect() == []


def test_neighbours_share_rare_terms():
    terms = [[0, 1, 2], [0, 3, 4], [0, 1, 5], [0, 3, 6], [0, 7], [0, 8]]
    document = np.repeat(np.arange(6), [len(t) for t in terms])
    index = BM25(document, np.array([t for ts in terms for t in ts]), 6)
    assert index.scores(0).argsort()[::-1][:2].tolist() in ([0, 2], [2, 0]) and index.scores(0)[1] == 0
    order = [p[0] for p in fill_windows(np.array([4, 4, 4, 4, 4, 4]), index, 8)]
    assert order == [0, 2, 1, 3, 4, 5]


def test_an_index_sorts_once_and_ranks_a_seeds_terms_when_asked():
    rng = np.random.default_rng(5)
    places = rng.integers(0, 5_000, 20_000) ** 2 // 5_000
    assert (numbered(places) == np.unique(places, return_inverse=True)[1]).all() and not len(numbered(places[:0]))
    document, term, n = np.sort(rng.integers(0, 60, len(places))), numbered(places), 60
    index = BM25(document, term, n)
    tf = np.zeros((n, term.max() + 1))
    np.add.at(tf, (document, term), 1)
    df, lengths = (tf > 0).sum(0), tf.sum(1)
    weight = np.log((n - df + 0.5) / (df + 0.5) + 1) * tf * (K1 + 1) / (tf + (K1 * (1 - B + B * lengths / lengths.mean()))[:, None])
    weight[:, (df < 2) | (df >= n / 2)] = 0
    for seed in (0, 17, 59):
        best = sorted(np.flatnonzero(weight[seed]), key=lambda t: (-weight[seed, t], t))[:24]
        assert index.best_terms(seed, 24).tolist() == best
        assert np.allclose(index.scores(seed), weight[:, best].sum(1))
