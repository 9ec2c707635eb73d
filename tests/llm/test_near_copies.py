import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from fareline.llm.graph import components
from fareline.llm import minhash
from fareline.llm.minhash import _links_within, near_duplicates
from tests.llm.brute import near_copies, roots, shingles

SCHEMA = "doc_id long, text string, component_id string, n int, id int, key int"


def _family(rng, size, edits):
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    out = []
    for _ in range(size):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(40)}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    out = [*_family(rng, 60, 9), *_family(rng, 12, 4), *_family(rng, 2, 2), "A b\tc", "a B c", "a b", "x y z p q", "", None, " \n", None]
    out += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(n)) for n in (4, 5, 6, 20_000)]
    out += [out[0], out[0].upper(), out[70]]
    # Words of equal sums of powers: no copies of each other.
    out += [" ".join("".join("ab"[(bin(k).count("1") + t) % 2] for k in range(1024)) + str(n) for n in range(8)) for t in (0, 1)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("crowded, percent", [(24, 85), (3, 85), (3, 80)])
def test_components_against_brute_force(frame, texts, crowded, percent):
    docs = dict(enumerate(texts, 10))
    given = frame(SCHEMA, *[(i, t, "x", 1, None, 2) for i, t in docs.items()])
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(given, percent=percent, crowded=crowded).collect()}
    wanted = near_copies(docs, percent)
    assert got == {i: (len(shingles(t)), wanted[i], wanted[i] == i) for i, t in docs.items()}


def test_null_and_repeated_ids_and_no_rows(frame):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (3, "other words"), (None, None)]
    got = near_duplicates(frame("doc_id long, text string", *rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(
        map(str, [(None, 2, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 3, True), (None, 0, None, True)])
    )
    assert near_duplicates(frame("doc_id long, text string")).collect() == []


def test_components_of_paths_stars_and_loops(frame):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 230)] + [(3, 3), (9, 8), (8, 9), (9, 8)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(frame("a long, b long", *links, (None, 1), (2, None))).collect()}
    wanted = roots({n for link in links for n in link}, links)
    assert got == {n: r for n, r in wanted.items() if n != 3}
    assert components(frame("a long, b long")).collect() == []


def test_pair_of_blocks_needs_linear_memory():
    """Many short templated texts in one group, as a crowd deals them."""
    rng, n = np.random.default_rng(3), 6_000
    sets = [rng.choice(400, 20, replace=False) for _ in range(n)]
    sets[17] = sets[5_900]
    group = pa.table({"id": np.arange(n), "set": pa.array([s.tolist() for s in sets], pa.list_(pa.int64())), "component": np.arange(n)})
    tracemalloc.start()
    got = _links_within(80)(group)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.to_pylist() == [{"a": 17, "b": 5_900}]
    assert peak < 4 * n * n  # a matrix of all pairs alone has this size


def test_blocks_are_bounded_in_documents(frame, texts, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 5)
    monkeypatch.setattr(minhash, "STRIP", 3)
    docs = dict(enumerate(texts, 10))
    given = frame(SCHEMA, *[(i, t, "x", 1, None, 2) for i, t in docs.items()])
    got = {r.doc_id: r.component_id for r in near_duplicates(given, crowded=3).collect()}
    assert got == near_copies(docs, 85)


def test_half_keys_follow_from_the_similarity():
    assert minhash.halves_for(85) == 8 and minhash.halves_for(80) == 11
    for percent in (50, 80, 85, 95):
        missed = 1 - (1 - (1 - (percent / 100) ** 3) ** minhash.halves_for(percent)) ** 2
        assert missed <= 0.001
