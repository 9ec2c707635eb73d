import random

import pytest

from fareline.llm.line_dedup import line_sites, remove_boilerplate
from tests.llm.brute import boilerplate, normal_line

SCHEMA = "doc_id long, text string, source string, n_chars long, n_lines string, line int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    common = [f"Shared  line number {k}" for k in range(12)] + ["two words", "", "ünï cödé LINE here"]
    out = []
    for i in range(120):
        lines = [rng.choice(common[: 1 + i % 15]) if rng.random() < 0.5 else f"own line of {i} {rng.random()}" for _ in range(rng.randrange(9))]
        out.append((i, "\n".join(lines), rng.choice(["a", "b", "c", "d", "e", "f", None]), None, "x", 1))
    big = "\n".join(["shared LINE number 0"] * 3000)
    return [*out, (500, None, "a", None, "x", 1), (501, "", "b", None, "x", 1), (502, big, "c", None, "x", 1), out[7], (None, out[3][1], "e", None, "x", 1)]


@pytest.mark.parametrize("keep_first", [False, True])
def test_removal_against_brute_force(frame, rows, keep_first):
    got = remove_boilerplate(frame(SCHEMA, *rows), min_sites=4, keep_first=keep_first).collect()
    common = boilerplate([(r[1], r[2]) for r in rows], 4)
    assert common
    first = {}
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if i is not None:
                first[normal_line(line)] = min(i, first.get(normal_line(line), i))
    wanted = []
    for i, text, site, *_ in rows:
        lines = [] if text is None else text.split("\n")
        gone = [normal_line(x) in common and not (keep_first and first.get(normal_line(x)) == i) for x in lines]
        left = None if text is None else "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        wanted.append((i, left, site, None if left is None else len(left), len(lines), sum(gone)))
    shown = [(r.doc_id, r.text, r.source, r.n_chars, r.n_lines, r.n_removed) for r in got]
    assert sorted(shown, key=str) == sorted(wanted, key=str)


def test_sketch_decides_far_and_counts_near(frame):
    rows = [(line, site) for line in range(30) for site in range(line * 20)]
    lines = frame("line long, site long", *rows, *rows[:50], (99, None))
    got = {r.line: r.sites for r in line_sites(lines, 200).collect()}
    assert set(got) == set(range(10, 30))
    assert all(got[k] == k * 20 for k in range(10, 12)) and all(abs(got[k] - k * 20) < k * 4 for k in got)


def test_emptied_rows_and_no_rows(frame):
    rows = [(i, "the same three words", f"s{i}") for i in range(5)] + [(9, " ", "s1")]
    docs = frame("doc_id long, text string, source string", *rows)
    got = remove_boilerplate(docs, min_sites=5, keep_first=True, drop_empty=True).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(0, "the same three words"), (9, " ")]
    assert remove_boilerplate(docs.limit(0), min_sites=5).collect() == []
