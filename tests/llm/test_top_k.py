import numpy as np
import pytest
from pyspark.sql import functions as F

from fareline.llm.pivot_index import Index, scaled, top_k


@pytest.mark.parametrize("spread", ["clusters", "equal", "norms"])
def test_exact_with_ties_and_broken_rows(frame, spread):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 6)) * 0.1 + rng.integers(0, 3, 700)[:, None]
    if spread == "equal":
        x[::3] = x[0]
    if spread == "norms":
        x *= rng.exponential(size=(700, 1))
    rows = [(k, [float(np.float32(v)) for v in e], 0, "id") for k, e in enumerate(x)]
    rows += [(800, None, 0, ""), (801, [1.0, None], 0, ""), (802, [float("nan")] * 6, 0, ""), (803, [float("inf")] * 6, 0, ""), (None, [1.0] * 6, 0, "")]
    rows += [(804, [2.0, 1.0], 0, ""), (810, [], 0, ""), rows[10], (11, [0.5] * 6, 0, "")]
    given = frame("vec_id long, embedding array<float>, score int, id string", *rows)
    got = sorted(map(tuple, top_k(given, F.col("vec_id") % 10 == 0, k=7).collect()))
    sound = [(i, np.pad(np.floor(1024 * np.array(e, np.float64)).astype(int), (0, 6 - len(e)))) for i, e, *_ in rows
             if i is not None and e is not None and None not in e and np.isfinite(e).all()]
    wanted = []
    for i, e in {(i, tuple(e)) for i, e in sound if i % 10 == 0}:
        scores = sorted((-int(np.dot(e, c)), j) for j, c in sound if j != i)[:7]
        wanted += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores, 1)]
    assert got == sorted(wanted)


def test_blocks_of_queries_and_small_tables(frame):
    rows = [(k, [float(k % 7), float(k % 5)]) for k in range(60)]
    given = frame("vec_id long, embedding array<double>", *rows).withColumn("v", scaled(F.col("embedding"), 1))
    index = Index(given, "vec_id", "v")
    one = sorted(map(tuple, index.search(given, "vec_id", "v", 3).collect()))
    assert sorted(map(tuple, index.search(given, "vec_id", "v", 3, block=7).collect())) == one and len(one) == 180
    few = frame("vec_id long, embedding array<double>", (0, [1.0]), (3, [2.0]))
    assert [tuple(r) for r in top_k(few, F.col("vec_id") == 0, scale=1).collect()] == [(0, 1, 3, 2)]
    assert top_k(few.limit(0), F.lit(True)).collect() == []


def test_large_components_are_exact_or_an_error(frame):
    rng = np.random.default_rng(4)
    x = rng.integers(-(10**6), 10**6, (300, 5)) + 0.5
    given = frame("vec_id long, embedding array<double>", *[(k, [float(v) for v in e]) for k, e in enumerate(x)])
    vectors = np.floor(1024 * x).astype(int).tolist()
    got = sorted(map(tuple, top_k(given, F.col("vec_id") % 50 == 0, k=9).collect()))
    wanted = []
    for i in range(0, 300, 50):
        scores = sorted((-sum(a * b for a, b in zip(vectors[i], c, strict=True)), j) for j, c in enumerate(vectors) if j != i)[:9]
        wanted += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores, 1)]
    assert got == sorted(wanted) and max(abs(s) for *_, s in got) > 2**53
    with pytest.raises(OverflowError):
        top_k(frame("vec_id long, embedding array<double>", (0, [1e7] * 5), (1, [1.0] * 5)), F.col("vec_id") == 0)
