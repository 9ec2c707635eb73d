"""Ordered groups: the plain way and the way for heavy groups must agree with brute force."""

import random

import pytest

from fareline.functions import ordered
from tests.conftest import rows

SCHEMA = "k string, o int, v string"
# Forces every group onto the second way.
ALL_HEAVY = {"rows": 1}


@pytest.fixture
def data():
    rng = random.Random(7)
    out = [("hot", n, f"h{n}") for n in range(400)]
    out += [(rng.choice("abcde"), n, f"v{n}") for n in range(300)]
    out += [(None, n, f"n{n}") for n in range(90)] + [("single", 1, None)]
    rng.shuffle(out)
    return out


def _groups(data):
    groups = {}
    for k, o, v in sorted(data, key=lambda r: r[1]):
        groups.setdefault(k, []).append((o, v))
    return groups


@pytest.mark.parametrize("limits", [{}, ALL_HEAVY, {"rows": 100}])
def test_row_numbers(frame, data, limits):
    got = ordered.number_rows(frame(SCHEMA, *data).repartition(6), ["k"], ["o"], "n", **limits)
    expected = {(k, o, v, i + 1) for k, items in _groups(data).items() for i, (o, v) in enumerate(items)}
    assert set(rows(got)) == expected and got.count() == len(data)


@pytest.mark.parametrize("limits", [{}, ALL_HEAVY, {"rows": 100}])
def test_look_ahead(frame, data, limits):
    got = ordered.look_ahead(frame(SCHEMA, *data).repartition(6), ["k"], ["o"], {"nv": "v", "no": "o"}, **limits)
    expected = set()
    for k, items in _groups(data).items():
        for (o, v), after in zip(items, [*items[1:], (None, None)]):
            expected.add((k, o, v, after[1], after[0]))
    assert set(rows(got)) == expected and got.count() == len(data)


@pytest.mark.parametrize("limits", [{}, ALL_HEAVY, {"rows": 100}])
@pytest.mark.parametrize("known", [0.3, 0.005])
def test_fill_forward(frame, data, limits, known):
    rng = random.Random(11)
    gappy = [(k, o, v if rng.random() < known else None) for k, o, v in data]
    got = ordered.fill_forward(frame(SCHEMA, *gappy).repartition(6), ["k"], ["o"], ["v"], **limits)
    expected = set()
    for k, items in _groups(gappy).items():
        last = None
        for o, v in items:
            last = v if v is not None else last
            expected.add((k, o, last))
    assert set(rows(got)) == expected and got.count() == len(data)


@pytest.mark.parametrize("limits", [{}, ALL_HEAVY])
def test_distinct_rows(frame, data, limits):
    got = ordered.number_rows(frame(SCHEMA, *data, *data), ["k"], ["o"], "n", distinct=True, **limits)
    assert got.count() == len(data)
    assert max(r[3] for r in rows(got.where("k = 'hot'"))) == 400


@pytest.mark.parametrize("copies", [1, 500])
def test_all_rows(frame, copies):
    data = [(f"k{n % 9}", n, "x") for n in range(200)] + [("same", 50, "y")] * copies
    got = ordered.number_all_rows(frame(SCHEMA, *data).repartition(5), ["o", "k"], "id")
    numbered = sorted((r[3], r[1], r[0]) for r in rows(got))
    assert [n for n, _, _ in numbered] == list(range(len(data)))
    assert [(o, k) for _, o, k in numbered] == sorted((o, k) for k, o, _ in data)


def test_heavy_groups_are_found(frame, data):
    df = frame(SCHEMA, *data)
    assert len(ordered.heavy_groups(df, ["k"], rows=350)) == 1
    assert ordered.heavy_groups(df, ["k"], rows=35000) == []


def test_no_task_gets_a_whole_heavy_group(frame):
    df = frame(SCHEMA, *[("hot", n, "x") for n in range(2000)]).repartition(4)
    ranges = ordered._into_ranges(df, ["k"], ["o"])
    sizes = [r[1] for r in rows(ranges.groupBy("__range").count())]
    assert len(sizes) >= 4 and max(sizes) < 1000


def test_identical_rows_spread_over_ranges(frame):
    df = frame(SCHEMA, *[("hot", 1, "x")] * 2000).repartition(4)
    sizes = [r[1] for r in rows(ordered._into_ranges(df, ["k"], ["o"]).groupBy("__range").count())]
    assert len(sizes) > 1 and max(sizes) < 1500


def test_heavy_is_an_absolute_number(spark):
    """A group of far less than a thousandth of the rows is split, if it has enough of them."""
    df = spark.range(3_000_000).selectExpr("if(id < 12000, -1L, id) AS k")
    assert len(ordered.heavy_groups(df, ["k"], rows=10_000)) == 1
    assert ordered.heavy_groups(df, ["k"], rows=20_000) == []


def test_ranges_grow_with_the_rows(spark):
    few, many = spark.range(1_000), spark.range(100_000)
    assert ordered.range_count(many, 1_000) == 100 > ordered.range_count(few, 1_000)
