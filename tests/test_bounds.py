import datetime as dt

import pytest

from fareline.operators import bounds
from tests.conftest import rows

LOG = "id bigint, t timestamp_ntz"


def at(day, hour=0, minute=0, second=0, micro=0):
    return dt.datetime(2024, 1, day, hour, minute, second, micro)


@pytest.fixture
def log(frame):
    # Day 3 is empty; two rows share a time on day 4; IDs have gaps.
    return frame(
        LOG, (10, at(1, 12)), (12, at(1, 23, 30)), (20, at(2, 6)), (21, at(2, 22)), (30, at(4, 9)), (31, at(4, 9)),
        (45, at(5, 1)), (50, None),
    )


def test_key_bounds(log):
    assert rows(bounds.key_bounds(log, "id")) == [(10, 50)]


def test_row_at(log):
    assert rows(bounds.row_at(log, "id", "t", 13)) == [(20, at(2, 6))]
    assert rows(bounds.row_at(log, "id", "t", 12)) == [(12, at(1, 23, 30))]
    assert rows(bounds.row_at(log, "id", "t", 13, exact=True)) == [(None, None)]
    assert rows(bounds.row_at(log, "id", "t", 99)) == [(None, None)]


@pytest.mark.parametrize(
    "target, before, after",
    [
        (at(1), None, 10),  # before the first row
        (at(1, 12), 10, 10),  # equal to a row
        (at(3, 5), 21, 30),  # an empty day; ties go to the lowest ID after
        (at(4, 9), 31, 30),  # ties go to the highest ID before
        (at(9), 45, None),  # after the last row
    ],
)
def test_id_at_time(log, target, before, after):
    assert rows(bounds.id_at_time(log, "id", "t", target))[0][0] == before
    assert rows(bounds.id_at_time(log, "id", "t", target, "after"))[0][0] == after


@pytest.mark.parametrize("away, close", [(299, True), (300, False), (301, False)])
def test_tolerance(log, away, close):
    later = at(5, 1) + dt.timedelta(seconds=away)
    assert rows(bounds.id_at_time(log, "id", "t", later)) == [(45, at(5, 1), close)]
    sooner = at(1, 12) - dt.timedelta(seconds=away)
    assert rows(bounds.id_at_time(log, "id", "t", sooner, "after")) == [(10, at(1, 12), close)]


def test_direction_is_checked(log):
    with pytest.raises(ValueError):
        bounds.id_at_time(log, "id", "t", at(1), "sideways")


def _expected(events, first, last, margin, inclusive_end):
    out = []
    for n in range((last - first).days + 1):
        start = dt.datetime.combine(first, dt.time()) + dt.timedelta(days=n)
        end = start + dt.timedelta(days=1) - (dt.timedelta() if inclusive_end else dt.timedelta(microseconds=1))
        lo = max(((t, i) for i, t in events if t and t <= start - margin), default=(None, None))
        hi = min(((t, i) for i, t in events if t and t >= end + margin), default=(None, None))
        out.append((start, start, end, lo[1], lo[0], hi[1], hi[0]))
    return out


@pytest.mark.parametrize("inclusive_end", [False, True])
@pytest.mark.parametrize("margin", [dt.timedelta(hours=1), dt.timedelta(0), dt.timedelta(hours=30)])
@pytest.mark.parametrize("first, last", [(dt.date(2024, 1, 1), dt.date(2024, 1, 6)), (dt.date(2024, 1, 3), dt.date(2024, 1, 3))])
def test_day_bounds_against_brute_force(log, first, last, margin, inclusive_end):
    events = rows(log)
    got = bounds.day_bounds(log, "id", "t", first, last, margin, inclusive_end, near=dt.timedelta(hours=1))
    assert rows(got, "start") == _expected(events, first, last, margin, inclusive_end)


def test_day_bounds_edges(frame):
    hour = dt.timedelta(hours=1)
    wanted_start, wanted_end = at(2) - hour, at(3) - dt.timedelta(microseconds=1) + hour
    tick = dt.timedelta(microseconds=1)
    log = frame(LOG, (1, wanted_start - tick), (2, wanted_start), (3, wanted_start + tick),
                (4, wanted_end - tick), (5, wanted_end), (6, wanted_end + tick))
    day = dt.date(2024, 1, 2)
    got = rows(bounds.day_bounds(log, "id", "t", day, day))[0]
    assert (got[3], got[5]) == (2, 5)


def test_day_bounds_far_rows(frame):
    # The closest rows lie weeks outside of the days asked for.
    log = frame(LOG, (1, at(1)), (2, at(1, 1)), (8, at(28)), (9, at(29)))
    got = rows(bounds.day_bounds(log, "id", "t", dt.date(2024, 1, 14), dt.date(2024, 1, 15)), "start")
    assert [(r[3], r[5]) for r in got] == [(2, 8), (2, 8)]


def test_spine(spark):
    got = rows(bounds.day_spine(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 1)), "day")
    assert [r[0] for r in got] == [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    assert got[0][3] == dt.datetime(2024, 2, 28, 23, 59, 59, 999999)
    closed = rows(bounds.day_spine(spark, dt.date(2024, 2, 29), dt.date(2024, 2, 29), inclusive_end=True))
    assert closed[0][3] == dt.datetime(2024, 3, 1)


@pytest.mark.parametrize("text", [False, True])
def test_bounds_table(spark, log, path, text):
    where = path("bounds")
    whole = bounds.day_bounds(log, "id", "t", dt.date(2024, 1, 1), dt.date(2024, 1, 5))
    bounds.save_bounds(whole, where, text)
    assert rows(bounds.load_bounds(spark, where, text=text), "start") == rows(whole, "start")
    some = bounds.load_bounds(spark, where, at(2), at(4), text)
    assert [r[1] for r in rows(some, "start")] == [at(2), at(3), at(4)]
