"""Cells of intervals and zone maps of logs against brute force; which files are opened."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fareline.operators import bounds, intervals
from fareline.sources import zones
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def at(s):
    return T0 + dt.timedelta(seconds=s)


@pytest.mark.parametrize("radices", [intervals.RADICES, (2,) * 40, (7, 3)])
def test_cover_is_exact_and_small(frame, radices):
    rng = random.Random(1)
    spans = [(0, 0), (5, 4), (-7, 3), (0, 86_399), (86_400, 2 * 86_400 - 1), (-100_000, 100_000), (None, 3)]
    spans += [tuple(sorted((rng.randrange(-9_000, 9_000), rng.randrange(-9_000, 9_000)))) for _ in range(60)]
    df = frame("lo long, hi long", *spans).withColumn("cells", intervals.cover("lo", "hi", radices))
    for r in df.collect():
        ticks = []
        for c in r.cells:
            width = 1
            for x in radices[: c.level]:
                width *= x
            assert c.level <= len(radices)
            ticks += range(c.cell * width, (c.cell + 1) * width)
        wanted = [] if r.lo is None or r.lo > r.hi else list(range(r.lo, r.hi + 1))
        assert sorted(ticks) == wanted
    assert {(r.lo, r.hi): len(r.cells) for r in df.collect()}[0, 86_399] == (1 if radices == intervals.RADICES else len(df.where("lo = 0 and hi = 86399").first().cells))


@pytest.mark.parametrize("inclusive", [True, False])
def test_points_in_overlapping_intervals(frame, inclusive):
    rng = random.Random(4)
    points = [(k, at(rng.randrange(-10**8, 10**8)) + dt.timedelta(microseconds=rng.choice([0, 1, 999_999]))) for k in range(300)] + [(999, None)]
    spans = []
    for k in range(120):
        start = rng.choice(points[:-1])[1] if k % 3 else at(rng.randrange(-10**8, 10**8))
        spans.append((k, start, start + dt.timedelta(seconds=int(10 ** rng.uniform(-1, 8.2)), microseconds=rng.choice([0, 5]))))
    spans += [(900, T0, None), (901, None, T0), (902, at(5), at(4)), (903, points[0][1], points[0][1])]
    got = intervals.assign_intervals(frame("p int, t timestamp_ntz", *points), "t", frame("i int, start timestamp_ntz, end timestamp_ntz", *spans), inclusive_end=inclusive)
    wanted = sorted((p, i) for p, t in points for i, s, e in spans if t and s and e and s <= t and (t <= e if inclusive else t < e))
    assert sorted((r.p, r.i) for r in got.collect()) == wanted
    none = intervals.assign_intervals(frame("p int, t timestamp_ntz", *points), "t", frame("i int, start timestamp_ntz, end timestamp_ntz", (1, None, None)))
    assert none.columns == ["p", "t", "i", "start", "end"] and none.isEmpty()


def _log(frame, path, values, files, mode="append"):
    df = frame("id long, t timestamp_ntz, pad string", *[(i, t, "x") for i, t in values])
    df.repartitionByRange(files, "id").sortWithinPartitions("id").write.mode(mode).parquet(path)


def test_only_new_files_are_read_and_gone_ones_drop_out(spark, frame, path):
    log, kept = path("log"), path("zones")
    _log(frame, log, [(k, at(60 * k)) for k in range(1000)], 8)
    assert zones.refresh_zones(spark, log, kept, "id", "t", zone_rows=50) == 8
    assert zones.refresh_zones(spark, log, kept, "id", "t", zone_rows=50) == 0
    before = zones.read_zones(spark, log, kept)
    assert before.agg(F.sum("rows")).first()[0] == 1000 and before.count() >= 20 and before.agg(F.max("rows")).first()[0] <= 50
    _log(frame, log, [(k, at(60 * k)) for k in range(1000, 1100)], 2)
    assert zones.refresh_zones(spark, log, kept, "id", "t", zone_rows=50) == 2
    now = zones.read_zones(spark, log, kept)
    assert now.agg(F.sum("rows"), F.min("low_id"), F.max("high_id")).first()[:] == (1100, 0, 1099)
    gone = now.where("low_id = 0").first().file
    name = spark._jvm.org.apache.hadoop.fs.Path(gone)
    name.getFileSystem(spark._jsc.hadoopConfiguration()).delete(name, False)
    assert zones.read_zones(spark, log, kept).agg(F.min("low_id")).first()[0] > 0
    # A second writer's rows for the same files count once.
    spark.read.parquet(kept).limit(5).write.mode("append").parquet(kept)
    assert zones.read_zones(spark, log, kept).groupBy("file", "zone").count().where("count > 1").isEmpty()
    with pytest.raises(FileNotFoundError):
        zones.read_zones(spark, log, path("nothing"))


@pytest.mark.parametrize("seed", [0, 3])
def test_closest_rows_from_few_files(spark, frame, path, seed):
    rng = random.Random(seed)
    log, kept = path("log"), path("zones")
    times, t = [], 0
    for k in range(900):
        t += rng.choice([0, 1, 50, 2_000, 200_000 if rng.random() < 0.02 else 10])
        times.append((k, at(t + (rng.randrange(-300, 300) if seed % 2 else 0))))
    times += [(5_000, None), (None, at(7))] if seed == 3 else []
    _log(frame, log, times, 16)
    zones.refresh_zones(spark, log, kept, "id", "t", zone_rows=20)
    zone_map = zones.read_zones(spark, log, kept)
    whole = spark.read.parquet(log)
    for direction in ("before", "after"):
        for target in [at(rng.randrange(-1000, t + 1000)) for _ in range(1)] + [rng.choice(times[:900])[1]]:
            got = zones.id_at_time_in_zones(spark, zone_map, "id", "t", target, direction)
            assert rows(got) == rows(bounds.id_at_time(whole, "id", "t", target, direction))
    first, last = T0.date() - dt.timedelta(days=1), at(t).date() + dt.timedelta(days=1)
    got = zones.day_bounds_in_zones(spark, zone_map, "id", "t", first, last)
    assert rows(got, "start") == rows(bounds.day_bounds(whole, "id", "t", first, last), "start")


def test_few_files_are_opened(spark, frame, path):
    log, kept = path("log"), path("zones")
    _log(frame, log, [(k, at(30 * k)) for k in range(40 * 2880)], 40)
    zones.refresh_zones(spark, log, kept, "id", "t", zone_rows=1000)
    zone_map = zones.read_zones(spark, log, kept)
    n_files = len(whole := spark.read.parquet(log).inputFiles())
    wanted = zones.zones_at_times(zone_map, frame("at timestamp_ntz", (at(86_400 * 17 + 5),)))
    assert n_files == 40 == len(whole) and len(zones.files_of(wanted)) <= 2
    day = T0.date() + dt.timedelta(days=20)
    spines = [zones.zones_at_times(zone_map, bounds.day_spine(spark, day, day).select(F.col("start").alias("at")), d) for d in ("before", "after")]
    assert len({f for s in spines for f in zones.files_of(s)}) <= 3
    ranged = zones.id_range_in_zones(spark, zone_map, ["id"], "id", 50_000, 52_000, spark.read.parquet(log).schema)
    assert ranged.count() == 2001 and len(ranged.inputFiles()) <= 2
    assert zones.id_range_in_zones(spark, zone_map, ["id"], "id", -9, -1, spark.read.parquet(log).schema).isEmpty()
