"""Text with line feeds inside quotes, divided in many ways, against the one-task reader."""

import random

import pytest
from pyspark.sql import functions as F

from fareline.sources.multiline import first_states, read_records, read_text_divided
from fareline.sources.scans import read_text
from fareline.sources.sinks import write_text

SCHEMA = "id long, text string, n int, note string"


@pytest.fixture
def divided(spark):
    """Divide files every 700 bytes."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def _texts(seed, n=200):
    rng = random.Random(seed)
    bits = ["a", "bc", ";", '"', "\n", "\n\n", "é", "\r", " ", '""', "\\", "日本", "\n;\n"]
    text = lambda: rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.randrange(30)))])
    return [(k, text(), rng.choice([None, k]), text()) for k in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_like_one_task(spark, frame, path, divided, seed):
    given = _texts(seed) + [(9_000 + seed, "line\n" * 1_000, 1, '"' * 3_000 + "\n"), (9_100, "x\n" * 5, 1, "y")]
    at = path()
    write_text(frame(SCHEMA, *given).coalesce(2), at, exact_nulls=True)
    schema = frame(SCHEMA).schema
    one = read_text(spark, at, schema, exact_nulls=True)
    many = read_text_divided(spark, at, schema, exact_nulls=True)
    key = lambda r: (r[0], str(r))
    assert sorted(map(tuple, many.collect()), key=key) == sorted(given, key=key) == sorted(map(tuple, one.collect()), key=key)
    lines = spark.read.option("lineSep", "\n").text(at)
    assert lines.rdd.getNumPartitions() > 20
    states = first_states(lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), "value"))
    assert states.where("inside").count() > 2 and states.where("not inside").count() > 2
    places = [tuple(r) for r in read_records(spark, at).select("file", "begin", "number").collect()]
    assert len(places) == len(set(places)) == len(given) + 2


def test_compressed_empty_and_named_files(spark, frame, path, divided):
    given = _texts(8, 50)
    at = path()
    rows = frame(SCHEMA, *given).withColumn("export", F.concat(F.lit("day"), F.col("id") % 3))
    write_text(rows, at, by="export", exact_nulls=True, compressed=True)
    schema = frame(SCHEMA).schema
    got = read_text_divided(spark, at, schema, exact_nulls=True, file="file")
    assert got.columns == [*schema.names, "file"] and got.select("file").distinct().count() >= 3
    assert sorted(str(tuple(r)[:4]) for r in got.collect()) == sorted(map(str, given))
    none = path()
    write_text(frame(SCHEMA), none)
    assert read_text_divided(spark, none, schema).collect() == []


def test_rows_that_do_not_parse(spark, frame, path, divided):
    at = path()
    write_text(frame("id string, text string, n int, note string", ("1", "a\nb", 1, None), ("x", "c\nd", 2, None)), at)
    schema = frame(SCHEMA).schema
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_text_divided(spark, at, schema).collect()
    lenient = read_text_divided(spark, at, schema, strict=False)
    assert sorted((r.id or 0, r.bad_row is not None) for r in lenient.collect()) == [(0, True), (1, False)]
