"""Delimited text whose quoted values hold line feeds, read by many tasks.

A large file is divided at line feeds, wherever these fall. Whether a divided part begins inside a quoted value follows
from the number of quotes before it: each part tells, for either state at its begin, the state at its end (it keeps or
turns it, by the parity of its quotes), and these compose in any grouping, so that one small row for each part is enough.
With its first state known a part finds its records by itself. What a record's border cuts off at a part's begin or end is
a few lines; these alone are put together again, by file. Values hold quotes only doubled and inside quotes, as `write_text`
writes them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.sources.scans import EXACT_NULLS, TEXT

_PART = ["file", "begin"]


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All lines with the file and the first byte of the divided part they were read in; a part's lines stay in order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), "value"
    )


def first_states(lines: DataFrame) -> DataFrame:
    """(file, begin, inside): whether each divided part begins inside a quoted value. A row for each part."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    parts = lines.groupBy(*_PART).agg((F.sum(quotes) % 2).alias("turns"))
    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(*_PART, (F.coalesce(F.sum("turns").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _cutter():
    """The function of the workers; it refers to nothing of this package, which they need not have."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # part: the one being read; open_: lines of a record not yet ended; headless: the record began in an earlier part.
        part, open_, headless, number, state = None, [], False, 0, False

        def batch_of(file, begin, numbers, kinds, records):
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [pa.array([file] * n, pa.string()), pa.array([begin] * n, pa.int64()), pa.array(numbers, pa.int64()),
                 pa.array(kinds, pa.string()), pa.array(records, pa.string())],
                names=["file", "begin", "number", "kind", "record"],
            )

        def leave():
            # The record that is open at the part's end: a tail, or the middle of one that fills the whole part.
            kind = "middle" if headless else "tail"
            return batch_of(*part, [number], [kind], ["\n".join(open_)]) if open_ else None

        for batch in batches:
            files, begins, inside = batch.column("file"), batch.column("begin").to_numpy(), batch.column("inside")
            codes = files.dictionary_encode().indices.to_numpy()
            edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(begins) != 0)) + 1
            for i, j in zip(np.append(0, edges).tolist(), np.append(edges, batch.num_rows).tolist(), strict=True):
                if i == j:
                    continue
                here = (files[i].as_py(), int(begins[i]))
                if here != part:
                    last = leave() if part is not None else None
                    if last is not None:
                        yield last
                    if inside[i].as_py() is None:
                        raise RuntimeError("the file was divided in another way than before; read it again")
                    part, open_, number, state = here, [], 0, bool(inside[i].as_py())
                    headless = state
                value = batch.column("value").slice(i, j - i)
                odd = pc.count_substring(value, '"').to_numpy() % 2
                states = (np.cumsum(odd) + state) % 2
                ends = np.flatnonzero(states == 0)
                state = bool(states[-1])
                lines = value.to_pylist()
                at, records, kinds = 0, [], []
                for end in ends.tolist():
                    records.append("\n".join([*open_, *lines[at : end + 1]]) if open_ or end > at else lines[end])
                    kinds.append("head" if headless else "whole")
                    open_, headless, at = [], False, end + 1
                open_ += lines[at:]
                if records:
                    yield batch_of(*part, range(number, number + len(records)), kinds, records)
                    number += len(records)
        last = leave() if part is not None else None
        if last is not None:
            yield last

    return cut


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, begin, number, record): every record as text, with its place; the first one of a file is its header."""
    lines = _lines(spark, path)
    # As many rows as there are tasks that read.
    known = lines.join(F.broadcast(first_states(lines)), _PART, "left")
    cut = known.mapInArrow(_cutter(), "file string, begin long, number long, kind string, record string")
    whole = cut.where("kind = 'whole'").drop("kind")
    # At most two rows a part: the end of a record that began before, and the begin of one that goes on.
    bits = cut.where("kind != 'whole'")
    order = Window.partitionBy("file").orderBy("begin", "number")
    chain = F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(order)
    bits = bits.withColumn("chain", chain).groupBy("file", "chain").agg(F.array_sort(F.collect_list(F.struct("begin", "number", "record"))).alias("bits"))
    mended = bits.select(
        "file", F.col("bits")[0]["begin"].alias("begin"), F.col("bits")[0]["number"].alias("number"),
        F.array_join(F.transform("bits", lambda b: b["record"]), "\n").alias("record"),
    )
    return whole.unionByName(mended)


def read_text_divided(
    spark: SparkSession, path: str | list[str], schema: T.StructType, *, strict: bool = True, exact_nulls: bool = False,
    sep: str = ";", bad_row: str = "bad_row", file: str | None = None,
) -> DataFrame:
    """As `read_text` with values over several lines, but a large file is divided among tasks.

    `file` names a column for the path of each row's file. A file that ends inside a quoted value fails if `strict`.
    """
    records = read_records(spark, path).where("record != '' and not (begin = 0 and number = 0)")
    options = {**TEXT, "sep": sep, "header": "false", "mode": "FAILFAST" if strict else "PERMISSIVE"}
    if exact_nulls:
        options |= EXACT_NULLS
    wanted = schema if strict else T.StructType([*schema.fields, T.StructField(bad_row, T.StringType())])
    if not strict:
        options["columnNameOfCorruptRecord"] = bad_row
    parsed = records.select("file", F.from_csv("record", F.lit(wanted.toDDL()), options).alias("row"))
    return parsed.select(*[F.col("row")[c].alias(c) for c in wanted.names], *([F.col("file").alias(file)] if file else []))
