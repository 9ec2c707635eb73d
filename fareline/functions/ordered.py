"""Row numbers and look-ahead inside ordered groups, safe for very large groups.

A plain window puts a whole group into one task. The functions here first look for groups of very many rows: the input
is pinned, and the keys of a sample of it are counted by an ordinary aggregate. Without such groups the plain window is
the plan. With them, only their rows take a second way: range-partitioned by (group, order) into ranges of a bounded
number of rows, pinned, numbered inside each range, and corrected by per-range totals, which are as few as the ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.session import pin

# A group is heavy from about this many rows on, whatever its share of the table.
HEAVY_ROWS = 1_000_000
# Rows of a heavy group's keys that the sample should hold: their number varies by a thirtieth.
_SAMPLED = 1_000
# Rows in a range of a heavy group.
RANGE_ROWS = 1_000_000
# Characters in a page of a group's joined text, give or take one row.
PAGE_CHARS = 4_096


def heavy_groups(df: DataFrame, keys: list[str], rows: int = HEAVY_ROWS) -> list[int]:
    """Hashes of the keys of groups of about `rows` rows or more: no more of them than rows / `rows`.

    Groups a little smaller may be among them, which is harmless: both ways give the same rows.
    """
    share = min(1.0, _SAMPLED / rows)
    # Drawn first: keys are made for the sample alone.
    drawn = df.sample(share, seed=5) if share < 1.0 else df
    hashes = drawn.select(F.xxhash64(*keys).alias("h"))
    least = rows if share == 1.0 else 0.8 * rows * share
    found = hashes.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return [r.h for r in found.select("h").collect()]


def _split(df: DataFrame, keys: list[str], rows: int, distinct: bool, pinned: bool = False):
    """Rows of ordinary groups, and those of heavy ones if there are any; each without repeats if `distinct`.

    A table that is `pinned` already, or gives the same rows whenever it is read, is not pinned again.
    """
    df = df if pinned else pin(df)
    heavy = heavy_groups(df, keys, rows)
    light, rest = df, None
    if heavy:
        is_heavy = F.xxhash64(*keys).isin(heavy)
        light, rest = df.where(~is_heavy), df.where(is_heavy)
    if distinct:
        # Placed by group once, rows are de-duplicated and ordered without a further shuffle.
        light = light.repartition(*keys).distinct()
        rest = None if rest is None else rest.distinct()
    return light, rest


def range_count(df: DataFrame, range_rows: int = RANGE_ROWS, rows: int | None = None) -> int:
    """Ranges for a pinned table, or one of `rows` rows at most: enough that none has many more than `range_rows` rows."""
    rows = df.count() if rows is None else rows
    return max(1, -(-rows // range_rows), df.sparkSession.sparkContext.defaultParallelism)


def _into_ranges(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    # `__tie` lets even rows with equal keys and order values spread over several ranges.
    df = pin(df)
    return pin(
        df.withColumn("__tie", F.monotonically_increasing_id())
        .repartitionByRange(range_count(df), *keys, *order, "__tie")
        .withColumn("__range", F.spark_partition_id())
    )


def _spanning(ranges: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """Aggregates per (group, range) for the groups that start a range, hence may span several.

    As few rows as ranges, give or take a factor of two. Struct equality takes null keys as equal.
    """
    starts = ranges.groupBy("__range").agg(F.min(F.struct(*keys)).alias("__key"))
    rows = ranges.join(
        F.broadcast(starts.select("__key").distinct()), F.struct(*keys) == F.col("__key"), "left_semi"
    )
    return rows.groupBy(F.struct(*keys).alias("__key"), F.col("__range").alias("__at")).agg(
        *aggregates
    )


def _with_spanning(ranges: DataFrame, spanning: DataFrame, keys: list[str]) -> DataFrame:
    here = (F.struct(*keys) == F.col("__key")) & (F.col("__range") == F.col("__at"))
    return ranges.join(F.broadcast(spanning), here, "left").drop("__key", "__at")


def _numbered_in_ranges(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    ranges = _into_ranges(df, keys, order)
    totals = _spanning(ranges, keys, F.count("*").alias("__n"))
    earlier = Window.partitionBy("__key").orderBy("__at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = totals.withColumn("__before", F.sum("__n").over(earlier))
    inside = Window.partitionBy("__range", *keys).orderBy(*order, "__tie")
    return (
        _with_spanning(ranges, totals.drop("__n"), keys)
        .withColumn(name, F.row_number().over(inside) + F.coalesce("__before", F.lit(0)))
        .drop("__tie", "__range", "__before")
    )


def number_rows(
    df: DataFrame, keys: list[str], order: list[str], name: str,
    distinct: bool = False, rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Add `name`: 1, 2, 3.. inside each group, as bigint; on `distinct` rows if asked."""
    light, heavy = _split(df, keys, rows, distinct)
    window = Window.partitionBy(*keys).orderBy(*order)
    out = light.withColumn(name, F.row_number().over(window).cast("bigint"))
    if heavy is None:
        return out
    return out.unionByName(_numbered_in_ranges(heavy, keys, order, name))


def number_all_rows(df: DataFrame, order: list[str], name: str, first: int = 0) -> DataFrame:
    """Add `name`: first, first+1, .. over the whole table in a total order.

    No single task sees the whole table: rows are numbered inside ranges and shifted by the number of
    rows in earlier ranges. Pins the table, since range edges come from sampling.
    """
    df = pin(df).withColumn("__tie", F.monotonically_increasing_id())
    ranges = df.repartitionByRange(range_count(df), *order, "__tie").sortWithinPartitions(*order, "__tie").drop("__tie")
    # The number of the range stands in the upper bits, the place inside it in the lower 33: no second shuffle.
    ranges = pin(ranges.withColumn("__place", F.monotonically_increasing_id()))
    of = F.shiftright("__place", 33)
    totals = ranges.groupBy(of.alias("__at")).agg(F.count("*").alias("__n"))
    earlier = Window.orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("__at", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    place = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    return ranges.join(F.broadcast(before), of == F.col("__at")).withColumn(name, place + F.col("__before") + first).drop("__place", "__at", "__before")


def distinct_ahead(df: DataFrame, keys: list[str], order: list[str], taken: dict[str, str]) -> DataFrame:
    """The distinct rows, with the value of each `new name -> column` of `taken` in the group's next one.

    One sort brings equal rows together, the last of which stays. Rows that are placed by some of `keys` already are not
    shuffled.
    """
    rest = [c for c in df.columns if c not in (*keys, *order)]
    row, window = F.struct(*order, *rest), Window.partitionBy(*keys).orderBy(*order, *rest)
    ahead = {new: F.lead(c).over(window) for new, c in taken.items()}
    repeated = row.eqNullSafe(F.lead(row).over(window))
    return df.withColumns({**ahead, "__repeated": repeated}).where(~F.col("__repeated")).drop("__repeated")


def look_ahead(
    df: DataFrame, keys: list[str], order: list[str], taken: dict[str, str],
    distinct: bool = False, rows: int = HEAVY_ROWS, pinned: bool = False,
) -> DataFrame:
    """Add, for each `new name -> column` of `taken`, the column's value in the group's next row.

    Ordinary groups stay where they are, if that is one task for each group.
    """
    light, heavy = _split(df, keys, rows, False, pinned)
    if distinct:
        out = distinct_ahead(light, keys, order, taken)
        heavy = None if heavy is None else heavy.distinct()
    else:
        window = Window.partitionBy(*keys).orderBy(*order)
        out = light.withColumns({new: F.lead(c).over(window) for new, c in taken.items()})
    if heavy is None:
        return out

    ranges = _into_ranges(heavy, keys, order)
    first = F.min_by(F.struct(*taken.values()), F.struct(*order, "__tie"))
    heads = _spanning(ranges, keys, first.alias("__head"))
    onward = Window.partitionBy("__key").orderBy("__at")
    heads = heads.withColumn("__head", F.lead("__head").over(onward))
    inside = Window.partitionBy("__range", *keys).orderBy(*order, "__tie")
    is_last = F.lead(F.lit(1)).over(inside).isNull()
    stitched = _with_spanning(ranges, heads, keys).withColumns(
        {
            new: F.when(is_last, F.col("__head")[c]).otherwise(F.lead(c).over(inside))
            for new, c in taken.items()
        }
    )
    return out.unionByName(stitched.drop("__tie", "__range", "__head"))


def fill_forward(
    df: DataFrame, keys: list[str], order: list[str], filled: list[str],
    rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Replace nulls of the `filled` columns by the group's last known value."""
    light, heavy = _split(df, keys, rows, distinct=False)
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    out = light.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in filled})
    if heavy is None:
        return out

    ranges = _into_ranges(heavy, keys, order)
    place = F.struct(*order, "__tie")
    known = [F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"__known_{c}") for c in filled]
    lasts = _spanning(ranges, keys, *known)
    earlier = Window.partitionBy("__key").orderBy("__at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = {f"__known_{c}": F.last(f"__known_{c}", ignorenulls=True).over(earlier) for c in filled}
    inside = Window.partitionBy("__range", *keys).orderBy(*order, "__tie").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    stitched = _with_spanning(ranges, lasts.withColumns(carried), keys).withColumns(
        {c: F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"__known_{c}")) for c in filled}
    )
    return out.unionByName(stitched.select(*out.columns))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def digest_in_order(
    df: DataFrame, keys: list[str], order: list[str], text: Column, separator: str = "|", pinned: bool = False,
    distinct: bool = False, rows: int | None = None,
) -> DataFrame:
    """Per group its rows (`n`) and the MD5 of its texts, joined in order (`digest`; null without any text).

    No row ever holds a group: the table is sorted by ranges, each range makes pages of joined texts, and the pages of a
    group pass through one digest, a batch at a time. That last step is sequential by nature, but it keeps nothing.
    With `distinct` equal rows count once: they meet in the sort, not in a shuffle of their own (floating-point columns are
    not meant). `rows`, a bound on the rows of a table that is `pinned` or the same whenever it is read, saves counting them.
    """
    df = df if pinned else pin(df)
    compared = [c for c in df.columns if c not in keys] if distinct else []
    # Equal rows must lie in one range to meet; else a tie lets them spread over several.
    ties = [c for c in compared if c not in order] if distinct else ["__tie"]
    placed = (
        (df if distinct else df.withColumn("__tie", F.monotonically_increasing_id()))
        .repartitionByRange(range_count(df, rows=rows), *keys, *order, *ties)
        .sortWithinPartitions(*keys, *order, *ties)
        .select(*keys, F.monotonically_increasing_id().alias("__place"), text.alias("__text"), *compared)
    )
    own = [placed.schema[k] for k in keys]
    page = T.StructType([*own, *[T.StructField(c, T.LongType()) for c in ("__place", "n", "__known")], T.StructField("__page", T.StringType())])
    width = PAGE_CHARS

    def changes(batch: pa.RecordBatch) -> np.ndarray:
        """Whether a row differs from the one before it, nulls being equal; the first does."""
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for column in batch.columns:
            a, b = column[:-1], column[1:]
            differ = pc.coalesce(pc.not_equal(a, b), pc.xor(pc.is_null(a), pc.is_null(b)))
            new[1:] |= differ.to_numpy(zero_copy_only=False)
        return new

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if distinct and batch.num_rows:
                each = batch.select([*keys, *compared])
                fresh = changes(each)
                fresh[0] = each.slice(0, 1).to_pylist() != last
                last = each.slice(len(fresh) - 1).to_pylist()
                batch = batch.filter(pa.array(fresh))
            if not batch.num_rows:
                continue
            new = changes(batch.select(keys))
            texts = batch.column("__text")
            filled = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy()) // width
            new[1:] |= filled[1:] != filled[:-1]
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(new))
            known = [[t for t in texts[i : j].to_pylist() if t is not None] for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
            first = batch.select([*keys, "__place"]).take(pa.array(starts))
            more = [pa.array(ends - starts), pa.array([len(x) for x in known], pa.int64()), pa.array([separator.join(x) for x in known], pa.string())]
            yield pa.RecordBatch.from_arrays([*first.columns, *more], names=page.names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, seen, whole = None, 0, False, hashlib.md5()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in [*keys, "n", "__known", "__page"]]
            done = []
            for *key, count, known, joined in zip(*columns, strict=True):
                if key != at:
                    if at is not None:
                        done.append((*at, n, whole.hexdigest() if seen else None))
                    at, n, seen, whole = key, 0, False, hashlib.md5()
                n += count
                if known:
                    whole.update(((separator if seen else "") + joined).encode())
                    seen = True
            if done:
                yield made(done)
        if at is not None:
            yield made([(*at, n, whole.hexdigest() if seen else None)])

    out = T.StructType([*own, T.StructField("n", T.LongType()), T.StructField("digest", T.StringType())])
    types = [pa.field(f.name, t.type) for f, t in zip(out, _arrow(out), strict=True)]

    def made(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types, strict=True)], schema=pa.schema(types))

    together = placed.mapInArrow(pages, page).repartition(*keys).sortWithinPartitions(*keys, "__place")
    return together.mapInArrow(digests, out)
