"""Near-duplicate documents by MinHash with tensored banding; every link is confirmed on the full shingle sets.

A document has two collections of half keys, each made of a few minhashes; the key of table (i, j) joins half key i of
the first collection with half key j of the second. m + m half keys thus make m * m tables, for the square root of the
minhashes that as many tables of their own would need.

1. Equal shingle sets collapse to their smallest document; only distinct sets go on.
2. Each table bucket links its members with its smallest one. Candidates pass an estimate from all minhashes, are
   confirmed on full sets, and confirmed links make components.
3. Buckets whose members still are in several components get what is between these: each pair of different components
   in small buckets; the members of crowded ones are dealt into blocks, and each pair of blocks counts its
   intersections as one matrix product and gives out links alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.llm.graph import components
from fareline.llm.shipping import ship
from fareline.llm.text import SPACE, Texts, hashes, mixed, slices, spans
from fareline.session import broadcast_if_small, pin

SHINGLE = 5
PERCENT = 85
#: Minhashes in each half key, and the probability with which a pair at the least similarity may miss all tables.
ROWS, MISSED = 3, 0.001
#: Buckets of up to this many distinct sets have their pairs listed.
CROWDED = 24
#: Shingles in a block of a crowd: from the first number on a crowd has several blocks, and none has more than the second.
BLOCK = 50_000, 1_000_000
#: Documents in a block of a crowd, on the average; documents of a pair of blocks that are compared with all others at once.
BLOCK_DOCS, STRIP = 2_000, 512
#: IDs that may be broadcast, after they have been counted.
BROADCAST_IDS = 1_000_000

_rng = np.random.default_rng(850_005)
_MIX = _rng.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIPS, _FACTORS = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: Texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all documents, and the bounds of each document's.

    Words are runs of characters other than ASCII white space, A-Z as a-z. A document of fewer than `size` words has
    its whole sequence as its one shingle; one without words has none.
    """
    starts, ends, first = spans(texts, ~SPACE)
    words, n_words = hashes(texts.data, starts, ends, lower=True), np.diff(first)
    sums = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        sums += words[k : k + len(sums)] * _MIX[k]
    inside = np.maximum(n_words - size + 1, 0)
    counts = np.where((n_words > 0) & (n_words < size), 1, inside)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(counts, out=bounds[1:])
    out = np.empty(int(bounds[-1]), np.uint64)
    for k in np.flatnonzero(counts).tolist():
        a, b = first[k], first[k + 1]
        if b - a < size:
            out[bounds[k]] = (words[a:b] * _MIX[: b - a]).sum() + np.uint64(b - a)
        else:
            part = out[bounds[k] : bounds[k + 1]]
            part[:] = sums[a : b - size + 1]
            part.sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[bounds[:-1][counts > 0]] = True
    kept = np.zeros(len(out) + 1, np.int64)
    np.cumsum(new, out=kept[1:])
    # Sums of word hashes are not spread well enough for minhashes; mixing is one to one.
    return mixed(out[new]), kept[bounds]


def halves_for(percent: int, rows: int = ROWS, missed: float = MISSED) -> int:
    """Half keys in each of the two collections so that a pair at `percent` misses all tables with a probability of at most
    `missed`: it meets in a table if it has an equal half key in both collections."""
    halves = 1
    while 1 - (1 - (1 - (percent / 100) ** rows) ** halves) ** 2 > missed:
        halves += 1
    return halves


def _signatures(halves: int, rows: int, size: int):
    n_hashes = 2 * halves * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "__text", 1 << 20):
                sets, bounds = shingle_sets(texts, size)
                n = np.diff(bounds)
                some = np.flatnonzero(n)
                at = bounds[:-1][some]
                least = np.zeros((len(texts), n_hashes), np.uint32)
                one, two = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)
                if len(some):
                    for k in range(n_hashes):
                        values = (((sets ^ _FLIPS[k]) * _FACTORS[k]) >> np.uint64(32)).astype(np.uint32)
                        least[some, k] = np.minimum.reduceat(values, at)
                    one[some] = np.add.reduceat(sets, at)
                    two[some] = np.bitwise_xor.reduceat(mixed(sets), at)
                keys = (least.reshape(-1, 2 * halves, rows).astype(np.uint64) * _MIX[:rows]).sum(2)
                keys = mixed(keys).view(np.int64)
                sketch = (least & 0xFF).astype(np.uint8)
                width = pa.int32()
                yield pa.RecordBatch.from_arrays(
                    [part.column("__id"), pa.array(n), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * 2 * halves, width), pa.array(keys.ravel())),
                     pa.array([r.tobytes() for r in sketch], pa.binary())],
                    names=["doc_id", "n", "h1", "h2", "halves", "sketch"],
                )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "__text", 1 << 20):
                sets, bounds = shingle_sets(texts, size)
                held = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("__id"), held], names=["id", "set"])

    return run


def _alike(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sa", "sb"))
                on = pa.array((one == two).sum(1) >= least)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(on), batch.column("b").filter(on)], names=["a", "b"])

    return run


class _Job:
    def __init__(self, rows: DataFrame, percent: int, size: int, halves: int, per_half: int):
        self.rows, self.percent, self.size, self.halves = rows, percent, size, halves
        share, n = percent / 100, 2 * halves * per_half
        # 4.5 standard deviations below the expected number of equal minhashes.
        self.least = int(share * n - 4.5 * (share * (1 - share) * n) ** 0.5)
        self.id_type = rows.schema["__id"].dataType

    def confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Those pairs (a, b) of distinct sets that the full shingle sets confirm; pins the result."""
        side = lambda c: sets.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
        close = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent
        schema = T.StructType([T.StructField("a", self.id_type), T.StructField("b", self.id_type)])
        likely = pin(pairs.join(side("a"), "a").join(side("b"), "b").where(close).mapInArrow(_alike(self.least), schema))
        full = self.full_sets(likely.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        one, two = full.select(F.col("id").alias("a"), F.col("set").alias("sa")), full.select(F.col("id").alias("b"), F.col("set").alias("sb"))
        both = F.size(F.array_intersect("sa", "sb"))
        union = F.size("sa") + F.size("sb") - both
        return pin(likely.join(one, "a").join(two, "b").where(both * 100 >= union * self.percent).select("a", "b"))

    def full_sets(self, ids: DataFrame) -> DataFrame:
        """(id, set) of the given documents, made anew from their texts; pinned."""
        wanted = broadcast_if_small(pin(ids), BROADCAST_IDS)
        rows = self.rows.join(wanted, self.rows["__id"] == wanted["id"], "left_semi")
        schema = T.StructType([T.StructField("id", self.id_type), T.StructField("set", T.ArrayType(T.LongType()))])
        return pin(rows.mapInArrow(_sets(self.size), schema))

    def crowded_links(self, members: DataFrame) -> DataFrame:
        """All links between different components among `members` (rep, center, component), crowd by crowd.

        A crowd is what crowded buckets connect. Its sets are dealt into blocks; each pair of blocks is one group of
        bounded size, which counts all intersections at once and returns the links alone.
        """
        edges = components(members.select(F.col("rep").alias("a"), F.col("center").alias("b")))
        own = members.select(F.col("rep").alias("id"), "component").distinct()
        named = own.join(edges.select(F.col("node").alias("id"), F.col("component").alias("crowd")), "id")
        sets = self.full_sets(named.select("id")).join(named, "id")
        sets = pin(sets.withColumn("n", F.size("set").cast("long")))
        sizes = sets.groupBy("crowd").agg(F.sum("n").alias("total"), F.count("*").alias("docs"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        most = F.greatest(F.lit(1), F.least(F.lit(40), F.ceil(F.col("total") / BLOCK[0])), F.ceil(F.col("total") / BLOCK[1]), F.ceil(F.col("docs") / BLOCK_DOCS)).cast("int")
        sizes = sizes.where("lo < hi").select("crowd", most.alias("blocks"))
        dealt = sets.join(broadcast_if_small(pin(sizes)), "crowd").withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select("id", "set", "component", "crowd", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
        schema = T.StructType([T.StructField("a", self.id_type), T.StructField("b", self.id_type)])
        return pin(dealt.groupBy("crowd", "one", "two").applyInArrow(_links_within(self.percent), schema).distinct())


def _links_within(percent: int):
    def run(group: pa.Table) -> pa.Table:
        _, component = np.unique(group.column("component").to_numpy(zero_copy_only=False), return_inverse=True)
        column = group.column("set").combine_chunks()
        n = np.diff(column.offsets.to_numpy())
        row = np.repeat(np.arange(len(n)), n)
        kinds, kind = np.unique(column.flatten().to_numpy(), return_inverse=True)
        shared = np.bincount(kind) > 1
        place = np.cumsum(shared) - 1
        on = shared[kind]
        row, kind = row[on], place[kind[on]]
        order = np.argsort(kind, kind="stable")
        row, kind = row[order], kind[order]
        found = []
        # A strip of rows against all documents at a time: memory is linear in the documents of the group.
        for top in range(0, len(n), STRIP):
            end = min(top + STRIP, len(n))
            both = np.zeros((end - top, len(n)), np.float32)
            # Only shingles that a row of the strip has.
            mine = np.unique(kind[(row >= top) & (row < end)])
            at = np.minimum(np.searchsorted(mine, kind), max(0, len(mine) - 1))
            on = mine[at] == kind if len(mine) else np.zeros(len(kind), bool)
            rows, places = row[on], at[on]
            for low in range(0, len(mine), 2048):
                i, j = np.searchsorted(places, (low, low + 2048))
                held = np.zeros((len(n), min(2048, len(mine) - low)), np.float32)
                held[rows[i:j], places[i:j] - low] = 1
                both += held[top:end] @ held.T
            linked = both * 100 >= (n[top:end, None] + n[None, :] - both) * percent
            linked &= component[top:end, None] < component[None, :]
            x, y = np.nonzero(linked)
            found.append((x + top, y))
        a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
        ids = group.column("id").combine_chunks()
        return pa.table({"a": ids.take(pa.array(a)), "b": ids.take(pa.array(b))})

    return run


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, shingle: int = SHINGLE,
    halves: int | None = None, rows: int = ROWS, crowded: int = CROWDED,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Documents whose shingle sets have 100 * intersection >= `percent` * union are linked; component_id is the smallest
    ID reachable over links. A row is kept if it has its component's name. Null and empty texts have no shingles and no
    links. Rows of equal ID count each by its own text, and all of them are kept where their ID is the component's
    name; a row without an ID has no links, a null component, and is kept. An empty table gives no rows; other columns
    take no part.
    """
    halves = halves or halves_for(percent, rows)
    given = ship(docs).select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    job = _Job(given.where("__id is not null"), percent, shingle, halves, rows)
    schema = T.StructType(
        [T.StructField("doc_id", job.id_type), *(T.StructField(c, T.LongType()) for c in ("n", "h1", "h2")),
         T.StructField("halves", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())]
    )
    signed = pin(given.mapInArrow(_signatures(halves, rows, shingle), schema))
    same = F.any_value("halves").alias("halves"), F.any_value("sketch").alias("sketch")
    sets = pin(signed.where("n > 0 and doc_id is not null").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"), *same))

    tables = F.sequence(F.lit(0), F.lit(halves * halves - 1))
    key = lambda k: F.xxhash64(k, F.get("halves", F.floor(k / halves)), F.get("halves", halves + k % halves))
    keys = sets.select("rep", F.explode(F.transform(tables, key)).alias("key"))
    buckets = keys.groupBy("key").agg(F.count("*").alias("c"), F.min("rep").alias("center")).where("c > 1")
    members = pin(keys.join(buckets, "key"))

    star = members.where("rep != center").select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct()
    links = job.confirmed(star, sets)
    label = components(links)
    named = members.join(label.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    named = pin(named.select("key", "rep", "c", "center", "component"))
    open_keys = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    rest = pin(named.join(open_keys, "key"))

    small = rest.where(F.col("c") <= crowded).groupBy("key").agg(F.collect_list(F.struct("rep", "component")).alias("all"))
    pair = small.select(F.explode("all").alias("x"), "all").select("x", F.explode("all").alias("y"))
    pair = pair.where("x.component < y.component")
    pair = pair.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()
    pair = pair.join(star, ["a", "b"], "left_anti")  # a star's center is its smallest member
    more = [job.confirmed(pair, sets)]
    many = rest.where(F.col("c") > crowded).select("rep", "center", "component").distinct()
    if not many.isEmpty():
        more.append(job.crowded_links(pin(many)))
    found = more[0] if len(more) == 1 else more[0].unionByName(more[1])
    if not found.isEmpty():
        named = label.select(F.col("node").alias("a"), F.col("component").alias("b"))
        label = components(named.unionByName(found))

    final = sets.join(label.withColumnRenamed("node", "rep"), "rep", "left")
    final = pin(final.select("h1", "h2", "n", F.coalesce("component", "rep").alias("component")))
    out = signed.select("doc_id", "n", "h1", "h2").join(final, ["h1", "h2", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )
