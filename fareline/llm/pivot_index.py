"""Exact top-k inner products by a pivot-distance index.

With one more coordinate, sqrt(M^2 - |x|^2) for the largest norm M, vectors x lie on a sphere, and the inner product
with a query falls as the distance to it grows. Each vector is keyed by its nearest pivot and its distance to it. Sorted
by that key, the vectors of a pivot form annuli, which are stored as blocks with their least and greatest distance.

A search first scans each query's own pivot, which gives it a k-th best score to beat. Then, pivot by pivot, annuli
count whose distances to the pivot, by the triangle inequality, leave room for such a score; all others are passed
over. Pivots come from a bounded sample; every vector is indexed, and the result is exact whatever the pivots are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareline.llm.shipping import ship
from fareline.session import pin

PIVOTS, SAMPLE = 64, 4096
#: Vectors in a stored annulus, and queries that are searched together (and broadcast).
ANNULUS, QUERY_BLOCK = 512, 4096
#: Share of M^2 that bounds are widened by, for the rounding of distances.
SLACK = 1e-9


#: Squared length from which scores may not fit into 64 bits, and a floor below all scores.
LONGEST, LEAST = float(2**63), np.iinfo(np.int64).min


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, as an array of longs; null if a component is null or not finite."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    n = np.asarray(pa.compute.list_value_length(column), np.int64)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def _lifted(x: np.ndarray, norm2: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(norm2 - (x * x).sum(1), 0))])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T, 0))


def choose_pivots(sample: np.ndarray, n: int, rounds: int = 5) -> np.ndarray:
    """Centers of a few rounds of k-means over the sample."""
    pivots = np.unique(sample, axis=0)[:: max(1, len(np.unique(sample, axis=0)) // n)][:n].astype(float)
    for _ in range(rounds):
        nearest = _distances(sample, pivots).argmin(1)
        counts = np.bincount(nearest, minlength=len(pivots))
        sums = np.zeros_like(pivots)
        np.add.at(sums, nearest, sample)
        pivots[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return pivots


class Index:
    """An index that is written as a table of annuli: pivot, low, high, ids, vectors."""

    def __init__(self, vectors: DataFrame, id: str, vector: str, n_pivots: int = PIVOTS, sample: int = SAMPLE):
        rows = ship(vectors).where(F.col(id).isNotNull() & F.col(vector).isNotNull()).select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v"))
        norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        self.vectors = rows
        top = rows.agg(F.max(norm), F.max(F.size("v"))).first()
        self.norm2, self.width = float(top[0] or 0), int(top[1] or 0)
        if self.norm2 >= LONGEST:
            raise OverflowError(f"a squared length of {self.norm2:.3g}: scores would not fit into 64 bits")
        drawn = rows.orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()
        self.pivots = np.zeros((1, self.width + 1))
        if drawn.num_rows:
            self.pivots = choose_pivots(_lifted(_matrix(drawn.column("v"), self.width), self.norm2), n_pivots)
        pivots, norm2, width = self.pivots, self.norm2, self.width

        def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    away = _distances(_lifted(_matrix(batch.column("v"), width), norm2), pivots)
                    nearest = away.argmin(1)
                    away = away[np.arange(len(nearest)), nearest]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nearest.astype(np.int32)), pa.array(away), batch.column("id"), batch.column("v")], names=["pivot", "away", "id", "v"]
                    )

        def annuli(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pivot, away = batch.column("pivot").to_numpy(), batch.column("away").to_numpy()
                ends = np.append(np.flatnonzero(np.diff(pivot)) + 1, len(pivot)) if len(pivot) else []
                low = 0
                for end in ends:
                    for begin in range(low, int(end), ANNULUS):
                        last = min(int(end), begin + ANNULUS)
                        block = batch.slice(begin, last - begin)
                        raw = _matrix(block.column("v"), width).astype("<i8").tobytes()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(pivot[begin : begin + 1]), pa.array(away[begin : begin + 1]), pa.array(away[last - 1 : last]),
                             pa.array([block.column("id").to_pylist()], pa.list_(pa.int64())), pa.array([raw], pa.binary())],
                            names=["pivot", "low", "high", "ids", "vectors"],
                        )
                    low = int(end)

        keyed = rows.mapInArrow(key, "pivot int, away double, id long, v array<long>")
        keyed = keyed.repartitionByRange("pivot", "away", "id").sortWithinPartitions("pivot", "away", "id")
        self.annuli = pin(keyed.mapInArrow(annuli, "pivot int, low double, high double, ids array<long>, vectors binary"))

    def search(self, queries: DataFrame, id: str, vector: str, k: int, block: int = QUERY_BLOCK) -> DataFrame:
        """(query_id, rank, vec_id, score): each query's k best rows of other IDs, ties to the smaller ID; pinned."""
        asked = queries.where(F.col(id).isNotNull() & F.col(vector).isNotNull()).select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v")).distinct()
        asked = pin(asked)
        n_blocks = -(-asked.count() // block)
        found = None
        for number in range(n_blocks):
            part = asked.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == number).toArrow()
            result = self._search_block(np.asarray(part.column("id"), np.int64), _matrix(part.column("v"), self.width), k)
            found = result if found is None else found.unionByName(result)
        if found is None:
            return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        return found

    def _search_block(self, ids: np.ndarray, asked: np.ndarray, k: int) -> DataFrame:
        context = self.annuli.sparkSession.sparkContext
        norms = (asked * asked).sum(1)
        away = _distances(np.column_stack([asked, np.zeros(len(asked))]), self.pivots)
        home = away.argmin(1)
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

        def scan(own: bool, floor: np.ndarray) -> DataFrame:
            shared = context.broadcast((ids, asked, norms, away, home, floor))
            return self.annuli.mapInArrow(_scanner(shared, own, k, self.norm2, self.width), "query_id long, vec_id long, score long")

        near = pin(scan(True, np.full(len(ids), LEAST)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank"))
        # A number for each query of the block.
        last = near.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k).toArrow()
        floor = np.full(len(ids), LEAST)
        order = np.argsort(ids)
        floor[order[np.searchsorted(ids[order], last.column("query_id").to_numpy())]] = last.column("floor").to_numpy()
        both = near.unionByName(scan(False, floor)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return pin(both.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _scanner(shared, own: bool, k: int, norm2: float, width: int):
    """Scan the annuli of each query's own pivot, or those of all others that can reach its floor."""

    def exact(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        # Sums of products below 2^53 are whole in doubles, which multiply much faster.
        if norm2 < 2**53:
            return (one @ two.T.astype(float)).astype(np.int64)
        return one.astype(np.int64) @ two.T.astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, asked, norms, away, home, floor = shared.value
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            for n in range(batch.num_rows):
                pivot, low, high = (batch.column(c)[n].as_py() for c in ("pivot", "low", "high"))
                gap = np.maximum(np.maximum(low - away[:, pivot], away[:, pivot] - high), 0)
                best = (norms + norm2 - gap * gap) / 2 + SLACK * (norms + norm2) + 1
                rows = np.flatnonzero((home == pivot) == own) if own else np.flatnonzero((home != pivot) & (best >= floor))
                if not len(rows):
                    continue
                vec_ids = np.asarray(batch.column("ids")[n].as_py(), np.int64)
                vectors = np.frombuffer(batch.column("vectors")[n].as_py(), "<i8").reshape(-1, width)
                order = np.argsort(vec_ids)
                vec_ids, vectors = vec_ids[order], vectors[order]
                scores = exact(asked[rows], vectors)
                keep = (scores >= floor[rows, None]) & (vec_ids[None, :] != ids[rows, None])
                if scores.shape[1] > k:  # the k best of each query, ties to the smaller ID: a stable order
                    top = np.argsort(np.where(keep, -scores, np.iinfo(np.int64).max), axis=1, kind="stable")[:, :k]
                    on = np.zeros_like(keep)
                    np.put_along_axis(on, top, True, axis=1)
                    keep &= on
                q, v = np.nonzero(keep)
                held = [np.concatenate(x) for x in zip(held, (ids[rows[q]], vec_ids[v], scores[q, v]), strict=True)]
                if len(held[0]) > 50_000:
                    held = _best(held, k)
        held = _best(held, k)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["query_id", "vec_id", "score"])

    return run


def _best(held: list[np.ndarray], k: int) -> list[np.ndarray]:
    query, vec, score = held
    order = np.lexsort((vec, -score, query))
    query = query[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    order = order[place < k]
    return [x[order] for x in held]


def top_k(
    vectors: DataFrame, queries: Column, id: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = 1024
) -> DataFrame:
    """The k highest integer inner products of each query row of `vectors` (where `queries` holds) with all other rows.

    Components become floor(scale * x). Rows without an ID, without a vector, or with a null or non-finite component
    take no part; vectors of different lengths are filled up with zeros; rows of the query's own ID are no candidates;
    other repeated rows count each; a query with fewer candidates gets all; an empty table gives no rows. Scores are exact;
    vectors so long that a score may not fit into 64 bits are an OverflowError.
    """
    rows = vectors.withColumn("__v", scaled(F.col(vector), scale)).where("__v is not null")
    return Index(rows.select(id, "__v"), id, "__v").search(rows.where(queries).select(id, "__v"), id, "__v", k)
