"""Token IDs as directly addressable codes: any token is read without decoding a block.

An ID is cut into chunks of eight bits. Level 0 holds the lowest chunk of every ID; level k holds chunk k of the IDs
that are long enough. Beside each level but the last stands a bitmap that says which of its IDs continue, and a rank
directory: the number of set bits before every 512th bit. Token i is read from chunk i of level 0; while its bit is
set, its place in the next level is the bit's rank.

A written folder holds one row for each block of whole documents: its shard, its number of tokens, the place of its
first token in the shard, its document IDs, where each document begins, and the codes. Shards follow the order of
the document IDs. Spark writes and commits the files, so a lost executor's shard is written again.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.llm.shipping import ship
from fareline.llm.text import slices
from fareline.llm.tokens import encoder

_MAGIC = b"DAC1"
_STEP = 512


def dump_codes(ids: np.ndarray) -> bytes:
    """The bytes of one block: a header, then chunks, bitmap and rank directory of each level."""
    at = ids.astype(np.uint32)
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while True:
        more = at > 0xFF
        bits = np.packbits(more, bitorder="little")
        ones = np.cumsum(more, dtype=np.uint32)
        directory = np.zeros(len(at) // _STEP + 1, np.uint32)
        directory[1:] = ones[_STEP - 1 :: _STEP][: len(directory) - 1]
        if not more.any():
            levels.append(((at & 0xFF).astype(np.uint8), bits[:0], directory[:0]))
            break
        levels.append(((at & 0xFF).astype(np.uint8), bits, directory))
        at = at[more] >> 8
    head = _MAGIC + struct.pack("<QI", len(ids), len(levels)) + b"".join(struct.pack("<Q", len(c)) for c, _, _ in levels)
    return head + b"".join(x.tobytes() for c, bits, directory in levels for x in (c, bits, directory.astype("<u4")))


class DirectCodes:
    """Reads tokens of a block's bytes."""

    def __init__(self, raw: bytes):
        if raw[:4] != _MAGIC:
            raise ValueError("not a block of directly addressable codes")
        self.length, levels = struct.unpack_from("<QI", raw, 4)
        sizes = struct.unpack_from(f"<{levels}Q", raw, 16)
        at, self.levels = 16 + 8 * levels, []
        for k, size in enumerate(sizes):
            chunks, at = np.frombuffer(raw, np.uint8, size, at), at + size
            n_bits = (size + 7) // 8 if k + 1 < levels else 0
            bits, at = np.frombuffer(raw, np.uint8, n_bits, at), at + n_bits
            n_ranks = size // _STEP + 1 if k + 1 < levels else 0
            directory, at = np.frombuffer(raw, "<u4", n_ranks, at), at + 4 * n_ranks
            self.levels.append((chunks, bits, directory))

    def __getitem__(self, places) -> np.ndarray:
        """The IDs at the given places, each read on its own."""
        places = np.atleast_1d(np.asarray(places, np.int64))
        if len(places) and (places.min() < 0 or places.max() >= self.length):
            raise IndexError("no such token")
        out, at, rows = np.zeros(len(places), np.int64), places, np.arange(len(places))
        for k, (chunks, bits, directory) in enumerate(self.levels):
            out[rows] |= chunks[at].astype(np.int64) << (8 * k)
            if not len(bits):
                break
            on = (bits[at >> 3] >> (at & 7)) & 1 == 1
            rows, at = rows[on], at[on]
            at = np.array([self._rank(bits, directory, i) for i in at.tolist()], np.int64)
        return out

    @staticmethod
    def _rank(bits: np.ndarray, directory: np.ndarray, place: int) -> int:
        begin = place // _STEP * _STEP
        tail = np.unpackbits(bits[begin // 8 : place // 8 + 1], bitorder="little")[: place - begin]
        return int(directory[place // _STEP]) + int(tail.sum())

    def all(self) -> np.ndarray:
        """All IDs, level by level from the highest."""
        value = self.levels[-1][0].astype(np.uint32)
        for chunks, bits, _ in self.levels[-2::-1]:
            more = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
            low = chunks.astype(np.uint32)
            low[more] |= value << 8
            value = low
        return value


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode all documents and write them below `path` in ascending order of `doc_id`.

    Null and empty texts have the end token alone. Rows of equal ID follow in the order in which they were read; a
    null ID comes first. An empty table writes a folder without blocks. `tokenizer` is a path that every worker has.
    """
    kind = docs.schema[doc_id].dataType
    longs = T.ArrayType(T.LongType())
    schema = T.StructType(
        [T.StructField("shard", T.IntegerType()), T.StructField("first_token", T.LongType()), T.StructField("n_tokens", T.LongType()),
         T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("begins", longs), T.StructField("codes", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, shard, first = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part, texts in slices(batch, "__text"):
                made.tidy()
                ids, bounds, _, _ = made.encode(texts, end)
                named = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), part.column("__id"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([first]), pa.array([len(ids)]), named,
                     pa.array([bounds[:-1].tolist()], pa.list_(pa.int64())), pa.array([dump_codes(ids)], pa.binary())],
                    names=schema.names,
                )
                first += len(ids)

    rows = ship(docs).select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    rows = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange("__id", "__tie")
    rows.sortWithinPartitions("__id", "__tie").select("__id", "__text").mapInArrow(run, schema).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a written folder: doc_id, start (tokens of all documents before it), n_tokens, ids.

    `ids` holds the token IDs as little-endian unsigned 32-bit integers.
    """
    blocks = spark.read.parquet(path)
    schema = T.StructType(
        [T.StructField("doc_id", blocks.schema["doc_ids"].dataType.elementType), T.StructField("shard", T.IntegerType()),
         T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block = batch.slice(k, 1)
                raw = DirectCodes(block.column("codes")[0].as_py()).all().astype("<u4").tobytes()
                doc_ids = block.column("doc_ids").flatten()
                bounds = np.append(block.column("begins").flatten().to_numpy(), block.column("n_tokens")[0].as_py())
                held = [raw[4 * i : 4 * j] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(np.full(len(doc_ids), block.column("shard")[0].as_py(), np.int32)),
                     pa.array(block.column("first_token")[0].as_py() + bounds[:-1]), pa.array(np.diff(bounds)), pa.array(held, pa.binary())],
                    names=schema.names,
                )

    # A row of 16 bytes for each task of the writer: small enough for one task and for a broadcast at any size.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    offsets = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    documents = ship(blocks).select("shard", "first_token", "n_tokens", "doc_ids", "begins", "codes").mapInArrow(run, schema)
    joined = documents.join(F.broadcast(offsets), "shard")
    return joined.select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids")
