"""Lexical retrieval packing: BM25 neighbours of a seed document fill its training window.

Each shard (a slice of documents of a few megabytes, as Spark deals the rows out) has its own inverted index of BM25
weights. A window begins with a seed, the next unused document or the rest of the one that the window before cut, and
takes the seed's best unused neighbours until it is full; where no neighbour is left, unused documents follow in their
order. Windows are always filled by cutting, so that only a shard's last tokens fall short of one; they are cut into
sequences whose lengths are powers of two. No step shuffles, and no task holds more than a shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.llm.shipping import ship
from fareline.llm.text import expand, slices
from fareline.llm.tokens import encoder

WINDOW = 2048
SHARD_BYTES = 4 << 20
K1, B = 1.2, 0.75
#: A seed's terms of highest BM25 weight that make its query.
QUERY_TERMS = 24


def numbered(places: np.ndarray) -> np.ndarray:
    """The rank of each place among the distinct ones, without sorting them."""
    there = np.zeros(int(places.max()) + 1 if len(places) else 0, bool)
    there[places] = True
    return (np.cumsum(there) - 1)[places]


class BM25:
    """Inverted index of a shard. A term in one document, or in half of all or more, ranks no neighbour and is left out."""

    def __init__(self, document: np.ndarray, term: np.ndarray, n_documents: int, k1: float = K1, b: float = B):
        """`document` ascends: each term as often as it occurs."""
        n_terms = int(term.max()) + 1 if len(term) else 0
        lengths = np.bincount(document, minlength=n_documents)
        # Sorted once, by term: postings stand in their order, and a seed's own terms are looked up when it is one.
        pairs, tf = np.unique(term * max(n_documents, 1) + document, return_counts=True)
        df = np.bincount(pairs // max(n_documents, 1), minlength=n_terms)
        telling = (df >= 2) & (df < max(2.5, n_documents / 2))
        on = np.repeat(telling, df)
        self.start = np.append(0, np.cumsum(np.where(telling, df, 0)))
        idf = np.log((n_documents - df + 0.5) / (df + 0.5) + 1)
        norm = k1 * (1 - b + b * lengths / max(lengths.mean(), 1)) if n_documents else lengths
        self.n_documents, self.k1, self.idf, self.norm, self.telling = n_documents, k1, idf, norm, telling
        self.term, self.first = term, np.append(0, np.cumsum(lengths))
        tf, df = tf[on], df[telling]
        self.posting = pairs[on] - np.repeat(np.flatnonzero(telling), df) * max(n_documents, 1)
        self.weight = np.repeat(idf[telling], df) * tf * (k1 + 1) / (tf + norm[self.posting])

    def best_terms(self, seed: int, most: int) -> np.ndarray:
        """The seed's terms of highest weight, best first."""
        term = self.term[self.first[seed] : self.first[seed + 1]]
        term, tf = np.unique(term[self.telling[term]], return_counts=True)
        weight = self.idf[term] * tf * (self.k1 + 1) / (tf + self.norm[seed])
        return term[np.argsort(-weight, kind="stable")[:most]]

    def scores(self, seed: int, most_terms: int = QUERY_TERMS) -> np.ndarray:
        """The BM25 score of every document for the seed's best terms."""
        terms = self.best_terms(seed, most_terms)
        if not len(terms):
            return np.zeros(self.n_documents)
        at = expand(self.start[terms], self.start[terms + 1] - self.start[terms])
        return np.bincount(self.posting[at], self.weight[at], self.n_documents)


def fill_windows(sizes: np.ndarray, index: BM25, window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece; sequences count from 0."""
    pieces: list[tuple[int, int, int, int, int]] = []
    unused = np.ones(len(sizes), bool)
    sequence = offset = following = 0
    scores: np.ndarray | None = None
    size_of = sizes.tolist()

    def put(document: int, start: int, length: int) -> None:
        nonlocal sequence, offset, scores
        while length:
            if not offset:
                scores = None  # the document that begins a window is its seed
            part = min(length, window - offset)
            pieces.append((document, start, part, sequence, offset))
            if not offset and part < window:
                scores = index.scores(document)
            start, length, offset = start + part, length - part, offset + part
            if offset == window:
                sequence, offset = sequence + 1, 0

    for _ in range(len(size_of)):
        best = -1
        if offset and scores is not None:
            open_scores = np.where(unused, scores, 0.0)
            best = int(open_scores.argmax())
            if open_scores[best] <= 0:
                best = -1
        if best < 0:
            while not unused[following]:
                following += 1
            best = following
        unused[best] = False
        put(best, 0, size_of[best])
    return _tail_in_powers(pieces, sequence, offset) if offset else pieces


def _tail_in_powers(pieces: list, sequence: int, length: int) -> list:
    """Cut the last, short sequence into sequences of falling powers of two."""
    tail = [p for p in pieces if p[3] == sequence]
    out = pieces[: len(pieces) - len(tail)]
    room, offset = 1 << (length.bit_length() - 1), 0
    for document, start, size, _, _ in tail:
        while size:
            part = min(size, room - offset)
            out.append((document, start, part, sequence, offset))
            start, size, offset, length = start + part, size - part, offset + part, length - part
            if offset == room:
                sequence, offset = sequence + 1, 0
                room = 1 << (length.bit_length() - 1) if length else 0
    return out


def pack(
    docs: DataFrame, tokenizer: str, end: int, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    `ids` holds the piece's token IDs as little-endian unsigned 32-bit integers; each document ends with `end`.
    Sequence IDs are unique; a sequence's pieces stand gapless from offset 0. Null and empty texts give the end token
    alone; repeated rows are packed one by one; an empty table gives no piece; other columns take no part. `tokenizer`
    is a path that every worker has.
    """
    kind = docs.schema[doc_id].dataType
    schema = T.StructType(
        [T.StructField("doc_id", kind), *(T.StructField(c, T.LongType()) for c in ("start", "length")),
         T.StructField("ids", T.BinaryType()), *(T.StructField(c, T.LongType()) for c in ("doc_tokens", "sequence_id", "offset"))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, base = encoder(tokenizer), TaskContext.get().partitionId() << 36
        for batch in batches:
            for shard, _ in slices(batch, "__text", SHARD_BYTES):
                made.tidy()
                parts = [made.encode(texts, end) for _, texts in slices(shard, "__text")]
                ids = np.concatenate([p[0] for p in parts])
                sizes = np.concatenate([np.diff(p[1]) for p in parts])
                bounds = np.append(0, np.cumsum(sizes))
                terms = numbered(np.concatenate([p[2] for p in parts]))
                document = np.repeat(np.arange(len(sizes)), np.concatenate([np.diff(p[3]) for p in parts]))
                del parts
                pieces = np.array(fill_windows(sizes, BM25(document, terms, len(sizes)), window), np.int64)
                row, start, length, sequence, offset = pieces.T
                raw = ids.astype("<u4").tobytes()
                begin = ((bounds[row] + start) * 4).tolist()
                held = [raw[i:j] for i, j in zip(begin, ((bounds[row] + start + length) * 4).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [shard.column("__id").take(pa.array(row)), pa.array(start), pa.array(length), pa.array(held, pa.binary()),
                     pa.array(sizes[row]), pa.array(base + sequence), pa.array(offset)],
                    names=schema.names,
                )
                base += int(sequence.max()) + 1

    return ship(docs).select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).mapInArrow(run, schema)
