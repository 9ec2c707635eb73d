"""Alignment of two tokenizers over a corpus: each distinct text once, pairs weighted by how often the text occurs.

Texts shuffle by their full text; each distinct one is encoded by both tokenizers and its tokens are cut into groups at
the byte offsets where tokens of both end. Tokens of a group whose byte ranges overlap are links. Both tokenizers begin
anew at a space that follows a character which is not white space, so that the tokens, groups and links of a piece
between such places are found once and looked up after that.

A pair's count is the number of its links over all documents. Each text keeps its links as packed pairs; the counts of
frequent pairs go to every task (their number is bounded), links of the others are joined with their counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from fareline.llm.shipping import ship
from fareline.llm.text import Texts, equal_ranges, expand, hashes, mixed, slices
from fareline.llm.tokens import cuts
from fareline.session import broadcast_if_small, pin

#: Pieces kept by one worker; beyond it the table is begun anew (more work, same result).
KEPT_PIECES = 400_000
#: Pairs of highest count whose counts every task holds (16 bytes each).
HEAD_PAIRS = 1_000_000
#: Documents of one text from which its measures are dealt out over several join keys.
HOT_COPIES = 20_000
MEASURES = "n_a n_b n_groups n_links n_best count_sum".split()
_SHIFT = 32


def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable characters of Latin-1 stand for
    themselves, the other bytes, in order, for the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """The two tokenizers, and what is known of pieces: their tokens, ends and links."""

    def __init__(self, byte_level: str, pieces: str):
        self.a, self.b = Tokenizer.from_file(byte_level), sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a.encode_special_tokens = True
        values = byte_values()
        special = self.a.get_added_tokens_decoder()
        entries = {i: t for t, i in self.a.get_vocab().items() if i not in special}
        self.a_bytes = [bytes(values[c] for c in entries.get(i, "")) for i in range(max([*entries, *special]) + 1)]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self._forget()

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def tidy(self) -> None:
        if len(self.known) > KEPT_PIECES:
            self._forget()

    def _forget(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.sizes, self.begins, self.data = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
        self.whole = np.zeros(0, bool)
        # For each piece, how many: tokens of A, of B, groups, links, characters of its groups as text.
        self.counts, self.firsts = np.zeros((0, 5), np.int64), np.zeros((0, 5), np.int64)
        self.links, self.words = np.zeros(0, np.int64), bytearray()

    def align(self, body: bytes, a: list[int], b: list[int]) -> tuple[bool, int, int, int, list[int], bytes]:
        """Of the tokens of one piece: whether both give back its bytes, the numbers of tokens and groups, the links
        (A's ID above B's) and the groups as text."""
        if b"".join([self.a_bytes[i] for i in a]) != body or b"".join([self.b_bytes[i] for i in b]) != body:
            return False, 0, 0, 0, [], b""
        links, groups, one, two = [], [], [], []
        i = j = 0
        end_a, end_b = len(self.a_bytes[a[0]]), len(self.b_bytes[b[0]])
        while True:
            links.append(a[i] << _SHIFT | b[j])
            if end_a <= end_b:
                one.append(str(a[i]))
            if end_b <= end_a:
                two.append(str(b[j]))
            if end_a == end_b:
                groups.append(",".join(one) + "|" + ",".join(two))
                one, two, i, j = [], [], i + 1, j + 1
                if i == len(a):
                    break
                end_a, end_b = end_a + len(self.a_bytes[a[i]]), end_b + len(self.b_bytes[b[j]])
            elif end_a < end_b:
                i += 1
                end_a += len(self.a_bytes[a[i]])
            else:
                j += 1
                end_b += len(self.b_bytes[b[j]])
        return True, len(a), len(b), len(groups), links, (";".join(groups) + ";").encode()

    def _learn(self, new: np.ndarray, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> None:
        raw, found, whole, counts, links, at = data.tobytes(), [], [], [], [], len(self.words)
        bodies = [raw[i:j] for i, j in zip(starts.tolist(), stops.tolist(), strict=True)]
        for k in range(0, len(bodies), 2_000):
            part = bodies[k : k + 2_000]
            pieces = [body.decode() for body in part]
            a = [x.ids for x in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
            # B puts a space before what it is given, but not before nothing.
            b = self.b.encode([piece[1:] for piece in pieces], num_threads=1)
            b = [ids if len(piece) > 1 else [self.b.piece_to_id("▁")] for ids, piece in zip(b, pieces, strict=True)]
            found += map(self.align, part, a, b)
        for ok, n_a, n_b, n_groups, linked, words in found:
            whole.append(ok)
            counts.append((n_a, n_b, n_groups, len(linked), len(words)))
            links += linked
            self.words += words
        counts = np.array(counts, np.int64)
        firsts = np.cumsum(counts, axis=0) - counts
        firsts[:, 3] += len(self.links)
        firsts[:, 4] += at
        place = np.searchsorted(self.known, new)
        self.known, self.place = np.insert(self.known, place, new), np.insert(self.place, place, len(self.whole) + np.arange(len(new)))
        self.whole = np.append(self.whole, np.array(whole, bool))
        self.counts, self.firsts = np.concatenate([self.counts, counts]), np.concatenate([self.firsts, firsts])
        self.links = np.append(self.links, np.array(links, np.int64))
        sizes = stops - starts
        self.begins = np.append(self.begins, len(self.data) + np.cumsum(sizes) - sizes)
        self.sizes, self.data = np.append(self.sizes, sizes), np.append(self.data, data[expand(starts, sizes)])

    def places(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The number in the table of each piece, found by hash and compared by bytes."""
        h = hashes(data, starts, stops)
        while True:
            kinds, example, kind = np.unique(h, return_index=True, return_inverse=True)
            at = np.searchsorted(self.known, kinds)
            missing = self.known[np.minimum(at, len(self.known) - 1)] != kinds if len(self.known) else np.ones(len(kinds), bool)
            if missing.any():
                self._learn(kinds[missing], data, starts[example[missing]], stops[example[missing]])
            place = self.place[np.searchsorted(self.known, kinds)][kind]
            alike = self.sizes[place] == stops - starts
            alike &= equal_ranges(data, starts, self.data, self.begins[place], np.where(alike, stops - starts, 0))
            if alike.all():
                return place
            h = np.where(alike, h, mixed(h))


_pairs: dict[tuple[str, str], Pair] = {}


def _pair(byte_level: str, pieces: str) -> Pair:
    if (byte_level, pieces) not in _pairs:
        _pairs[byte_level, pieces] = Pair(byte_level, pieces)
    return _pairs[byte_level, pieces]


def with_space(texts: Texts) -> Texts:
    """The texts with a space before each that is not empty."""
    sizes = np.diff(texts.bounds)
    out = Texts(pa.array([], pa.string()))
    out.bounds = np.append(0, np.cumsum(sizes + (sizes > 0)))
    out.data = np.full(int(out.bounds[-1]), 0x20, np.uint8)
    inner = np.ones(len(out.data), bool)
    inner[out.bounds[:-1][sizes > 0]] = False
    out.data[inner] = texts.data
    return out


def space_cuts(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `cuts`, at spaces only."""
    starts, _, _ = cuts(texts)
    starts = starts[texts.data[starts] == 0x20]
    return starts, np.append(starts[1:], len(texts.data)), np.searchsorted(starts, texts.bounds)


def _aligned(byte_level: str, pieces: str):
    """For each text its measures and its links as (pairs, how often); then one row with the pairs of all, weighted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _pair(byte_level, pieces)
        for batch in batches:
            for part, plain in slices(batch, "text"):
                made.tidy()
                texts = with_space(plain)
                starts, stops, first = space_cuts(texts)
                place = made.places(texts.data, starts, stops)
                n_pieces = np.diff(first)
                document = np.repeat(np.arange(len(texts)), n_pieces)
                good = n_pieces > 0
                good[document[~made.whole[place]]] = False
                kept = good[document]
                place, document = place[kept], document[kept]
                counts = made.counts[place]
                sums = np.zeros((len(texts), 5), np.int64)
                np.add.at(sums, document, counts)
                links = made.links[expand(made.firsts[place, 3], counts[:, 3])]
                of = np.repeat(document, counts[:, 3])
                order = np.lexsort((links, of))
                links, of = links[order], of[order]
                new = np.ones(len(links), bool)
                new[1:] = (links[1:] != links[:-1]) | (of[1:] != of[:-1])
                at = np.flatnonzero(new)
                times = np.diff(at, append=len(links))
                bounds = np.searchsorted(of[at], np.arange(len(texts) + 1)).astype(np.int32)
                digests, words, spans = [], memoryview(made.words), np.searchsorted(document, np.arange(len(texts) + 1))
                begin = made.firsts[place, 4].tolist()
                end = (made.firsts[place, 4] + counts[:, 4]).tolist()
                for k in range(len(texts)):
                    if not good[k]:
                        digests.append("")
                        continue
                    held = b"".join([words[begin[i] : end[i]] for i in range(spans[k], spans[k + 1])])
                    digests.append(hashlib.sha256(held[:-1]).hexdigest())
                del words
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x)) for x in (links[at], times.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("n"), *[pa.array(sums[:, c]) for c in range(4)], pa.array(digests), *lists],
                    names=[*"key n n_a n_b n_groups n_links groups_sha256 pairs times".split()],
                )

    return run


def _weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs and their counts over the texts of a batch, each weighted by its documents."""
    for batch in batches:
        bounds = batch.column("pairs").offsets.to_numpy()
        weight = np.repeat(batch.column("n").to_numpy(), np.diff(bounds)) * batch.column("times").flatten().to_numpy()
        pairs, which = np.unique(batch.column("pairs").flatten().to_numpy(), return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, which, weight)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(total)], names=["pair", "count"])


class Head:
    """Counts of the frequent pairs, and which of them are the highest of their B token."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray):
        self.pairs, self.counts, self.best = pairs, counts, best

    def measure(self, batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]:
        """(key, n_best, count_sum) by the known pairs; row, pair and times of the links of all others."""
        bounds = batch.column("pairs").offsets.to_numpy()
        pairs, times = batch.column("pairs").flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
        row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        at = np.minimum(np.searchsorted(self.pairs, pairs), max(0, len(self.pairs) - 1))
        on = self.pairs[at] == pairs if len(self.pairs) else np.zeros(len(pairs), bool)
        sums = np.zeros((2, batch.num_rows), np.int64)
        np.add.at(sums[0], row[on], times[on] * self.best[at[on]])
        np.add.at(sums[1], row[on], times[on] * self.counts[at[on]])
        out = pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sums[0]), pa.array(sums[1])], names=["key", "n_best", "count_sum"])
        return out, row[~on], pairs[~on], times[~on]


def align_corpus(
    docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text", head_pairs: int = HEAD_PAIRS
) -> tuple[DataFrame, DataFrame]:
    """(measures of every row, pairs of the corpus).

    Measures: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair has the highest count of its B token, ties
    included), count_sum (counts of all links), groups_sha256. Pairs: a, b, count, best. Null and empty texts, and texts
    that one of the tokenizers does not give back byte for byte, have zeros and an empty groups_sha256. Repeated rows
    count each and have equal measures; rows without an ID are measured too; other columns take no part. An empty table
    gives no rows. Both paths must be there on every worker.
    """
    given = ship(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    given = given.withColumn("key", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    distinct = given.where("text != ''").groupBy("text").agg(F.count("*").alias("n"), F.any_value("key").alias("key"))
    longs = "n long, n_a long, n_b long, n_groups long, n_links long"
    schema = f"key binary, {longs}, groups_sha256 string, pairs array<long>, times array<int>"
    aligned = pin(distinct.mapInArrow(_aligned(byte_level, pieces), schema))

    counted = aligned.where("n_links > 0").select("n", "pairs", "times").mapInArrow(_weighted, "pair long, count long")
    counts = pin(counted.groupBy("pair").agg(F.sum("count").alias("count")))
    token = F.col("pair").bitwiseAND((1 << _SHIFT) - 1)
    # One row for each token of B's vocabulary.
    most = counts.groupBy(token.alias("b")).agg(F.max("count").alias("most"))
    known = counts.withColumn("b", token).join(F.broadcast(most), "b")
    known = pin(known.select("pair", F.shiftright("pair", _SHIFT).alias("a"), "b", "count", (F.col("count") == F.col("most")).alias("best")))

    head = known.orderBy(F.col("count").desc(), "pair").limit(head_pairs) if known.limit(head_pairs + 1).count() > head_pairs else known
    head = head.select("pair", "count", "best").toArrow().combine_chunks().sort_by("pair")
    shown = given.sparkSession.sparkContext.broadcast(Head(*[head.column(c).to_numpy() for c in ("pair", "count", "best")]))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, row, pairs, times = shown.value.measure(batch)
            nothing = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*out.columns, nothing, nothing], names=[*out.schema.names, "pair", "times"])
            if len(row):
                zero = pa.array(np.zeros(len(row), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(row)), zero, zero, pa.array(pairs), pa.array(times)],
                    names=[*out.schema.names, "pair", "times"],
                )

    links = aligned.where("n_links > 0").select("key", "pairs", "times")
    found = pin(links.mapInArrow(measure, "key binary, n_best long, count_sum long, pair long, times long"))
    part = found.where("pair is null").select("key", "n_best", "count_sum")
    if known.limit(head_pairs + 1).count() > head_pairs:
        rare = found.where("pair is not null").select("key", "pair", "times").join(known.select("pair", "count", "best"), "pair")
        more = rare.select("key", (F.col("times") * F.col("best").cast("long")).alias("n_best"), (F.col("times") * F.col("count")).alias("count_sum"))
        part = part.unionByName(more).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    measured = aligned.select("key", "n", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(part, "key", "left")
    zeros = given.where("text is null or text = ''").select("doc_id", *[F.lit(0).cast("long").alias(c) for c in MEASURES], F.lit("").alias("groups_sha256"))
    named = given.where("text != ''").select("doc_id", "key")
    return _to_documents(named, measured).unionByName(zeros), known.select("a", "b", "count", "best")


def _to_documents(named: DataFrame, measured: DataFrame) -> DataFrame:
    """The measures of each document's text; a text of very many documents has its row under several keys."""
    measured = pin(measured)
    many = measured.where(F.col("n") >= HOT_COPIES)
    many = broadcast_if_small(many.select("key", F.ceil(F.col("n") / HOT_COPIES).cast("int").alias("parts")))
    part = lambda x: F.coalesce(x, F.lit(1))
    named = named.join(many, "key", "left").withColumn("part", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), part("parts")).cast("int"))
    rows = measured.join(many, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0), part(F.col("parts")) - 1)))
    out = named.drop("parts").join(rows.drop("parts"), ["key", "part"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(
        "doc_id", *[zero(c) for c in MEASURES],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
