"""Benchmark decontamination: an FM-index for each shard of the training text, searched backwards for test phrases.

A shard is a slice of documents of a few megabytes. Its words become symbols: a word of the phrases has its number,
any other word is a separator that no phrase contains. Stretches between separators that are shorter than the
shortest phrase cannot hold one and are left out. Over the rest stand a suffix array, from which the index keeps the
Burrows-Wheeler transform as a wavelet matrix (bits and their running counts for each level) and every eighth text
position. A phrase is searched from its last word to its first by two ranks a word; its occurrences are located by
walking back to a sampled position. Positions become word and character spans, merged for each document.

Shards follow the rows as Spark deals them out, so no step shuffles, and no key or document group meets in one task.
Phrases reach the tasks in blocks of bounded size; each block is one more narrow pass that adds to the spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.llm.shipping import ship
from fareline.llm.text import ASCII_ALNUM_OR_BEYOND, expand, hash_words, hashes, slices, spans

WINDOW = 10
SHARD_BYTES = 2 << 20
SAMPLED = 8
#: Characters of benchmark text in one broadcast block.
BLOCK_CHARS = 16_000_000

_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_list(text: str) -> Column:
    """The words of a text column: runs of 0-9, a-z (A-Z lower-cased) and characters beyond ASCII; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(_WORD), 0)


class WaveletMatrix:
    """Ranks and symbols of a sequence of small integers: a bit and its running count for each level."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels = max(1, int(alphabet - 1).bit_length())
        self.ones, self.zeros = [], []
        at = symbols
        for level in range(self.levels - 1, -1, -1):
            bits = (at >> level) & 1
            counts = np.zeros(len(bits) + 1, np.int64)
            np.cumsum(bits, out=counts[1:])
            self.ones.append(counts)
            self.zeros.append(len(bits) - int(counts[-1]))
            at = np.concatenate([at[bits == 0], at[bits == 1]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before the position of the same place in `ends`."""
        low, high = np.zeros_like(ends), ends
        for k, (counts, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            one = ((symbols >> (self.levels - 1 - k)) & 1).astype(bool)
            low = np.where(one, zeros + counts[low], low - counts[low])
            high = np.where(one, zeros + counts[high], high - counts[high])
        return high - low

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for counts, zeros in zip(self.ones, self.zeros, strict=True):
            bit = counts[at + 1] - counts[at]
            out = out * 2 + bit
            at = np.where(bit == 1, zeros + counts[at], at - counts[at])
        return out


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by prefix doubling; only suffixes that still tie are sorted again."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ranks = np.empty(n, np.int64)
    first = np.ones(n, bool)
    first[1:] = symbols[order[1:]] != symbols[order[:-1]]
    heads = np.flatnonzero(first)
    ranks[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    step = 1
    while True:
        alone = np.diff(np.append(heads, n)) == 1
        tied = ~np.repeat(alone, np.diff(np.append(heads, n)))
        if not tied.any():
            return order
        places = np.flatnonzero(tied)
        rows = order[places]
        later = np.where(rows + step < n, ranks[np.minimum(rows + step, n - 1)] + 1, 0)
        again = np.lexsort((later, ranks[rows]))
        rows, later = rows[again], later[again]
        old = ranks[rows]
        order[places] = rows
        split = np.ones(len(rows), bool)
        split[1:] = (old[1:] != old[:-1]) | (later[1:] != later[:-1])
        first[places] = split
        heads = np.flatnonzero(first)
        sub = np.flatnonzero(split)
        ranks[rows] = np.repeat(places[sub], np.diff(np.append(sub, len(rows))))
        step *= 2


class FMIndex:
    """Backward search and location in a sequence of symbols below `alphabet`; symbol 0 is never searched."""

    def __init__(self, symbols: np.ndarray, alphabet: int, sampled: int = SAMPLED):
        # Below all symbols stands the text's end, which makes the order of suffixes that of rotations.
        symbols, alphabet = np.append(symbols + 1, 0), alphabet + 1
        suffixes = suffix_array(symbols)
        last = symbols[suffixes - 1]  # the symbol before each suffix; before the first one stands the end
        counts = np.bincount(symbols, minlength=alphabet)
        self.before = np.zeros(alphabet + 1, np.int64)
        np.cumsum(counts, out=self.before[1:])
        self.last = WaveletMatrix(last, alphabet)
        marked = suffixes % sampled == 0
        self.marks = np.zeros(len(symbols) + 1, np.int64)
        np.cumsum(marked, out=self.marks[1:])
        self.positions, self.length = suffixes[marked], len(symbols)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [low, high) of the suffixes that begin with each phrase; phrases are padded on the right."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.length, np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            on = np.flatnonzero((k < lengths) & (low < high))
            symbol = phrases[on, k] + 1
            low[on] = self.before[symbol] + self.last.rank(symbol, low[on])
            high[on] = self.before[symbol] + self.last.rank(symbol, high[on])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: steps back to a sampled position are counted and added."""
        out, at, ahead = np.full(len(rows), -1, np.int64), rows.copy(), np.arange(len(rows))
        steps = 0
        while len(ahead):
            marked = self.marks[at + 1] > self.marks[at]
            out[ahead[marked]] = self.positions[self.marks[at[marked]]] + steps
            ahead, at = ahead[~marked], at[~marked]
            symbol = self.last.symbol(at)
            at = self.before[symbol] + self.last.rank(symbol, at)
            steps += 1
        return out


class Phrases:
    """The distinct windows of a block of benchmark items, as symbols, and the items of each."""

    def __init__(self, items: list[tuple[str | None, list[str]]], window: int):
        words = sorted({w.encode() for _, text in items for w in text})
        known = hash_words(words) if words else np.zeros(0, np.uint64)
        order = np.argsort(known)
        self.hashes = known[order]
        number = {words[k].decode(): place + 1 for place, k in enumerate(order.tolist())}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            symbols = [number[w] for w in text]
            for k in range(max(1, len(symbols) - window + 1) if symbols else 0):
                # Windows of items without an ID are searched too; they name no item.
                found.setdefault(tuple(symbols[k : k + window]), set()).update([] if item is None else [item])
        self.lengths = np.array([len(w) for w in found], np.int64)
        self.symbols = np.zeros((len(found), window), np.int64)
        for k, w in enumerate(found):
            self.symbols[k, : len(w)] = w
        names = sorted({name for name, _ in items if name is not None})
        place = {name: k for k, name in enumerate(names)}
        self.items = np.array(names, object)
        self.item_of = np.array([place[i] for s in found.values() for i in sorted(s)], np.int64)
        self.first_item = np.cumsum([0, *(len(s) for s in found.values())])
        self.shortest = int(self.lengths.min()) if len(found) else 0

    def in_shard(self, texts) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[list[str]]]:
        """Words of each document; then, in order of documents, hit words and items with occurrences."""
        starts, ends, first = spans(texts, ASCII_ALNUM_OR_BEYOND)
        n_words = np.diff(first)
        nothing = n_words, np.zeros((0, 3), np.int64), np.zeros((0, 2), np.int64)
        if not self.shortest or not len(starts):
            return nothing
        seen = hashes(texts.data, starts, ends, lower=True)
        place = np.minimum(np.searchsorted(self.hashes, seen), len(self.hashes) - 1)
        symbols = np.where(self.hashes[place] == seen, place + 1, 0)
        # Stretches of phrase words inside one document, long enough for some phrase.
        breaks = np.zeros(len(symbols) + 1, bool)
        breaks[first] = True
        inside = symbols > 0
        opens = np.flatnonzero(inside & (breaks[:-1] | ~np.append(False, inside[:-1])))
        closes = np.flatnonzero(inside & (breaks[1:] | ~np.append(inside[1:], False))) + 1
        long = closes - opens >= self.shortest
        opens, closes = opens[long], closes[long]
        if not len(opens):
            return nothing
        places = expand(opens, closes - opens + 1)  # one more place for the separator
        last = np.cumsum(closes - opens + 1) - 1
        text = symbols[np.minimum(places, len(symbols) - 1)]
        text[last] = 0
        index = FMIndex(text, len(self.hashes) + 1)
        low, high = index.search(self.symbols, self.lengths)
        occurring = np.flatnonzero(high > low)
        counts = high[occurring] - low[occurring]
        if not len(occurring):
            return nothing
        found = index.locate(expand(low[occurring], counts))
        words = places[found]
        which = np.repeat(occurring, counts)
        document = np.searchsorted(first, words, side="right") - 1
        # Words under any occurrence: +1 where one begins, -1 behind its end.
        cover = np.bincount(words, minlength=len(symbols) + 1) - np.bincount(words + self.lengths[which], minlength=len(symbols) + 1)
        hit = np.cumsum(cover)[:-1] > 0
        edges = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
        edges_in = np.flatnonzero(hit & breaks[:-1])
        opens = np.union1d(np.flatnonzero(edges == 1), edges_in)
        closes = np.union1d(np.flatnonzero(edges == -1), edges_in[hit[edges_in - 1] & (edges_in > 0)])
        owner = np.searchsorted(first, opens, side="right") - 1
        merged = np.column_stack([owner, opens - first[owner], closes - first[owner]])
        pairs = np.unique(document * len(self.first_item) + which)
        document, which = pairs // len(self.first_item), pairs % len(self.first_item)
        each = self.first_item[which + 1] - self.first_item[which]
        items = self.item_of[expand(self.first_item[which], each)]
        pairs = np.unique(np.repeat(document, each) * len(self.items) + items)
        return n_words, merged, np.column_stack([pairs // len(self.items), pairs % len(self.items)])


def _merge(old, new: list[tuple[int, int]]) -> list[dict]:
    """Union of two lists of half-open word ranges."""
    out: list[list[int]] = []
    for low, high in sorted([(s["first"], s["last"]) for s in old] + new):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [{"first": low, "last": high} for low, high in out]


SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
FOUND = [T.StructField("__n_words", T.LongType()), T.StructField("__spans", SPANS), T.StructField("__items", T.ArrayType(T.StringType()))]
_ARROW = [pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])), pa.list_(pa.string())]


def _blocks(benchmark: DataFrame, item: str, text: str, chars: int) -> Iterator[list[tuple[str | None, list[str]]]]:
    """Items with words, in blocks of bounded size; the driver holds one block at a time."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), word_list(text).alias("words"))
    block, size = [], 0
    for row in rows.where(F.size("words") > 0).toLocalIterator():
        block.append((row.item, row.words))
        size += sum(map(len, row.words)) + 20
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Every row of `docs` with the words that lie in occurrences of benchmark windows.

    Adds `n_words`, `spans` (merged half-open ranges of word numbers) and `items` (IDs as text, sorted, without
    repeats); columns of `docs` with these names are replaced. Words are lower-cased runs of letters, digits and
    characters beyond ASCII. A window has `window` words of one item; an item with fewer words is one window. Null and
    empty texts have no words and no spans; items without words take no part, and those without an ID count in `spans`
    alone; repeated rows each get their own result; an empty table on either side gives rows without spans.
    """
    added = ["__n_words", "__spans", "__items"]
    out = ship(docs).drop("n_words", "spans", "items").withColumns(
        {"__n_words": F.lit(None).cast("long"), "__spans": F.lit(None).cast(SPANS), "__items": F.lit(None).cast("array<string>")}
    )
    schema = out.schema
    spark = docs.sparkSession
    for block in _blocks(benchmark, item, item_text, block_chars) if item in benchmark.columns else ():
        shared = spark.sparkContext.broadcast(Phrases(block, window))
        out = out.mapInArrow(_searcher(shared, text, added), schema)
    return out.select(
        *[F.col(c) for c in out.columns if c not in added],
        F.coalesce("__n_words", F.size(word_list(text)).cast("long")).alias("n_words"),
        F.coalesce("__spans", F.array().cast(SPANS)).alias("spans"),
        F.coalesce("__items", F.array().cast("array<string>")).alias("items"),
    )


def _searcher(shared, text: str, added: list[str]):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for batch in batches:
            for part, texts in slices(batch, text, SHARD_BYTES):
                n_words, merged, items = phrases.in_shard(texts)
                spans_of = [[] if s is None else s for s in part.column("__spans").to_pylist()]
                items_of = [[] if s is None else s for s in part.column("__items").to_pylist()]
                for k, group in pd.DataFrame(merged, columns=list("dab")).groupby("d"):
                    spans_of[k] = _merge(spans_of[k], list(zip(group.a.tolist(), group.b.tolist(), strict=True)))
                for k, group in pd.DataFrame(items, columns=list("di")).groupby("d"):
                    items_of[k] = sorted({*items_of[k], *phrases.items[group.i.to_numpy()]})
                columns = [part.column(c) for c in part.schema.names if c not in added]
                columns += [pa.array(x, t) for x, t in zip((n_words, spans_of, items_of), _ARROW, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return search


def remove_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """`docs` with the merged spans cut out of the texts, in the columns of `docs`; clean rows stay as they are.

    A span reaches from its first word's first character to its last word's last one; a line break takes its place.
    A document of which no word is left goes. Null and empty texts stay. `n_chars`, if there, is counted anew.
    """
    found = find_leaks(docs, benchmark, text, window=window)
    hit = F.size("spans") > 0
    places = F.sequence(F.lit(0), F.size("__gaps") - 1)
    # split() gives what stands around the words: gap 0, word 0, gap 1, ..
    pieces = F.expr(
        "transform(__places, i -> case"
        " when i = size(__gaps) - 1 then __gaps[i]"
        " when exists(spans, s -> i >= s.first and i < s.last) then"
        " if(exists(spans, s -> i > s.first and i < s.last), '', concat(__gaps[i], '\n'))"
        " else concat(__gaps[i], __words[i]) end)"
    )
    raw_words = F.regexp_extract_all(F.col(text), F.lit("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"), 0)
    cut = (
        found.where(hit)
        .withColumn("__words", raw_words)
        .withColumn("__gaps", F.split(text, "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", -1))
        .withColumn("__places", places)
        .withColumn(text, F.array_join(pieces, ""))
        .where(F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"]) < F.col("n_words"))
    )
    out = found.where(~hit).select(*docs.columns).unionByName(cut.select(*docs.columns))
    return out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
