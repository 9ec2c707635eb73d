"""Toxicity by two class-conditional Kneser-Ney models of words with shared backoff counts.

Each class has counts of words and pairs of words from a bounded sample of labelled rows. Below them stand the corpus
counts: a Spark table of every word of all documents, with its count and the number of texts that hold it (its contexts),
so that it grows with the input. Below these stand models that spell words, each byte from those before it in the word,
with n-grams of both classes of two to ten bytes and pairs of bytes of the corpus words as the last resort.

A class takes its share of a word's corpus count by how well it spells the word: of two words that the sample lacks, the
one with toxic parts is likelier in toxic text.

A document's evidence is its toxic minus its ordinary log-likelihood, over all words as often as they occur, divided by
their number. Beside it stands what single words say that are spelled in a clearly toxic way, since a few of them vanish
in the mean of a long text. A logistic curve over both, fitted on sampled rows that the models have not seen, makes a
score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.llm.fm_index import word_list
from fareline.llm.shipping import ship
from fareline.llm.text import ASCII_ALNUM_OR_BEYOND, LOWER, Texts, expand, hash_words, hashes, mixed, slices, spans
from fareline.session import pin

#: Bound of the labelled sample: rows and characters of each class. A quarter of the rows fits the curve.
SAMPLE_ROWS, SAMPLE_CHARS = 4_000, 16_000_000
#: Lengths of the classes' own n-grams of bytes, and distinct sampled texts that a word must be in for its spelling to be learnt.
LOWEST, HIGHEST = 2, 10
LEAST_TEXTS = 2
DISCOUNT = 0.75
#: Words of most contexts whose counts every worker holds; others are joined. Results do not depend on it.
HEAD_WORDS = 200_000
#: Nats by which the spelling of a word must differ to be clearly toxic.
MARGIN = 4.0
_BEGIN, _END = 1, 2
_STEPS = np.random.default_rng(77).integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: All pairs of bytes, in their order; their contexts, single bytes, stand behind them.
SHARED_PLACES = 1 << 16
#: Places that are hashed together, and shares of the contexts that are fitted together: bounds of the driver's memory.
BLOCK, CONTEXT_BITS = 1 << 18, 3


def spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' lower-cased bytes, each word between two marks; each word's first place, and each byte's place in its word."""
    lengths = ends - starts + 2
    first = np.cumsum(lengths) - lengths
    letters = np.full(int(lengths.sum()), _END, np.uint8)
    letters[first] = _BEGIN
    letters[expand(first + 1, ends - starts)] = LOWER[data[expand(starts, ends - starts)]]
    return letters, first, np.arange(len(letters)) - np.repeat(first, lengths)


def grams(letters: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """A hash of the last n bytes at each place; from the word's begin where it is nearer."""
    out = np.zeros(len(letters), np.uint64)
    for first in range(0, len(letters), BLOCK):
        last = min(first + BLOCK, len(letters))
        for k in range(n):
            low = max(first, k)
            part = letters[low - k : last - k] * _STEPS[k]
            part[place[low:last] < k] = 0
            out[low:last] += part
        out[first:last] = mixed(out[first:last])
    return out


def _shared_places(letters: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    before = np.zeros(len(letters), np.int64)
    before[1:] = letters[:-1]
    return before * 256 + letters, before + SHARED_PLACES


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each slice with their count and their texts."""
    for batch in batches:
        for _, texts in slices(batch, "__text", 4 << 20):
            starts, ends, first = spans(texts, ASCII_ALNUM_OR_BEYOND)
            if not len(starts):
                continue
            _, example, kind = np.unique(hashes(texts.data, starts, ends, lower=True), return_index=True, return_inverse=True)
            pairs = np.unique(np.repeat(np.arange(len(texts)), np.diff(first)) * len(example) + kind)
            raw = LOWER[texts.data].tobytes()
            words = [raw[i:j] for i, j in zip(starts[example].tolist(), ends[example].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(np.bincount(kind, minlength=len(example))),
                 pa.array(np.bincount(pairs % len(example), minlength=len(example)))],
                names=["word", "n", "contexts"],
            )


def _joined(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' bytes one after the other, and where each begins and ends."""
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths)
    return np.frombuffer(b"".join(words), np.uint8), ends - lengths, ends


def _byte_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of bytes and their contexts in the words of the corpus, each word once."""
    counts = np.zeros(2 * SHARED_PLACES, np.int64)
    for batch in batches:
        if batch.num_rows:
            letters, _, place = spelled(*_joined(batch.column("word").to_pylist()))
            for places in _shared_places(letters, place):
                counts += np.bincount(places[place > 0], minlength=2 * SHARED_PLACES)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["place", "n"])


def _pairs(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(before * _STEPS[1] + word * _STEPS[0])


def _word_pairs(texts: Texts) -> tuple[np.ndarray, ...]:
    """Starts, ends, first words; the hash of each word and of the one before it (0 before a text's first)."""
    starts, ends, first = spans(texts, ASCII_ALNUM_OR_BEYOND)
    word = hashes(texts.data, starts, ends, lower=True)
    before = np.zeros(len(word), np.uint64)
    before[1:] = word[:-1]
    before[first[:-1][np.diff(first) > 0]] = 0
    return starts, ends, first, word, before


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of words of each slice with the number of texts of both classes that hold them."""
    for batch in batches:
        for part, texts in slices(batch, "__text"):
            _, _, first, word, before = _word_pairs(texts)
            _, one, kind = np.unique(_pairs(before, word), return_index=True, return_inverse=True)
            pairs = np.unique(np.repeat(np.arange(len(texts)), np.diff(first)) * max(1, len(one)) + kind)
            toxic, kind = part.column("__toxic").to_numpy()[pairs // max(1, len(one))], pairs % max(1, len(one))
            n = [np.bincount(kind, toxic == c, len(one)).astype(np.int64) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(before[one].view(np.int64)), pa.array(word[one].view(np.int64)), *map(pa.array, n)], names=["v", "w", "ordinary", "toxic"]
            )


@dataclass
class Order:
    """N-grams of one length: sorted hashes with both classes' counts; their contexts with totals and what discounts leave.

    A single column stands for both classes. N-grams that all have the same count may stand in `once`, as hashes alone.
    """

    keys: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    reserves: np.ndarray
    once: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    once_count: float = 0.0


def _find(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


def _columns(places: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.column_stack([np.bincount(places, values[:, c], n) for c in (0, 1)]).astype(np.float32)


def _discounts(counts: np.ndarray, once: int = 0) -> np.ndarray:
    """What modified Kneser-Ney takes from counts of 1, 2 and more (from 0: nothing), by the counts of counts.

    `once` further counts are 1.
    """
    n1, n2, n3, n4 = (max(float((counts == k).sum()) + (once if k == 1 else 0), 1.0) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    taken = np.array([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.append(0.0, np.clip(taken, [0.1, 0.1, 0.1], [1.0, 2.0, 3.0]))


@dataclass
class Words:
    """Both classes' words and pairs of words, counted by texts and discounted; between them the pairs of both together."""

    words: Order
    pairs: Order
    both: Order
    left: np.ndarray = field(default_factory=lambda: np.ones(2))  # times its chance in the corpus is that of a word a class lacks

    @classmethod
    def fit(
        cls, kinds: np.ndarray, counts: np.ndarray, kinds_once: np.ndarray, firsts: np.ndarray, totals: np.ndarray,
        at: np.ndarray, word: np.ndarray, pair_counts: np.ndarray, once_at: np.ndarray, once: np.ndarray, pairs_once: np.ndarray,
    ) -> Words:
        """From words and pairs that at least LEAST_TEXTS texts hold, with the texts of both classes, and from those of one text.

        Of words of one text the number in each class is enough (`kinds_once`); of pairs also that by first word
        (`pairs_once`), and their hashes, since both classes together keep them. `firsts` are the hashes of the pairs'
        first words, sorted, with both classes' texts of all their pairs (`totals`); `at` and `once_at` are places in them.
        """
        nothing = np.zeros(1, np.uint64)
        words = cls._order(kinds, counts, nothing, (counts.sum(0) + kinds_once)[None], np.zeros(len(kinds), np.int64), kinds_once[None])
        key = _pairs(firsts[at], word)
        order = np.argsort(key)
        key, at, pair_counts = key[order], at[order], pair_counts[order]
        pairs = cls._order(key, pair_counts, firsts, totals, at, pairs_once)
        together, all_once = pair_counts.sum(1), pairs_once.sum(1)
        discounts = _discounts(together, int(all_once.sum()))
        taken = discounts[np.minimum(together, 3).astype(int)]
        reserves = np.bincount(at, taken, len(firsts)) + discounts[1] * all_once
        both = Order(
            pairs.keys, (together - taken).astype(np.float32)[:, None], firsts, totals.sum(1, keepdims=True).astype(np.float32),
            reserves.astype(np.float32)[:, None], np.sort(_pairs(firsts[once_at], once)), float(np.float32(1 - discounts[1])),
        )
        return cls(words, pairs, both)

    @staticmethod
    def _order(keys: np.ndarray, counts: np.ndarray, contexts: np.ndarray, totals: np.ndarray, at: np.ndarray, once: np.ndarray) -> Order:
        """What is in fewer than LEAST_TEXTS texts goes to the reserve whole: `once`, by context."""
        taken = [_discounts(counts[:, c], int(once[:, c].sum()))[np.minimum(counts[:, c], 3).astype(int)] for c in (0, 1)]
        reserves = np.column_stack([np.bincount(at, taken[c], len(contexts)) + once[:, c] for c in (0, 1)]).astype(np.float32)
        left = np.column_stack([(counts[:, c] - taken[c]).astype(np.float32) for c in (0, 1)])
        order = np.argsort(keys)
        return Order(keys[order], left[order], contexts, totals.astype(np.float32), reserves)

    def shares(self, before: np.ndarray, word: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For both classes (a, b): a word's chance is a + b * its chance in the corpus."""
        at, known = _find(self.words.keys, word)
        own = [np.where(known, self.words.counts[at, c], 0) / max(1.0, float(self.words.totals[0, c])) for c in (0, 1)]
        out = [(own[c].astype(float), np.where(own[c] > 0, 0.0, self.left[c])) for c in (0, 1)]
        pair = _pairs(before, word)
        for order, context, key in ((self.both, before, pair), (self.pairs, before, pair)):
            there, seen = _find(order.contexts, context)
            at, known = _find(order.keys, key)
            rare = np.where(_find(order.once, key)[1], order.once_count, 0.0)
            for c in (0, 1) if len(order.contexts) else ():
                column = min(c, order.totals.shape[1] - 1)
                total = np.where(seen, order.totals[there, column], 0).astype(float)
                count = np.where(known, order.counts[at, column], 0) if len(order.keys) else 0.0
                left, own = order.reserves[there, column] / np.maximum(total, 1), (count + rare) / np.maximum(total, 1)
                a, b = out[c]
                out[c] = np.where(total > 0, own + left * a, a), np.where(total > 0, left * b, b)
        return out


@dataclass
class Model:
    """Column 0 of all counts is ordinary, column 1 toxic."""

    shared: np.ndarray  # counts of pairs of bytes and of bytes, over the words of the corpus
    orders: list[Order] = field(default_factory=list)
    curve: tuple[float, ...] = (0.0, 0.0, -4.0)  # slopes of both kinds of evidence, offset
    words: Words | None = None
    corpus: DataFrame | None = None  # (h, contexts) of the words beyond the head; stays with the driver
    speller: Broadcast | None = None  # the model without words, for the workers
    shown: Broadcast | None = None  # all but these three, the orders and the curve, for the workers
    kinds: int = 0
    total: float = 1.0
    split: np.ndarray = field(default_factory=lambda: np.ones(2))  # makes the classes' shares of the corpus counts sum to 1
    head: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    head_counts: np.ndarray = field(default_factory=lambda: np.zeros((0, 3)))  # contexts and both spelling log-likelihoods

    def spelling(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The ordinary and the toxic log-likelihood of each word by its bytes, a row each."""
        letters, first, place = spelled(data, starts, ends)
        if not len(letters) or not self.orders:
            return np.zeros((2, len(starts)))
        whole, context = _shared_places(letters, place)
        base = np.clip((self.shared[whole] + 0.01) / (self.shared[context] + 1), 1e-6, 1.0)
        chances = [base, base]
        on = np.arange(len(letters))  # places whose contexts were known so far: longer ones of others are not
        for n, order in zip(range(LOWEST, HIGHEST + 1), self.orders, strict=True):
            on = on[place[on] >= n - 1]
            there, seen = _find(order.contexts, grams(letters, place, n - 1)[on - 1])
            on, there = on[seen], there[seen]
            at, known = _find(order.keys, grams(letters, place, n)[on])
            for c in (0, 1):
                count, total = np.where(known, order.counts[at, c], 0), order.totals[there, c]
                own = (np.maximum(count - DISCOUNT, 0) + order.reserves[there, c] * chances[c][on]) / np.maximum(total, 1)
                chances[c] = chances[c].copy()
                chances[c][on] = np.where(total > 0, own, chances[c][on])
        logs = np.log(np.array(chances))
        logs[:, first] = 0
        return np.add.reduceat(logs, first, axis=1)

    def word_evidence(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The toxic minus the ordinary log-likelihood of each word by its bytes."""
        ordinary, toxic = self.spelling(data, starts, ends)
        return toxic - ordinary

    def corpus_shares(self, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For both classes (p, q): a word's chance in the corpus is p + q * its discounted contexts."""
        mean = np.logaddexp(logs[0], logs[1]) - np.log(2)
        return DISCOUNT * self.kinds * np.exp(logs) / self.total, np.exp(logs - mean) / self.split[:, None] / self.total

    def parts(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
        """Each text's difference over the words of the head, its number of words, what its distinct clearly toxic words
        say (by the root of the number of distinct words), and what must be joined.

        That is: text, hash of the word, number, and p and q of both classes, whose p + q * discounted contexts is the
        chance of the word.
        """
        starts, ends, first, word, before = _word_pairs(texts)
        n_words = np.diff(first)
        if not len(word):
            none = np.zeros(0)
            return np.zeros(len(texts)), n_words, np.zeros(len(texts)), (none.astype(np.int64), none.astype(np.uint64), none.astype(np.int64), *[none] * 4)
        _, one, kind = np.unique(_pairs(before, word), return_index=True, return_inverse=True)
        kinds, example, of = np.unique(word[one], return_index=True, return_inverse=True)
        at, known = _find(self.head, kinds)
        logs, contexts = np.zeros((2, len(kinds))), np.zeros(len(kinds))
        logs[:, known], contexts[known] = self.head_counts[at[known], 1:].T, self.head_counts[at[known], 0]
        rest = one[example[~known]]
        if len(rest):
            logs[:, ~known] = self.spelling(texts.data, starts[rest], ends[rest])
        p, q = (x[:, of] for x in self.corpus_shares(logs))
        share = self.words.shares(before[one], word[one])
        p = np.array([share[c][0] + share[c][1] * p[c] for c in (0, 1)])
        q = np.array([share[c][1] * q[c] for c in (0, 1)])
        chance = p + q * np.maximum(contexts - DISCOUNT, 0)[of]
        here = np.where(known[of], np.log(np.maximum(chance[1], 1e-300)) - np.log(np.maximum(chance[0], 1e-300)), 0.0)
        document = np.repeat(np.arange(len(texts)), n_words)
        sums = np.bincount(document, here[kind], len(texts))
        held = np.unique(document * len(kinds) + of[kind])
        clear = np.maximum(logs[1] - logs[0] - MARGIN, 0)[held % len(kinds)]
        held = held // len(kinds)
        clear = np.bincount(held, clear, len(texts)) / np.maximum(np.bincount(held, minlength=len(texts)), 1) ** 0.5
        open_ = ~known[of][kind]
        pairs, n = np.unique(document[open_] * len(one) + kind[open_], return_counts=True)
        document, kind = pairs // len(one), pairs % len(one)
        return sums, n_words, clear, (document, word[one][kind], n, p[0, kind], q[0, kind], p[1, kind], q[1, kind])


def fit_orders(words: list[bytes], counts: np.ndarray) -> list[Order]:
    """Kneser-Ney counts of all lengths: the longest by texts, shorter ones by distinct bytes before them.

    An n-gram that begins a word has nothing before it and keeps its count of texts.
    """
    if not words:
        return []
    letters, _, place = spelled(*_joined(words))
    place = place.astype(np.int32)
    word = np.repeat(np.arange(len(words), dtype=np.int32), [len(w) + 2 for w in words])
    orders = []
    shorter, own = grams(letters, place, LOWEST - 1), grams(letters, place, LOWEST)
    for n in range(LOWEST, HIGHEST + 1):
        longer = grams(letters, place, n + 1) if n < HIGHEST else None
        # A context has all that is counted of it in one share; shares follow one another in order.
        share = (shorter >> np.uint64(64 - CONTEXT_BITS)).astype(np.uint8)
        parts = []
        for k in range(1 << CONTEXT_BITS):
            on = np.flatnonzero(place >= n - 1)
            on = on[share[on - 1] == k]
            inside = None if longer is None else place[on] >= n
            parts.append(_fit_order(own[on], shorter[on - 1], counts[word[on]], inside, None if longer is None else longer[on[inside]]))
        keys, *rest = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(keys)
        orders.append(Order(keys[order], rest[0][order], *rest[1:]))
        shorter, own = own, longer
    return orders


def _fit_order(
    gram: np.ndarray, ctx: np.ndarray, value: np.ndarray, inside: np.ndarray | None, longer: np.ndarray | None
) -> tuple[np.ndarray, ...]:
    """An order's arrays from the n-grams, contexts and counts of some places; those `inside` a word have `longer` ones."""
    if inside is not None:
        gram_in, ctx_in = gram[inside], ctx[inside]
        _, one, back = np.unique(longer, return_index=True, return_inverse=True)
        held = (_columns(back, value[inside], len(one)) > 0).astype(np.float32)
        gram = np.concatenate([gram_in[one], gram[~inside]])
        ctx = np.concatenate([ctx_in[one], ctx[~inside]])
        value = np.concatenate([held, value[~inside]])
    keys, one, back = np.unique(gram, return_index=True, return_inverse=True)
    table = _columns(back, value, len(keys))
    contexts, at = np.unique(ctx[one], return_inverse=True)
    return keys, table, contexts, _columns(at, table, len(contexts)), _columns(at, np.minimum(table, DISCOUNT), len(contexts))


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Slopes (one for each column of x) and offset of a logistic curve, by Newton steps with a weak pull of the scaled slopes to 0."""
    if len(x) < 2 or y.min() == y.max():
        return *[0.0] * x.shape[1], (4.0 if len(y) and y.min() == 1 else -4.0)
    scale = np.where(x.std(0) > 0, x.std(0), 1.0)
    z, weight = np.column_stack([x / scale, np.ones(len(x))]), weight / weight.mean()
    pull = np.append(np.full(x.shape[1], 0.01), 0.0)
    at = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ at, -30, 30)))
        gradient = z.T @ (weight * (p - y)) + pull * at
        hessian = (z * (weight * p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(pull)
        step = np.linalg.solve(hessian, gradient)
        at = at - step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
    return *(at[:-1] / scale).tolist(), float(at[-1])


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
    rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS,
) -> Model:
    """A model from the rows of `labels` (doc_id, 0 or 1), all of which it may learn from, and from all texts of `docs`.

    Of each class up to `rows` rows, of up to `chars` characters together, are drawn by a hash of the ID. Null IDs,
    labels other than 0 and 1, IDs with both labels and labels without a document are not used; without rows of both
    classes every score is the same.
    """
    texts = ship(docs).select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    clear = labels.where(F.col(toxic).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__id"))
    clear = clear.agg(F.min(toxic).cast("int").alias("__toxic"), F.max(toxic).alias("__other")).where("__toxic = __other").drop("__other")
    clear = pin(clear)
    order = F.xxhash64("__id", F.lit(7))
    # At most `rows` IDs of each class: small enough for a broadcast and for one window group.
    drawn = [clear.where(F.col("__toxic") == c).orderBy(order, "__id").limit(rows) for c in (0, 1)]
    found = pin(texts.join(F.broadcast(pin(drawn[0].unionByName(drawn[1]))), "__id").where("__text is not null").dropDuplicates(["__id"]))
    so_far = Window.partitionBy("__toxic").orderBy(order, "__id").rowsBetween(Window.unboundedPreceding, 0)
    within = found.select("__id", F.sum(F.length("__text")).over(so_far).alias("sum"), F.row_number().over(so_far).alias("k"))
    within = within.where((F.col("sum") <= chars) | (F.col("k") <= 2)).select("__id", (F.col("k") % 4 == 0).alias("__fits"))
    sample = found.join(F.broadcast(pin(within)), "__id")

    counted = texts.mapInArrow(_word_counts, "word binary, n long, contexts long")
    counted = pin(counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("contexts").alias("contexts")))
    shared = np.zeros(2 * SHARED_PLACES)
    spelt = counted.select("word").mapInArrow(_byte_pairs, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    shared[spelt.column("place").to_numpy()] = spelt.column("n").to_numpy()

    learnt = sample.where("not __fits").dropDuplicates(["__toxic", "__text"]).select("__toxic", "__text")
    # A row for each word, and for each pair of words, of the bounded sample.
    seen = learnt.select("__toxic", F.explode(F.array_distinct(word_list("__text"))).alias("word"))
    words = pin(seen.groupBy("word").agg(F.sum(1 - F.col("__toxic")).alias("ordinary"), F.sum("__toxic").alias("toxic")))
    often = F.col("ordinary") + F.col("toxic") >= LEAST_TEXTS
    rare = words.where(~often).agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("ordinary", "toxic")]).first()
    words = words.where(often).toArrow()
    counts = np.column_stack([words.column(c).to_numpy() for c in ("ordinary", "toxic")]).astype(float)
    if not len(counts) or not counts.sum(0).all():
        return Model(shared)
    spelt = [w.encode() for w in words.column("word").to_pylist()]
    model = Model(shared, fit_orders(spelt, counts))
    model.words = Words.fit(hash_words(spelt), counts, np.array(list(rare), float), *_collected_pairs(learnt))
    # The driver holds the model alone from here on.
    del words, spelt, counts
    pa.default_memory_pool().release_unused()
    _with_corpus(model, counted)

    held = _evidence(sample.where("__fits").select(F.col("__id").alias("__key"), "__text"), model)
    held = sample.where("__fits").select("__id", "__toxic").join(held, F.col("__id") == F.col("__key"), "left")
    held = held.select("__toxic", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("evidence", "__clear")]).toArrow()
    sizes = {r["__toxic"]: r["count"] for r in clear.groupBy("__toxic").count().collect()}
    y = held.column("__toxic").to_numpy().astype(float)
    share = np.where(y == 1, sizes.get(1, 0) / max(1, y.sum()), sizes.get(0, 0) / max(1, (1 - y).sum()))
    model.curve = fit_curve(np.column_stack([held.column(c).to_numpy() for c in ("evidence", "__clear")]), y, share)
    return model


def _collected_pairs(learnt: DataFrame) -> tuple[np.ndarray, ...]:
    """The pairs of words of the bounded sample as `Words.fit` takes them; those of a single text come as the second word alone."""
    pairs = learnt.mapInArrow(_pair_counts, "v long, w long, ordinary long, toxic long")
    # Placed by first word once, pairs are counted and listed without a further shuffle.
    pairs = pairs.repartition("v").groupBy("v", "w").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    single = F.col("ordinary") + F.col("toxic") < LEAST_TEXTS
    rows = pairs.groupBy("v").agg(
        F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"),
        F.sum(F.when(single, F.col("toxic")).otherwise(0)).alias("rare"),
        F.collect_list(F.when(single, F.col("w"))).alias("once"),
        *[F.collect_list(F.when(~single, F.col(c).cast(kind))).alias(f"more_{c}") for c, kind in (("w", "long"), ("ordinary", "int"), ("toxic", "int"))],
    ).toArrow()
    order = np.argsort(rows.column("v").to_numpy().view(np.uint64))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    flat = lambda c: pc.list_flatten(rows.column(c)).to_numpy()
    many, few = (pc.list_value_length(rows.column(c)).to_numpy() for c in ("more_w", "once"))
    totals, rare = np.column_stack([rows.column(c).to_numpy() for c in ("ordinary", "toxic")]), rows.column("rare").to_numpy()
    return (
        rows.column("v").to_numpy().view(np.uint64)[order], totals[order].astype(float),
        np.repeat(place, many), flat("more_w").view(np.uint64), np.column_stack([flat("more_ordinary"), flat("more_toxic")]).astype(float),
        np.repeat(place, few), flat("once").view(np.uint64), np.column_stack([few - rare, rare])[order].astype(float),
    )


def _with_corpus(model: Model, counted: DataFrame) -> None:
    """Give the model the table of words, its sums, and its head."""
    spark = counted.sparkSession
    # As many rows as there are different numbers of texts that a word can be in.
    sizes = counted.groupBy("contexts").agg(F.count("*").alias("n")).toArrow().sort_by([("contexts", "descending")])
    n, contexts = sizes.column("n").to_numpy(), sizes.column("contexts").to_numpy()
    model.kinds, model.total = int(n.sum()), max(1.0, float((n * contexts).sum()))
    within = contexts[np.cumsum(n) <= HEAD_WORDS]
    least = int(within.min()) if len(within) else 1 << 62
    learnt = model.words.words
    speller = model.speller = spark.sparkContext.broadcast(Model(model.shared, model.orders))
    shown = spark.sparkContext.broadcast((learnt.keys, learnt.counts > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                where = _joined(batch.column("word").to_pylist())
                contexts, (keys, owned) = batch.column("contexts").to_numpy(), shown.value
                logs = speller.value.spelling(*where)
                mean = np.logaddexp(logs[0], logs[1]) - np.log(2)
                h, on = hashes(*where), contexts >= least
                at, known = _find(keys, h)
                parts = np.exp(logs - mean) * np.maximum(contexts - DISCOUNT, 0), np.exp(logs)
                own = owned[at].T & known
                sums = parts[0].sum(1)
                held = np.array([(x * own).sum(1) for x in parts])
                h = pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(h.view(np.int64))])
                # The first row has the sums; logs are only kept for the head.
                kept = [pa.array(np.append(sums[c], np.where(on, logs[c], 0.0))) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [h, pa.array(np.append(0, contexts)), *kept, pa.array(np.append(False, on)),
                     pa.array([held.ravel().tolist(), *[None] * len(on)], pa.list_(pa.float64()))],
                    names=[*"h contexts ordinary toxic head held".split()],
                )

    found = pin(counted.select("word", "contexts").mapInArrow(run, "h long, contexts long, ordinary double, toxic double, head boolean, held array<double>"))
    shown.destroy()
    del shown
    sums = found.where("h is null").agg(F.sum("ordinary"), F.sum("toxic"), *[F.sum(F.get("held", F.lit(k))) for k in range(4)]).first()
    head = found.where("head").select("h", "contexts", "ordinary", "toxic").toArrow()
    whole = max(model.total - DISCOUNT * model.kinds, 1e-9)
    sums = np.array([x or 0.0 for x in sums])
    model.split = np.maximum(sums[:2] / whole, 1e-9)
    # What the corpus gives to words that a class has of its own; the others share the reserve.
    held = (sums[2:4] / model.split + DISCOUNT * model.kinds * sums[4:]) / model.total
    reserve = model.words.words.reserves[0] / np.maximum(model.words.words.totals[0], 1)
    model.words.left = reserve / np.maximum(1 - held, 1e-3)
    h = head.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    model.head, model.head_counts = h[order], np.column_stack([head.column(c).to_numpy() for c in ("contexts", "ordinary", "toxic")])[order]
    model.corpus = found.where("h is not null and not head").select("h", "contexts")


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `evidence` and `score` (0 to 1); columns of these names are replaced.

    Null and empty texts have the evidence 0. Scores depend on the text alone, so repeated rows have equal ones. Words
    that the corpus of `train` lacks count as words of no context.
    """
    kept = ship(docs).drop("evidence", "score").withColumn("__key", F.xxhash64(text))
    if model.words is None:
        found = kept.drop("__key").withColumns({"evidence": F.lit(0.0), "__clear": F.lit(0.0)})
    else:
        each = _evidence(kept.select("__key", F.col(text).alias("__text")).where("__text != ''"), model)
        found = kept.join(each, "__key", "left").drop("__key")
        found = found.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("evidence", "__clear")})
    whole, clear, offset = model.curve
    at = whole * F.col("evidence") + clear * F.col("__clear") + offset
    return found.withColumn("score", 1 / (1 + F.exp(-F.least(F.greatest(at, F.lit(-30.0)), F.lit(30.0))))).drop("__clear")


def _evidence(texts: DataFrame, model: Model) -> DataFrame:
    """(__key, evidence, __clear) of each key of `texts` (__key, __text); rows of one key have one text."""
    if model.shown is None:
        rest = replace(model, corpus=None, speller=None, shared=model.shared[:0], orders=[])
        model.shown = texts.sparkSession.sparkContext.broadcast(rest)
    shared, speller = model.shown, model.speller
    key = texts.schema["__key"]
    chances = ["p0", "q0", "p1", "q1"]
    schema = T.StructType(
        [key, *(T.StructField(c, T.LongType()) for c in ("h", "n", "words")), *(T.StructField(c, T.DoubleType()) for c in ("sum", "clear", *chances))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = replace(shared.value, shared=speller.value.shared, orders=speller.value.orders)
        for batch in batches:
            for part, texts in slices(batch, "__text"):
                sums, n_words, clear, (document, h, n, *rest) = whole.parts(texts)
                keys, none = part.column("__key"), np.zeros(len(sums))
                # A row for the text, which meets no word, and one for each pair of which the second word is not in the head.
                own = [keys, pa.array(mixed(np.arange(len(sums), dtype=np.uint64)).view(np.int64)), pa.array(none.astype(np.int64)), pa.array(n_words), pa.array(sums), pa.array(clear)]
                yield pa.RecordBatch.from_arrays([*own, *[pa.array(none)] * 4], names=schema.names)
                zero = np.zeros(len(h))
                more = [keys.take(pa.array(document)), pa.array(h.view(np.int64)), pa.array(n), pa.array(zero.astype(np.int64)), pa.array(zero), pa.array(zero)]
                yield pa.RecordBatch.from_arrays([*more, *map(pa.array, rest)], names=schema.names)

    rows = texts.mapInArrow(run, schema).join(model.corpus, "h", "left")
    held = F.greatest(F.coalesce("contexts", F.lit(0)) - DISCOUNT, F.lit(0.0))
    log = lambda c: F.log(F.greatest(F.col(f"p{c}") + F.col(f"q{c}") * held, F.lit(1e-300)))
    # A head's row has n = 0.
    each = F.col("sum") + F.when(F.col("n") > 0, F.col("n") * (log(1) - log(0))).otherwise(0.0)
    total = rows.groupBy("__key").agg(F.sum(each).alias("sum"), F.sum("words").alias("words"), F.max("clear").alias("__clear"))
    return total.select("__key", F.when(F.col("words") > 0, F.col("sum") / F.col("words")).otherwise(0.0).alias("evidence"), "__clear")
