"""Repair of conversation structure: the cheapest edits that give turns of the right roles, and the least such edits.

A repaired conversation is empty, or an optional system turn and then one or more pairs of user and assistant. Rows are
kept, get another role, or are deleted; turns without text are inserted. Each row and border is a layer of four nodes:
nothing yet, after the system turn, after a user, after an assistant. A dynamic programme gives each node its least cost to the
end; arcs that reach it are optimal. Nodes are ranked by the least letters of their optimal arcs, first one letter, then
2, 4, 8, ..: a node's rank for twice the length is that of its own rank and of the rank of the node its pointer leads to,
and pointers double with it. Doubled pointers then list the least path from the first node.

A conversation may be of any length. Rows are dealt by ranges of conversation and order, so that a long one is spread over
tasks, and written as pages of bounded size. A page that holds its whole conversation is repaired at once. The pages of
others send one small row each: the least cost from each node at its begin to each node at its end. These are added up from
the last page to the first, then the pages' least paths are followed from the first to the last, a row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.llm.shipping import ship
from fareline.session import pin

#: Bounds of a page: rows, and bytes of text beyond its first row.
PAGE_ROWS, PAGE_BYTES = 4_096, 1 << 17
#: Rows whose nodes are held at once.
CHUNK_ROWS = 32_768
# Letters of edits, and what edits cost.
LETTERS = "DIKR"
RETITLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
NODES, FAR = 4, 1 << 60
#: By node and role letter: the node after a kept row of that role (-1: not allowed). By node: the node after a user or
#: assistant turn that is put there, and the role of that turn.
_AFTER = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
_NEXT, _ROLE = np.array([2, 2, 3, 2]), np.array(["user", "user", "assistant", "user"])
_FINAL = np.array([0, FAR, FAR, 0])
_KEPT = np.array([_AFTER["s"], _AFTER["u"], _AFTER["a"], (-1, -1, -1, -1)])


def _codes(roles: np.ndarray) -> np.ndarray:
    """0, 1, 2 for roles that begin with s, u, a; 3 for others."""
    first = np.array([r[:1] for r in roles], "U1")
    return np.select([first == "s", first == "u", first == "a"], [0, 1, 2], 3)


def _with_inserts(cost: np.ndarray) -> np.ndarray:
    """Least costs of the nodes of a layer if turns may be inserted first; more than two never pay off."""
    for _ in range(3):
        cost = np.minimum(cost, INSERT + cost[..., _NEXT])
    return cost


def costs(codes: np.ndarray, bad: np.ndarray, short: np.ndarray, bounds: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least cost to the end of each node of each layer, for several runs of rows at once.

    Run k has the rows bounds[k]:bounds[k+1] and one layer more, all at bounds[k] + k and on; `last` holds what follows
    each run's last layer: the costs of its nodes, or, with a further axis, several such costs at once.
    """
    n_rows = np.diff(bounds)
    out = np.full((len(codes) + len(n_rows), NODES, *last.shape[2:]), FAR, np.int64)
    end = bounds[1:] + np.arange(len(n_rows))
    tail = last.swapaxes(1, -1)
    out[end] = _with_inserts(tail).swapaxes(1, -1) if last.ndim > 2 else _with_inserts(tail)
    order = np.argsort(-n_rows, kind="stable")
    for back in range(1, int(n_rows.max(initial=0)) + 1):
        order = order[: int((n_rows[order] >= back).sum())]
        row, layer = bounds[order + 1] - back, end[order] - back
        below = out[layer + 1]
        extra = (short[row] * CUT_SHORT).reshape(-1, *[1] * (below.ndim - 1))
        to = _KEPT[codes[row]]
        keep = np.take_along_axis(below, np.maximum(to, 0).reshape(*to.shape, *[1] * (below.ndim - 2)), 1) + extra
        no_keep = ((to < 0) | bad[row, None]).reshape(*to.shape, *[1] * (below.ndim - 2))
        keep = np.where(no_keep, FAR, keep)
        title = np.where(bad[row].reshape(-1, *[1] * (below.ndim - 1)), FAR, below[:, _NEXT] + RETITLE + extra)
        best = np.minimum(np.minimum(below + DELETE, keep), title)
        moved = _with_inserts(best.swapaxes(1, -1)).swapaxes(1, -1) if below.ndim > 2 else _with_inserts(best)
        out[layer] = np.minimum(moved, FAR)
    return out


def least_arcs(codes: np.ndarray, bad: np.ndarray, short: np.ndarray, bounds: np.ndarray, cost: np.ndarray, open_end: np.ndarray):
    """The nodes' ranks by the least audit to the end, and pointers along it, for each power of two.

    Nodes are numbered layer by layer. Returns (letter of each node's arc: an index into LETTERS, -1 at an end; list of
    pointers over 1, 2, 4, .. arcs; ranks). Runs end at the last layer's nodes whose costs are `open_end`.
    """
    n_rows = np.diff(bounds)
    n_layers = len(codes) + len(n_rows)
    run = np.repeat(np.arange(len(n_rows)), n_rows + 1)
    last = np.zeros(n_layers, bool)
    last[bounds[1:] + np.arange(len(n_rows))] = True
    row = np.minimum(np.arange(n_layers) - run, max(0, len(codes) - 1))
    base = np.arange(n_layers)[:, None] * NODES
    arcs = np.full((4, n_layers, NODES), -1, np.int64)
    pay = lambda target, price: np.where(target >= 0, cost.ravel()[np.maximum(target, 0)] + price, FAR)
    ends = np.zeros((n_layers, NODES), bool)
    ends[last] = (cost[last] == open_end) & (open_end < FAR)
    if len(codes):
        fine, extra = ~bad[row] & ~last, (short[row] * CUT_SHORT)[:, None]
        go = np.where(~last[:, None], base + NODES + np.arange(NODES), -1)
        arcs[0] = np.where(pay(go, DELETE) == cost, go, -1)
        to = _KEPT[codes[row]]
        go = np.where(fine[:, None] & (to >= 0), base + NODES + to, -1)
        arcs[2] = np.where(pay(go, extra) == cost, go, -1)
        go = np.where(fine[:, None], base + NODES + _NEXT, -1)
        arcs[3] = np.where(pay(go, RETITLE + extra) == cost, go, -1)
    go = base + _NEXT
    arcs[1] = np.where(pay(go, INSERT) == cost, go, -1)
    arcs[:, (cost >= FAR) | ends] = -1
    arcs = arcs.reshape(4, -1)
    # One letter: a node's arcs have different letters, so the least one is one arc.
    there = arcs >= 0
    letter = np.where(there.any(0), there.argmax(0), -1)
    node = np.arange(arcs.shape[1])
    pointer = np.where(letter >= 0, arcs[np.maximum(letter, 0), node], node)
    rank, pointers = letter + 1, [pointer]
    while (rank[pointer] > 0).any():
        # A shorter audit comes before those that go on from it: the rank of an end is 0.
        both = rank * (int(rank.max()) + 1) + rank[pointer]
        rank = np.unique(both, return_inverse=True)[1] + int(both.min() > 0)
        pointer = pointer[pointer]
        rank = np.where(letter < 0, 0, rank)
        pointers.append(pointer)
    return letter, pointers, rank


def follow(start: int, pointers: list[np.ndarray], letter: np.ndarray) -> np.ndarray:
    """The nodes of the least path from `start`, its end included: each pointer doubles what is listed."""
    path = np.array([start])
    for pointer in pointers:
        if letter[path[-1]] < 0:
            break
        path = np.append(path, pointer[path])
    return path[: int(np.argmax(letter[path] < 0)) + 1]


def _text_faults(text: str) -> tuple[str, str, str]:
    """SQL: blank, cut short (last character that is not white space), and a digest of conversation, role and text."""
    inner = rf"regexp_replace({text}, '[\\x20\\x09-\\x0D]+$', '')"
    return f"{inner} = ''", f"right({inner}, 1) not in ('.', '!', '?')", (
        f"unhex(sha2(concat(coalesce(concat('c', cast(conv_id as string)), ''), '|', length(role), ':', role, {text}), 256))"
    )


_PAGE = T.StructType(
    [T.StructField("page", T.LongType()), T.StructField("whole", T.BooleanType()), T.StructField("turns", T.ArrayType(T.LongType())),
     T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType())),
     T.StructField("digests", T.ArrayType(T.BinaryType())), T.StructField("blank", T.ArrayType(T.BooleanType())),
     T.StructField("short", T.ArrayType(T.BooleanType()))]
)


def pages_of(rows: DataFrame, page_rows: int, page_bytes: int) -> DataFrame:
    """Rows (conv_id, turn, role, text, gone) in order as pages: at most `page_rows` rows and about `page_bytes` bytes of
    one conversation each. Rows that are gone only keep their conversation. `whole`: no other page has rows of it."""
    blank, short, digest = _text_faults("text")
    rows = rows.withColumns({"blank": F.expr(blank), "short": F.expr(short), "digest": F.expr(digest), "head": F.substring("text", 1, 64)})
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "head", "digest")]
    # The number of a row only tells equal rows apart, so that a range can end between them.
    spread = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order, "row").sortWithinPartitions(*order)
    kept = spread.select("conv_id", "turn", "role", "text", "gone", "blank", "short", "digest")
    schema = T.StructType([rows.schema["conv_id"], *_PAGE.fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size, first, cut = TaskContext.get().partitionId() << 33, [], 0, True, False

        def page(whole: bool) -> tuple:
            live = [r for r in held if not r[4]]
            return (held[0][0], number, whole, [r[1] for r in live], [r[2] for r in live], [r[3] for r in live],
                    [r[7] for r in live], [r[5] for r in live], [r[6] for r in live])

        def out(pages: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.binary()), *[pa.list_(pa.bool_())] * 2]
            columns = list(zip(*pages, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], conv_type), *map(pa.array, columns[1:], kinds)], names=names)

        conv_type = None
        ready, weight = [], 0
        for batch in batches:
            conv_type = batch.schema.field(0).type
            for r in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and (r[0] != held[0][0] or len(held) >= page_rows or size >= page_bytes):
                    same = r[0] == held[0][0]
                    ready.append(page(not (first or cut or same)))
                    weight, number, first, cut = weight + size, number + 1, first and same, same
                    held, size = [], 0
                    if len(ready) >= 500 or weight >= page_bytes:
                        yield out(ready)
                        ready, weight = [], 0
                held.append(r)
                size += 4 * len(r[3])
        if held:
            yield out([*ready, page(False)])

    return kept.mapInArrow(run, schema)


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False)


def _seen(digests: list[bytes], earlier: list[bytes] | None) -> np.ndarray:
    known, out = set(earlier or []), np.zeros(len(digests), bool)
    for k, d in enumerate(digests):
        out[k] = d in known
        known.add(d)
    return out


class _Pages:
    """The rows of a batch of pages as flat arrays."""

    def __init__(self, batch: pa.RecordBatch):
        repeated = np.concatenate([_seen(d, e) for d, e in zip(batch.column("digests").to_pylist(), batch.column("earlier").to_pylist(), strict=True)])
        lists = batch.column("roles")
        self.n = np.diff(lists.offsets.to_numpy())
        self.bounds = np.append(0, np.cumsum(self.n))
        self.codes = _codes(_flat(batch, "roles").astype(object))
        self.blank, short = _flat(batch, "blank").astype(bool), _flat(batch, "short").astype(bool)
        self.repeated = repeated & ~self.blank
        self.bad = self.blank | self.repeated
        self.short = short & ~self.bad

    def edits(self, batch: pa.RecordBatch, after: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
        """Audit and repaired turns of each page, from its start node on; `after` are the costs beyond its end."""
        cost = costs(self.codes, self.bad, self.short, self.bounds, after)
        letter, pointers, _ = least_arcs(self.codes, self.bad, self.short, self.bounds, cost, after)
        roles, texts = batch.column("roles").flatten().to_pylist(), batch.column("texts").flatten().to_pylist()
        audits, made = [], []
        for k in range(batch.num_rows):
            first = self.bounds[k] + k
            path = follow(int(first * NODES + start[k]), pointers, letter)
            word = [LETTERS[x] for x in letter[path[:-1]].tolist()]
            layer, role, turns = path // NODES - first + self.bounds[k], _ROLE[path % NODES], []
            for x, i, new in zip(word, layer.tolist(), role.tolist(), strict=False):
                if x == "I":
                    turns.append({"role": new, "text": ""})
                elif x != "D":
                    turns.append({"role": roles[i] if x == "K" else new, "text": texts[i]})
            audits.append("".join(word))
            made.append(turns)
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        return pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("page"), pa.array(audits), pa.array(made, kind)], names=["conv_id", "page", "audit", "repaired"]
        )


_COUNTS = "gaps blank duplicate truncated illegal cost".split()
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True


def _inner(pages: _Pages, batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """By page: faults, pairs of neighbours that are not legal, least and greatest turn, and number of turns."""
    n, bounds = pages.n, pages.bounds
    page = np.repeat(np.arange(len(n)), n)
    count = lambda on: np.bincount(page[on], minlength=len(n))
    pair = page[1:] == page[:-1]
    wrong = np.zeros(len(page), bool)
    wrong[1:] = pair & ~_LEGAL[pages.codes[:-1], pages.codes[1:]]
    column = batch.column("turns").flatten()
    known = np.array(column.is_valid())
    turn = column.fill_null(0).to_numpy()
    new = known.copy()
    new[1:] &= ~(pair & known[:-1] & (turn[1:] == turn[:-1]))
    low, high = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    some = count(known) > 0
    # Turns ascend inside a page, those without a number first.
    first = bounds[1:] - count(known)
    low[some], high[some] = turn[first[some]], turn[bounds[1:][some] - 1]
    return {"blank": count(pages.blank), "duplicate": count(pages.repeated), "truncated": count(pages.short), "illegal": count(wrong),
            "known": some, "low": low, "high": high, "distinct": count(new)}


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repair pages that hold their whole conversation."""
    for batch in _chunks(batches):
        pages = _Pages(batch)
        after = np.tile(_FINAL, (batch.num_rows, 1))
        cost = costs(pages.codes, pages.bad, pages.short, pages.bounds, after)[pages.bounds[:-1] + np.arange(batch.num_rows), 0]
        found = _inner(pages, batch)
        gaps = np.where(found["known"], found["high"] - found["low"] + 1 - found["distinct"], 0)
        out = pages.edits(batch, after, np.zeros(batch.num_rows, np.int64))
        counts = [gaps, *[found[c] for c in _COUNTS[1:5]], cost]
        yield pa.RecordBatch.from_arrays(
            [*out.columns, pa.array(np.ones(batch.num_rows, np.int64)), *[pa.array(c.astype(np.int64)) for c in counts]],
            names=[*out.schema.names, "pages", *_COUNTS],
        )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with a bounded number of rows in their pages."""
    for batch in batches:
        ends, first = batch.column("roles").offsets.to_numpy() if batch.num_rows else [0], 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + CHUNK_ROWS, "right")) - 1)
            yield pa.concat_batches([batch.slice(first, last - first)]).take(pa.array(range(min(last, batch.num_rows) - first)))
            first = last


_LISTED = [*("blank duplicate truncated illegal low high distinct".split())]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page its counts, what its borders show, and the least costs from each first to each last node."""
    for batch in _chunks(batches):
        pages = _Pages(batch)
        found = _inner(pages, batch)
        last = np.broadcast_to(np.where(np.eye(NODES, dtype=bool), 0, FAR), (batch.num_rows, NODES, NODES))
        whole = costs(pages.codes, pages.bad, pages.short, pages.bounds, last)[pages.bounds[:-1] + np.arange(batch.num_rows)]
        some = pages.n > 0
        codes = [np.full(len(some), -1), np.full(len(some), -1)]
        codes[0][some], codes[1][some] = pages.codes[pages.bounds[:-1][some]], pages.codes[pages.bounds[1:][some] - 1]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("page"), *[pa.array(found[c].astype(np.int64)) for c in _LISTED], pa.array(found["known"]),
             *[pa.array(c.astype(np.int64)) for c in codes], pa.array(whole.reshape(len(some), -1).tolist(), pa.list_(pa.int64()))],
            names=["conv_id", "page", *_LISTED, "known", "first", "last", "costs"],
        )


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the last page of each conversation to its first: what each page's last nodes cost to the end; then a row of
    the conversation's totals without a page."""
    names, state, conv = ["conv_id", "page", "after", "pages", *_COUNTS], None, None

    def total() -> tuple:
        gaps = state["high"] - state["low"] + 1 - state["distinct"] if state["known"] else 0
        return (conv, None, None, state["pages"], gaps, *[state[c] for c in _COUNTS[1:5]], int(state["cost"][0]))

    def out(made: list[tuple]) -> pa.RecordBatch:
        kinds = [kind, pa.int64(), pa.list_(pa.int64()), *[pa.int64()] * 7]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), kinds, strict=True)], names=names)

    kind = None
    for batch in batches:
        kind, made = batch.schema.field("conv_id").type, []
        for r in batch.to_pylist():
            if state is None or r["conv_id"] != conv:
                if state is not None:
                    made.append(total())
                conv = r["conv_id"]
                state = dict.fromkeys(_LISTED, 0) | {"pages": 0, "known": False, "cost": _FINAL, "first": -1}
            made.append((conv, r["page"], state["cost"].tolist(), None, *[None] * 6))
            both = np.array(r["costs"]).reshape(NODES, NODES)
            state["cost"] = np.minimum((both + state["cost"][None, :]).min(1), FAR)
            for c in _LISTED[:4]:
                state[c] += r[c]
            state["illegal"] += r["last"] >= 0 and state["first"] >= 0 and not _LEGAL[r["last"], state["first"]]
            state["first"] = r["first"] if r["first"] >= 0 else state["first"]
            if r["known"]:
                state["distinct"] += r["distinct"] - (state["known"] and state["low"] == r["high"])
                state["high"], state["low"] = state["high"] if state["known"] else r["high"], r["low"]
                state["known"] = True
            state["pages"] += 1
        if made:
            yield out(made)
    if state is not None:
        yield out([total()])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page the last node that the least path from each of its first nodes comes to."""
    for batch in _chunks(batches):
        pages = _Pages(batch)
        after = batch.column("after").flatten().to_numpy().reshape(-1, NODES)
        cost = costs(pages.codes, pages.bad, pages.short, pages.bounds, after)
        _, pointers, _ = least_arcs(pages.codes, pages.bad, pages.short, pages.bounds, cost, after)
        first = (pages.bounds[:-1] + np.arange(batch.num_rows))[:, None] * NODES + np.arange(NODES)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("page"), pa.array((pointers[-1][first] % NODES).tolist(), pa.list_(pa.int64()))],
            names=["conv_id", "page", "exits"],
        )


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node at which each page begins, from the first page of each conversation to its last."""
    conv, node, begun = None, 0, False
    for batch in batches:
        starts = []
        for c, exits in zip(batch.column("conv_id").to_pylist(), batch.column("exits").to_pylist(), strict=True):
            if not begun or c != conv:
                conv, node, begun = c, 0, True
            starts.append(node)
            node = exits[node]
        yield pa.RecordBatch.from_arrays([batch.column("page"), pa.array(starts, pa.int64())], names=["page", "start"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _chunks(batches):
        after = batch.column("after").flatten().to_numpy().reshape(-1, NODES)
        yield _Pages(batch).edits(batch, after, batch.column("start").to_numpy())


def _streamed(df: DataFrame, ascending: bool) -> DataFrame:
    """One conversation's pages, a small row each, pass one task in order."""
    page = F.col("page").asc() if ascending else F.col("page").desc()
    return df.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), page)


def _of_several_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(audit and repaired turns of each page, totals of each conversation) where pages may have others beside them."""
    conv = pages.schema["conv_id"]
    field = lambda text: T._parse_datatype_string(text).fields
    held = pages.select("page", F.explode(F.array_distinct("digests")).alias("digest"))
    first = held.groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n")).where("n > 1")
    late = held.join(first, "digest").where("page > first").groupBy("page").agg(F.collect_list("digest").alias("earlier"))
    pages = pin(pages.join(late, "page", "left"))
    lean = [c for c in pages.columns if c != "texts"]
    sums = T.StructType([conv, *field(f"page long, {' long, '.join(_LISTED)} long, known boolean, first long, last long, costs array<long>")])
    back = T.StructType([conv, *field(f"page long, after array<long>, pages long, {' long, '.join(_COUNTS)} long")])
    walked = pin(_streamed(pages.select(*lean).mapInArrow(_sums, sums), False).mapInArrow(_backward, back))
    totals = walked.where("page is null").select("conv_id", "pages", *_COUNTS)
    after = walked.where("page is not null").select("page", "after")
    exits = T.StructType([conv, *field("page long, exits array<long>")])
    through = _streamed(pages.select(*lean).join(after, "page").mapInArrow(_exits, exits), True)
    start = pin(through.mapInArrow(_forward, "page long, start long").join(after, "page"))
    made = T.StructType([conv, *field("page long, audit string, repaired array<struct<role:string,text:string>>")])
    return pages.join(start, "page").mapInArrow(_parts, made), totals


def repair(rows: DataFrame, gone: str | None = None, page_rows: int = PAGE_ROWS, page_bytes: int = PAGE_BYTES) -> DataFrame:
    """Repaired conversations of (conv_id, turn, role, text) as pages: conv_id, page (in order), audit, repaired (an array
    of role and text), pages (of the conversation), and its gaps, blank, duplicate, truncated, illegal and cost.

    Rows go by turn, those without one first; rows of equal turn by role, then by the first 64 characters of the text and
    a digest of it, so that equal rows stand beside each other and all but the first are duplicates. A null role or text
    is one space; rows without a conversation are one conversation. Rows for which the column `gone` is true only make
    their conversation appear; one without other rows has zeros, an empty audit and no turns. An empty table gives no
    pages; other columns take no part.
    """
    flag = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    given = ship(rows).select("conv_id", F.col("turn").cast("long").alias("turn"), space("role"), space("text"), flag.alias("gone"))
    pages = pin(pages_of(given, page_rows, page_bytes))
    longs = ", ".join(f"{c} long" for c in ("pages", *_COUNTS))
    made = f"page long, audit string, repaired array<struct<role:string,text:string>>, {longs}"
    schema = T.StructType([pages.schema["conv_id"], *T._parse_datatype_string(made).fields])
    alone = pages.where("whole").withColumn("earlier", F.lit(None).cast("array<binary>")).mapInArrow(_whole, schema)
    parts, totals = _of_several_pages(pages.where("not whole"))
    same = parts["conv_id"].eqNullSafe(totals["conv_id"])
    return alone.unionByName(parts.join(totals, same).drop(totals["conv_id"]))


def summarize(repaired: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, its counts, audit, and repaired_sha256: of its turns as `role:text`, a line each.

    A digest runs over a conversation's pages in order, so those of one conversation pass one task, a page at a time.
    """
    line = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    given = repaired.select("conv_id", "page", "pages", *_COUNTS, "audit", line.alias("lines"))
    alone = given.where("pages = 1").select("conv_id", *_COUNTS, "audit", F.sha2(F.array_join("lines", "\n"), 256).alias("repaired_sha256"))
    schema = alone.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest, audit, seen, begun = None, None, [], 0, False
        for batch in batches:
            for r in batch.to_pylist():
                if not seen:
                    digest, audit, begun = hashlib.sha256(), [], False
                for x in r["lines"]:
                    digest.update(("\n" if begun else "").encode() + x.encode())
                    begun = True
                audit.append(r["audit"])
                seen += 1
                if seen == r["pages"]:
                    at, seen = [r["conv_id"], *[r[c] for c in _COUNTS], "".join(audit), digest.hexdigest()], 0
                    kinds = [batch.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(at, kinds, strict=True)], names=schema.names)

    return alone.unionByName(_streamed(given.where("pages > 1"), True).mapInArrow(run, schema))


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, by the crc32 of `conv_id:turn` modulo 20: 0 drops a row (`gone`), 1 empties its
    text, 2 takes its `.!?` away, 3 repeats it, 4 makes it a user's. Nulls count as one space."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(word("text"), ".!?", "")).otherwise(word("text"))
    hit = rows.withColumn("kind", kind).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(word("role")).alias("role"), text.alias("text"),
        (F.col("kind") == 0).alias("gone"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return hit.drop("copy")
