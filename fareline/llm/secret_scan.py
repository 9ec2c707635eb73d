"""Secrets in texts: known forms, and strings whose sliding-window entropy is high for their character class.

All in SQL functions. Matches of a pattern are placed by cutting the text at them: the lengths of the pieces between and
of the matches add up to positions. A candidate string (a long run of one character class) is walked once: the counts
of the window's characters change by the one that enters and the one that leaves, and with them the sum of c * log2(c)
that the Shannon entropy needs, as an exact integer. Candidates of allowed forms are suppressed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The known forms, each with its pattern, the group whose length counts, and the least length.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = [("assign", ASSIGN, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]{24,}", 0, 24)]

#: Characters in a window; for each class its characters, and the entropy in bits from which a window is a secret.
WINDOW = 20
CLASSES = [
    ("entropy_hex", "[0-9A-Fa-f]", "0123456789abcdefABCDEF", 3.0),
    ("entropy_base64", "[A-Za-z0-9+/_=-]", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.8),
]
#: Candidates that hold one of these are no secrets: identifiers in the usual five groups, plain words, plain numbers,
#: and placeholders.
ALLOWED = [
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$", "^[A-Za-z/_=-]+$", "^[0-9+/_=-]+$",
    "(?i)example|sample|placeholder|dummy|changeme|your_|xxxx|0000000|1234567|abcdefg",
]
_SCALE = 1 << 20


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _placed(text: str, pattern: str, group: int, least: int, kind: str, place: int) -> str:
    """SQL for an array of (start, place, end, kind, found) of a pattern's matches, leftmost first and not overlapping."""
    found = _text(pattern)
    return f"""if({text} rlike {found}, aggregate(
        arrays_zip(split({text}, {found}, -1), regexp_extract_all({text}, {found}, 0), regexp_extract_all({text}, {found}, {group})),
        named_struct('at', 0L, 'out', cast(array() as array<struct<start:bigint,place:int,end:bigint,kind:string,found:string>>)),
        (s, x) -> if(x['1'] is null, s, named_struct(
            'at', s.at + length(x['0']) + length(x['1']),
            'out', if(length(x['2']) >= {least}, concat(s.out, array(named_struct(
                'start', s.at + length(x['0']), 'place', {place}, 'end', s.at + length(x['0']) + length(x['1']),
                'kind', '{kind}', 'found', x['1']))), s.out))),
        s -> s.out), cast(array() as array<struct<start:bigint,place:int,end:bigint,kind:string,found:string>>))"""


def entropy_limit(bits: float, window: int = WINDOW) -> int:
    """The largest scaled sum of c * log2(c) with which a window still has this entropy."""
    return math.floor((math.log2(window) - bits) * window * _SCALE)


def _hot_part(found: str, alphabet: str, bits: float, window: int) -> str:
    """SQL for (first, last): from the first to the last character under windows of high entropy; first is -1 without any."""
    table = ", ".join(f"{round(c * math.log2(c) * _SCALE) if c else 0}L" for c in range(window + 1))
    return f"""transform(array(transform(regexp_extract_all({found}, '.', 0), ch -> instr({_text(alphabet)}, ch) - 1)), codes ->
        aggregate(sequence(0, size(codes) - 1),
            named_struct('counts', array_repeat(0, {len(alphabet)}), 'sum', 0L, 'first', -1, 'last', -1),
            (s, i) -> transform(array(named_struct(
                'comes', codes[i], 'goes', if(i >= {window}, codes[i - {window}], -1))), m -> transform(array(
                s.sum + if(m.comes = m.goes, 0L, array({table})[s.counts[m.comes] + 1] - array({table})[s.counts[m.comes]]
                    + if(m.goes >= 0, array({table})[s.counts[m.goes] - 1] - array({table})[s.counts[m.goes]], 0L))),
                total -> named_struct(
                    'counts', transform(s.counts, (v, k) -> v + if(k = m.comes, 1, 0) - if(k = m.goes, 1, 0)),
                    'sum', total,
                    'first', if(s.first < 0 and i >= {window - 1} and total <= {entropy_limit(bits, window)}L, i - {window - 1}, s.first),
                    'last', if(i >= {window - 1} and total <= {entropy_limit(bits, window)}L, i + 1, s.last)))[0])[0]))[0]"""


def find_secrets(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """`docs` with `secrets`: an array of (kind, start, end) by start, then kind as listed above.

    Positions count characters (code points), ends exclusive. Matches of the known forms (`assign`, `access`, `hex`)
    always stay. A candidate of an entropy class is a run of `window` or more of the class's characters; its span
    reaches over all its windows of high entropy. It is dropped if its run has an allowed form, or if it lies inside a
    match of a known form or, for the second class, inside a span of the first. Null and empty texts have no spans; a
    column named `secrets` is replaced; repeated rows have equal spans.
    """
    kept = docs.drop("secrets")
    body = "__body"
    out = kept.withColumn(body, F.coalesce(F.col(text), F.lit("")))
    base = [_placed(body, pattern, group, least, kind, k) for k, (kind, pattern, group, least) in enumerate(BASE)]
    out = out.withColumn("__base", F.expr(f"concat({', '.join(base)})"))
    allowed = " or ".join(f"c.found rlike {_text(p)}" for p in ALLOWED)
    hot = []
    for k, (kind, characters, alphabet, bits) in enumerate(CLASSES):
        runs = _placed(body, f"{characters}{{{window},}}", 0, window, kind, len(BASE) + k)
        hot.append(
            f"""filter(transform(filter({runs}, c -> not ({allowed})), c -> transform(array({_hot_part("c.found", alphabet, bits, window)}),
                h -> named_struct('start', if(h.first < 0, -1L, c.start + h.first), 'place', c.place, 'end', c.start + h.last, 'kind', c.kind,
                    'found', c.found))[0]), c -> c.start >= 0)"""
        )
    out = out.withColumn("__one", F.expr(hot[0])).withColumn("__two", F.expr(hot[1]))
    inside = "not exists({0}, b -> b.start <= c.start and c.end <= b.end)"
    added = f"""concat(filter(__one, c -> {inside.format("__base")}),
        filter(__two, c -> {inside.format("__base")} and {inside.format("__one")}))"""
    spans = f"transform(array_sort(concat(__base, {added})), c -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end))"
    return out.withColumn("secrets", F.expr(spans)).select(*kept.columns, "secrets")
