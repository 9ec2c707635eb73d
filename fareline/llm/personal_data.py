"""Personal data in texts: labelers vote on candidate spans, their reliabilities are estimated, a classifier decides.

Candidates are matches of patterns. Four kinds have fixed forms (`email`, `ip`, `card`, `phone`) whose valid matches always
stay. The other kinds (numbers like cards that fail the check digit, local phone numbers, identity numbers, bank accounts,
names of persons) only stay if the classifier takes them for personal.

Six labelers vote for, against, or not at all: the strict form, the check digit, a gazetteer, cue words on the left, the
characters around, other candidates nearby. Candidates are counted by kind and votes (a bounded table), and expectation
and maximisation over it estimates how often each labeler votes which way on personal and on other spans, and each kind's share.
Each candidate's posterior is then its soft label for a naive Bayes classifier of features no labeler looks at: the shape
of the span, the words beside it, the size of the document's list of candidates.

All in SQL functions: no Python runs on data. Texts are cut at the matches of a pattern; the lengths of what lies between add
up to positions, and the ends of what lies between are the contexts, so that a text is walked once for each pattern.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.session import pin

# The known forms. Possessive quantifiers, looks back and first looks ahead only save time: the same matches
# are found.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++"
IP = r"(?=[0-9])(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
DIGITS = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Further kinds: candidates only.
LOCAL_PHONE = r"(?=[(0-9])(?<![0-9+(.-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"
IDENTITY = r"(?=[0-9])(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
BANK = r"(?=[A-Z]{2}[0-9])(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"
#: Given names, frequent ones of the four languages of the corpus.
NAMES = (
    "Alexander Alice Ana Andreas Anna Anne Antonio Barbara Carlos Carmen Charles Claire David Elizabeth Emily Emma "
    "Francisco François George Hans Isabel James Jean Jennifer John José Juan Julia Julie Karl Laura Lucía Manuel María "
    "Marie Mary Michael Michel Patricia Paul Peter Philippe Pierre Robert Sophie Stefan Susan Thomas Ursula William Wolfgang"
).split()
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Mme Señor Señora Sr Sra".split()
PERSON = (
    rf"(?=[A-Z])(?<!\p{{L}})(?:(?:{'|'.join(TITLES)})\.?\x20|(?=(?:{'|'.join(NAMES)})\x20))"
    r"\p{Lu}\p{Ll}{1,30}(?:\x20\p{Lu}\p{Ll}{1,30}){0,2}"
)
KINDS = "email ip card phone number local_phone identity bank person".split()
N_BASE = 4
#: Cue words on the left of personal data, and of other numbers.
FOR = (
    "e-?mail|mail|correo|contact|contacto|kontakt|call|phone|tel|telephone|téléphone|teléfono|telefon|mobile|fax|card|carte|karte|tarjeta|"
    "visa|iban|account|konto|compte|cuenta|ssn|passport|name|nom|nombre|mr|mrs|dr|from|ip|host|login|user"
)
AGAINST = "version|v|release|order|invoice|ref|isbn|issn|doi|page|seite|no|nr|build|serial|sku|item|chapter|figure|table|section|total|sum"
PLACEHOLDERS = "^(noreply|no-reply|test|user|name|someone|example)@|0000000|1234567|^(127|0|255)[.]|^192[.]0[.]2[.]"

#: Labelers, values of a vote (against, none, for), and prior belief in votes as counts: what personal and other spans get.
LABELERS = "form check gazetteer cues around nearby".split()
BELIEF = {1: (10.0, 40.0, 50.0), 0: (50.0, 40.0, 10.0)}
ROUNDS = 25
#: Places of each kind of feature; the least probability at which a candidate of a further kind stays.
PLACES, FEATURES, LEAST = 4_096, 4, 0.9


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(body: str, pattern: str, needs: str = "") -> str:
    """SQL for an array of (start, end, found, before, after) of a pattern's matches, leftmost first, not overlapping.

    Texts without the character `needs` are not searched.
    """
    found, none = _text(pattern), "cast(array() as array<struct<start:bigint,end:bigint,found:string,before:string,after:string>>)"
    first = f"contains({body}, '{needs}') and " if needs else ""
    return f"""if({first}{body} rlike {found}, transform(array(split({body}, {found}, -1)), parts -> aggregate(
        arrays_zip(parts, regexp_extract_all({body}, {found}, 0), slice(parts, 2, size(parts))),
        named_struct('at', 0L, 'out', {none}),
        (s, x) -> if(x['1'] is null, s, named_struct(
            'at', s.at + length(x.parts) + length(x['1']),
            'out', concat(s.out, array(named_struct('start', s.at + length(x.parts), 'end', s.at + length(x.parts) + length(x['1']),
                'found', x['1'], 'before', right(x.parts, 40), 'after', left(x['2'], 24)))))),
        s -> s.out))[0], {none})"""


_DIGITS_OF = "regexp_replace({0}, '[^0-9]', '')"


def luhn(digits: str) -> str:
    """SQL: whether a string of digits passes the check of its last digit."""
    digit = f"(ascii(substr({digits}, i, 1)) - 48)"
    twice = f"if((length({digits}) - i) % 2 = 1, {digit} * 2 - if({digit} > 4, 9, 0), {digit})"
    return f"(aggregate(sequence(1, length({digits})), 0, (s, i) -> s + {twice}) % 10 = 0)"


def _kinds(body: str) -> list[str]:
    """SQL for the candidates of each pattern, as (kind, place, base, ok: check digit, and the match)."""

    def named(array: str, kind: str, ok: str = "true") -> str:
        place = KINDS.index(kind)
        return f"""transform({array}, m -> named_struct('start', m.start, 'place', {place}, 'end', m.end, 'kind', '{kind}',
            'ok', {ok}, 'found', left(m.found, 64), 'before', m.before, 'after', m.after))"""

    count = f"length({_DIGITS_OF.format('m.found')})"
    part = "trim(LEADING '0' FROM p)"
    small = f"forall(split(m.found, '[.]'), p -> length({part}) <= 3 and coalesce(try_cast({part} as int), 0) <= 255)"
    passes = luhn(_DIGITS_OF.format("m.found"))
    numbers = f"filter({_matches(body, DIGITS)}, m -> {count} between 12 and 19)"
    split = f"transform({numbers}, m -> named_struct('luhn', {passes}, 'm', m))"
    return [
        named(_matches(body, EMAIL, "@"), "email"),
        named(f"filter({_matches(body, IP)}, m -> {small})", "ip"),
        f"""transform({split}, x -> named_struct('start', x.m.start, 'place', if(x.luhn, {KINDS.index('card')}, {KINDS.index('number')}),
            'end', x.m.end, 'kind', if(x.luhn, 'card', 'number'), 'ok', x.luhn, 'found', left(x.m.found, 64), 'before', x.m.before,
            'after', x.m.after))""",
        named(f"filter({_matches(body, PHONE, "+")}, m -> {count} between 9 and 15)", "phone"),
        *[named(_matches(body, p), k) for p, k in ((LOCAL_PHONE, "local_phone"), (IDENTITY, "identity"), (BANK, "bank"), (PERSON, "person"))],
    ]


def _votes(c: str, all_of_them: str) -> str:
    """SQL: the six votes on a candidate, each 0 (against), 1 (none) or 2 (for)."""
    names = "|".join(NAMES)
    form = f"""case {c}.kind when 'email' then if({c}.found rlike '[A-Za-z0-9]@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)*[.][A-Za-z]{{2,12}}$', 2, 0)
        when 'ip' then if({c}.found rlike '(^|[.])0[0-9]', 0, 2) when 'phone' then 2 when 'card' then if({c}.found rlike '^[3-6]', 2, 1)
        when 'number' then if({c}.found rlike '^[3-6][0-9]{{3}}([ -][0-9]{{4}}){{3}}$', 2, 0) when 'identity' then if({c}.found rlike '^(000|666|9)', 0, 2)
        when 'person' then if({c}.found rlike '{{P}}', 2, 1) else 1 end""".replace("{P}", r"\\x20\\p{Lu}\\p{Ll}+\\x20")
    check = f"case when {c}.kind in ('card', 'number') then if({c}.ok, 2, 0) else 1 end"
    gazetteer = f"""case when lower({c}.found) rlike {_text(PLACEHOLDERS)} then 0
        when {c}.kind = 'person' and {c}.found rlike {_text(f'(^|[ ])({names})( |$)')} then 2
        when {c}.kind = 'email' and {c}.found rlike '[.](com|org|net|edu|gov|de|fr|es|uk|eu|info)$' then 2 else 1 end"""
    cues = f"""case when lower({c}.before) rlike {_text(rf'(?:^|[^a-zé])({FOR})[^a-z0-9é]{{1,4}}$')} then 2
        when lower({c}.before) rlike {_text(rf'(?:^|[^a-zé])({AGAINST})[^a-z0-9é]{{0,4}}$')} then 0 else 1 end"""
    around = f"""case when {c}.before rlike '[A-Za-z0-9_/=#%]$' or {c}.after rlike '^[A-Za-z0-9_/=%@]' then 0
        when ({c}.before = '' or {c}.before rlike '[\\\\s(<:,"]$') and ({c}.after = '' or {c}.after rlike '^[\\\\s).,;:!?>"]') then 2 else 1 end"""
    nearby = f"if(exists({all_of_them}, o -> o.place < {N_BASE} and o.start != {c}.start and abs(o.start - {c}.start) < 300), 2, 1)"
    return f"array({form}, {check}, {gazetteer}, {cues}, {around}, {nearby})"


def _features(c: str, all_of_them: str) -> str:
    """SQL: the place of each feature: shape of the span, word on the left, word on the right, number of candidates."""
    place = lambda *x: f"cast(pmod(xxhash64({', '.join(x)}), {PLACES}) as int)"
    shape = f"regexp_replace(regexp_replace(regexp_replace({c}.found, '[0-9]', '9'), '[a-z]+', 'a'), '[A-Z]+', 'A')"
    word = lambda s, p: f"regexp_extract(lower({s}), '{p}', 1)"
    return f"""array({place(f'{c}.kind', shape)}, {place(f'{c}.kind', word(f'{c}.before', r'(\\p{L}{0,12})\\P{L}{0,3}$'), "'l'")},
        {place(f'{c}.kind', word(f'{c}.after', r'^\\P{L}{0,3}(\\p{L}{0,12})'), "'r'")},
        {place(f'{c}.kind', f'least(size({all_of_them}), 8)', "'n'")})"""


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `candidates`: an array of (start, place, end, kind, ok, votes, features) by start, then kind."""
    kept = docs.drop("candidates")
    out = kept.withColumn("__body", F.coalesce(F.col(text), F.lit("")))
    out = out.withColumn("__all", F.expr(f"array_sort(concat({', '.join(_kinds('__body'))}))"))
    judged = f"""transform(__all, c -> named_struct('start', c.start, 'place', c.place, 'end', c.end, 'kind', c.kind,
        'votes', {_votes('c', '__near')}, 'features', {_features('c', '__all')}))"""
    # The candidates that the labeler of neighbours asks are few beside their contexts.
    out = out.withColumn("__near", F.expr("transform(filter(__all, c -> c.place < 4), c -> named_struct('start', c.start, 'place', c.place))"))
    return out.withColumn("candidates", F.expr(judged)).select(*kept.columns, "candidates")


@dataclass
class Model:
    """Share of personal spans by kind; P(vote | personal) and P(vote | other) of each labeler; the classifier's weights."""

    shares: list[float]
    votes: list[float]
    weights: list[float]
    prior: list[float]

    def reliabilities(self) -> dict[str, dict[str, tuple[float, ...]]]:
        at = lambda y, k: tuple(self.votes[(y * len(LABELERS) + k) * 3 : (y * len(LABELERS) + k) * 3 + 3])
        return {name: {"personal": at(1, k), "other": at(0, k)} for k, name in enumerate(LABELERS)}


def _literal(values: list[float]) -> str:
    return f"cast(split('{','.join(map(repr, values))}', ',') as array<double>)"


def _posterior(place: str, votes: str, shares: str, table: str) -> str:
    """SQL: the probability that a candidate of these votes is personal."""
    n = len(LABELERS)
    odds = f"""aggregate(sequence(0, {n - 1}), ln({shares}[{place}]) - ln(1 - {shares}[{place}]), (acc, l) ->
        acc + ln({table}[({n} + l) * 3 + {votes}[l]]) - ln({table}[l * 3 + {votes}[l]]))"""
    return f"(1 / (1 + exp(-({odds}))))"


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> tuple[list[float], list[float]]:
    """Expectation and maximisation over (place, votes, n): each kind's share and each labeler's table of votes.

    The table of patterns is bounded by kinds and votes, and so is one row for it; all rounds are one expression.
    """
    n, k = len(LABELERS), len(KINDS)
    start = [x / 100 for y in (0, 1) for _ in LABELERS for x in BELIEF[y]]
    base = [0.8 if place < N_BASE else 0.3 for place in range(k)]
    belief = _literal([x for y in (0, 1) for _ in LABELERS for x in BELIEF[y]])
    post = _posterior("x.place", "x.votes", "s.shares", "s.table")
    step = f"""transform(array(transform(rows, x -> named_struct('place', x.place, 'votes', x.votes, 'n', x.n, 'p', {post}))), w -> named_struct(
        'shares', transform(sequence(0, {k - 1}), j -> aggregate(w, named_struct('a', 10 * {_literal(base)}[j], 'b', 10D),
            (t, x) -> if(x.place = j, named_struct('a', t.a + x.n * x.p, 'b', t.b + x.n), t), t -> t.a / t.b)),
        'table', transform(sequence(0, {6 * n - 1}), j -> aggregate(w, named_struct('a', {belief}[j], 'b', 100D),
            (t, x) -> transform(array(x.n * if(j div {3 * n} = 1, x.p, 1 - x.p)), m -> named_struct(
                'a', t.a + if(x.votes[(j div 3) % {n}] = j % 3, m, 0D), 'b', t.b + m))[0], t -> t.a / t.b))))[0]"""
    whole = f"""aggregate(sequence(1, {rounds}), named_struct('shares', {_literal(base)}, 'table', {_literal(start)}), (s, i) -> {step})"""
    # Sums in one order, whatever the order of the rows.
    rows = patterns.groupBy().agg(F.array_sort(F.collect_list(F.struct("place", "votes", F.col("n").cast("double").alias("n")))).alias("rows"))
    found = rows.select(F.expr(whole).alias("found")).first().found
    return list(found.shares), list(found.table)


def train(found: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model of a table with `candidates`. Without candidates all stays as believed."""
    each = found.select(F.explode("candidates").alias("c")).select("c.place", "c.votes", "c.features")
    shares, table = estimate(each.groupBy("place", "votes").agg(F.count("*").alias("n")), rounds)
    p = F.expr(_posterior("place", "votes", _literal(shares), _literal(table)))
    # In units of a millionth, so that sums do not depend on the order of the rows.
    parts = each.withColumn("p", F.round(p * 1_000_000).cast("long")).select("place", "p", F.posexplode("features").alias("feature", "at"))
    sums = parts.groupBy("feature", "at").agg(F.sum("p").alias("yes"), F.sum(1_000_000 - F.col("p")).alias("no")).collect()
    weights = [0.0] * (FEATURES * PLACES)
    total = {k: (1e-6 * sum(r.yes for r in sums if r.feature == k), 1e-6 * sum(r.no for r in sums if r.feature == k)) for k in range(FEATURES)}
    for r in sums:
        yes, no = total[r.feature]
        weights[r.feature * PLACES + r["at"]] = log_ratio(1e-6 * r.yes, 1e-6 * r.no, yes, no)
    return Model(shares, table, weights, shares)


def log_ratio(yes: float, no: float, all_yes: float, all_no: float) -> float:
    """The weight of a feature's place: how much likelier it is on personal spans; one span each way is added."""
    return round(log((yes + 1) / (all_yes + 2)) - log((no + 1) / (all_no + 2)), 9)


def judge(found: DataFrame, model: Model, least: float = LEAST) -> DataFrame:
    """`found` with `personal` in place of `candidates`: an array of (kind, start, end, probability).

    Spans of the known forms all stay. Of the further kinds those stay to which the classifier gives `least` or more and
    that overlap neither a span of a known form nor an earlier span that stays.
    """
    weights, shares = _literal(model.weights), _literal(model.prior)
    odds = f"""aggregate(sequence(0, {FEATURES - 1}), ln({shares}[c.place]) - ln(1 - {shares}[c.place]),
        (s, f) -> s + {weights}[f * {PLACES} + c.features[f]])"""
    rated = f"""transform(candidates, c -> named_struct('start', c.start, 'place', c.place, 'end', c.end, 'kind', c.kind,
        'probability', 1 / (1 + exp(-({odds})))))"""
    out = found.withColumn("__rated", F.expr(rated)).withColumn("__base", F.expr(f"filter(__rated, c -> c.place < {N_BASE})"))
    apart = "not exists({0}, b -> b.start < c.end and c.start < b.end)"
    likely = f"filter(__rated, c -> c.place >= {N_BASE} and c.probability >= {least}D and {apart.format('__base')})"
    added = f"aggregate({likely}, filter(__base, c -> false), (s, c) -> if({apart.format('s')}, concat(s, array(c)), s))"
    whole = f"""transform(array_sort(concat(__base, {added})), c -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end,
        'probability', c.probability))"""
    return out.withColumn("personal", F.expr(whole)).drop("candidates", "__rated", "__base")


def find_personal_data(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (all but the text if not given) with `personal`: (kind, start, end, probability) by start,
    then kind as listed above; positions count characters (code points), ends exclusive.

    Null and empty texts have no spans; repeated rows have equal spans; a table without candidates leaves the priors; an
    empty table gives no rows; columns named `candidates` or `personal` are replaced.
    """
    kept = [c for c in (keep or [c for c in docs.columns if c != text]) if c not in ("candidates", "personal")]
    found = pin(candidates(docs.select(*kept, F.col(text).alias("__text")), "__text").drop("__text"))
    return judge(found, train(found))
