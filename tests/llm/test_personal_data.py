"""Personal data: known forms against plain patterns, the estimate and the classifier against numpy, whole texts by hand."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from fareline.llm import personal_data as p

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def plain(text):
    out = []
    for place, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True,
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), place, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


ODD = [
    None, "", " ", "a@b", "a@b.c", "x a@b.com_x@y.zz y", "a@b.com.c@d.e", "@@a@@b.c", "..@a.b..c", "a@b.c-@d.e", "é@a.b a.é@c.d", "1.2.3.4.5.6.7.8 1.2.3.256",
    "0001.02.3.000000255", "1.2.3.4000000000000000000000", "4111 1111 1111 1111, 4111-1111-1111-1112", "4111  1111", "41111111111111110000000000", "000000000000",
    "+1 (017) 555-7713 +12 3 +1234567890123456", "+1-2.3(4)5 6789 0", "++1 234 567 89", "🎈 mail me: a.b+c@mail.example.com 🎈", "4111111111111111@card.org",
    "10.0.0.1@host.net", "user@1.2.3.4", "+49 30 1234567.8.9.10", "Dr. Émile Zola met Mr Smith, James Brown", "call (030) 555-1234 or 555 123 4567", "123-45-6789",
    "IBAN DE89370400440532013000", "a" * 20_000 + "@", "1" * 20_000 + ".1.1", "1." * 8_000, "a@" + "b." * 8_000, "+" + "1" * 20_000, "+1" + " " * 20_000 + "x",
]


def test_known_forms_like_plain_patterns(frame):
    rng = random.Random(5)
    bits = ["a", "@", ".", "1", "23", "+", "-", " ", "(", ")", "_", "4111111111111111", "1.2.3.4", "x@y.z", "+1 234 567 890", "é", "🎈", "%"]
    texts = ODD + ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(400)]
    docs = frame("doc_id int, text string, candidates int, personal int, n int", *[(k, t, 1, 1, 7) for k, t in enumerate(texts)])
    found = p.find_personal_data(docs)
    assert found.columns == ["doc_id", "n", "personal"]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.personal] for r in found.collect()}
    base = set(PLAIN)
    for k, t in enumerate(texts):
        assert [s for s in got[k] if s[0] in base] == plain(t), repr(t)
        for kind, start, end in got[k]:
            assert kind in p.KINDS and 0 <= start < end <= len(t)
            assert kind in base or not any(a < end and start < b for x, a, b in got[k] if (x, a, b) != (kind, start, end))


def test_empty_table_and_repeated_rows(frame):
    assert p.find_personal_data(frame("doc_id int, text string")).collect() == []
    assert [r.personal for r in p.find_personal_data(frame("doc_id int, text string", (1, None), (None, ""))).collect()] == [[], []]
    got = p.find_personal_data(frame("doc_id int, text string", (1, "a@b.cc"), (1, "a@b.cc"), (None, "a@b.cc"))).collect()
    assert len(got) == 3 and len({str(r.personal) for r in got}) == 1


def _numpy_estimate(rows, rounds):
    n, kinds = len(p.LABELERS), len(p.KINDS)
    belief = np.array([[p.BELIEF[y]] * n for y in (0, 1)], float)
    table, base = belief / 100, np.array([0.8 if k < p.N_BASE else 0.3 for k in range(kinds)])
    shares = base.copy()
    place, votes, many = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows], float)
    for _ in range(rounds):
        odds = np.log(shares[place] / (1 - shares[place]))
        for k in range(n):
            odds += np.log(table[1, k, votes[:, k]] / table[0, k, votes[:, k]])
        q = 1 / (1 + np.exp(-odds))
        shares = np.array([(10 * base[j] + (many * q)[place == j].sum()) / (10 + many[place == j].sum()) for j in range(kinds)])
        table = np.array([[[(belief[y, k, v] + (many * (q if y else 1 - q))[votes[:, k] == v].sum()) / (100 + (many * (q if y else 1 - q)).sum())
                            for v in range(3)] for k in range(n)] for y in (0, 1)])
    return shares, table


def test_estimate_like_numpy_and_right_on_made_votes(frame):
    rng = np.random.default_rng(2)
    truth = rng.random(4_000) < np.where(np.arange(4_000) % 2, 0.7, 0.2)
    right = np.array([0.95, 0.8, 0.9, 0.7, 0.6, 0.85])
    votes = np.where(rng.random((4_000, 6)) < 0.3, 1, np.where((rng.random((4_000, 6)) < right) == truth[:, None], 2, 0))
    places = np.where(np.arange(4_000) % 2, 0, 5)
    counts = Counter((int(k), tuple(v)) for k, v in zip(places, votes.tolist(), strict=True))
    rows = [(k, list(v), c) for (k, v), c in counts.items()]
    shares, table = p.estimate(frame("place int, votes array<int>, n long", *rows), 15)
    wanted = _numpy_estimate(sorted(rows), 15)
    assert np.allclose(shares, wanted[0]) and np.allclose(table, wanted[1].ravel())
    assert abs(shares[0] - 0.7) < 0.05 and abs(shares[5] - 0.2) < 0.05
    told = np.array(table).reshape(2, 6, 3)
    assert np.abs(told[1, :, 2] / (told[1, :, 0] + told[1, :, 2]) - right).max() < 0.08


def test_classifier_like_plain_sums(frame):
    rng = random.Random(9)
    words = "the of mail call card number page order invoice tel".split()
    text = lambda: " ".join(rng.choice([rng.choice(words), "ann@mail.org", "4111111111111111", "4111111111111112", "555 123 4567", "Dr Anna Smith"]) for _ in range(12))
    docs = frame("doc_id int, text string", *[(k, text()) for k in range(150)])
    found = p.candidates(docs).select("doc_id", "candidates")
    model = p.train(found)
    each = [c for r in found.collect() for c in r.candidates]
    votes = np.array(model.votes).reshape(2, 6, 3)
    soft = []
    for c in each:
        odds = np.log(model.shares[c.place] / (1 - model.shares[c.place])) + sum(np.log(votes[1, k, v] / votes[0, k, v]) for k, v in enumerate(c.votes))
        soft.append(1 / (1 + np.exp(-odds)))
    weight = {}
    for f in range(p.FEATURES):
        yes, no = sum(soft), len(soft) - sum(soft)
        for at in {c.features[f] for c in each}:
            mine = [q for q, c in zip(soft, each, strict=True) if c.features[f] == at]
            weight[f, at] = np.log((sum(mine) + 1) / (yes + 2)) - np.log((len(mine) - sum(mine) + 1) / (no + 2))
    judged = {(r.doc_id, s.kind, s.start): s.probability for r in p.judge(found, model, 0.0).collect() for s in r.personal}
    assert judged
    for r in found.collect():
        for c in r.candidates:
            odds = np.log(model.shares[c.place] / (1 - model.shares[c.place])) + sum(weight[f, at] for f, at in enumerate(c.features))
            if (r.doc_id, c.kind, c.start) in judged:
                assert abs(judged[r.doc_id, c.kind, c.start] - 1 / (1 + np.exp(-odds))) < 1e-4
    assert set(model.reliabilities()) == set(p.LABELERS)


def test_no_python_on_the_main_path(frame):
    found = p.find_personal_data(frame("doc_id int, text string", (1, "a@b.cc")))
    plan = found._jdf.queryExecution().executedPlan().toString() + p.candidates(frame("doc_id int, text string", (1, "x")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_given_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.personal for r in p.find_personal_data(docs).where(F.size("personal") > 0).collect()}
    for r in docs.collect():
        assert [(s.kind, s.start, s.end) for s in got.get(r.doc_id, []) if s.kind in PLAIN] == plain(r.text)
