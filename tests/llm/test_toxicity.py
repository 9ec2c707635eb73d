import math
import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareline.llm import toxicity as tox


def _plain(words, counts, shared):
    """The same model with dictionaries, for one class column at a time."""
    marked = [b"\x01" + w + b"\x02" for w in words]
    grams = []
    for n in range(tox.LOWEST, tox.HIGHEST + 1):
        table, before = defaultdict(lambda: [0.0, 0.0]), defaultdict(set)
        for w, c in zip(marked, counts, strict=True):
            for i in range(n - 1, len(w)):
                for k in (0, 1):
                    if n == tox.HIGHEST or i == n - 1:
                        table[w[i - n + 1 : i + 1]][k] += c[k]
                    elif c[k]:
                        before[(k, w[i - n + 1 : i + 1])].add(w[i - n])
        for (k, g), s in before.items():
            table[g][k] += len(s)
        grams.append(table)

    def chance(w, i, k):
        p = shared(w, i)
        for n, table in zip(range(tox.LOWEST, tox.HIGHEST + 1), grams, strict=True):
            if i < n - 1:
                break
            inside = {g: c[k] for g, c in table.items() if g[:-1] == w[i - n + 1 : i]}
            total = sum(inside.values())
            if total:
                count = inside.get(w[i - n + 1 : i + 1], 0)
                p = (max(count - tox.DISCOUNT, 0) + sum(min(c, tox.DISCOUNT) for c in inside.values()) * p) / total
        return p

    return lambda w: sum(math.log(chance(w, i, 1)) - math.log(chance(w, i, 0)) for i in range(1, len(w)))


def test_word_evidence_against_dictionaries():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 14))).encode() for _ in range(60)})
    counts = np.array([[rng.randrange(4), rng.randrange(4)] for _ in words], float)
    model = tox.Model(np.zeros(2 * tox.SHARED_PLACES), tox.fit_orders(words, counts))
    base = np.clip(0.01, 1e-6, 1.0)  # no shared counts: the same chance everywhere
    plain = _plain(words, counts, lambda w, i: base)
    asked = [*words, b"zzz", b"abcabcabcabcabc", b"a"]
    ends = np.cumsum([len(w) for w in asked])
    got = model.word_evidence(np.frombuffer(b"".join(asked), np.uint8), ends - [len(w) for w in asked], ends)
    assert np.allclose(got, [plain(b"\x01" + w + b"\x02") for w in asked])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice(["ta", "ro", "mi", "ne", "su"]) for _ in range(rng.randrange(1, 5)))
    out = []
    for i in range(400):
        bad = i % 5 == 0
        words = [word() for _ in range(rng.randrange(20, 80))]
        for _ in range(rng.randrange(3, 6) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["grumkop", "zlevnik" + word(), "blorfs"]))
        out.append((i, " ".join(words), int(bad)))
    return out


def test_held_out_rows(frame, rows):
    docs = frame("doc_id long, text string, score string, toxic string", *[(i, t, "x", "y") for i, t, _ in rows], (900, None, "", ""), (901, "", "", ""), (5, rows[5][1], "", ""))
    labels = frame("doc_id long, toxic int", *[(i, y) for i, _, y in rows], (None, 1), (5, 0), (6, None), (7, 3), (8, 1), (8, 0), (5000, 1))
    model = tox.train(docs, labels.where(F.col("doc_id") % 2 == 0))
    got = tox.score(docs, model).collect()
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.doc_id % 2 and r.doc_id in truth]
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in held]) > 0.97
    assert len(got) == 403 and all(0 <= r.score <= 1 for r in got) and got[0].toxic == "y"
    assert {r.evidence for r in got if not r.text} == {0.0}


def test_without_labels_or_rows(frame, rows):
    docs = frame("doc_id long, text string", *[(i, t) for i, t, _ in rows[:20]])
    none = frame("doc_id long, toxic int")
    model = tox.train(docs, none)
    assert len({r.score for r in tox.score(docs, model).collect()}) == 1
    assert len({r.score for r in tox.score(docs, tox.train(docs, frame("doc_id long, toxic int", (1, 1), (2, 1)))).collect()}) == 1
    assert tox.score(docs.limit(0), tox.train(docs.limit(0), none)).collect() == []


def test_toxic_by_word_order(frame):
    rng = random.Random(4)
    some = lambda n: [rng.choice("red blue green black white grey pink brown".split()) for _ in range(n)]
    rows = []
    for i in range(240):
        # The same ordinary words, in another order.
        phrase = ["you", "will", "lose"] if i % 2 else ["lose", "will", "you"]
        rows.append((i, " ".join(some(6) + phrase + some(6) + phrase + some(6)), i % 2))
    docs = frame("doc_id long, text string", *[(i, t) for i, t, _ in rows])
    model = tox.train(docs, frame("doc_id long, toxic int", *[(i, y) for i, _, y in rows if i < 160]))
    held = [r for r in tox.score(docs, model).collect() if r.doc_id >= 160]
    assert np.mean([(r.score >= 0.5) == r.doc_id % 2 for r in held]) > 0.95


def test_corpus_counts_grow_and_enter(frame, rows, monkeypatch):
    labels = frame("doc_id long, toxic int", *[(i, y) for i, _, y in rows])
    docs = [(i, t) for i, t, _ in rows]
    more = [(1000 + k, f"word{k} other{k} grumkop blorfs") for k in range(300)]
    small, large = (tox.train(frame("doc_id long, text string", *r), labels) for r in (docs, docs + more))
    assert large.kinds == small.kinds + 600 and large.total == small.total + 1200
    asked = frame("doc_id long, text string", (1, "ta grumkop ro"), (2, "word7 other8 notthere ta"))
    whole = [{r.doc_id: r.evidence for r in tox.score(asked, m).collect()} for m in (small, large)]
    assert whole[0][2] != whole[1][2]
    # Words of the head and joined ones give the same.
    monkeypatch.setattr(tox, "HEAD_WORDS", 50)
    joined = tox.train(frame("doc_id long, text string", *docs, *more), labels)
    assert len(joined.head) <= 50 < len(large.head)
    assert {r.doc_id: r.evidence for r in tox.score(asked, joined).collect()} == pytest.approx(whole[1], rel=1e-6)


def test_the_driver_fits_orders_in_parts():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randrange(6, 14))).encode() for _ in range(20_000)})
    counts = np.ones((len(words), 2))
    tracemalloc.start()
    orders = tox.fit_orders(words, counts)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    held = sum(x.nbytes for o in orders for x in (o.keys, o.counts, o.contexts, o.totals, o.reserves))
    # Beside the result, some bytes for each letter: not all the arrays of an n-gram length at once.
    assert most - held < 100 * sum(len(w) + 2 for w in words)


def test_pairs_of_a_single_text_are_held_as_hashes(frame):
    rng = random.Random(9)
    some = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("aeiou") for _ in range(40)) for _ in range(60)]
    texts = frame("__toxic int, __text string", *[(i % 3 // 2, t) for i, t in enumerate(some)])
    held = [defaultdict(set), defaultdict(set)]
    for i, t in enumerate(some):
        for v, w in zip([""] + t.split(), t.split(), strict=False):
            held[i % 3 // 2][v, w].add(i)
    both = {p: sum(len(h.get(p, ())) for h in held) for p in {*held[0], *held[1]}}
    got = tox.Words.fit(np.ones(1, np.uint64), np.ones((1, 2)), np.zeros(2), *tox._collected_pairs(texts))
    assert len(got.both.keys) == sum(n > 1 for n in both.values()) and len(got.both.once) == sum(n == 1 for n in both.values())

    def chances(v, w):
        """Both classes' (own, left) of a pair: of the class, above both together."""
        n = [sorted(both.values()).count(k) for k in (1, 2, 3, 4)]
        d = tox._discounts(np.array(list(both.values())))
        assert n[0] and n[1]
        after = {x: k for (a, x), k in both.items() if a == v}
        total = sum(after.values())
        a, b = max(after.get(w, 0) - d[min(after.get(w, 0), 3)], 0) / total, sum(d[min(k, 3)] for k in after.values()) / total
        out = []
        for h in held:
            own, d = {x: len(s) for (f, x), s in h.items() if f == v}, tox._discounts(np.array([len(s) for s in h.values()]))
            total = sum(own.values())
            taken = {x: d[min(k, 3)] if both[v, x] > 1 else k for x, k in own.items()}
            left = sum(taken.values()) / max(total, 1)
            out.append(((own.get(w, 0) - taken.get(w, 0)) / total + left * a, left * b) if total else (a, b))
        return out

    asked = [p for p in sorted(both) if p[0]][:200]
    of = lambda k: tox.hash_words([p[k].encode() for p in asked])
    plain = [chances(*p) for p in asked]
    for c, (a, b) in enumerate(got.shares(of(0), of(1))):
        assert np.allclose(a, [p[c][0] for p in plain], rtol=1e-5) and np.allclose(b, [p[c][1] for p in plain], rtol=1e-5)
