import datetime as dt
import random

import numpy as np
import pyarrow as pa

from fareline.llm import language_id
from fareline.llm.text import Texts
from fareline.llm.url_lists import host_of, judge_captures, validity_intervals


def _day(n):
    return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(n)


def test_hosts(frame):
    urls = ["HTTP://User@WWW.Example.com:80/a?b", "https://a.b./", "x", None, "", "ftp://h#f", "http:///p"]
    got = [r[0] for r in frame("k int, url string", *enumerate(urls)).orderBy("k").select(host_of("url")).collect()]
    assert got == ["www.example.com", "a.b", None, None, None, "h", None]


def test_captures_against_brute_force(frame):
    rng = random.Random(6)
    hosts = [f"{a}{b}.{c}" for a in ("", "x.", "y.x.") for b in "pqr" for c in ("com", "org")]
    changes = [(rng.choice([*hosts, "com"]), rng.randrange(40), rng.random() < 0.6) for _ in range(90)] + [(None, 1, True), ("p.com", None, True), ("p.com", 3, None)]
    captures = [(k, f"http://{rng.choice(hosts)}/{k}", rng.choice([None, *range(45)])) for k in range(400)]
    captures += [(900, None, 3), (901, "no url", 3), captures[0], captures[0]]
    given = frame("page_id int, url string, fetched date, entry int, host int", *[(i, u, _day(d), 0, 0) for i, u, d in captures])
    listed = frame("host string, at date, listed boolean", *[(h, _day(d), on) for h, d, on in changes])
    sound = [c for c in changes if None not in c]

    def judge(url, day):
        host = url.split("/")[2] if url and "//" in url else None
        if host is None or day is None:
            return None
        for k in range(host.count(".") + 1):
            name = host.split(".", k)[-1]
            before = [(d, on) for h, d, on in sound if h == name and d <= day]
            if before and any(on for d, on in before if d == max(before)[0]):
                return name
        return None

    got = sorted((r.page_id, r.blocked, r.entry or "") for r in judge_captures(given, listed).collect())
    assert got == sorted((i, judge(u, d) is not None, judge(u, d) or "") for i, u, d in captures)
    assert judge_captures(given, listed.limit(0)).where("blocked").count() == 0
    assert judge_captures(given.limit(0), listed).collect() == []


def test_intervals_merge_repeated_states(frame):
    changes = [("A", _day(d), on) for d, on in ((1, True), (3, True), (5, False), (5, False), (9, True), (9, False), (12, False))]
    got = sorted(map(tuple, validity_intervals(frame("host string, at date, listed boolean", *changes)).collect()))
    assert got == [("a", _day(1), _day(5)), ("a", _day(9), _day(12))]


def test_language_against_brute_force(frame):
    rng = random.Random(9)
    words = {"aa": ["lala", "lolo", "el", "de"], "bb": ["krk", "zzt", "de", "prt"], "cc": ["mumu", "nana", "de", "el"]}
    docs = [(k, lang, " ".join(rng.choice(words[lang]) for _ in range(30))) for k, lang in enumerate(("aa", "bb", "cc") * 20)]
    model = language_id.train(frame("doc_id int, lang string, text string", *docs, (1, None, "x y"), (2, "aa", None)))
    assert model[0] == ["aa", "bb", "cc"]
    pages = []
    for k in range(90):
        lang = rng.choice("abc") * 2
        body = " ".join(rng.choice(words[lang] if rng.random() < 0.6 else words["bb"]) for _ in range(rng.choice((0, 1, 20))))
        declared = rng.choice(["", f' lang="{lang}"', ' lang="BB-x"', " lang=aa"])
        host = rng.choice([None, "h.com", f"{lang}.org", "q.net"])
        pages.append((k, host and f"http://{host}/{k}", f"<html{declared}><script>krk</script><p>{body}</p>", "x", "y"))
    pages += [(100, None, None, "x", "y"), (101, "http://h.com/", "", "x", "y"), pages[3]]
    got = language_id.identify(frame("page_id int, url string, html string, language string, p string", *pages), model).collect()
    assert got[0].p == "y" and len(got) == len(pages)

    def text(page):
        return " " if page[2] is None else page[2].split("<p>")[1].split("</p>")[0] if "<p>" in page[2] else page[2]

    likely = []
    for page in pages:
        raw = "" if page[2] is None else "" if not page[2] else "  " + " " + text(page) + " "
        places, _ = language_id.trigram_places(Texts(pa.array([raw])))
        found = np.array([row[places].astype(float).sum() for row in model[1]]) / max(1, len(places)) ** (1 - language_id.TEXT_POWER)
        likely.append(found - found.max())
    p = np.exp(likely) / np.exp(likely).sum(1, keepdims=True)
    host = [None if x[1] is None else x[1].split("/")[2] for x in pages]
    suffix = [h and h.split(".")[-1] for h in host]
    code = [(x[2] or "").split("lang=")[1].strip('"')[:2].lower() if "lang=" in (x[2] or "") else None for x in pages]
    flat = (p.sum(0) + 1) / (p.sum() + 3)
    n_codes = len({c for c in code if c})
    of_all = p[[c is not None for c in code]].sum(0)
    for k, page in enumerate(pages):
        less = lambda keys: np.maximum(p[[x == keys[k] for x in keys]].sum(0) - p[k], 0) if keys[k] else np.zeros(3)  # noqa: E731, B023
        prior = (less(suffix) + language_id.SUFFIX_WEIGHT * flat) / (less(suffix).sum() + language_id.SUFFIX_WEIGHT)
        prior = (less(host) + language_id.HOST_WEIGHT * prior) / (less(host).sum() + language_id.HOST_WEIGHT)
        w = language_id.DECLARED_WEIGHT
        says = (less(code) + w / n_codes) / (of_all + w) if code[k] else 1
        fused = np.exp(likely[k]) * prior * says
        fused /= fused.sum()
        mine = [r for r in got if r.page_id == page[0]][0]
        assert (mine.language, mine.declared, mine.suffix) == (model[0][int(fused.argmax())], code[k], suffix[k])
        assert abs(mine.confidence - fused.max()) < 1e-6
    nothing = language_id.identify(frame("page_id int, url string, html string", (1, "http://a.b/", "x")), language_id.train(frame("lang string, text string")))
    assert [tuple(r) for r in nothing.collect()] == [(1, "http://a.b/", None, None, None, None, "b")]
    assert language_id.identify(frame("page_id int, url string, html string"), model).collect() == []
