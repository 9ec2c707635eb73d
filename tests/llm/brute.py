"""Plain Python forms of what the operators compute, for small tables."""

from __future__ import annotations

import re

LOWER = str.maketrans({i: i + 32 for i in range(65, 91)})
_SPACED = re.compile(r"[^\x20\x09-\x0D]+")
_PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def spaced_words(text):
    return _SPACED.findall((text or "").translate(LOWER))


def plain_words(text):
    return _PLAIN.findall((text or "").translate(LOWER))


def shingles(text, size=5):
    words = spaced_words(text)
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def roots(nodes, links):
    """The smallest node that each node reaches."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_copies(docs, percent):
    """{doc_id: component} of {doc_id: text}."""
    sets = {i: shingles(t) for i, t in docs.items()}
    ids, links = sorted(sets), []
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    links.append((a, b))
    return roots(ids, links)


def leaks(text, items, window=10):
    """(hit flags of all words, items with occurrences) for {item: text}."""
    words = plain_words(text)
    hit, found = [False] * len(words), set()
    for item, item_text in items.items():
        w = plain_words(item_text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            phrase = w[k : k + window]
            for at in range(len(words) - len(phrase) + 1):
                if words[at : at + len(phrase)] == phrase:
                    found.add(item)
                    hit[at : at + len(phrase)] = [True] * len(phrase)
    return hit, found


def normal_line(line):
    return re.sub("[ \t\x0b\x0c\r]+", " ", line).strip(" ").lower()


def boilerplate(rows, min_sites):
    """Normal lines of three or more words that `min_sites` distinct sites hold; rows are (text, site)."""
    sites = {}
    for text, site in rows:
        for line in (text or "").split("\n"):
            if site is not None and normal_line(line).count(" ") >= 2:
                sites.setdefault(normal_line(line), set()).add(site)
    return {line for line, s in sites.items() if len(s) >= min_sites}
