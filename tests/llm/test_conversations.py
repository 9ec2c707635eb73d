"""Repair of conversations against a plain search over all edits, in memory, of whole conversations."""

import hashlib
import random
import re
import zlib
from functools import cache

import numpy as np
import pytest

from fareline.llm.conversations import NODES, _FINAL, costs, damage, follow, least_arcs, repair, summarize

NAMES = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
SOLID = re.compile("[^\x20\x09-\x0d]")


def plain(rows):
    """{conv_id: row} by the same rules, one conversation at a time."""
    kept = {}
    for conv, turn, role, text in rows:
        word = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
        role, text = ("user" if kind == 4 else word(role)), word(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    out = []
    for conv, turns in kept.items():
        key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(f"{'' if conv is None else 'c' + str(conv)}|{len(r[1])}:{r[1]}{r[2]}".encode()).digest())  # noqa: E731, B023, E501
        turns = sorted(turns, key=key)
        seen, faults = set(), []
        for _, role, text in turns:
            solid = SOLID.findall(text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[1][:1] for r in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))

        @cache
        def best(i, node, inserted=0):
            ways = [(0, "", ())] if i == len(turns) and node in "-a" else []
            new = "assistant" if node == "u" else "user"
            if inserted < 3:
                cost, audit, rest = best(i, new[0], inserted + 1)
                ways.append((cost + 2, "I" + audit, (f"{new}:", *rest)))
            if i < len(turns):
                _, role, text = turns[i]
                cost, audit, rest = best(i + 1, node)
                ways.append((cost + 3, "D" + audit, rest))
                if faults[i] not in ("blank", "duplicate"):
                    extra = faults[i] == "truncated"
                    cost, audit, rest = best(i + 1, new[0])
                    ways.append((cost + 2 + extra, "R" + audit, (f"{new}:{text}", *rest)))
                    if role[:1] == new[0] or (role[:1] == "s" and node == "-"):
                        cost, audit, rest = best(i + 1, role[:1])
                        ways.append((cost + extra, "K" + audit, (f"{role}:{text}", *rest)))
            return min(ways, key=lambda w: w[:2]) if ways else (10**9, "", ())

        for i in range(len(turns), -1, -1):
            for node in "-sua":
                best(i, node)
        cost, audit, lines = best(0, "-")
        count = lambda f: sum(x == f for x in faults)  # noqa: E731, B023
        out.append((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def conversations(seed, n=120):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "well", "well ", "", " \t", None, "Why?\n", "a.b", "One. Two", "é."]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(9)):
            at = None if rng.random() < 0.05 else turn * rng.choice([1, 1, 2]) - rng.choice([0, 0, 1])
            role = rng.choices(roles, [8, 8, 2, 1, 1, 1])[0] if rng.random() < 0.4 else ["user", "assistant"][turn % 2]
            rows.append((conv or None, at, role, rng.choice(texts) if rng.random() < 0.6 else f"text {conv} {turn}."))
    return rows + rows[:9] + [(5, 1, "user", "x" * 50_000 + "."), (6, 9, "user", "x" * 50_000 + " \n")]


@pytest.mark.parametrize("page_rows", [4096, 2, 1])
def test_against_plain_search(frame, page_rows):
    rows = conversations(page_rows)
    given = frame("conv_id long, turn long, role string, text string, page int, whole int", *[(*r, 1, 2) for r in rows])
    got = summarize(repair(damage(given), gone="gone", page_rows=page_rows))
    assert got.columns == NAMES
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, plain(rows)))


def test_long_conversation_over_many_tasks(spark, frame):
    rng = random.Random(7)
    rows = [(1, k, ["user", "assistant"][(k + (k % 11 == 0)) % 2], rng.choice(["Same.", f"text {k}.", f"cut {k}"])) for k in range(700)]
    rows += [(k, 0, "system", "Hello.") for k in range(2, 40)]
    given = frame("conv_id long, turn long, role string, text string", *rows).repartition(5)
    pages = repair(damage(given), gone="gone", page_rows=16)
    assert pages.where("conv_id = 1").count() > 40
    assert sorted(map(str, (tuple(r) for r in summarize(pages).collect()))) == sorted(map(str, plain(rows)))


def test_given_conversations(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = summarize(repair(damage(rows), gone="gone"))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, plain([tuple(r) for r in rows.collect()])))


def test_empty_table(frame):
    assert summarize(repair(frame("conv_id long, turn long, role string, text string"))).collect() == []


def test_ranks_follow_the_least_audits():
    """Every node's rank orders its least audit among all nodes'."""
    rng = np.random.default_rng(3)
    codes, bad, short = rng.integers(0, 4, 40), rng.random(40) < 0.2, rng.random(40) < 0.3
    bounds, after = np.array([0, 15, 15, 40]), np.tile(_FINAL, (3, 1))
    cost = costs(codes, bad, short & ~bad, bounds, after)
    letter, pointers, rank = least_arcs(codes, bad, short & ~bad, bounds, cost, after)
    audits = ["".join("DIKR"[x] for x in letter[follow(v, pointers, letter)[:-1]]) for v in range(43 * NODES)]
    order = sorted(set(audits))
    assert [order[k] for k in rank] == audits
