"""The registered queries against their SQL on the smallest given tables; the pipeline against brute force."""

import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from fareline.llm.registry import ORACLES, QUERIES
from tests.llm.brute import boilerplate, leaks, near_copies, normal_line, plain_words
from tests.test_entry import _sorted

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert QUERIES.keys() | {"pipeline"} <= entry.queries().keys()
    assert ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    assert got
    if name in ORACLES:
        relation = duck.sql(ORACLES[name])
        assert _sorted(df.columns, got) == _sorted(relation.columns, relation.fetchall())


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before and after each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        if name != "packing":
            assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows = after.collect()
        out[name] = ({r.doc_id: r for r in docs.collect()}, rows)
        docs = spark.createDataFrame(rows, after.schema)
    return out


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    assert kept <= before.keys() and all(before[r.doc_id] == r for r in after)
    clean = [i for i, y in labels.items() if y == 0 and i in before]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)


def test_labelled_toxic_documents_are_found(spark, stages):
    before, after = stages["toxicity"]
    kept = {r.doc_id for r in after}
    toxic = [r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect() if r.doc_id in before]
    assert toxic and sum(i not in kept for i in toxic) > 0.5 * len(toxic)


def test_shared_lines_go(stages):
    before, after = stages["line_dedup"]
    common = boilerplate([(r.text, r.source) for r in before.values()], 10)
    first = {}
    for i in sorted(before):
        for line in before[i].text.split("\n"):
            first.setdefault(normal_line(line), i)
    wanted = {}
    for i, r in before.items():
        lines = r.text.split("\n")
        left = [x for x in lines if normal_line(x) not in common or first[normal_line(x)] == i]
        if len(left) == len(lines) or "".join(left).strip():
            wanted[i] = "\n".join(left)
    assert {r.doc_id: r.text for r in after} == wanted
    assert all(r.n_chars == len(r.text) for r in after)


def test_one_of_each_group_stays(stages):
    before, after = stages["minhash_near_dedup"]
    group = near_copies({i: r.text for i, r in before.items()}, 80)
    assert sorted(r.doc_id for r in after) == sorted(set(group.values()))


def test_benchmark_passages_go(spark, stages):
    before, after = stages["benchmark_decontamination"]
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    assert not any(leaks(r.text, items)[1] for r in after)
    left = {r.doc_id: r for r in after}
    for i, r in before.items():
        hit, found = leaks(r.text, items)
        if not found:
            assert left[i] == r
        elif not all(hit):
            assert plain_words(left[i].text) == [w for w, h in zip(plain_words(r.text), hit, strict=True) if not h]
        else:
            assert i not in left


def test_all_kept_text_is_packed(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    before, after = stages["packing"]
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in sorted(after, key=lambda r: r.start):
        pieces.setdefault(r.doc_id, []).append(np.frombuffer(r.ids, "<u4"))
    assert {i: np.concatenate(p).tolist() for i, p in pieces.items()} == {
        i: [*whole.encode(r.text, add_special_tokens=False).ids, 1] for i, r in before.items()
    }
