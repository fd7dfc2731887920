"""Queries over whole tables, against plain Python on the smallest ones."""

import os

import pyarrow.parquet as pq
import pytest

from lorebase.plans import catalogue

BASE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="needs the driver's tables")


def table(name, *cols):
    t = pq.read_table(f"{BASE}/{name}.parquet")
    return list(zip(*[t.column(c).to_pylist() for c in cols]))


def rows(spark, name, *cols):
    return sorted(map(tuple, catalogue.QUERIES[name](spark, BASE).select(*cols).collect()))


def test_every_redirect(spark):
    least = {}
    parts = table("part", "p_partkey", "p_name")
    for k, n in parts:
        least[n] = min(k, least.get(n, k))
    want = sorted((k, least[n]) for k, n in parts if k != least[n])
    assert any(k % 7 for k, _ in want) and rows(spark, "detail_redirect", "old_id", "p_partkey") == want


def test_every_edge(spark):
    names = dict(table("part", "p_partkey", "p_name"))
    edges = table("lineitem", "l_orderkey", "l_partkey")
    assert rows(spark, "rel_forward", "l_orderkey", "p_partkey", "p_name") == sorted((o, p, names[p]) for o, p in edges if p in names)
    want = []
    for part in {p for _, p in edges}:
        want += [(part, o) for o in sorted({o for o, p in edges if p == part})[:20]]
    assert rows(spark, "rel_reverse_limited", "l_partkey", "l_orderkey") == sorted(want)


def test_every_resolvable_redirect(spark):
    first = {}
    for e, u in sorted(table("events", "event_id", "user_id")):
        if e % 11:
            first.setdefault(e % 97 + 31, u % 50 + 1)
    want = sorted((o, c) for o, c in first.items() if c not in first)
    assert want and rows(spark, "redirect_cycles", "old_id", "canonical_id") == want


def test_whole_texts_as_keys(spark, tmp_path):
    docs = [(1, "s", "en", "a" * 20 + "x"), (2, "s", "en", "a" * 20 + "y"), (3, "t", "en", "b"), (4, "t", "en", "b")]
    spark.createDataFrame(docs, "doc_id long, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["metric"]: r["n"] for r in catalogue.QUERIES["source_key_check"](spark, str(tmp_path)).collect()}
    assert found["multi_case_files"] == 1 and found["dup_combined"] == 1
