"""Ranked search against scores added up term by term, early stops, ties, empty tables and clashing names."""

import math
import random
import re

import numpy as np
import pytest

from lorebase.llm import ranked_search
from tests.llm.fixtures import documents, frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, queries, k=10):
    """(query text, rank, id, score) by the formula, for ids that are not null."""
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n_docs, length = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in queries:
        scored = []
        for i, t in held:
            m = 100 - 75 + 75 * len(t) * n_docs // length
            s = 0
            for x in terms(text):
                tf = t.count(x)
                if tf:
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def asked(docs):
    r = random.Random(4)
    texts = [t for _, t in docs if t]
    some = [(k, " ".join(r.choice(texts).split()[: r.randint(1, 40)])) for k in range(40)]
    return some + [(40, None), (41, ""), (42, "?! --"), (43, "nowhere"), (44, "the THE the on"), (44, "ſecret Ⅷ ﬁ"), (None, "re ti an")]


@pytest.fixture(scope="module")
def tables(spark):
    docs = [(row[0], row[1]) for row in documents()]
    queries = asked(docs)
    return docs, queries, spark.createDataFrame(queries, "item_id long, text string")


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("block,shard", ((200_000, 1 << 16), (60, 7)))
def test_against_brute_force(spark, tables, monkeypatch, block, shard):
    docs, queries, asked_ = tables
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", block)
    monkeypatch.setattr(ranked_search, "SHARD_ROWS", shard)
    assert got(ranked_search.search(frame(spark), asked_)) == brute(docs, queries)


def test_ids_that_are_texts(spark, tables):
    docs, queries, asked_ = tables
    want = {(q, s) for q, _, _, s in brute(docs, queries)}
    rows = ranked_search.search(frame(spark).selectExpr("cast(doc_id as string) as doc_id", "text"), asked_)
    assert dict(rows.dtypes)["doc_id"] == "string" and {(r["item_id"], r["score"]) for r in rows.collect()} == want


def test_stops_early_with_whole_results():
    r = np.random.default_rng(2)
    n_docs, n_terms = 5000, 12
    # one term that everyone has adds little, others are rare and add much
    adds = [{0: int(r.integers(1, 50))} | ({int(r.integers(1, n_terms)): int(r.integers(5000, 9000))} if k % 40 == 0 else {}) for k in range(n_docs)]
    bounds = np.concatenate(([0], np.cumsum([len(a) for a in adds])))
    shard = ranked_search.Shard(bounds, np.array([t for a in adds for t in a]), np.array([v for a in adds for v in a.values()]), n_terms)
    query = [(t, 1 + t % 2) for t in range(n_terms)]
    docs, scores, read = shard.best(query, 10)
    whole = np.array([sum((1 + t % 2) * v for t, v in a.items()) for a in adds])
    assert read < n_docs / 5 and len(docs) < n_docs / 5
    assert (whole[docs] == scores).all() and sorted(scores)[-10:] == sorted(whole)[-10:]


def test_groups_of_equal_impact():
    bounds = np.array([0, 2, 3, 5])
    shard = ranked_search.Shard(bounds, np.array([0, 1, 0, 0, 1]), np.array([7, 3, 7, 9, 3]), 2)
    assert shard.adds[shard.groups].tolist() == [9, 7, 3] and shard.groups.tolist() == [0, 1, 3]


def test_empty_tables_and_clashing_names(spark, tables):
    _, _, asked_ = tables
    empty = ranked_search.search(frame(spark, []), asked_)
    assert empty.columns == ["item_id", "rank", "doc_id", "score"] and empty.count() == 0
    assert ranked_search.search(frame(spark), spark.createDataFrame([], "item_id long, text string")).count() == 0
    names = "doc_id long, text string, n long, terms string, tfs int, query int, score string, rank string"
    docs = spark.createDataFrame([(1, "aa bb", 0, "", 0, 0, "", ""), (1, "aa bb", 0, "", 0, 0, "", ""), (None, "bb", 0, "", 0, 0, "", "")], names)
    queries = spark.createDataFrame([("x", "aa", "y", 3)], "item_id string, text string, term string, times int")
    assert sorted(tuple(r)[:3] for r in ranked_search.search(docs, queries).collect()) == [("x", 1, 1), ("x", 2, 1)]
