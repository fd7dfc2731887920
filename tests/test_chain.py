"""Chains: every row kept lies on a whole path, and counts agree with the list of paths."""

import random

import pytest

from lorebase.operators import chain


@pytest.fixture(scope="module")
def db(spark):
    r = random.Random(3)
    edge = lambda n, m, k, names: spark.createDataFrame([(r.randrange(1, n), r.randrange(1, m)) for _ in range(k)] + [(None, 1), (1, None), (999, 1)], names)
    named = lambda n, c="name": spark.createDataFrame([(k, f"{c}{k}") for k in range(1, n)], f"id long, {c} string")
    return {
        "symptoms": named(12), "syndromes": named(15), "formulas": named(25), "herbs": named(9), "clinical_cases": named(30, "patient_id"),
        "syndrome_symptoms": edge(14, 11, 20, "syndrome_id long, symptom_id long"), "formula_syndromes": edge(22, 14, 18, "formula_id long, syndrome_id long"),
        "formula_herbs": edge(20, 9, 25, "formula_id long, herb_id long"), "case_formulas": edge(28, 24, 30, "case_id long, formula_id long"),
    }


def pairs(db, hop):
    ids = lambda t: {x["id"] for x in db[t].collect()}
    return {(x[hop.own], x[hop.far]) for x in db[hop.edge].collect() if x[hop.own] in ids(hop.source) and x[hop.far] in ids(hop.target)}


def walks(db, hops, start):
    out = [(s,) for s in start]
    for hop in hops:
        edges = pairs(db, hop)
        out = [(*p, far) for p in out for own, far in edges if own == p[-1]]
    return out


def test_edges_are_reduced_from_both_ends(spark, db):
    start = {x["id"] for x in chain.matching(db, "name1").collect()}
    whole = walks(db, chain.TO_CASES, start)
    assert whole and start < {x["id"] for x in db["symptoms"].collect()}
    got = chain.reduced(db, chain.TO_CASES, chain.matching(db, "name1"))
    for k, rows in enumerate(got):
        # the number of rows of every intermediate is the number of edges on whole paths
        assert sorted(map(tuple, rows.select("own", "far").collect())) == sorted({(p[k], p[k + 1]) for p in whole})
    # and no join of paths makes a row that a later one drops
    first = got[0].join(got[1].selectExpr("own as far", "far as next"), "far")
    assert first.count() == len({p[:3] for p in whole})


def test_paths_and_counts(spark, db):
    names = {t: {x["id"]: x[1] for x in db[t].collect()} for t in ("symptoms", "clinical_cases")}
    start = {x["id"] for x in db["symptoms"].collect()}
    whole = walks(db, chain.TO_CASES, start)
    got = [tuple(x) for x in chain.paths(db, "").collect()]
    assert sorted((x[0], x[2], x[4], x[6]) for x in got) == sorted(whole) and all(x[1] == names["symptoms"][x[0]] and x[7] == names["clinical_cases"][x[6]] for x in got)
    counts = {x["id"]: x["paths"] for x in chain.path_counts(db, db["symptoms"].select("id")).collect()}
    assert counts == {s: sum(p[0] == s for p in whole) for s in start}
    assert chain.paths(db, "nothing").count() == 0


def test_coverage(spark, db):
    hops = (*chain.TO_HERBS, chain.TO_CASES[-1])
    edges = {h.name: pairs(db, h) for h in hops}
    for row in chain.hop_coverage(db).collect():
        e = edges[row["hop"]]
        hop = next(h for h in hops if h.name == row["hop"])
        after = [own for h in hops if h.source == hop.target for own, _ in edges[h.name]]
        assert (row["edges"], row["covered_source"], row["covered_target"]) == (len(e), len({a for a, _ in e}), len({b for _, b in e}))
        assert (row["total_source"], row["total_target"]) == (db[hop.source].count(), db[hop.target].count())
        assert row["onward"] == (len({b for _, b in e} & set(after)) if after else None)
    start = {x["id"] for x in chain.matching(db, "1").collect()}
    for row in chain.start_coverage(db, "1").collect():
        some = walks(db, chain.TO_CASES[: row["step"]], start)
        assert (row["covered"], row["total"], row["reached"]) == (len({p[0] for p in some}), len(start), len({p[-1] for p in some}))
