"""Merged values: a fill wins over blanks, other rows stay as they are, gates see what is left."""

from lorebase.operators import resolve
from tests.test_domain import formulas, values


def test_fill_of_a_blank_and_untouched_rows(spark):
    rows = [(1, "甲汤", "primary", "p", {"chapter": "  ", "six_channel": "x"}), (2, "甲汤", "primary", "q", {"chapter": "CH", "alias": "a"}), (3, "乙汤", "o", "p", {"alias": ""})]
    out = resolve.migrate({"formulas": formulas(spark, rows)}, [])
    assert values(out["formulas"], "id", "chapter", "alias") == [(1, "CH", "a"), (3, None, "")]
    evidence = out["evidence"].collect()
    assert [(r["source_type"], r["review_status"], r["source_path"]) for r in evidence] == [("database_row", "pending", "q")]


def test_gates(spark):
    rows = spark.createDataFrame([(1,), (3,)], "id long")
    edge = spark.createDataFrame([(1, 7), (2, 7)], "formula_id long, herb_id long")
    evidence = spark.createDataFrame([("formula", 2, None, None), ("formula", 1, "formula", 9), ("herb", 2, None, None)], "subject_type string, subject_id long, object_type string, object_id long")
    gone = spark.createDataFrame([(2,)], "id long")
    found = resolve.delete_gates({"formulas": rows, "formula_herbs": edge, "evidence": evidence}, [("formula_herbs", "formula_id")], gone)
    got = {r["gate"]: (r["n"], r["ok"]) for r in found.collect()}
    assert got == {"formula_herbs.formula_id": (1, False), "evidence.subject": (1, False), "evidence.subject.orphan": (1, False), "evidence.object": (0, True), "evidence.object.orphan": (1, False)}


def test_sets_without_arrays(spark):
    import random

    from lorebase.operators import resolve

    r = random.Random(4)
    edges = {(r.randrange(12), r.randrange(5)) for _ in range(40)} | {(20, 1), (21, 1), (22, 2), (30, None)}
    groups = [(f"n{i % 4}", i % 4, i) for i in range(12)] + [("x", 20, 20), ("x", 20, 21), ("x", 20, 22), ("y", 30, 30), ("y", 30, 31)]
    edge = spark.createDataFrame(sorted(edges, key=str), "formula_id long, herb_id long")
    g = spark.createDataFrame(groups, "name string, canonical_id long, id long")
    of = {}
    for _, c, i in groups:
        mine = frozenset(h for f, h in edges if f == i and h is not None)
        if mine:
            of.setdefault(c, set()).add(mine)
    got = {x["canonical_id"]: x["same"] for x in resolve.consistent_sets(edge, "formula_id", "herb_id", g).collect()}
    assert got == {c: len(s) == 1 for c, s in of.items()}
    after = resolve.repoint(edge, "formula_id", g, ["formula_id", "herb_id"])
    union = {c: {h for f, h in edges for _, k, i in groups if f == i and k == c} for _, c, _ in groups}
    rows = {(x["formula_id"], x["herb_id"]) for x in after.collect()}
    assert rows == {(c, h) for c, hs in union.items() for h in hs} and after.count() == len(rows)
    assert all(x["same"] for x in resolve.reconciled(edge, after, "formula_id", "herb_id", g).collect())
    lost = after.where("not (formula_id = 20 and herb_id = 2)")
    assert {x["canonical_id"] for x in resolve.reconciled(edge, lost, "formula_id", "herb_id", g).where("not same").collect()} == {20}


def test_a_row_that_stays_goes_before_a_moved_one(spark):
    from lorebase.operators import resolve

    g = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", 1, 3)], "name string, canonical_id long, id long")
    edge = spark.createDataFrame([(1, 7, "z"), (2, 7, "a"), (2, 8, "c"), (3, 8, "b"), (9, 9, None)], "formula_id long, herb_id long, role string")
    got = sorted(map(tuple, resolve.repoint(edge, "formula_id", g, ["formula_id", "herb_id"]).collect()))
    assert got == [(1, 7, "z"), (1, 8, "b"), (9, 9, None)]
