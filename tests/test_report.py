from lorebase.operators import cleanup, report, resolve
from lorebase.sources import catalog
from tests.test_domain import formulas, values


def tables(spark):
    rows = [
        (1, "甲汤", "primary", "p", {"six_channel": "太阳", "dosage": "一"}), (2, "甲汤", "primary", "p", {"dosage": "二"}), (3, "甲汤", "primary", "p", {"dosage": "二"}),
        (4, "乙汤", "primary", "p", {"chapter": "x"}), (5, "乙汤", "secondary", "p", {"chapter": "y"}), (6, "> 乙汤", "o", "p", {}), (7, "> 杂，说", "o", "p", {}),
    ]
    return {
        "formulas": formulas(spark, rows),
        "formula_herbs": spark.createDataFrame([(4, 10), (5, 10), (7, 11)], "formula_id long, herb_id long"),
        "case_formulas": spark.createDataFrame([(k, 5) for k in range(7)], "case_id long, formula_id long"),
    }


def test_reports(spark):
    db, refs = tables(spark), [r for r in catalog.referencing("formulas")]
    assert values(report.conflicts(db["formulas"], resolve.canonical_rows(db["formulas"])), "field", "value", "ids", "medical") == [
        ("chapter", "y", [5], False), ("dosage", "二", [2, 3], True)]
    assert values(report.risk_report(db, refs), "name", "risk", "case_links", "moved") == [("乙汤", "yellow", 7, 8), ("甲汤", "red", 0, 0)]
    plan = {r["name"]: r for r in report.merge_plan(db, refs).collect()}
    assert plan["甲汤"]["n_removed"] == 2 and len(plan["乙汤"]["relations"]) == 3
    found = report.cleanup_plan(db, refs)
    assert values(found, "id", "class", "blocked") == [(6, "A_clean_match", False), (7, "descriptive_non_entity", True)]
    assert values(report.class_counts(found), "class", "n") == [("A_clean_match", 1), ("descriptive_non_entity", 1)]
    after, held, _ = cleanup.clean(db["formulas"])
    checks = {r["metric"]: r["ok"] for r in report.verified_cleanup(db["formulas"], after, held, [(db["formula_herbs"], "formula_id")]).collect()}
    assert checks == {"conserved": True, "dirty": True, "reference_0:formula_id": False, "all": False}
    assert report.markdown_table(report.class_counts(found)).count("\n") == 3


def test_dictionary(spark):
    df = spark.createDataFrame([("a", ""), ("b", "z"), ("c", None)], "name string, topic string")
    assert values(report.enriched(df, {"a": {"topic": "x"}, "b": {"topic": "y"}}, "name", ["topic"]), "name", "topic") == [("a", "x"), ("b", "z"), ("c", None)]


def test_enums_cover_the_tables():
    assert set(catalog.ENTITY_TYPES.values()) == {t.name for t in catalog.ENTITIES}
    for t in catalog.TABLES.values():
        assert set(t.key) | set(t.references) | set(t.search) | set(t.facets) | set(t.json) <= set(catalog.columns(t.name))
