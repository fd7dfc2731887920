"""Domain fixtures: names, redirects, merging, extraction, patches."""

import pytest
from pyspark.sql import functions as F

from lorebase.functions import text
from lorebase.operators import audit, changes, cleanup, extract, link, resolve, search
from lorebase.sources import catalog


def values(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


NAMES = [
    (1, ">麻黄汤"), (2, ">白虎汤"), (3, ">桂枝、麻黄汤"), (4, ""), (5, "   "), (6, None), (7, "麻黄\n汤"), (8, "白虎\t汤"),
    (9, "麻黄汤"), (10, "桂枝汤"), (11, "小柴胡汤"), (12, "这是一张普通的方子"), (13, "麻黄汤"),
]


def test_name_audit(spark):
    df = spark.createDataFrame(NAMES, "id long, name string")
    found = values(audit.name_findings(df), "id", "level", "rule")
    rules = [r for _, level, r in found if level == "hard"]
    assert (rules.count("blockquote"), rules.count("empty_name"), rules.count("control_char")) == (3, 3, 2)
    assert not [f for f in found if f[0] in (9, 10, 11, 13)]
    assert ("麻黄汤", 2, "9,13") in values(audit.duplicate_names(df), "trimmed", "n", "ids")


def test_cleanup(spark):
    rows = [
        (1, "麻黄汤"), (30, "白虎汤"), (7, "> 麻黄汤"), (76, "> 白虎汤"), (3, "> 干姜黄连黄芩人参汤"), (11, "> 这是描述性，方子"),
        (90, "> 桂枝、麻黄、葛根汤"), (5, "> 未知方剂XYZ"),
    ]
    df = spark.createDataFrame(rows, "id long, name string")
    after, held, evidence = cleanup.clean(df)
    assert values(held, "source_record_id", "reason_code") == [(11, "descriptive_non_entity"), (5, "ambiguous_name"), (90, "multiple_entities")]
    assert values(after, "id") == [(1,), (3,), (30,), (7,), (76,)] and evidence.count() == 3
    assert cleanup.conserved(df, after, held).first()["ok"]
    again, held2, _ = cleanup.clean(after)
    assert values(again, "id", "name") == values(after, "id", "name") and held2.count() == 0


def test_planned_class_differs(spark):
    df = spark.createDataFrame([(1, "> 芍药多"), (2, "> 甲煎和乙露")], "id long, name string")
    assert values(cleanup.classified(df, cleanup.planned_class), "id", "class") == [(1, "descriptive_non_entity"), (2, "multiple_entities")]


def test_redirects(spark):
    rows = [(1, "8", 209), (2, "8", 210), (3, "abc", 5), (4, "0", 5), (5, "1", 2), (6, "2", 1)]
    ev = spark.createDataFrame(rows, "id long, source_record_id string, subject_id long").withColumns({"relation_type": F.lit("merged_from"), "subject_type": F.lit("formula")})
    found = resolve.redirect_map(ev)
    assert values(found, "old_id", "canonical_id", "n_canonical") == [(1, 2, 1), (2, 1, 1), (8, 209, 2)]
    assert values(resolve.resolvable(found), "old_id", "canonical_id") == [(8, 209)]
    db = {"formulas": spark.createDataFrame([(209, "麻黄汤", "**a**")], "id long, name string, commentary string")}
    row, _ = search.detail(db, "formulas", "8", resolve.resolvable(found))
    assert values(row, "id", "redirected_from", "commentary_html") == [(209, 8, "<strong>a</strong>")]
    assert values(search.detail(db, "formulas", 209, resolve.resolvable(found))[0], "id", "redirected_from") == [(209, None)]
    assert search.detail(db, "formulas", 999999, resolve.resolvable(found))[0].count() == 0


@pytest.mark.parametrize("bad", ["abc", "0", "-1", "1.5", "", "１"])
def test_ids_are_checked(bad):
    with pytest.raises(ValueError):
        search.checked_id(bad)


@pytest.mark.parametrize("bad", ["sqlite_master", "", "herbs; drop"])
def test_names_are_checked(bad):
    with pytest.raises(ValueError):
        catalog.table(bad)
    with pytest.raises(ValueError):
        catalog.column("herbs", bad)


def formulas(spark, rows):
    cols = "id long, name string, source_repo string, raw_path string, " + ", ".join(f"{f} string" for f in catalog.MERGE_FIELDS)
    full = [(*r[:4], *[r[4].get(f) for f in catalog.MERGE_FIELDS]) for r in rows]
    return spark.createDataFrame(full, cols)


def test_migration(spark):
    rows = [
        (1, "甲汤", "secondary", "p", {"six_channel": "太阳", "dosage": ""}), (2, "甲汤", "primary", "p", {"dosage": "三钱", "alias": "x"}),
        (3, "甲汤", "primary", "p", {"dosage": "三钱", "alias": "y"}), (4, "乙汤", "secondary", "p", {}), (5, "乙汤", "primary", "p", {}), (6, "丙汤", "o", "p", {}),
    ]
    db = {
        "formulas": formulas(spark, rows),
        "formula_herbs": spark.createDataFrame([(1, 10, "a"), (2, 10, "b"), (3, 11, "c"), (4, 12, "d")], "formula_id long, herb_id long, role string"),
    }
    out = resolve.migrate(db, [("formula_herbs", "formula_id", ["formula_id", "herb_id"])])
    assert values(out["formulas"], "id", "dosage", "alias") == [(1, "三钱", None), (5, None, None), (6, None, None)]
    assert values(out["formula_herbs"], "formula_id", "herb_id", "role") == [(1, 10, "a"), (1, 11, "c"), (5, 12, "d")]
    kinds = values(out["evidence"].groupBy("relation_type").count(), "relation_type", "count")
    assert kinds == [("field_value", 2), ("merged_from", 3)]
    groups = resolve.canonical_rows(db["formulas"])
    assert all(r["same"] for r in resolve.reconciled(db["formula_herbs"], out["formula_herbs"], "formula_id", "herb_id", groups).collect())
    again = resolve.migrate(out, [("formula_herbs", "formula_id", ["formula_id", "herb_id"])])
    assert values(again["formulas"], "id") == values(out["formulas"], "id") and again["evidence"].count() == out["evidence"].count()


def test_evidence_repoint(spark):
    groups = spark.createDataFrame([("甲", 1, 2), ("甲", 1, 1)], "name string, canonical_id long, id long")

    def evidence(*rows):
        df = spark.createDataFrame(list(rows), "id long, subject_id long, object_id long, evidence_text string, source_record_id string")
        return df.withColumns({"subject_type": F.lit("formula"), "object_type": F.when(F.col("object_id").isNotNull(), "formula"), "dedupe_key": F.lit("")})

    moved = resolve.repoint_evidence(evidence((1, 2, None, "t", "2"), (2, 1, 2, "u", "1")), groups)
    assert values(moved, "subject_id", "object_id", "source_record_id") == [(1, 1, "1"), (1, None, "2")]
    assert resolve.repoint_evidence(evidence((1, 1, None, "t", "9"), (2, 2, None, "t", "9")), groups).count() == 1
    with pytest.raises(resolve.Collision):
        resolve.repoint_evidence(evidence((1, 1, None, "A", "9"), (2, 2, None, "B", "9")), groups)


def test_keys_tell_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "null")], "subject_type string, field_name string")
    assert df.select(resolve.dedupe_key(df).alias("k")).distinct().count() == 3


def test_source_keys(spark):
    rows = [("p1", "主诉A", "f.md"), ("p2", "主诉B", "f.md"), ("核心要点", "x", "")]
    df = spark.createDataFrame(rows, "patient_id string, chief_complaint string, raw_path string")
    found = dict(values(audit.source_keys(df), "metric", "n"))
    assert found["blank_raw_path"] == 1 and found["multi_case_files"] == 1 and found["dup_combined"] == 0


def test_text_functions(spark):
    assert one(spark, text.herb_name, " 炙甘草三 12克（后下）") == "甘草三"
    assert one(spark, text.herb_name, "生姜") == "姜"
    assert one(spark, text.composition_herbs, "桂枝三钱, 芍药３两,,桂枝三钱,甘草") == ["桂枝", "芍药", "桂枝", "甘草"]
    assert one(spark, text.composition_herbs, None) == []
    assert sorted(one(spark, text.herbs_in, "桂枝三钱芍药三钱\n水煮服\n甘草(炙)二两　\n一长串不是药名啊")) == ["桂枝", "甘草", "芍药"]
    assert "桂枝汤" in one(spark, text.formulas_in, "桂枝汤、肾气丸")
    assert one(spark, text.list_of, '["a", "b"]') == ["a", "b"] and one(spark, text.list_of, "a, b") == ["a", "b"] and one(spark, text.list_of, "[bad") == ["[bad"]
    assert one(spark, text.without_markup, "<p>**a**</p> ") == "a"
    assert one(spark, text.person_name, "O'Neil,  J.-P") == "o neil j p"
    assert one(spark, text.patient_name, "王 小明 20200101") == "王 小明" and one(spark, text.patient_name, "王") == "王"
    assert one(spark, text.case_date, "于2020/1/5来") == "2020-1-5" and one(spark, text.case_date, "无") is None
    assert one(spark, text.age, "年４５ 岁") == "４５岁" and one(spark, text.gender, "性别女") == "女"
    assert one(spark, lambda c: text.treatment_category(c, F.lit(None).cast("string")), "清热解毒法") == "清热"
    assert one(spark, lambda c: text.treatment_category(c, F.lit("")), "某法") == "方剂治法"
    assert one(spark, lambda c: text.hours_of(c.cast("int")), "3") == 4.5 and one(spark, lambda c: text.hours_of(c.cast("int")), "0") is None
    html = one(spark, text.markdown_html, "# 题\n> 引\n**b** ![x](assets/screenshots/a.webp) ![y](u.png)")
    assert html.startswith('<h2 style="margin:20px 0 10px;">题</h2><br><blockquote') and "<strong>b</strong>" in html and '<img src="u.png" alt="y"' in html


def test_matching(spark):
    names = spark.createDataFrame([(5, "甘草"), (2, "桂枝"), (9, "桂枝"), (3, "枝"), (7, "白芍药")], "id long, name string")
    tokens = spark.createDataFrame([(x,) for x in ("桂枝", "炙甘草", "芍药", "大桂枝根", "无", None, "")], "token string")
    found = dict(values(extract.match_tokens(tokens, extract.entity_names(names), text.herb_name), "token", "id"))
    assert found == {"桂枝": 9, "炙甘草": 5, "芍药": 7, "大桂枝根": 9}


def test_changes(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "id long, a string, b string")
    new = spark.createDataFrame([(2, "", "z"), (3, "c", "c"), (3, "d", "d")], "id long, a string, b string")
    assert values(changes.patch(old, new, "id", ["a", "b"]), "id", "a", "b") == [(1, "a", None), (2, "b", "z")]
    assert values(changes.patch(old, new, "id", ["a"], False), "id", "a") == [(1, "a"), (2, "")]
    assert values(changes.insert_ignore(old, new, ["id"], ["a"]), "id", "a") == [(1, "a"), (2, "b"), (3, "c")]
    assert values(changes.upsert(old, new.where("a <> 'd'"), ["id"], ["b"]), "id", "a", "b") == [(1, "a", None), (2, "b", "z"), (3, "c", "c")]
    assert values(changes.append_with_ids(old, new.drop("id"), ["a"]), "id", "a") == [(1, "a"), (2, "b"), (3, ""), (4, "c"), (5, "d")]
    twice = changes.insert_ignore(changes.insert_ignore(old, new, ["id"], ["a"]), new, ["id"], ["a"])
    assert twice.count() == 3


def test_greedy_linkage(spark):
    new = spark.createDataFrame([(1, "John Smith", "2020-1-1", ""), (2, "john  smith", "2020-1-2", ""), (3, "Smith", "", ""), (4, "Zed", "", "头痛三日")], "id long, name string, case_date string, chief_complaint string")
    old = spark.createDataFrame([(10, "John Smith 20200102", "2020-1-2", ""), (11, "JOHN SMITH", "2020-1-9", ""), (12, "Smith Ann", "", ""), (13, "Q", "", "头痛三日")], "id long, patient_id string, case_date string, chief_complaint string")
    assert values(link.link(new, old), "new_id", "old_id") == [(1, 11), (2, 10), (3, 12), (4, 13)]


def test_audit_run(spark):
    db = {
        "formulas": spark.createDataFrame([(1, "麻黄汤")], "id long, name string"), "herbs": spark.createDataFrame([(1, "甘草")], "id long, name string"),
        "formula_herbs": spark.createDataFrame([(1, 1)], "formula_id long, herb_id long"),
    }
    assert audit.run(db)[0] is False
    db["formula_herbs"] = spark.createDataFrame([(1, 1), (2, 1)], "formula_id long, herb_id long")
    failed, report = audit.run(db)
    assert failed and ("orphans", 1) in values(report, "check", "n")


@pytest.mark.parametrize("value,ok", [('{"a":1}', True), ("[1]", True), ("1", True), ("{bad", False), ('{"a":1}}', False), ("1,2", False), ("", False)])
def test_json(spark, value, ok):
    assert one(spark, audit.valid_json, value) is ok


def test_search_prefix_limit(spark):
    herbs = spark.createDataFrame([(k, f"甘草{k}", None, None, "x" * 300, None) for k in range(25)], "id long, name string, alias string, indication string, commentary string, bencao_raw string")
    herbs = herbs.withColumns({"category": F.lit(""), "nature": F.lit(""), "flavor": F.lit("")})
    sym = spark.createDataFrame([(1, "甘草症", "", "", "", "")], "id long, name string, category string, description string, first_gateway string, target_module string")
    found = search.search({"herbs": herbs, "symptoms": sym}, "甘草").collect()
    assert len(found) == 20 and {r["type"] for r in found} == {"中药"} and all(len(r["commentary"]) == 200 for r in found)
    assert search.export_search({"herbs": herbs, "symptoms": sym}, "甘草").count() == 26


def test_audit_report_and_quarantine(spark):
    db = {
        "formulas": spark.createDataFrame([(1, "麻黄汤"), (2, "麻黄汤")], "id long, name string"), "herbs": spark.createDataFrame([(1, "甘草")], "id long, name string"),
        "formula_herbs": spark.createDataFrame([(1, 1)], "formula_id long, herb_id long"), "ingestion_quarantine": spark.createDataFrame([("{}",), ("[]",)], "raw_record_json string"),
    }
    failed, found = audit.run(db)
    assert not failed and audit.human_report(found).endswith("PASSED") and "[WARN] duplicates: 1" in audit.human_report(found)
    failed, found = audit.run(db | {"ingestion_quarantine": spark.createDataFrame([("",)], "raw_record_json string")})
    assert failed and "[FAIL] json:ingestion_quarantine: 1" in audit.human_report(found)
