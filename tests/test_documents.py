"""Document parsing, sources, sinks and the incremental import."""

import json

import pytest
from pyspark.sql import functions as F

from lorebase.operators import parse
from lorebase.sources import documents, sinks
from lorebase.streaming.incremental import import_cases

TABLE = """|**王医师病案纪录**|
|:--|
|初诊日期：2019/3/7 王医师病案纪录|
|姓名|性别|年龄|日期|
|<p>Ann Lee</p>|女|45岁|2019/3/7|
|**来诊原因：** <p>头痛</p>|
|问诊：**睡眠** 差|
|舌诊：白|
|特殊诊断：不计|
|诊断：太阳|
|中药处方：桂枝三钱|
|解说备注：无|
|初诊日期：2019/4/1 王医师病案纪录|
|姓名|性别|年龄|日期|
|Bob|x|30|2019/4/1|
|来诊原因：咳|
|初诊日期：2019/5/1 王医师病案纪录|
|问诊：空|
"""
VISITS = "初诊日期：短\n初诊日期：2020\n姓名\t性别\t年龄\t日期\nCarl\t男\t50\t2020/1/2\n来诊原因：腰痛\n已经三年\n\n还有腿麻\n问诊：口渴\n问诊：不渴\n望诊：x\n诊断：肾虚而且是非常长的一个诊断用来凑足字数的五十个字\n中药处方：肾气丸"
HEADED = "# Dora\n\n## 初诊\n2021-2-3 女 33 岁\n## 来诊原因\n失眠\n多梦\n### 望诊\n舌诊：红\n眼诊： 正常\n## 特殊诊断\n否\n## 诊断\n少阴\n"
PLAIN = "Eve\n2021/5/6 男 7岁\n问诊：饿\n累\n脉诊：浮\n诊断：表\n中药处方：麻黄\n解说：好\n备注：x"


def frame(spark, *texts):
    return spark.createDataFrame([(f"p{k}", t) for k, t in enumerate(texts)], "path string, text string")


def test_table_and_visit_cases(spark):
    rows = {(r["path"], r["name"]): r for r in parse.case_records(frame(spark, TABLE, VISITS)).collect()}
    assert set(rows) == {("p0", "Ann Lee"), ("p0", "Bob"), ("p1", "Carl")}
    a, b, c = rows["p0", "Ann Lee"], rows["p0", "Bob"], rows["p1", "Carl"]
    assert (a["case_date"], a["gender"], a["age"], a["chief_complaint"], a["inquiry"], a["tongue_diagnosis"], a["diagnosis"], a["herbal_rx"], a["notes"]) == (
        "2019-3-7", "女", "45岁", "头痛", "睡眠 差", "白", "太阳", "桂枝三钱", None)
    assert (b["gender"], b["chief_complaint"], b["case_date"]) == ("", "咳", "2019-4-1")
    assert (c["case_date"], c["chief_complaint"], c["inquiry"], c["herbal_rx"]) == ("2020-1-2", "腰痛 已经三年  还有腿麻", "不渴", "肾气丸")


def test_section_cases(spark):
    rows = {r["name"]: r for r in parse.section_case(frame(spark, HEADED, PLAIN)).collect()}
    d, e = rows["Dora"], rows["Eve"]
    assert (d["case_date"], d["gender"], d["age"], d["chief_complaint"], d["tongue_diagnosis"], d["eye_diagnosis"], d["diagnosis"]) == (
        "2021-2-3", "女", "33岁", "失眠\n多梦", "红", "正常", "少阴")
    assert (e["case_date"], e["age"], e["inquiry"], e["pulse_diagnosis"], e["herbal_rx"], e["notes"]) == ("2021-5-6", "7岁", "饿\n累", "浮", "麻黄", "好")


def test_sources(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.md").write_bytes("中文".encode("gbk"))
    (tmp_path / "a" / "README.md").write_text("no")
    (tmp_path / "b.md").write_text("---\nk: [a, 'b']\n# c: d\nt: \"v\"\n---\nbody", "utf-8")
    tree = documents.markdown_tree(spark, str(tmp_path))
    assert sorted(r["s"] for r in tree.select(documents.stem(F.col("path")).alias("s")).collect()) == ["b", "x"]
    assert "中文" in {r["text"] for r in documents.text_files(spark, str(tmp_path), "x.md").collect()}
    front = tree.where("path like '%b.md'").select(documents.front_matter(F.col("text")).alias("m")).first()["m"]
    assert front == {"k": "a, b", "t": "v"}
    assert sorted(r["n"] for r in documents.files_by_folder(spark, str(tmp_path)).collect()) == [1, 2]


def test_exports_and_publishing(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a,"b"\n', None), (2, "中", "x")], "id long, t string, u string")
    assert sinks.small_csv(df.orderBy("id")) == 'id,t,u\r\n1,"a,""b""\n",\r\n2,中,x\r\n'
    assert sinks.small_csv(df.where("id > 9")) == ""
    assert json.loads(sinks.small_json(df.orderBy("id")))[0] == {"id": 1, "t": 'a,"b"\n', "u": None}
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).columns == ["id", "t", "u"]
    folder = str(tmp_path / "snap")
    assert sinks.publish({"t": df}, folder, dry_run=True) is None and not (tmp_path / "snap").exists()
    with pytest.raises(ValueError):
        sinks.publish({"t": df}, folder, gates=[lambda db: db["t"].where("u is null")])
    assert sinks.publish({"t": df}, folder) == folder
    assert sinks.verify_copy(df, spark.read.parquet(f"{folder}/t.parquet")).first()["same"]
    with pytest.raises(ValueError):
        sinks.publish({"t": df}, folder)


def test_incremental_import(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.md").write_text(VISITS, "utf-8")
    out, marks = str(tmp_path / "out"), str(tmp_path / "marks")
    known = spark.createDataFrame([("TWO 20200101",)], "patient_id string")
    import_cases(spark, str(tmp_path / "in"), out, marks, known).awaitTermination(120)
    (tmp_path / "in" / "two.md").write_text(VISITS, "utf-8")
    (tmp_path / "in" / "three.md").write_text(VISITS, "utf-8")
    import_cases(spark, str(tmp_path / "in"), out, marks, known).awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 2 and all(r["source_locator"].split("#")[0].endswith(("one.md", "three.md")) for r in rows)


def test_front_values_counts_and_registries(spark, tmp_path):
    text = '---\na: [x, "y z"]\nb: "it\'s"\n# c: no\nb2: plain "quoted"\na2: [ ]\nurl: http://x/y\nb: last\n---\nbody: no'
    rows = spark.createDataFrame([(1, text), (2, "no front"), (3, None), (4, "---\nnever closed: 1")], "id long, text string")
    m = documents.front_values(F.col("text"))
    got = {r["id"]: r["m"] for r in rows.select("id", F.transform_values(m, lambda _, v: F.to_json(v)).alias("m")).collect()}
    assert got[1] == {"a": '["x","y z"]', "b2": '"plain \\"quoted"', "a2": '"[ ]"', "url": '"http://x/y"', "b": '"last"'} or got[1]["a2"] == '[""]'
    assert not got[2] and not got[4]
    assert documents.file_count(spark, str(tmp_path / "nowhere")) == 0
    (tmp_path / "x.md").write_text("a")
    assert documents.file_count(spark, str(tmp_path)) == 1
    js = '{"sources": [{"repo": "r", "contributions": {"herbs": 3, "notes": [1]}}, {"repo": "s", "contributions": ["a", "b"]}, {"repo": "t"}]}'
    found = documents.contributions(spark.createDataFrame([(js,), (None,), ("no json",)], "text string"))
    assert sorted((r["source"], r["table"], r["what"]) for r in found.select("source", "table", F.to_json("what").alias("what")).collect() if r["table"]) == [
        ("r", "herbs", "3"), ("r", "notes", "[1]"), ("s", "0", '"a"'), ("s", "1", '"b"'),
    ]
