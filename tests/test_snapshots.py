"""Snapshots: one computation a table, gates before the pointer, conflicts, stopped writers, damage and copies; and constraints."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from lorebase.operators import audit, cleanup, constraints, resolve
from lorebase.sources import snapshots


def frames(spark, n=20):
    return {"formulas": spark.range(n).select("id", F.concat(F.lit("f"), "id").alias("name")), "herbs": spark.createDataFrame([(1, "甘草"), (2, None)], "id long, name string")}


def test_versions_and_manifests(spark, tmp_path):
    root = str(tmp_path / "kb")
    assert snapshots.read(spark, root) == {} and snapshots.versions(spark, root) == []
    first = snapshots.commit(frames(spark), root, note="one")
    second = snapshots.commit(frames(spark, 5), root, base=1)
    assert snapshots.versions(spark, root) == [1, 2] and first["tables"]["formulas"]["n"] == 20
    assert snapshots.read(spark, root)["formulas"].count() == 5 and snapshots.read(spark, root, 1)["formulas"].count() == 20
    assert snapshots.manifest(spark, root, 1) == first and snapshots.differences(first, first) == []
    assert {t for t, _ in snapshots.differences(first, second)} == {"formulas"}
    shuffled = snapshots.commit({**frames(spark), "formulas": frames(spark)["formulas"].orderBy(F.desc("id"))}, root)
    assert snapshots.differences(first, shuffled) == []
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(frames(spark), root, base=2)
    with pytest.raises(ValueError):
        snapshots.manifest(spark, root, 9)


def test_every_row_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).mapInArrow(pass_on, "id long")
    made = snapshots.commit({"t": df}, str(tmp_path / "kb"), gates=[lambda db: db["t"].where("id < 0")])
    assert seen.value == 1000 and made["tables"]["t"]["n"] == 1000
    assert {k: made["tables"]["t"][k] for k in ("n", "first", "second")} == snapshots.measured(spark.range(1000))


def test_gates_and_stopped_writers_leave_the_version_before(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "kb")
    snapshots.commit(frames(spark), root)
    assert snapshots.commit(frames(spark), root, dry_run=True) is None
    with pytest.raises(snapshots.Refused):
        snapshots.commit(frames(spark), root, gates=[lambda db: db["herbs"].where("name is null")])

    def stopped(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(snapshots, "_put_if_absent", stopped)
        with pytest.raises(KeyboardInterrupt):
            snapshots.commit(frames(spark, 3), root)
    assert snapshots.versions(spark, root) == [1] and snapshots.read(spark, root)["formulas"].count() == 20
    # two writers that saw the same last version: one wins
    with monkeypatch.context() as m:
        m.setattr(snapshots, "versions", lambda *_: [])
        with pytest.raises(snapshots.Conflict):
            snapshots.commit(frames(spark, 3), root)
    assert snapshots.read(spark, root)["formulas"].count() == 20


def test_damage_and_copies(spark, tmp_path):
    root, to = str(tmp_path / "kb"), str(tmp_path / "copy")
    made = snapshots.commit(frames(spark), root)
    assert snapshots.damaged(spark, root) == []
    assert snapshots.differences(made, snapshots.backup(spark, root, to)) == []
    folder = f"{root}/{made['tables']['formulas']['path']}"
    part = next(f for f in sorted(os.listdir(folder)) if f.startswith("part-"))
    os.remove(f"{folder}/{part}")
    found = snapshots.damaged(spark, root)
    assert ("formulas", "n") in found
    shutil.rmtree(f"{root}/{made['tables']['herbs']['path']}")
    assert ("herbs", "missing") in snapshots.damaged(spark, root)
    failed, report = audit.run({"formulas": frames(spark)["formulas"], "formula_herbs": spark.createDataFrame([(1, 1)], "formula_id long, herb_id long"), "herbs": spark.createDataFrame([(1, "x")], "id long, name string")}, found)
    assert failed and {r["check"]: r["n"] for r in report.collect()}["signature"] == len(found)


def test_merge_gates_of_a_snapshot(spark, tmp_path):
    groups = spark.createDataFrame([("a", 1, 1), ("a", 1, 2)], "name string, canonical_id long, id long")
    db = {"formulas": spark.createDataFrame([(1, "a")], "id long, name string"), "formula_herbs": spark.createDataFrame([(1, 7)], "formula_id long, herb_id long")}
    gate = resolve.nothing_left([("formula_herbs", "formula_id")], groups.where("id <> canonical_id"))
    assert snapshots.commit(db, str(tmp_path / "kb"), gates=[gate])["version"] == 1
    with pytest.raises(snapshots.Refused, match="gates_not_ok"):
        snapshots.commit(db | {"formula_herbs": spark.createDataFrame([(2, 7)], "formula_id long, herb_id long")}, str(tmp_path / "kb"), gates=[gate])


def test_doubled_ids_and_edges_fail_the_audit(spark):
    db = {
        "formulas": spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string"), "herbs": spark.createDataFrame([(1, "x")], "id long, name string"),
        "formula_herbs": spark.createDataFrame([(1, 1), (2, 1)], "formula_id long, herb_id long"),
    }
    assert not audit.run(db)[0] and constraints.violations(db).count() == 0
    for name in ("formulas", "formula_herbs"):
        failed, report = audit.run(db | {name: db[name].unionAll(db[name])})
        assert failed and {r["check"]: r["n"] for r in report.collect()}["keys"] == 2
    bad = db | {"formula_herbs": spark.createDataFrame([(1, 1), (9, 1)], "formula_id long, herb_id long"), "herbs": spark.createDataFrame([(1, None)], "id long, name string")}
    text = audit.human_report(audit.run(bad)[1], audit.findings(bad))
    assert "[FAIL] orphans: 1\n    - formula_herbs.formula_id: 9" in text and "    - herbs not_null:name: 1" in text and text.endswith("FAILED")
    with pytest.raises(ValueError):
        audit.human_report(audit.run(bad)[1], audit.findings(bad), limit=1)


def test_cleanup_of_whole_tables(spark):
    rows = [(1, "> 麻黄汤", "p1", "s"), (2, "麻黄汤", "p2", "s"), (3, "> 平常喝的", "p3", None), (5, "> 无名", None, None)]
    formulas = spark.createDataFrame(rows, "id long, name string, raw_path string, source_repo string")
    db = {"formulas": formulas, "formula_herbs": spark.createDataFrame([(1, 1)], "formula_id long, herb_id long")}
    out = cleanup.cleaned_tables(db, run_id="r1")
    assert sorted(x["name"] for x in out["formulas"].collect()) == ["麻黄汤", "麻黄汤"]
    held = {x["source_record_id"]: x for x in out["ingestion_quarantine"].collect()}
    assert set(held) == {3, 5} and held[3]["raw_record_json"] == '{"id": 3, "name": "> 平常喝的", "raw_path": "p3", "source_repo": null}'
    assert {(x["status"], x["run_id"], x["schema_version"]) for x in held.values()} == {("pending_review", "r1", "v2")} and held[3]["source_path"] == "p3"
    assert constraints.violations({k: out[k] for k in ("evidence", "ingestion_quarantine")}).count() == 0
    again = cleanup.cleaned_tables(out, run_id="r1")
    assert all(again[k].count() == out[k].count() for k in out)
    with pytest.raises(cleanup.Blocked):
        cleanup.cleaned_tables(db | {"formula_herbs": spark.createDataFrame([(3, 1)], "formula_id long, herb_id long")})
