import __spark_entry__
import corpus_pipeline
from lorebase.sources.tables import read_table

BASE = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = read_table(spark, BASE, "documents")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, BASE)
        assert docs.columns == columns, name
        now = {r["doc_id"] for r in docs.collect()}
        assert now <= ids and len(now) == docs.count()
        ids = now
    out = {r["doc_id"] for r in corpus_pipeline.run(spark, BASE).collect()}
    assert out == ids and len(out) > 50


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
