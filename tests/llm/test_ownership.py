"""Ownership counts sources and repositories; long texts take time in proportion."""

import time

from lorebase.llm import secrets

SCHEMA = "doc_id long, text string, source string"


def test_owners_and_repositories(spark):
    text = "key Abcdefghij0123456789xyz end"
    docs = [(k, text + " " * (k % 4), s) for k, s in enumerate(["a"] * 5 + [None] * 2 + ["b"])]
    found = secrets.candidates(spark.createDataFrame(docs, SCHEMA))
    counted = secrets.ownership(secrets.spans_of(found))
    # null is an owner of its own; each different text is a repository
    assert [(r["n_owners"], r["n_repositories"]) for r in counted.collect()] == [(3, 4)]


def test_many_repositories_make_an_example(spark):
    docs = [(k, f"text {k} key Abcdefghij0123456789xyz end", "one") for k in range(4)]
    frame = spark.createDataFrame(docs, SCHEMA)
    assert {r["n_live"] for r in secrets.secret_report(frame, max_repositories=4).collect()} == {1}
    assert {r["n_live"] for r in secrets.secret_report(frame, max_repositories=3).collect()} == {0}
    by_id = secrets.secret_report(frame.withColumn("repo", frame.doc_id % 2), repository="repo", max_repositories=2)
    assert {r["n_live"] for r in by_id.collect()} == {1}


def test_long_text(spark):
    n = 40_000
    part = "0123456789abcdef0 Zyxw0Qponmlkjihgzyxwv9 é "
    docs = [(1, part * n, "s"), (2, "x" * 1_000_000, "s")]
    frame = spark.createDataFrame(docs, SCHEMA)
    began = time.time()
    row = secrets.secret_report(frame).where("doc_id = 1").first()
    assert row["n_hex"] == n and row["spans"].count("blob") == n
    (out,) = [r["text"] for r in secrets.mask_secrets(frame).where("doc_id = 1").collect()]
    assert out == "[SECRET] [SECRET] é " * n
    assert time.time() - began < 60


def test_masks_over_the_bounds_of_pieces(spark):
    texts = [f"{'é' * (4080 + k)} password = abcdefghijklmnop{'q' * 5000 * (k % 2)} tail" for k in range(0, 24, 3)]
    frame = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r["text"] for r in secrets.mask_secrets(frame).collect()}
    assert got == {k: f"{t.split(' ')[0]} [SECRET] tail" for k, t in enumerate(texts)}
