"""Stages on tables whose extra columns are named like inner ones, with nulls, and on empty tables."""

import pytest

from lorebase.llm import decontaminate, jaccard_join, quality, secrets
from tests.llm.fixtures import prose

import random

NAMES = ("__hash", "__id", "__score", "__doc_id", "g_id", "g_hash", "h_id", "k_id", "spans", "runs", "score", "text_hash", "words", "node", "row", "c0", "c1", "uid", "i", "y")
SCHEMA = ", ".join([*(f"{n} string" for n in NAMES), "doc_id long", "text string", "lang string", "source string", "n_chars long"])


def rows():
    r = random.Random(8)
    texts = [prose(r, 40) for _ in range(6)] + [None, "", "x y"]
    texts += [texts[0], texts[1] + " more", f"key Abcdefghij0123456789xyz {texts[5]}"]
    return [(*[f"{n}{k}" for n in NAMES], None if k == 3 else k, t, None if k == 2 else "en", None if k == 4 else "s", None) for k, t in enumerate(texts)]


def stages(spark):
    benchmark = spark.createDataFrame([(1, rows()[2][-4])], "item_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(9)], "doc_id long, quality int, toxic int")
    return {
        "quality": lambda d: quality.keep_good(d, labels),
        "near_duplicates": jaccard_join.keep_one,
        "decontamination": lambda d: decontaminate.keep_clean(d, benchmark),
        "secrets": secrets.mask_secrets,
    }


@pytest.mark.parametrize("stage", ("quality", "near_duplicates", "decontamination", "secrets"))
def test_clashing_names(spark, stage):
    docs = spark.createDataFrame(rows(), SCHEMA)
    run = stages(spark)[stage]
    out = run(docs)
    assert out.columns == docs.columns
    got = out.collect()
    inputs = {r[0]: r for r in rows()}
    # every row that stays is a row of the input; only the secrets stage changes a text
    at = docs.columns.index("text")
    for g in got:
        want = inputs[g[0]]
        assert tuple(g)[:at] == want[:at] and tuple(g)[at + 1 :] == want[at + 1 :]
        assert g[at] == want[at] or (stage == "secrets" and "[SECRET]" in g[at])
    # a copy and two near copies; one benchmark text
    expected = {"near_duplicates": len(inputs) - 3, "decontamination": len(inputs) - 1, "secrets": len(inputs)}
    assert len(got) == expected.get(stage, len(got)) and len({g[0] for g in got}) == len(got)
    empty = run(spark.createDataFrame([], SCHEMA))
    assert empty.columns == docs.columns and empty.count() == 0
