"""Collocations against plain counting, with rows flushed early, hash collisions and awkward rows."""

import re
from collections import Counter

import numpy as np
import pytest

from lorebase.llm import phrases
from tests.llm.fixtures import DOCS, documents, frame

FOLD = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, top=2000):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(FOLD)):
            w = [x for x in re.split("[ \t]", piece) if x]
            total[lang] += len(w)
            for n in (1, 2, 3, 4):
                for i in range(len(w) - n + 1):
                    f[lang, tuple(w[i : i + n])] += 1
    f = {k: v for k, v in f.items() if v >= least}
    out = []
    for (lang, w), a in f.items():
        if len(w) < 2:
            continue
        score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        longer = [b for (x, v), b in f.items() if x == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if not any(100 * b >= 80 * a for b in longer):
            out.append((lang, -score, -a, " ".join(w).encode(), a, f[lang, w[:k]], f[lang, w[k:]], total[lang]))
    found, rank = [], Counter()
    for lang, score, _, phrase, a, left, right, n in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            found.append((lang, rank[lang], phrase.decode(), a, left, right, n, -score))
    return found


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("held", (2_000_000, 300))
def test_against_plain_counting(spark, monkeypatch, held):
    monkeypatch.setattr(phrases, "HELD_HASHES", held)
    monkeypatch.setattr(phrases, "TASK_WORDS", 100)
    docs = [(row[2], row[1]) for row in documents()]
    want = brute(docs, 6)
    assert len(want) > 30 and rows_of(phrases.collocations(frame(spark), least=6)) == sorted(want)
    assert rows_of(phrases.collocations(frame(spark), least=6, top=5)) == sorted(brute(docs, 6, 5))


def test_a_full_bit_table_loses_and_adds_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MAX_BITS", 64)
    docs = [(row[2], row[1]) for row in documents()]
    assert rows_of(phrases.collocations(frame(spark), least=8)) == sorted(brute(docs, 8))


def test_equal_hashes_are_counted_apart():
    h, g = np.array([5, 7, 5, 5, 7], np.uint64), np.array([1, 2, 3, 1, 2], np.uint32)
    got = phrases._summed([(h[:2], g[:2], np.array([10, 20]), np.array([0, 0])), (h[2:], g[2:], np.array([1, 2, 4]), np.array([1, 2, 3]))])
    assert sorted(zip(*[x.tolist() for x in got])) == [(5, 1, 12, 0), (5, 3, 1, 1), (7, 2, 24, 0)]


def test_nulls_empty_tables_and_clashing_names(spark):
    names = "doc_id long, text string, lang string, piece string, times int, n int, phrase string, h string, part string, w string"
    rows = [(k, t, lang, "p", 1, 2, "q", "h", "x", "w") for k, (t, lang) in enumerate([("Red wine", None), ("red  wine", "und"), (None, "en"), ("", None), ("red wine", "en"), ("red wine", "en")])]
    got = rows_of(phrases.collocations(spark.createDataFrame(rows, names), least=2))
    assert got == [("en", 1, "red wine", 2, 2, 2, 4, 1_000_000), ("und", 1, "red wine", 2, 2, 2, 4, 1_000_000)]
    assert rows_of(phrases.collocations(spark.createDataFrame([], DOCS))) == []


def test_counts_beyond_64_bits_of_product(spark):
    big = 1 << 60
    counts = spark.createDataFrame([("en", "a", big + 5), ("en", "b", big + 1), ("en", "a b", big)], "lang string, phrase string, n long")
    row = phrases.best_cuts(counts).first()
    assert row["score"] == 2_000_000 * big // (2 * big + 6)


def test_pieces_are_counted_once(spark):
    docs = spark.createDataFrame([(1, "A b,a  b\na\tb ", "en"), (2, "a b. c", "en")], "doc_id long, text string, lang string")
    assert {tuple(r)[:4] for r in phrases.pieces_of(docs).collect()} == {("en", "a b", 4, 2), ("en", "c", 1, 1)}
