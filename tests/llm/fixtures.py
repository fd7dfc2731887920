"""Small tables with the awkward cases, as Python rows and as frames."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ("n", "s", "key", "node", "score", "words", "uid", "__hash", "c0")],
    ]
)

_SYLLABLES = ("the", "on", "re", "ti", "an", "éa", "sch", "Qu", "ño", "ba", "lo", "mi")


def prose(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n))


def documents() -> list[tuple]:
    r = random.Random(5)
    rows: list[tuple] = []

    def put(text, doc_id=None, lang="en", source="s0"):
        rows.append((len(rows) + 1 if doc_id is None else doc_id, text, lang, source, len(text or "")))

    base = [prose(r, n) for n in (3, 5, 6, 8, 12, 30, 60, 120, 400)]
    for k, b in enumerate(base):
        put(b, source=f"s{k % 3}")
        words = b.split(" ")
        for change in (1, 1, 2, 4):
            w = list(words)
            for _ in range(min(change, len(w) // 8)):
                w[r.randrange(len(w))] = prose(r, 1)
            put(" ".join(w), source=f"s{(k + change) % 4}")
    passage = prose(r, 60)
    for k in range(25):  # a passage that many share, and a chain of near copies
        put(prose(r, r.randint(2, 60)) + " " + passage + "\n" + prose(r, r.randint(2, 60)))
    chain = prose(r, 80).split(" ")
    for k in range(12):
        chain[(7 * k) % 80] = prose(r, 1)
        put("\t".join(chain))
    for _ in range(30):
        put(prose(r, r.randint(1, 25)))
    put(None)
    put("")
    put(" \t\n ")
    put("\x1c\x85  ")
    put("!!! ... ---")
    put("0123 4567")
    put("ÀÉÎ ẞß İı Ⅷ \U0001d400 \U0001f600 ﬁ K ſecret=abcdefghijklmnop")
    put(" ".join(["word"] * 50))
    put(prose(r, 20_000))
    put("a" * 5000)
    for t in (base[5], base[5].upper(), base[8], base[8] + " x"):
        put(t)
    put(base[6], doc_id=1)  # an id that occurs twice, with another text
    rows.append(rows[-1])
    rows.append((None, base[7], None, None, None))
    rows.append((None, None, None, None, None))
    rows.append((-3, base[7] + " tail", "fr", "s1", 0))
    return [(*row, *[f"x{k}" for k in range(9)]) for row in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, DOCS).repartition(3)
