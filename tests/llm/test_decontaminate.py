import hashlib
import random
import re
from collections import Counter

from lorebase.llm import decontaminate
from tests.llm.fixtures import documents, frame, prose


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_force(rows, items):
    out = []
    for r in rows:
        w = words(r[1])
        hit, found = set(), []
        for item_id, text in items:
            v = words(text)
            n = min(10, len(v))
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            at = [i for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows] if n else []
            hit |= {i + k for i in at for k in range(n)}
            found += [str(item_id)] if at else []
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((r[0], len(w), len(hit), len(found), ids, bool(hit)))
    return Counter(out)


def cases():
    r = random.Random(3)
    rows = documents()
    items = []
    for k in range(20):
        src = words(rows[r.randrange(len(rows))][1]) or ["x"]
        a = r.randrange(len(src))
        items.append((k, " ".join(src[a : a + r.choice((3, 9, 10, 11, 14, 25))])))
    items += [(20, None), (21, ""), (22, "..."), (23, "word"), (24, items[3][1]), (3, items[3][1]), (25, "word " * 12), (26, prose(r, 30))]
    return rows, items


def test_against_brute_force(spark):
    rows, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(frame(spark), bench)
    assert Counter(map(tuple, got.collect())) == brute_force(rows, items)


def test_blocks_of_the_benchmark(spark, monkeypatch):
    rows, items = cases()
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 90)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(frame(spark), bench)
    assert Counter(map(tuple, got.collect())) == brute_force(rows, items)


def test_keep_clean_and_empty(spark):
    rows, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.keep_clean(frame(spark), bench)
    assert kept.columns == frame(spark).columns
    clean = Counter(k[0] for k, n in brute_force(rows, items).items() if not k[5] for _ in range(n))
    assert Counter(r["doc_id"] for r in kept.collect()) == clean
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(frame(spark), none).where("contaminated").count() == 0
    assert decontaminate.decontaminate(frame(spark, []), bench).count() == 0


def test_long_texts_and_repeats_take_no_square(spark):
    """A document equal to a long item, and a long repetition: rows of hits follow the words."""
    r = random.Random(9)
    long = prose(r, 6000)
    rows = [(1, long), (2, "echo " * 900), (3, "other words only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(1, long), (2, "echo " * 700), (3, "echo"), (4, "echo " * 9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    prints = decontaminate.prints_of(decontaminate.items_of(bench).select("item", "words"), [1, 9])
    assert prints.count() < 6000  # the repetition's fingerprints lie in few different words
    found, _ = decontaminate.hits(docs, decontaminate.items_of(bench))
    n = found.groupBy("doc_id").count().collect()
    assert {x["doc_id"]: x["count"] for x in n}[1] < 4 * 6000 and {x["doc_id"]: x["count"] for x in n}[2] < 100 * 900
    got = {x["doc_id"]: x for x in decontaminate.decontaminate(docs, bench).collect()}
    assert got[1]["n_hit"] == len(words(long)) and got[2]["n_hit"] == 900 and got[2]["n_items"] == 3 and got[3]["n_hit"] == 0


def test_equal_documents_and_items_are_not_paired(spark):
    r = random.Random(10)
    text = prose(r, 12)
    docs = spark.createDataFrame([(k, text) for k in range(400)] + [(1000, prose(r, 12))], "doc_id long, text string")
    bench = spark.createDataFrame([(k, text) for k in range(400)], "item_id long, text string")
    found, _ = decontaminate.hits(docs, decontaminate.items_of(bench))
    assert found.select("doc_id", "item").distinct().count() == 400 and found.count() <= 400 * 12
    got = decontaminate.decontaminate(docs, bench).where("contaminated").collect()
    ids = hashlib.sha256(",".join(sorted(map(str, range(400)))).encode()).hexdigest()
    assert len(got) == 400 and {(x["n_items"], x["items_sha256"]) for x in got} == {(400, ids)}
