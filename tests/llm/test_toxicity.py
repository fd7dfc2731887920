"""The kernel against plain enumeration, the collapsed weights against kernel sums, planted insults, awkward rows."""

import random
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from lorebase.llm import toxicity
from tests.llm.fixtures import DOCS, frame, prose


def kernel(a: str, b: str) -> float:
    """Common subsequences of four signs, gaps weighed, by enumeration over two words of different letters."""

    def values(w):
        w, out = "^" + w, {}
        for i in range(len(w)):
            for x, y, z in combinations(range(i + 1, min(len(w), i + 4 + toxicity.MAX_GAP)), 3):
                key = w[i] + w[x] + w[y] + w[z]
                out[key] = out.get(key, 0.0) + toxicity.GAP ** (z - i - 3)
        return out

    u, v = values(a), values(b)
    return sum(u[k] * v[k] for k in u.keys() & v.keys()) / np.sqrt(sum(x * x for x in u.values()) * sum(x * x for x in v.values()))


def by_places(a: str, b: str) -> float:
    rows = []
    for w in (a, b):
        _, place, value = toxicity.strings([w]).sparse()
        x = np.zeros(toxicity.DIM)
        np.add.at(x, place, value)
        rows.append(x)
    return float(rows[0] @ rows[1])


def test_kernel_by_enumeration():
    for a, b in (("stupid", "stupid"), ("stupid", "stuxpid"), ("clown", "clwn"), ("moran", "marno"), ("worthles", "wortheld"), ("abcd", "efgh")):
        assert abs(by_places(a, b) - kernel(a, b)) < 1e-6
    assert by_places("stupid", "stuxpid") > 0.4 > by_places("stupid", "studio")


def test_words_of_texts():
    s = toxicity.strings(["An i.d.i-o.t, and i d i o t", "", "ÉtÉ été", "a b", "a", "b"])
    words = [toxicity._of_signs([w]).texts(np.array([0]))[0] for w in s.texts(np.arange(len(s.starts)))]
    assert words == s.texts(np.arange(len(s.starts)))
    plain = toxicity.strings(["an", "idiot", "and", "idiot", "été", "été", "ab", "a", "b"])
    assert words == plain.texts(np.arange(9)) and s.row.tolist() == [0, 0, 0, 0, 2, 2, 3, 4, 5]


def test_one_weight_a_subsequence_equals_all_landmarks():
    marks = [w.encode() for w in ("stupid", "clown", "reading", "house")]
    signs = [toxicity.strings([m.decode()]).texts(np.array([0]))[0] for m in marks]
    y = np.array([1.0, 1.0, -1.0, -1.0])
    machine = toxicity.nystroem(signs, y, np.ones(4), signs)
    gram = np.array([[by_places(a.decode(), b.decode()) for b in marks] for a in marks])
    # solve the same machine in its dual space: f = gram @ alpha + bias
    alpha = np.linalg.lstsq(gram, machine.margins(toxicity.strings([m.decode() for m in marks])) - machine.bias, rcond=None)[0]
    for other in ("stuupid", "clowns", "housing", "idea"):
        want = sum(a * by_places(m.decode(), other) for a, m in zip(alpha, marks)) + machine.bias
        assert abs(float(machine.margins(toxicity.strings([other]))[0]) - want) < 1e-4
    assert (np.sign(machine.margins(toxicity.strings([m.decode() for m in marks]))) == y).all()


def test_last_step_by_plain_descent():
    r = np.random.default_rng(1)
    x = np.column_stack((r.normal(size=(200, 2)), np.ones(200)))
    y = (x @ [1.5, -2.0, 0.3] + r.normal(size=200) > 0).astype(float)
    w = np.zeros(3)
    for _ in range(20_000):
        w += 0.01 * (x.T @ (y - 1 / (1 + np.exp(-x @ w))) - 0.1 * w)
    assert np.allclose(toxicity.logistic(x, y), w, atol=1e-6)


def planted(n=400):
    r = random.Random(11)
    insults = ("blockhead", "numskull", "twerp", "dimwit")
    docs, labels = [], []
    for k in range(n):
        words = prose(r, r.randint(30, 90)).split(" ")
        if k % 4 == 0:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(insults))
        docs.append((k, ". ".join(" ".join(words[i : i + 12]) for i in range(0, len(words), 12)), "en", "s", 0, *["x"] * 9))
        labels.append((k, 1, int(k % 4 == 0)))
    return docs, labels


def test_planted_insults_and_awkward_rows(spark):
    docs, labels = planted()
    extra = [(1000, None), (1001, ""), (1002, "you nuumskull, you d.i.m.w.i.t and t w e r p"), (1003, docs[1][1] * 300), (None, docs[0][1]), (1004, docs[0][1]), (1004, docs[0][1])]
    rows = docs + [(i, t, None, None, None, *["x"] * 9) for i, t in extra]
    marks = spark.createDataFrame([*labels, (0, 1, 1), (1, 1, 1), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.classify(frame(spark, rows), marks).collect()
    assert len(out) == len(rows) and set(out[0].asDict()) == {"doc_id", "held_out", "score", "predicted"}
    got = {r["doc_id"]: r for r in out}
    for k, *_ in docs:
        assert got[k]["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) and got[k]["predicted"] == int(k % 4 == 0) == int(got[k]["score"] >= 0.7)
    assert [got[k]["predicted"] for k in (1000, 1001, 1002, 1003, 1004)] == [0, 0, 1, 0, 1]
    assert got[None]["score"] == got[1004]["score"] == got[0]["score"] and got[None]["held_out"] is False
    # nothing is learned from what is held out
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    again = toxicity.classify(frame(spark, rows), spark.createDataFrame(flipped + [(0, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int"))
    free = {k for k, *_ in docs if k not in (1,)}
    now = {r["doc_id"]: r["predicted"] for r in again.collect()}
    assert all(now[k] == got[k]["predicted"] for k in free)


def test_one_label_or_none(spark):
    docs, labels = planted(8)
    one = toxicity.classify(frame(spark, docs), spark.createDataFrame([(i, 1, 1) for i, *_ in labels], "doc_id long, quality int, toxic int")).collect()
    assert {r["predicted"] for r in one} == {1}
    none = toxicity.classify(frame(spark, docs), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert {r["predicted"] for r in none} == {0} and len(none) == 8
    assert toxicity.classify(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")).count() == 0


def test_extra_columns_stay(spark):
    docs, labels = planted(40)
    model = toxicity.train(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    out = toxicity.score(frame(spark, docs), model)
    assert out.columns == [f.name for f in DOCS] + ["score"] and out.count() == 40


def test_held_out_third_of_the_tables(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    truth = dict(zip(*[pq.read_table(f"{base}/labels.parquet").column(c).to_pylist() for c in ("doc_id", "toxic")]))
    rows = [r for r in toxicity.classify(docs, labels).where("held_out").collect() if r["doc_id"] in truth]
    hit = sum(r["predicted"] for r in rows if truth[r["doc_id"]])
    assert hit >= 0.85 * sum(truth[r["doc_id"]] for r in rows) and sum(r["predicted"] for r in rows if not truth[r["doc_id"]]) <= 0.005 * len(rows)
