"""URL filter, sharding, pseudonyms, BPE, top-k, language and quality against brute force or round trips."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from public_tokenizers import path as vocabulary
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lorebase.llm import bpe, language_id, pii, quality, sharding, top_k, url_filter
from tests.llm.fixtures import documents, frame, prose

# ---- URLs


def judged(url, listed):
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3 :]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for action, h, p in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[1])):
            best = (action, h + p)
    if best:
        return host, path, best[1], best[0]
    labels = host.rstrip(".").split(".")
    hosts = {".".join(labels[-k:]) for k in range(1, min(6, len(labels)) + 1)} if host else set()
    parts = (path or "/").split("/")
    paths = {path or "/"} | {"/".join(parts[:k]) + "/" for k in range(1, min(4, len(parts) - 1) + 1)}
    return host, path, None, "block" if any(h + p in listed for h in hosts for p in paths) else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/x?y#z", "http://a.example.com/en/1", "http://example.com/en",
    "http://net/es/", "http://x.net/fr/q", "http://x.net/de/q", "http://spam-farm.example.org/a/b/c", "http://www.spam-farm.example.org", "http://notspam-farm.example.org/",
    "http://spam-farm.example.org.evil/", "a://b://c/d", "http://É.com/É", "http://x.org?u=http://spam-farm.example.org/", "http://a.b.c.d.e.f.g.h.spam-farm.example.org./x", "http://xcom/", "ftp://free-bets.example.net#f",
]


@pytest.mark.parametrize("listed", [url_filter.LISTED, (), ("x.org/a/", "x.org/b/c")])
def test_urls(spark, listed):
    urls = URLS + ["http://x.org/a/q", "http://x.org/b/c", "http://x.org/b/cd"] * 3
    rows = [(k, u, "clash", "clash") for k, u in enumerate(urls)] + [(None, URLS[6], "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, key string")
    got = url_filter.filter_urls(df, url_filter.listed_frame(spark, listed)).drop("listed")
    assert Counter(map(tuple, got.collect())) == Counter((r[0], *judged(r[1], set(listed))) for r in rows)
    assert url_filter.filter_urls(df.limit(0), url_filter.listed_frame(spark)).count() == 0


def test_bloom_has_no_false_negative_and_some_selectivity(spark):
    keys = spark.range(3000).select(F.concat(F.lit("h"), F.col("id").cast("string"), F.lit("/")).alias("key"))
    bits = url_filter.bloom_blocks(keys.where("length(key) < 6"), 256)
    asked = keys.withColumns({"block": url_filter._block(F.col("key"), 256), "m": url_filter._mask(F.col("key"))})
    hit = asked.join(bits, "block").where(F.col("word").bitwiseAND(F.col("m")) == F.col("m"))
    assert hit.where("length(key) < 6").count() == keys.where("length(key) < 6").count() and hit.count() < 2500


# ---- shards


def test_feistel_is_a_permutation(spark):
    for n in (1, 2, 3, 17, 1000):
        got = sharding.permuted(spark.range(n).toDF("x"), "x", n).collect()
        assert sorted(r["x"] for r in got) == list(range(n))


def test_shards(spark):
    rows = documents() * 2
    got = sharding.shard_rows(frame(spark, rows)).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shard_rows(frame(spark, rows[::-1]).repartition(5))
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, got))
    assert sharding.shard_rows(frame(spark, [])).count() == 0


# ---- personal data


def test_pseudonyms_keep_format_and_invert():
    r = random.Random(1)
    for _ in range(300):
        digits = "".join(r.choice("0123456789") for _ in range(15))
        card = digits + str(pii.luhn(digits))
        d = f"{r.randint(1900, 2099)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}"
        cases = {
            "card": card, "date": d, "ipv4": ".".join(str(r.randint(0, 255)) for _ in range(4)), "phone": f"+1 ({r.randint(100, 999)}) 555-{r.randint(0, 9999):04d}",
            "email": prose(r, 1).encode("ascii", "ignore").decode().strip("?") + f"x.{r.randint(0, 99)}@mail.example.com", "ssn": f"{r.randint(1, 665):03d}-{r.randint(1, 99):02d}-{r.randint(1, 9999):04d}",
        }
        for kind, v in cases.items():
            out = pii.pseudonym(kind, v, "k")
            assert out is not None and pii.pseudonym(kind, out, "k", back=True) == v
            if kind != "ipv4":
                assert re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", out))) == re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", v)))
        assert pii.luhn(pii.pseudonym("card", card, "k")[:-1]) == int(pii.pseudonym("card", card, "k")[-1])
    iban = "DE89 3704 0044 0532 0130 00"
    assert pii._mod97(pii.pseudonym("iban", iban, "k").replace(" ", "")) == 1 and pii.pseudonym("iban", pii.pseudonym("iban", iban, "k"), "k", back=True) == iban
    assert pii.pseudonym("date", "2021-02-30", "k") is None and pii.pseudonym("ipv4", "256.1.1.1", "k") is None and pii.pseudonym("card", "4111111111111112", "k") is None
    for n in (2, 3, 10, 97):
        assert sorted(pii.permute(x, n, "k") for x in range(n)) == list(range(n))


def test_pseudonyms_in_documents(spark):
    secret = ["ggor.91@mail9.example.com", "+1 (976) 555-9947", "4111111111111111", "10.20.30.40"]
    text = "Write to {} or call {}, card {} from {} on 2020-02-29; order 12345 stays.".format(*secret)
    rows = [r for r in documents()] + [(7000 + k, text, "en", "s", 0, *["x"] * 9) for k in range(2)]
    got = pii.pseudonymise(frame(spark, rows), "k" * 100)
    assert got.columns[: len(frame(spark, rows).columns)] == frame(spark, rows).columns
    out = {r["doc_id"]: r for r in got.collect()}
    assert out[7000]["text"] == out[7001]["text"] and not any(s in out[7000]["text"] for s in secret) and "order 12345 stays" in out[7000]["text"]
    assert (out[7000]["n_email"], out[7000]["n_phone"], out[7000]["n_card"], out[7000]["n_ipv4"], out[7000]["n_date"]) == (1, 1, 1, 1, 1)
    clean = Counter((r[0], r[1]) for r in rows if not r[1] or not re.search(r"[@0-9]", r[1]))
    assert clean - Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter()
    back = pii.pseudonymise(got.select("doc_id", "text"), "k" * 100, back=True)
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter((r[0], r[1]) for r in rows)


# ---- tokens


def test_bpe(spark):
    tok = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    r = random.Random(2)
    odd = "\u00a0\u2003\u3000\u200b\x1c\x1d\x85\t\r\n '’sS'lL\u0301٣Ⅷ²½ᾳǅ\U0001f600\U00010400_-<|>€"
    rows = documents()
    rows += [(8000 + k, "".join(r.choice(odd + "ab1") for _ in range(r.randint(1, 60))), "en", "s", 0, *["x"] * 9) for k in range(200)]
    rows += [(8300, "a <|endoftext|> b<|endoftext|><|endoftext|", "en", "s", 0, *["x"] * 9), (8301, "it's we'll 'ts I'M'll", "en", "s", 0, *["x"] * 9)]
    got = bpe.encode(frame(spark, rows), vocabulary("byte_bpe_50k.json"), outputs=("n_tokens", "ids_sha256", "decoded_sha256", "ids"), max_words=500)
    want = Counter()
    for x in rows:
        ids = tok.encode(x[1] or "", add_special_tokens=False).ids
        decoded = tok.decode(ids, skip_special_tokens=False)
        want[(x[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())] += 1
    assert Counter(map(tuple, got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == want
    back = bpe.decode(got.select("doc_id", "ids"), vocabulary("byte_bpe_50k.json"))
    assert Counter((x["doc_id"], x["decoded"]) for x in back.collect()) == Counter((x[0], x[1] or "") for x in rows)
    assert bpe.encode(frame(spark, []), vocabulary("byte_bpe_50k.json")).count() == 0


# ---- top-k


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(top_k, "SHARD_ROWS", 60)
    monkeypatch.setattr(top_k, "BLOCK_ROWS", 7)
    monkeypatch.setattr(top_k, "LEAF_ROWS", 8)
    monkeypatch.setattr(top_k, "PIVOT_ROWS", 25)
    rng = np.random.default_rng(4)
    rows = [(k, [float(x) for x in rng.normal(size=6)]) for k in range(300)]
    rows += [(300, rows[0][1]), (20, rows[0][1]), (301, None), (302, [1.0, None]), (303, [float("nan")] * 6), (304, [float("inf")] * 6), (305, []), (320, [9.0] * 8), (None, [5.0] * 6)]
    rows += [(400, [0.0] * 6)] * 3 + [(420, [1e13, -1e13, 1.0])]
    got = top_k.top_k(spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, shard string, uid long")).collect()
    ok = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    want = Counter()
    for k, (i, q) in enumerate(ok):
        if i is not None and i % 20 == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v)), (j is None, j or 0)) for m, (j, v) in enumerate(ok) if m != k)[:20]
            want.update((i, n, None if j[0] else j[1], -x) for n, (x, j) in enumerate(s, 1))
    assert Counter(map(tuple, got)) == want
    assert top_k.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# ---- languages and quality


def test_language(spark):
    base = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    model = language_id.train(docs.where(~language_id.held_out()))
    found = language_id.identify(docs, *model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.98 * len(found) and all(0 <= r["score"] <= 1 for r in found)
    got = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.identify(frame(spark), *model).collect()}
    for r in documents():
        if not any(c.isalpha() for c in r[1] or ""):
            assert (r[0], "und", 0.0) in got
    assert all(r["lang_pred"] == "und" for r in language_id.identify(frame(spark), *language_id.train(frame(spark, []))).collect())
    # the same sums, one n-gram at a time
    text = "Éa the on."
    v, c = language_id.letter_vectors().astype(int), [0, *language_id.letter_classes()[[ord(x) for x in text]].tolist(), 0]
    c = [x for k, x in enumerate(c) if k == 0 or x or c[k - 1]]
    total = sum(np.roll(v[a], 2) * np.roll(v[b], 1) * v[d] for a, b, d in zip(c, c[1:], c[2:]))
    import pyarrow as pa

    assert np.allclose(language_id.bundles(pa.array([text, None]))[0], total / np.linalg.norm(total), atol=1e-5)


def test_quality(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in found)
    assert len(found) > 200 and right >= 0.97 * len(found)
    good = [r for r in found if r["quality"] == 1]
    assert sum(r["predicted"] for r in good) >= 0.99 * len(good)


def test_quality_cases(spark):
    rows = documents()
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.classify(frame(spark), none)
    assert got.count() == len(rows) and got.where("score <> 0.5").count() == 0
    ones = spark.createDataFrame([(r[0], 1, 0) for r in rows], "doc_id long, quality int, toxic int")
    assert quality.classify(frame(spark), ones).where("predicted <> 1").count() == 0
    mixed = spark.createDataFrame([(r[0], k % 2, None) for k, r in enumerate(rows)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(frame(spark), mixed)
    assert kept.columns == frame(spark).columns and kept.count() <= len(rows)
    assert quality.classify(frame(spark, []), mixed).count() == 0


def test_scores_are_sparse_dot_products():
    import pyarrow as pa

    texts = ["a b a", "", None, "B!! B!!"]
    w = np.random.default_rng(0).normal(size=quality.DIM)
    got = quality.scores(pa.array(texts, pa.string()), w, 0.25)
    for k, t in enumerate(texts):
        data = np.frombuffer((t or "").encode(), np.uint8)
        places, _ = quality.features(data, np.array([0, len(data)]))
        c = Counter(places.tolist())
        dot = sum(w[p] * n for p, n in c.items()) / (math.sqrt(sum(n * n for n in c.values())) or 1)
        assert math.isclose(got[k], 1 / (1 + math.exp(-dot - 0.25)), rel_tol=1e-9)


def test_top_k_of_clusters_and_a_frequent_vector(spark, monkeypatch):
    for name, n in {"SHARD_ROWS": 40, "BLOCK_ROWS": 5, "LEAF_ROWS": 8, "PIVOT_ROWS": 30, "ASK_ROWS": 7}.items():
        monkeypatch.setattr(top_k, name, n)
    rng = np.random.default_rng(9)
    v = np.round(rng.normal(size=(6, 5))[rng.integers(0, 6, 400)] * 3 + rng.normal(size=(400, 5)) * 0.05, 2)
    v[::3] = v[0]
    got = top_k.top_k(spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<double>")).collect()
    x = np.floor(64 * v).astype(int)
    want = {(q, n, int(j), int(x[q] @ x[j])) for q in range(0, 400, 20) for n, j in enumerate([j for j in np.lexsort((range(400), -(x @ x[q]))) if j != q][:20], 1)}
    assert {tuple(r) for r in got} == want and len(got) == 400


def test_search_visits_only_nodes_that_can_reach_the_kth_score():
    x = np.array([[100, 0]] * 200 + [[-100, 0]] * 200)
    tree = top_k.build_tree(np.arange(400), np.arange(400), x)
    tree["v"][tree["v"][:, 0] < 0] = 101  # would come first, were its leaves read
    ids, own, scores = top_k.search(tree, np.array([1000]), np.array([[50, 0]]), np.array([-top_k._NO_ID]), 3)
    assert ids.tolist() == [[0, 1, 2]] and scores.tolist() == [[5000] * 3]


def test_top_k_of_large_components(spark):
    rows = [(20, [1.0, 1.0]), (1, [5e6, 5e6]), (2, [6e6, 6e6]), (3, [-1e15, 0.0])]
    got = top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(2, 49152000000), (1, 40960000000), (3, -4096000000000000000)]
    for bad in ([-3e15, 0.0], [1e30, 0.0]):
        with pytest.raises(Exception, match="64 bits"):
            top_k.top_k(spark.createDataFrame([*rows, (4, bad)], "vec_id long, embedding array<double>")).collect()
