"""Training by plain loops over single values: FTRL weights, language prototypes and their argmax."""

import math
import random

import numpy as np
import pyarrow as pa

from lorebase.llm import language_id, quality
from tests.llm.fixtures import frame, prose


def test_ftrl_one_weight_at_a_time():
    rng = np.random.default_rng(3)
    examples = [(np.sort(rng.choice(40, rng.integers(1, 9), replace=False)), None, int(k % 3 == 0)) for k in range(60)]
    examples = [(at, rng.random(len(at)), y) for at, _, y in examples] + [(np.zeros(0, int), np.zeros(0), 1)]
    z, n, bias, bias_n = {}, {}, 0.0, 0.0

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality.L1:
            return 0.0
        return (math.copysign(quality.L1, z[i]) - z[i]) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for at, x, y in examples:
            before = [weight(i) for i in at]
            error = 1 / (1 + math.exp(-sum(w * v for w, v in zip(before, x)) - bias)) - y
            for i, w, v in zip(at, before, x):
                g, old = error * v, n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / quality.ALPHA * w
                n[i] = old + g * g
            bias_n += error * error
            bias -= quality.ALPHA * error / (quality.BETA + math.sqrt(bias_n))
    w, b = quality.ftrl(examples)
    assert np.allclose(w[:40], [weight(i) for i in range(40)], rtol=1e-9, atol=1e-12) and not w[40:].any() and math.isclose(b, bias, rel_tol=1e-9)


def test_prototypes_and_nearest_language(spark):
    r = random.Random(6)
    texts = [(k, prose(r, 12) if k % 3 else " ".join("xyzzy"[r.randrange(5)] * 2 for _ in range(20)), ("en", "fr", "xx")[k % 3 - 1]) for k in range(60)]
    texts += [(60, None, "en"), (61, "no language", None), (62, "123", "en"), (63, texts[0][1], texts[0][2])]
    rows = [(*t, "s", 0, *["x"] * 9) for t in texts]
    langs, protos = language_id.train(frame(spark, rows))
    vector = lambda t: language_id.bundles(pa.array([t]))[0].astype(float)
    unit = lambda v: v / np.linalg.norm(v)
    known = sorted({lang for _, t, lang in texts if t is not None and lang is not None})
    means = np.array([unit(sum(vector(t) for _, t, lang in texts if t is not None and lang == name)) for name in known])
    want = np.array([unit(m - means.mean(0)) for m in means])
    assert langs == known and np.allclose(protos, want, atol=1e-5)
    got = {x["doc_id"]: (x["lang_pred"], x["score"]) for x in language_id.identify(frame(spark, rows), langs, protos).collect()}
    for k, t, _ in texts:
        if not any(c.isalpha() for c in t or ""):
            assert got[k] == ("und", 0.0)
            continue
        cosines = want @ vector(t)
        assert abs(got[k][1] - (1 + cosines.max()) / 2) < 1e-5 and cosines[known.index(got[k][0])] > cosines.max() - 1e-5


def test_a_tie_goes_to_the_name_that_sorts_first():
    one = language_id.bundles(pa.array(["the same letters"]))[0]
    assert language_id.judge(pa.array(["the same letters"]), ["aa", "bb"], np.array([one, one]))[0] == ["aa"]
