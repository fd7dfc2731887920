"""Containment by rarest runs: all pairs and no more, and few comparisons beside one very common beginning."""

import random

from pyspark.sql import functions as F

from lorebase.operators import contain


def strings(spark, texts, name):
    return spark.createDataFrame([(x,) for x in texts], f"{name} string")


def test_all_pairs(spark):
    r = random.Random(1)
    word = lambda n: "".join(r.choice("ab甲é ") for _ in range(n))
    xs = [word(r.randint(0, 7)) for _ in range(80)] + [None, "", "a"]
    ys = [word(r.randint(0, 14)) for _ in range(60)] + xs[:10] + [None]
    want = {(x, y) for x in xs if x for y in ys if y and x in y}
    got = contain.contained(strings(spark, xs, "x"), strings(spark, ys, "y")).collect()
    assert {tuple(p) for p in got} == want and len(got) == len(want)
    both = want | {(x, y) for x in xs if x for y in ys if y and y in x}
    assert {tuple(p) for p in contain.either(strings(spark, xs, "x"), strings(spark, ys, "y")).collect()} == both
    assert contain.contained(strings(spark, ["", None], "x"), strings(spark, ys, "y")).count() == 0


def test_a_common_beginning_pairs_nothing(spark, monkeypatch):
    n = 400
    xs, ys = [f"formula of {k:05d}" for k in range(n)], [f"formula of {k:05d}, old" for k in range(n)] + [f"formula of x{k}" for k in range(n)]
    compared = spark.sparkContext.accumulator(0)
    real = F.contains

    @F.udf("boolean")
    def count(hit):
        compared.add(1)
        return hit

    monkeypatch.setattr(contain.F, "contains", lambda y, x: count(real(y, x)))
    got = contain.contained(strings(spark, xs, "x"), strings(spark, ys, "y")).collect()
    assert len(got) == n and compared.value < 20 * n
