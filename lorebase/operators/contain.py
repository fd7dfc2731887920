"""Which strings are inside which others, by the rarest run of the inner one.

A string of RUN characters or more gives its runs of RUN characters, a shorter one itself; the
outer strings give their runs of those lengths that occur. A table of how many outer strings hold
each run picks, for every inner string all of whose runs occur, the rarest, and only by that
one do the two meet and are compared. So a run that nearly all strings have pairs nothing,
unless an inner string has no other. The distinct strings of both sides are written once, as
each side is read several times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lorebase.sources.tables import materialise

#: Characters of a run.
RUN = 4


def runs(c: Column, n: int | Column) -> Column:
    """Distinct runs of n characters; none of a shorter string."""
    count = F.char_length(c) - n + 1
    each = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.substring(c, i, n if isinstance(n, Column) else F.lit(n)))
    return F.array_distinct(F.when(count >= 1, each).otherwise(F.array().cast("array<string>")))


def _strings(df: DataFrame, name: str) -> DataFrame:
    return materialise(df.select(name).where(F.col(name) != "").distinct(), "strings")


def contained(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """(x, y): distinct strings x of ``inner`` and y of ``outer``, columns of these names, where y holds x; empty ones hold and are held by nothing."""
    return _contained(_strings(inner, "x"), _strings(outer, "y"))


def _contained(x: DataFrame, y: DataFrame) -> DataFrame:
    size = F.least(F.char_length("x"), F.lit(RUN))
    lengths = sorted(r[0] for r in x.select(size.alias("n")).distinct().collect())  # RUN at most
    if not lengths:
        return x.select("x", F.col("x").alias("y")).limit(0)
    x_runs = x.select("x", runs(F.col("x"), size).alias("runs"))
    x_runs = x_runs.select("x", F.size("runs").alias("n_runs"), F.explode("runs").alias("run"))
    y_runs = y.select("y", F.explode(F.flatten(F.array(*[runs(F.col("y"), n) for n in lengths]))).alias("run"))
    counts = y_runs.join(x_runs.select("run").distinct(), "run", "left_semi").groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    found = x_runs.join(counts, "run").groupBy("x").agg(F.min(F.struct("n", "run")).alias("best"), F.count(F.lit(1)).alias("met"), F.first("n_runs").alias("n_runs"))
    rarest = found.where("met = n_runs").select("x", F.col("best.run").alias("run"))
    return rarest.join(y_runs, "run").where(F.contains("y", "x")).select("x", "y")


def either(a: DataFrame, b: DataFrame) -> DataFrame:
    """(x, y) of distinct strings of ``a`` (column x) and ``b`` (column y) where one holds the other."""
    x, y = _strings(a, "x"), _strings(b, "y")
    back = _contained(y.toDF("x"), x.toDF("y"))
    return _contained(x, y).unionAll(back.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()
