"""Token extraction and prioritised matching of tokens with entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lorebase.operators.contain import either


def entity_names(df: DataFrame, key: str = "id", name: str = "name") -> DataFrame:
    """(name, ord, id): names that occur twice keep the place of the first and the id of the last."""
    return df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("name")).agg(F.min(key).alias("ord"), F.max(key).alias("id"))


def match_tokens(tokens: DataFrame, names: DataFrame, normalise=None, exact: bool = True) -> DataFrame:
    """(token, id): exact name first, then the normalised name, then either holding the other; the first entity wins.

    Exact and normalised matches are equi-joins. Only the distinct tokens left over
    meet the names by containment, each held string by its rarest run.
    """
    distinct = tokens.select("token").where("token is not null and token <> ''").distinct()
    found = []
    left = distinct
    if exact:
        hit = left.join(names, left.token == names.name).select("token", "id")
        found.append(hit)
        left = left.join(hit.select("token"), "token", "left_anti")
        if normalise is not None:
            plain = left.withColumn("plain", normalise(F.col("token")))
            hit = plain.join(names, plain.plain == names.name).select("token", "id")
            found.append(hit)
            left = left.join(hit.select("token"), "token", "left_anti")
    probe = left.withColumn("part", normalise(F.col("token")) if normalise is not None else F.col("token")).where("part <> ''")
    pairs = either(probe.select(F.col("part").alias("x")), names.select(F.col("name").alias("y")))
    held = probe.select("token", F.col("part").alias("x")).join(pairs, "x").join(names.withColumnRenamed("name", "y"), "y")
    found.append(held.groupBy("token").agg(F.min_by("id", "ord").alias("id")))
    out = found[0]
    for f in found[1:]:
        out = out.unionAll(f)
    return out


def edges(df: DataFrame, key: str, tokens: Column, names: DataFrame, out: tuple[str, str], normalise=None, exact: bool = True) -> DataFrame:
    """Distinct (own id, matched id) of rows and the tokens in them."""
    each = df.select(F.col(key).alias(out[0]), F.explode(tokens).alias("token"))
    hit = match_tokens(each, names, normalise, exact)
    return each.join(hit, "token").select(out[0], F.col("id").alias(out[1])).distinct()
