"""Inserts, updates and patches as functions from tables to tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lorebase.functions.text import blank_to_null


def insert_ignore(old: DataFrame, new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first writer of a key stays; rows whose key is there already are passed over."""
    w = Window.partitionBy(*key).orderBy(*order)
    first = new.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    return old.unionByName(first.join(old.select(*key), key, "left_anti"), allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, key: list[str], mutable: list[str]) -> DataFrame:
    """Known keys take the new values of the mutable columns, new keys are added."""
    right = new.select(*[F.col(c).alias(f"__{c}") if c not in key else F.col(c) for c in new.columns])
    both = old.withColumn("__old", F.lit(True)).join(right, key, "full")
    pick = lambda c: F.when(F.col("__old").isNull() | F.lit(c in mutable), F.coalesce(F.col(f"__{c}"), F.col(c))).otherwise(F.col(c)).alias(c)
    return both.select(*[F.col(c) if c in key or c not in new.columns else pick(c) for c in old.columns])


def patch(old: DataFrame, new: DataFrame, key: str, columns: list[str], blank_is_missing: bool = True) -> DataFrame:
    """Values that are there replace old ones; missing ones leave them."""
    right = new.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    value = lambda c: blank_to_null(F.col(f"__{c}"), False) if blank_is_missing else F.col(f"__{c}")
    out = old.join(right, key, "left").withColumns({c: F.coalesce(value(c), F.col(c)) for c in columns})
    return out.select(*old.columns)


def delete(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids, key, "left_anti")


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in df.columns})


def append_with_ids(old: DataFrame, new: DataFrame, order: list[str], key: str = "id") -> DataFrame:
    """New rows numbered on from the greatest id, in a stable order.

    Numbers come from the order within ranges of it and the ranges' running counts,
    so no task sorts all rows.
    """
    from lorebase.sources.tables import materialise

    top = old.agg(F.coalesce(F.max(key), F.lit(0)).alias("m")).first()["m"]
    dealt = new.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    dealt = materialise(dealt.withColumn("__part", F.shiftright("__at", 33)).withColumn("__at", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1).cast("long"))), "numbered")
    sizes = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    numbered = dealt.join(F.broadcast(starts), "__part").withColumn(key, F.col("__start") + F.col("__at") + F.lit(top + 1).cast("long"))
    return old.unionByName(numbered.drop("__part", "__at", "__start"), allowMissingColumns=True)


def differences(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Keys on one side only, with the side."""
    left = a.select(*key).distinct()
    right = b.select(*key).distinct()
    return left.join(right, key, "left_anti").withColumn("side", F.lit("before")).unionByName(right.join(left, key, "left_anti").withColumn("side", F.lit("after")))


def all_of(flags: list[Column]) -> Column:
    return reduce(Column.__and__, flags)
