"""Checks made from the declared catalogue: rules of rows, keys and references of all tables.

All rules of a table's rows are counted in one aggregate. Each key is found doubled by its own
columns, so that no task holds names of tables or keys as text, and all references are held
against one index of ids in one anti join, however many tables there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lorebase.sources import catalog

Database = dict[str, DataFrame]


def row_rules(name: str, df: DataFrame) -> dict[str, Column]:
    """rule -> condition that is true for rows that break it; only columns that ``df`` has."""
    spec = catalog.table(name)
    has = set(df.columns)
    rules = {f"not_null:{c}": F.col(c).isNull() for c in spec.required if c in has}
    rules |= {f"enum:{c}": F.col(c).isNotNull() & ~F.col(c).isin(*v) for c, v in spec.enums.items() if c in has}
    rules |= {f"range:{c}": F.col(c).isNotNull() & ~F.col(c).between(*v) for c, v in spec.ranges.items() if c in has}
    rules |= {f"pair:{a},{b}": F.col(a).isNull() != F.col(b).isNull() for a, b in spec.pairs if a in has and b in has}
    return rules


def row_violations(db: Database) -> DataFrame:
    """(table, rule, n) of every rule of rows, also where n is 0."""
    parts = []
    for name, df in db.items():
        rules = row_rules(name, df) if name in catalog.TABLES else {}
        if rules:
            row = df.agg(*[F.count_if(c).alias(f"r{k}") for k, c in enumerate(rules.values())])
            each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"r{k}").alias("n")) for k, r in enumerate(rules)]))
            parts.append(row.select(each.alias("x")).select(F.lit(name).alias("table"), "x.rule", "x.n"))
    return _all(db, parts)


def _all(db: Database, parts: list[DataFrame]) -> DataFrame:
    if parts:
        return reduce(DataFrame.unionByName, parts)
    return next(iter(db.values())).sparkSession.createDataFrame([], "table string, rule string, n long")


def doubled_keys(db: Database) -> DataFrame:
    """(table, rule, key, n): values of primary and unique keys that more than one row has; keys with a null are not judged."""
    parts = []
    for name, df in db.items():
        spec = catalog.TABLES.get(name)
        for key in (spec.key, *((u,) for u in spec.unique)) if spec else ():
            if set(key) <= set(df.columns):
                rows = df.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in key]))
                doubled = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                value = F.concat_ws(",", *[F.col(c).cast("string") for c in key])
                parts.append(doubled.select(F.lit(name).alias("table"), F.lit("key:" + ",".join(key)).alias("rule"), value.alias("key"), "n"))
    return _all(db, parts) if parts else _all(db, []).select("table", "rule", F.lit("").alias("key"), "n")


def broken_references(db: Database) -> DataFrame:
    """(table, rule, key): references of all tables, by declaration, that lead nowhere; parents that are not there are passed over."""
    refs, parents = [], set()
    for name, df in db.items():
        spec = catalog.TABLES.get(name)
        for column, parent in (spec.references if spec else {}).items():
            if parent in db and column in df.columns:
                parents.add(parent)
                rows = df.where(F.col(column).isNotNull())
                refs.append(rows.select(F.lit(name).alias("table"), F.lit(f"reference:{column}").alias("rule"), F.lit(parent).alias("parent"), F.col(column).cast("long").alias("key")))
    if not refs:
        return _all(db, []).select("table", "rule", F.col("n").alias("key"))
    ids = reduce(DataFrame.unionAll, [db[p].select(F.lit(p).alias("parent"), F.col("id").cast("long").alias("key")) for p in sorted(parents)])
    return reduce(DataFrame.unionAll, refs).join(ids, ["parent", "key"], "left_anti").select("table", "rule", "key")


def violations(db: Database) -> DataFrame:
    """(table, rule, n) of every rule that is broken: rows, keys (doubled values) and references."""
    count = lambda df: df.groupBy("table", "rule").agg(F.count(F.lit(1)).alias("n"))
    return row_violations(db).where("n > 0").unionAll(count(doubled_keys(db))).unionAll(count(broken_references(db)))


def declared(db: Database) -> DataFrame:
    """``violations`` as a gate of a snapshot."""
    return violations(db)
