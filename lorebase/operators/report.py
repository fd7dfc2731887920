"""Merge and cleanup plans with their risks, as nested DataFrames; text forms for bounded results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lorebase.functions.text import blank_to_null
from lorebase.operators import cleanup, resolve

# Fields compared in reports, and those of medical weight.
COMPARED = (
    "source_book", "chapter", "alias", "composition", "dosage", "indication",
    "six_channel", "syndrome", "differentiation", "contraindication", "commentary",
)
NOT_MEDICAL = ("source_book", "chapter")

Database = dict[str, DataFrame]
Refs = list[tuple[str, str]]


def relation_counts(db: Database, refs: Refs, ids: DataFrame) -> DataFrame:
    """(id, edge, n) for all ids of one column ``id`` and all references to them."""
    parts = [db[t].select(F.col(fk).alias("id"), F.lit(t).alias("edge")) for t, fk in refs if t in db]
    return reduce(DataFrame.unionAll, parts).join(ids.select("id").distinct(), "id", "left_semi").groupBy("id", "edge").agg(F.count(F.lit(1)).alias("n"))


def conflicts(df: DataFrame, groups: DataFrame, fields: tuple[str, ...] = COMPARED) -> DataFrame:
    """(name, canonical_id, field, canonical, value, ids, medical): one row for each distinct value that differs."""
    present = [f for f in fields if f in df.columns]
    values = resolve.unpivoted(df, present).join(groups, "id")
    own = values.where("id = canonical_id").select("canonical_id", "field", F.col("value").alias("canonical"))
    others = values.where("id <> canonical_id and value is not null").groupBy("name", "canonical_id", "field", "value").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    many = others.groupBy("canonical_id", "field").agg(F.count(F.lit(1)).alias("kinds"))
    both = others.join(own, ["canonical_id", "field"]).join(many, ["canonical_id", "field"])
    differ = both.where("(canonical is not null and canonical <> value) or (canonical is null and kinds > 1)")
    return differ.select("name", "canonical_id", "field", "canonical", "value", "ids", (~F.col("field").isin(*NOT_MEDICAL)).alias("medical"))


def merge_plan(db: Database, refs: Refs, table: str = "formulas") -> DataFrame:
    """One row a group: canonical id, all rows, conflicts, relation counts, and the high-risk flag of any row."""
    df = db[table]
    groups = resolve.canonical_rows(df)
    rows = df.drop("name").join(groups, "id").groupBy("name", "canonical_id").agg(F.array_sort(F.collect_list(F.struct("id", *[c for c in df.columns if c not in ("id", "name")]))).alias("rows"))
    found = conflicts(df, groups).groupBy("canonical_id").agg(F.array_sort(F.collect_list(F.struct("field", "value", "canonical", "ids", "medical"))).alias("conflicts"))
    counts = relation_counts(db, refs, groups).join(groups, "id").groupBy("canonical_id").agg(F.array_sort(F.collect_list(F.struct("id", "edge", "n"))).alias("relations"))
    out = rows.join(found, "canonical_id", "left").join(counts, "canonical_id", "left")
    if "is_high_risk" in df.columns:
        out = out.withColumn("is_high_risk", F.array_max(F.col("rows.is_high_risk")))
    return out.withColumn("n_removed", F.size("rows") - 1)


def risk_report(db: Database, refs: Refs, table: str = "formulas", edge: str = "formula_herbs", fk: str = "formula_id", other: str = "herb_id", cases: str = "case_formulas") -> DataFrame:
    """(name, canonical_id, risk, n_medical, n_other, herbs_consistent, case_links, moved) of each group.

    Sets of partners are compared between the rows that have any.
    """
    groups = resolve.canonical_rows(db[table])
    found = conflicts(db[table], groups).groupBy("canonical_id").agg(F.count(F.when(F.col("medical"), 1)).alias("n_medical"), F.count(F.when(~F.col("medical"), 1)).alias("n_other"))
    same = resolve.consistent_sets(db[edge], fk, other, groups).withColumnRenamed("same", "herbs_consistent")
    counts = relation_counts(db, refs, groups).join(groups.where("id <> canonical_id"), "id")
    links = counts.groupBy("canonical_id").agg(F.sum("n").alias("moved"), F.sum(F.when(F.col("edge") == cases, F.col("n")).otherwise(0)).alias("case_links"))
    out = groups.select("name", "canonical_id").distinct().join(found, "canonical_id", "left").join(same, "canonical_id", "left").join(links, "canonical_id", "left")
    out = out.fillna(0, ["n_medical", "n_other", "moved", "case_links"]).fillna(True, ["herbs_consistent"])
    risk = resolve.risk(F.col("n_medical") > 0, ~F.col("herbs_consistent"), F.col("case_links"), F.col("n_other"), F.col("moved"))
    return out.select("name", "canonical_id", risk.alias("risk"), "n_medical", "n_other", "herbs_consistent", "case_links", "moved")


def cleanup_plan(db: Database, refs: Refs, table: str = "formulas") -> DataFrame:
    """Dirty rows with planned class, number of relations, and whether relations block their removal."""
    marked = cleanup.classified(db[table], cleanup.planned_class).select("id", "name", "cleaned", "class")
    counts = relation_counts(db, refs, marked).groupBy("id").agg(F.sum("n").alias("n_relations"))
    out = marked.join(counts, "id", "left").fillna(0, ["n_relations"])
    return out.withColumn("blocked", (F.col("class") != "A_clean_match") & (F.col("n_relations") > 0))


def class_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("class").agg(F.count(F.lit(1)).alias("n")).orderBy("class")


def verified_cleanup(before: DataFrame, after: DataFrame, quarantine: DataFrame, edges: list[tuple[DataFrame, str]]) -> DataFrame:
    """(metric, n, ok), the last row being whether all hold: conservation, no dirty name left, no reference to a removed row."""
    n = cleanup.conserved(before, after, quarantine).select(F.lit("conserved").alias("metric"), (F.col("before") - F.col("after") - F.col("held")).alias("n"), "ok")
    dirty = after.where(F.col("name").startswith(cleanup.DIRTY)).agg(F.count(F.lit(1)).alias("n")).select(F.lit("dirty").alias("metric"), "n", (F.col("n") == 0).alias("ok"))
    parts = [n, dirty]
    for k, (edge, fk) in enumerate(edges):
        gone = edge.join(quarantine.select(F.col("source_record_id").alias(fk)), fk, "left_semi").agg(F.count(F.lit(1)).alias("n"))
        parts.append(gone.select(F.lit(f"reference_{k}:{fk}").alias("metric"), "n", (F.col("n") == 0).alias("ok")))
    every = reduce(DataFrame.unionByName, parts)
    return every.unionByName(every.agg(F.lit("all").alias("metric"), F.count(F.when(~F.col("ok"), 1)).alias("n"), F.bool_and("ok").alias("ok")))


def markdown_table(df: DataFrame, limit: int = 500, ordered: bool = False) -> str:
    """A bounded result as a Markdown table, sorted by its columns unless it is ``ordered`` already; a larger one is refused."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows: write them as a table")
    rows = sorted(rows, key=lambda r: [(v is None, str(v)) for v in r]) if not ordered else rows
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
    lines += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|").replace("\n", " ") for v in r) + " |" for r in rows]
    return "\n".join(lines)


#: Entries of a dictionary that may be broadcast; beyond, a shuffled join.
MAX_ENTRIES = 100_000


def enriched(df: DataFrame, values: dict[str, dict], key: str, columns: list[str]) -> DataFrame:
    """Columns filled from a dictionary by key where they are missing."""
    rows = [(k, *[v.get(c) for c in columns]) for k, v in values.items()]
    fixed = df.sparkSession.createDataFrame(rows, ", ".join([f"{key} string", *[f"__{c} string" for c in columns]]))
    out = df.join(F.broadcast(fixed) if len(rows) <= MAX_ENTRIES else fixed, key, "left")
    return out.withColumns({c: F.coalesce(blank_to_null(F.col(c), False), F.col(f"__{c}")) for c in columns}).select(*df.columns)
