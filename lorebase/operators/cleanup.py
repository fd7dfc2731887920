"""Dirty names: classification, renaming with evidence, quarantine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lorebase.functions.identity import key_of, record_json
from lorebase.functions.text import ustrip
from lorebase.operators.resolve import dedupe_key

# Signs and words that tell a description from a name.
PUNCTUATION = "[。，.,；;：:！!？?]"
EXPLAINING = ("是", "的", "为", "即", "平常", "接近", "减少", "增加", "不一样", "还好", "煮", "收", "简称")
PLAN_EXPLAINING = (*EXPLAINING, "多", "少")
SEPARATORS, AUDIT_SEPARATORS = "[、和与及还有]", "[、和与及]"
ENDINGS, PLAN_ENDINGS = "[汤丸散丹膏饮]", "[汤丸散丹膏饮煎酒栓露]"
FORCED_NAME, FORCED_MIXED = (3, 4, 22), (90,)
DIRTY = "> "


def cleaned_name(c: Column) -> Column:
    return ustrip(F.regexp_replace(c, r"(?U)^\s*>\s*", ""))


def named_parts(c: Column, separators: str, endings: str) -> Column:
    """Number of parts that end like a formula somewhere."""
    return F.size(F.filter(F.split(c, separators), lambda p: p.rlike(endings)))


def executed_class(c: Column, key: Column, known: Column, forced_name=FORCED_NAME, forced_mixed=FORCED_MIXED) -> Column:
    explains = reduce(Column.__or__, [c.contains(w) for w in EXPLAINING])
    mixed = key.isin(*forced_mixed) | (named_parts(c, SEPARATORS, ENDINGS) >= 2) | c.contains("、")
    return F.when(c.rlike(PUNCTUATION) | explains, "B").when(mixed, "C").when(known | key.isin(*forced_name), "A").otherwise("ambiguous")


def planned_class(c: Column, known: Column) -> Column:
    explains = reduce(Column.__or__, [c.contains(w) for w in PLAN_EXPLAINING])
    return (
        F.when(c.rlike(PUNCTUATION), "descriptive_non_entity")
        .when(named_parts(c, SEPARATORS, PLAN_ENDINGS) >= 2, "multiple_entities")
        .when(explains, "descriptive_non_entity")
        .when(known, "A_clean_match")
        .otherwise("ambiguous_name")
    )


def classified(df: DataFrame, classify=executed_class) -> DataFrame:
    """Dirty rows with cleaned and class."""
    known = df.where(~F.col("name").startswith(DIRTY)).select(F.col("name").alias("cleaned")).where("cleaned is not null").distinct().withColumn("known", F.lit(True))
    dirty = df.where(F.col("name").startswith(DIRTY)).withColumn("cleaned", cleaned_name(F.col("name"))).join(known, "cleaned", "left")
    flag = F.coalesce("known", F.lit(False))
    kind = classify(F.col("cleaned"), F.col("id"), flag) if classify is executed_class else classify(F.col("cleaned"), flag)
    return dirty.withColumn("class", kind).drop("known").select(*df.columns, "cleaned", "class")


#: Class -> reason of quarantine.
REASONS = {"B": "descriptive_non_entity", "C": "multiple_entities", "ambiguous": "ambiguous_name"}
# Tables whose references keep a row from leaving.
GATES = (("formula_herbs", "formula_id"), ("formula_syndromes", "formula_id"), ("case_formulas", "formula_id"))


class Blocked(ValueError):
    """Rows that are to leave are still referred to."""


def clean(df: DataFrame, run_id: str = "cleanup", snapshot: str | None = None, build: str | None = None, schema_version: str = "v2") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows after, quarantine, evidence of renames): class A is renamed, the rest leaves with its whole row as JSON.

    Quarantine and evidence rows have all columns of their tables but ids and times. ``cleaned_tables`` applies the gate.
    """
    marked = classified(df)
    renamed = marked.where("class = 'A'")
    gone = marked.where("class <> 'A'")
    rest = df.where(~F.coalesce(F.col("name").startswith(DIRTY), F.lit(False)))
    after = rest.unionByName(renamed.withColumn("name", F.col("cleaned")).select(*df.columns))
    text = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    null = F.lit(None).cast("string")
    held = gone.withColumn("raw_record_json", record_json(df)).withColumn("content_hash", F.sha2("raw_record_json", 256))
    given = {"snapshot": F.lit(snapshot).cast("string"), "build": F.lit(build).cast("string")}
    parts = [(F.lit("formulas"), False), (given["snapshot"], False), (given["build"], False), (F.col("id"), True), (F.col("content_hash"), False)]
    reason = reduce(lambda out, r: F.when(F.col("class") == r[0], r[1]).otherwise(out), REASONS.items(), null)
    quarantine = held.select(
        F.lit("formulas").alias("source_table"), F.col("id").alias("source_record_id"), given["snapshot"].alias("source_snapshot"), given["build"].alias("build_id"), "content_hash",
        F.lit(schema_version).alias("schema_version"), "raw_record_json", text("source_repo").alias("source_repo"), text("raw_path").alias("source_path"),
        F.col("name").alias("original_name"), F.col("cleaned").alias("cleaned_name"), F.lit(run_id).alias("run_id"), reason.alias("reason_code"), F.lit("pending_review").alias("status"),
        key_of(parts).alias("dedupe_key"), null.alias("metadata_json"),
    )
    evidence = renamed.select(
        F.lit("formula").alias("subject_type"), F.col("id").alias("subject_id"), F.lit("normalized_from").alias("relation_type"), null.alias("object_type"), F.lit(None).cast("long").alias("object_id"),
        F.lit("source_record").alias("evidence_kind"), F.lit("database_row").alias("source_type"), F.lit("formula").alias("source_record_type"), F.col("id").cast("string").alias("source_record_id"),
        F.lit(None).cast("long").alias("source_id"), text("raw_path").alias("source_path"), F.lit("name").alias("field_name"), F.col("name").alias("evidence_text"), F.lit(None).cast("double").alias("confidence"),
        F.lit("normalization").alias("extraction_method"), F.lit("pending").alias("review_status"), null.alias("metadata_json"),
    )
    return after, quarantine, evidence.withColumn("dedupe_key", dedupe_key(evidence))


def gate(db: dict[str, DataFrame], gone: DataFrame, gates: tuple = GATES) -> DataFrame:
    """(gate, id, n): references to rows that are to leave; ``gone`` has one column id. No row: nothing is in the way."""
    refs = [db[t].select(F.lit(f"{t}.{fk}").alias("gate"), F.col(fk).alias("id")) for t, fk in gates if t in db]
    if not refs:
        return gone.select(F.lit("").alias("gate"), "id", F.lit(0).cast("long").alias("n")).limit(0)
    return reduce(DataFrame.unionAll, refs).join(gone.select("id").distinct(), "id", "left_semi").groupBy("gate", "id").agg(F.count(F.lit(1)).alias("n"))


def cleaned_tables(db: dict[str, DataFrame], table: str = "formulas", **options) -> dict[str, DataFrame]:
    """The tables after the cleanup, evidence and quarantine added to those that are there; Blocked where a reference is in the way.

    Rows whose key is there already are not added again, so a second run changes nothing.
    """
    after, held, evidence = clean(db[table], **options)
    if not gate(db, held.select(F.col("source_record_id").alias("id"))).isEmpty():
        raise Blocked("rows that are to leave are referred to")
    out = {**db, table: after}
    for name, new in (("evidence", evidence), ("ingestion_quarantine", held)):
        old = db.get(name)
        out[name] = new if old is None else old.unionByName(new.join(old.select("dedupe_key"), "dedupe_key", "left_anti"), allowMissingColumns=True)
    return out


def conserved(before: DataFrame, after: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row: counts taken from the three tables, and whether they add up."""
    n = lambda df, c: df.agg(F.count(F.lit(1)).alias(c))
    tagged = n(before, "n").withColumn("k", F.lit("before")).unionByName(n(after, "n").withColumn("k", F.lit("after"))).unionByName(n(quarantine, "n").withColumn("k", F.lit("held")))
    out = tagged.groupBy().pivot("k", ["before", "after", "held"]).agg(F.sum("n"))
    return out.withColumn("ok", F.col("before") == F.col("after") + F.col("held"))
