"""Duplicate entities: groups, canonical rows, merged fields, re-pointed references, evidence, redirects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lorebase.functions.identity import key_of
from lorebase.functions.text import blank_to_null
from lorebase.sources.catalog import IDENTITY_FIELDS, MERGE_FIELDS
from lorebase.sources.tables import materialise

#: Sources by rank, and the leading one: the caller's own names for them.
LEADING, RANKS = "primary", {"primary": 0, "secondary": 1}
#: Columns that do not count towards a full row.
META = ("id", "name", "raw_path", "source_repo")


class Collision(ValueError):
    """Two evidence rows of one identity differ in content."""


def duplicate_groups(df: DataFrame, name: str = "name") -> DataFrame:
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n >= 2").orderBy(F.desc("n"), name)


def fullness(df: DataFrame, meta: tuple[str, ...] = META) -> Column:
    """Number of columns, without meta columns, that hold something."""
    cols = [c for c in df.columns if c not in meta]
    flags = [F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), 0).otherwise(1) for c in cols]
    return reduce(Column.__add__, flags, F.lit(0))


def canonical_rows(df: DataFrame, name: str = "name", key: str = "id", tier: Column | None = None, full: Column | None = None, rank: Column | None = None, leading: str = LEADING, ranks: dict[str, int] = RANKS) -> DataFrame:
    """(name, canonical_id, id) of every row in a group of two or more.

    Rows with a channel from the leading source come first, then others with a
    channel, both by id; the rest by fullness, source rank and id.
    """
    if tier is None:
        has = blank_to_null(F.col("six_channel"), False).isNotNull()
        tier = F.when(has & (F.col("source_repo") == leading), 0).when(has, 1).otherwise(2)
    full = fullness(df) if full is None else full
    if rank is None:
        rank = reduce(lambda out, s: F.when(F.col("source_repo") == s[0], s[1]).otherwise(out), ranks.items(), F.lit(9))
    rows = df.select(F.col(name).alias("name"), F.col(key).alias("id"), tier.alias("tier"), full.alias("full"), rank.alias("rank"))
    best = F.struct(
        "tier", F.when(F.col("tier") == 2, -F.col("full")).otherwise(0).alias("f"), F.when(F.col("tier") == 2, F.col("rank")).otherwise(0).alias("r"), "id"
    )
    groups = rows.groupBy("name").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("n")).where("n >= 2")
    return rows.select("name", "id").join(groups.select("name", F.col("best.id").alias("canonical_id")), "name").select("name", "canonical_id", "id")


def unpivoted(df: DataFrame, fields: list[str], key: str = "id") -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]))
    return df.select(F.col(key).alias("id"), pairs.alias("p")).select("id", "p.field", blank_to_null(F.col("p.value")).alias("value"))


def merged_fields(df: DataFrame, groups: DataFrame, fields: tuple[str, ...] = MERGE_FIELDS, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(fills, evidence).

    A blank field of the canonical row is filled if the others agree on one value.
    Else every other row whose value differs leaves evidence of it.
    """
    values = unpivoted(df, list(fields), key).join(groups, "id")
    own = values.where(F.col("id") == F.col("canonical_id")).select("canonical_id", "field", F.col("value").alias("own"))
    others = values.where((F.col("id") != F.col("canonical_id")) & F.col("value").isNotNull())
    both = others.join(own, ["canonical_id", "field"])
    one = both.where("own is null").groupBy("canonical_id", "field").agg(F.min("value").alias("value"), F.count_distinct("value").alias("n"))
    fills = one.where("n = 1").select("canonical_id", "field", "value")
    kept = both.join(fills.select("canonical_id", "field", F.lit(True).alias("filled")), ["canonical_id", "field"], "left")
    evidence = kept.where("filled is null and (own is null or own <> value)").select("canonical_id", "id", "field", "value", F.col("own").alias("kept"))
    return fills, evidence


# Merged fields that people have to decide on.
MEDICAL_FIELDS = ("composition", "dosage", "indication", "six_channel", "syndrome", "differentiation", "contraindication", "alias", "commentary")
REASON, MEDICAL, OTHER = "合并去重保留的非canonical字段值；", "医学字段需人工裁定", "该字段不参与推理"


def _origin(rows: DataFrame, key: str = "id") -> DataFrame:
    """(id, origin, path, part) of rows, null where a table has no such column."""
    get = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    return rows.select(F.col(key).alias("id"), get("source_repo").alias("origin"), get("raw_path").alias("path"), blank_to_null(get("chapter")).alias("part"))


def _evidence(relation: str, field: Column, text: Column, meta: Column) -> list[Column]:
    """The columns of one evidence row of a merge."""
    return [
        F.lit("formula").alias("subject_type"), F.col("canonical_id").alias("subject_id"), F.lit(relation).alias("relation_type"),
        F.lit("source_record").alias("evidence_kind"), F.lit("database_row").alias("source_type"), F.lit("formula").alias("source_record_type"),
        F.col("id").cast("string").alias("source_record_id"), F.col("path").alias("source_path"), field.alias("field_name"), text.alias("evidence_text"),
        F.lit("migration").alias("extraction_method"), F.lit("pending").alias("review_status"),
        F.to_json(meta, {"ignoreNullFields": "false"}).alias("metadata_json"),
    ]


def field_evidence(evidence: DataFrame, rows: DataFrame) -> DataFrame:
    """Evidence rows of kept-out values; ``rows`` is the table that was merged."""
    medical = F.col("field").isin(*MEDICAL_FIELDS)
    meta = F.struct(
        F.col("kept").alias("canonical_value"), F.col("origin").alias("original_source_repo"), medical.alias("is_medical_field"),
        F.concat(F.lit(REASON), F.when(medical, MEDICAL).otherwise(OTHER)).alias("reason"),
    )
    return evidence.join(_origin(rows), "id").select(*_evidence("field_value", F.col("field"), F.col("value"), meta))


def merged_from(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """One evidence row for each removed row."""
    meta = F.struct(
        F.col("name").alias("original_name"), F.col("canonical_id").alias("duplicate_of"), F.col("origin").alias("original_source_repo"),
        F.col("path").alias("original_raw_path"), F.col("part").alias("original_chapter"),
    )
    text = F.format_string("原formula_id=%d已合并入canonical %d", "id", "canonical_id")
    gone = groups.where("id <> canonical_id").join(_origin(rows), "id")
    return gone.select(*_evidence("merged_from", F.lit(None).cast("string"), text, meta))


def delete_gates(db: dict[str, DataFrame], refs: list[tuple[str, str]], removed: DataFrame, table: str = "formulas", kind: str = "formula") -> DataFrame:
    """(gate, n, ok): what still refers to the removed ids (one column id), and evidence whose subject or object is not there.

    Source ids may keep an old id. Nothing may be published while a gate is not ok.
    """
    gone = removed.select("id").distinct()
    parts = [(f"{edge}.{fk}", db[edge].join(gone.withColumnRenamed("id", fk), fk, "left_semi")) for edge, fk in refs if edge in db]
    evidence = db.get("evidence")
    for side in ("subject", "object") if evidence is not None else ():
        if f"{side}_id" in evidence.columns:
            own = evidence.where((F.col(f"{side}_type") == kind) & F.col(f"{side}_id").isNotNull())
            key = own.select(F.col(f"{side}_id").alias("id"))
            parts += [(f"evidence.{side}", key.join(gone, "id", "left_semi")), (f"evidence.{side}.orphan", key.join(db[table].select("id"), "id", "left_anti"))]
    counted = [rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(gate).alias("gate"), "n", (F.col("n") == 0).alias("ok")) for gate, rows in parts]
    return reduce(DataFrame.unionAll, counted)


def nothing_left(refs: list[tuple[str, str]], removed: DataFrame, table: str = "formulas", kind: str = "formula"):
    """The gates as a gate of a snapshot: a function from the tables to the gates that do not hold."""

    def gates_not_ok(db: dict[str, DataFrame]) -> DataFrame:
        return delete_gates(db, refs, removed, table, kind).where(~F.col("ok"))

    return gates_not_ok


def repoint(edge: DataFrame, fk: str, groups: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """References moved to canonical ids; of rows that become equal in key the first stays.

    Only moved rows can come to an equal key: they are few, so rows that stay are neither sorted nor
    dealt out, but only asked for the keys that moved rows come to. ``key`` is the key of the edges,
    so rows that stay have different ones.
    """
    to = groups.where("id <> canonical_id").select(F.col("id").alias(fk), "canonical_id")
    stay = edge.join(to.select(fk), fk, "left_anti")
    moved = edge.join(to, fk).withColumn(fk, F.col("canonical_id")).select(*edge.columns)
    rest = order or [c for c in edge.columns if c not in key]
    others = [c for c in edge.columns if c not in key]
    first = F.min(F.struct(*[F.col(c).alias(f"o{k}") for k, c in enumerate(rest)], F.struct(*others).alias("row"))) if others else F.count(F.lit(1))
    one = moved.groupBy(*key).agg(first.alias("first")).select(*key, *[F.col(f"first.row.{c}").alias(c) for c in others])
    held = stay.select(*key).join(one.select(*key), key, "left_semi")
    return stay.unionByName(one.join(held, key, "left_anti").select(*edge.columns))


def dedupe_key(df: DataFrame) -> Column:
    numbers = {"subject_id", "object_id", "source_id"}
    return key_of([(F.col(c) if c in df.columns else F.lit(None).cast("string"), c in numbers) for c in IDENTITY_FIELDS])


def repoint_evidence(evidence: DataFrame, groups: DataFrame) -> DataFrame:
    """Subject and object moved, source ids left, keys made anew; equal rows merge, differing ones raise Collision."""
    for side in (s for s in ("subject", "object") if f"{s}_id" in evidence.columns):
        to = groups.where("id <> canonical_id").select(F.col("id").alias(f"{side}_id"), F.col("canonical_id"), F.lit("formula").alias(f"{side}_type"))
        evidence = evidence.join(to, [f"{side}_id", f"{side}_type"], "left").withColumn(f"{side}_id", F.coalesce("canonical_id", f"{side}_id")).drop("canonical_id")
    evidence = evidence.withColumn("dedupe_key", dedupe_key(evidence))
    content = F.struct(*[c for c in evidence.columns if c not in ("id", "created_at", "dedupe_key")])
    bad = evidence.groupBy("dedupe_key").agg(F.count_distinct(content).alias("n")).where("n > 1")
    if not bad.isEmpty():
        raise Collision("evidence rows of one identity differ in content")
    w = Window.partitionBy("dedupe_key").orderBy("id" if "id" in evidence.columns else "dedupe_key")
    return evidence.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def migrate(db: dict[str, DataFrame], refs: list[tuple[str, str, list[str]]], table: str = "formulas", fields: tuple[str, ...] = MERGE_FIELDS, leading: str = LEADING, ranks: dict[str, int] = RANKS) -> dict[str, DataFrame]:
    """The tables after all groups are merged; nothing is published here. ``refs``: (edge, fk, key of the edge)."""
    groups = materialise(canonical_rows(db[table], leading=leading, ranks=ranks), "groups")  # read by every edge and evidence table
    present = tuple(f for f in fields if f in db[table].columns)
    fills, kept_out = merged_fields(db[table], groups, present)
    wide = fills.groupBy(F.col("canonical_id").alias("id")).pivot("field", list(present)).agg(F.first("value"))
    rows = db[table].join(groups.where("id <> canonical_id").select("id"), "id", "left_anti")
    right = wide.select("id", *[F.col(f).alias(f"__{f}") for f in present])
    # a fill exists only where the canonical row is blank, so it wins; all other values stay as they are
    rows = rows.join(right, "id", "left").withColumns({f: F.coalesce(F.col(f"__{f}"), F.col(f)) for f in present}).select(*db[table].columns)
    out = {**db, table: rows}
    for edge, fk, key in refs:
        out[edge] = repoint(db[edge], fk, groups, key)
    new = field_evidence(kept_out, db[table]).unionByName(merged_from(groups, db[table]))
    new = new.withColumn("dedupe_key", dedupe_key(new))
    if "evidence" in db:
        moved = repoint_evidence(db["evidence"], groups)
        new = new.join(moved.select("dedupe_key"), "dedupe_key", "left_anti")
        out["evidence"] = moved.unionByName(new, allowMissingColumns=True)
    else:
        out["evidence"] = new
    return out


def reconciled(before: DataFrame, after: DataFrame, fk: str, other: str, groups: DataFrame) -> DataFrame:
    """(canonical_id, same): whether each group's set of partners is the same before and after.

    Sets are compared partner by partner, which counts add up to, so no set is ever gathered.
    """
    to = groups.select(F.col("id").alias(fk), "canonical_id")
    side = lambda df, bit: df.join(to, fk).select("canonical_id", F.col(other).alias("partner"), F.lit(bit).alias("side"))
    sides = side(before, 1).unionAll(side(after, 2)).groupBy("canonical_id", "partner").agg(F.bit_or("side").alias("sides"))
    return sides.groupBy("canonical_id").agg((F.bool_and((F.col("sides") == 3) | F.col("partner").isNull())).alias("same"))


def consistent_sets(edge: DataFrame, fk: str, other: str, groups: DataFrame) -> DataFrame:
    """(canonical_id, same): whether all rows of a group that have partners have the same ones.

    They do if every partner of the group is one of each row: two counts, and no set is gathered.
    """
    pairs = edge.select(F.col(fk).alias("id"), F.col(other).alias("partner")).where("partner is not null").join(groups.select("id", "canonical_id"), "id").distinct()
    rows = pairs.select("canonical_id", "id").distinct().groupBy("canonical_id").agg(F.count(F.lit(1)).alias("rows"))
    have = pairs.groupBy("canonical_id", "partner").agg(F.count(F.lit(1)).alias("n")).groupBy("canonical_id").agg(F.min("n").alias("least"))
    return have.join(rows, "canonical_id").select("canonical_id", (F.col("least") == F.col("rows")).alias("same"))


def redirect_map(evidence: DataFrame) -> DataFrame:
    """(old_id, canonical_id): the first evidence of an old id counts."""
    rows = evidence.where("relation_type = 'merged_from' and subject_type = 'formula'").select(
        "id", F.expr("try_cast(source_record_id as bigint)").alias("old_id"), F.col("subject_id").alias("canonical_id")
    )
    return rows.where("old_id > 0 and canonical_id > 0").groupBy("old_id").agg(F.min_by("canonical_id", "id").alias("canonical_id"), F.count_distinct("canonical_id").alias("n_canonical"))


def resolvable(redirects: DataFrame) -> DataFrame:
    """Redirects whose target is not itself redirected."""
    keys = redirects.select(F.col("old_id").alias("canonical_id"))
    return redirects.join(keys, "canonical_id", "left_anti")


def risk(medical: Column, inconsistent: Column, case_links: Column, other: Column, moved: Column) -> Column:
    """red, yellow or green, by the fixed thresholds 5, 2 and 20."""
    return F.when(medical | inconsistent, "red").when((case_links > 5) | (other > 2) | (moved > 20), "yellow").otherwise("green")
