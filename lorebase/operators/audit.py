"""Read-only data quality checks; every check is a DataFrame of findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lorebase.operators import constraints
from lorebase.operators.cleanup import AUDIT_SEPARATORS, ENDINGS, PUNCTUATION, named_parts
from lorebase.sources import catalog
from lorebase.sources.tables import materialise

Database = dict[str, DataFrame]
#: Checks whose findings do not fail the audit.
REPORTED_ONLY = ("name_soft", "duplicates")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def orphans(edge: DataFrame, fk: str, parent: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose reference leads nowhere."""
    return edge.where(F.col(fk).isNotNull()).join(parent.select(F.col(key).alias(fk)), fk, "left_anti")


def orphan_counts(db: Database) -> DataFrame:
    """table, fk, n over all declared references; tables that are not there are passed over."""
    parts = [
        orphans(db[t.name], fk, db[p]).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t.name).alias("table"), F.lit(fk).alias("fk"), "n")
        for t in catalog.EDGES
        for fk, p in t.references.items()
        if t.name in db and p in db
    ]
    return _union(parts)


def entity_index(db: Database) -> DataFrame:
    """(entity_type, id) of all entities."""
    return _union([db[t].select(F.lit(k).alias("entity_type"), F.col("id").cast("long").alias("id")) for k, t in catalog.ENTITY_TYPES.items() if t in db])


def poly_orphans(evidence: DataFrame, index: DataFrame, side: str) -> DataFrame:
    """Evidence whose subject or object is not among the entities; types without a table are not judged."""
    kinds = index.select("entity_type").distinct()
    typed = evidence.join(F.broadcast(kinds), F.col(f"{side}_type") == kinds.entity_type, "left_semi")  # at most one row a table
    named = index.select(F.col("entity_type").alias("e_type"), F.col("id").alias("e_id"))
    return typed.join(named, (F.col(f"{side}_type") == F.col("e_type")) & (F.col(f"{side}_id") == F.col("e_id")), "left_anti")


def historical_sources(evidence: DataFrame, index: DataFrame) -> DataFrame:
    """Database rows named as a source that are gone by now: not an error."""
    rows = evidence.where("source_type = 'database_row'").withColumn("source_key", F.expr("try_cast(source_record_id as bigint)"))
    ids = index.select(F.col("entity_type").alias("source_record_type"), F.col("id").alias("source_key"))
    return rows.join(ids, ["source_record_type", "source_key"], "left_anti")


def valid_json(c: Column) -> Column:
    """One JSON value and nothing after it; inside brackets, what follows a value is no longer passed over."""
    inside = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    return F.coalesce(F.size(F.try_variant_get(inside, "$", "array<variant>")) == 1, F.lit(False)) & F.try_parse_json(c).isNotNull()


def invalid_json(df: DataFrame, columns: list[str], key: str = "id") -> DataFrame:
    """(column, id) of values that are no JSON. A column that is not there raises, as a wrong schema must."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))
    rows = df.select(F.col(key).alias("id"), pairs.alias("p")).select("id", "p.column", "p.value")
    return rows.where("value is not null and value <> ''").where(~valid_json(F.col("value"))).select("column", "id")


def name_hard(c: Column) -> Column:
    """The first hard rule that a name breaks, or null."""
    blank = c.isNull() | ~c.rlike(r"(?U)\S")
    return F.when(blank, "empty_name").when(c.rlike(r"(?U)^\s*>"), "blockquote").when(c.rlike(r"[\x00-\x1f]"), "control_char")


def name_soft(c: Column) -> Column:
    """All soft rules that a name breaks."""
    long = F.when((F.length(c) > 8) & c.rlike(PUNCTUATION), F.lit("descriptive"))
    many = F.when(named_parts(c, AUDIT_SEPARATORS, ENDINGS) >= 2, F.lit("multi_entity"))
    return F.array_compact(F.array(long, many))


def name_findings(df: DataFrame, name: str = "name", key: str = "id") -> DataFrame:
    """(id, level, rule): one hard finding, else all soft ones."""
    rows = df.select(F.col(key).alias("id"), name_hard(F.col(name)).alias("hard"), name_soft(F.coalesce(F.col(name), F.lit(""))).alias("soft"))
    hard = rows.where("hard is not null").select("id", F.lit("hard").alias("level"), F.col("hard").alias("rule"))
    return hard.unionByName(rows.where("hard is null").select("id", F.lit("soft").alias("level"), F.explode("soft").alias("rule")))


def duplicate_names(df: DataFrame, name: str = "name", key: str = "id") -> DataFrame:
    """Groups of names equal but for spaces around: least spelling, count, ids in order."""
    ids = F.array_join(F.array_sort(F.collect_list(key)).cast("array<string>"), ",")
    return df.where(F.col(name).isNotNull()).groupBy(F.trim(F.col(name)).alias("trimmed")).agg(F.min(name).alias("name"), F.count(F.lit(1)).alias("n"), ids.alias("ids")).where("n >= 2")


def constraint_violations(df: DataFrame, key: list[str], required: list[str] = (), enums: dict[str, tuple] | None = None, ranges: dict[str, tuple] | None = None, pairs: list[tuple[str, str]] = ()) -> DataFrame:
    """(rule, n) of keys, not-null, enum, range and both-or-none rules, in one pass but for the key."""
    counts = {f"not_null:{c}": F.col(c).isNull() for c in required}
    counts |= {f"enum:{c}": F.col(c).isNotNull() & ~F.col(c).isin(*v) for c, v in (enums or {}).items()}
    counts |= {f"range:{c}": F.col(c).isNotNull() & ~F.col(c).between(*v) for c, v in (ranges or {}).items()}
    counts |= {f"pair:{a},{b}": F.col(a).isNull() != F.col(b).isNull() for a, b in pairs}
    dup = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("n")).select(F.lit("key:" + ",".join(key)).alias("rule"), "n")
    if not counts:
        return dup
    row = df.agg(*[F.count(F.when(c, 1)).alias(f"r{k}") for k, c in enumerate(counts.values())])
    out = row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{k}").alias("n")) for k, n in enumerate(counts)])).alias("x")).select("x.rule", "x.n")
    return dup.unionByName(out)


def duplicate_rows(df: DataFrame, name: str = "name", key: str = "id") -> DataFrame:
    """(trimmed, id) of all rows in such a group, a row each, for groups of any size."""
    rows = df.where(F.col(name).isNotNull()).select(F.trim(F.col(name)).alias("trimmed"), F.col(key).alias("id"))
    return rows.join(rows.groupBy("trimmed").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("trimmed"), "trimmed", "left_semi")


def blank_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, blank, total) of all columns in one pass."""
    row = df.agg(F.count(F.lit(1)).alias("total"), *[F.count(F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), 1)).alias(f"b{k}") for k, c in enumerate(columns)])
    return row.select("total", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"b{k}").alias("blank")) for k, c in enumerate(columns)])).alias("x")).select("x.column", "x.blank", "total")


def coverage(parent: DataFrame, edge: DataFrame, fk: str, key: str = "id") -> DataFrame:
    """Parents with an edge, all parents, and their ratio."""
    have = parent.select(key).join(edge.select(F.col(fk).alias(key)), key, "left_semi").agg(F.count_distinct(key).alias("covered"))
    both = have.withColumn("total", F.lit(0).cast("long")).unionByName(parent.agg(F.count(F.lit(1)).alias("total")).withColumn("covered", F.lit(0).cast("long")))
    return both.agg(F.sum("covered").alias("covered"), F.sum("total").alias("total")).withColumn("ratio", F.col("covered") / F.col("total"))


def source_keys(cases: DataFrame) -> DataFrame:
    """One row on whether any source column could identify a case."""
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "")
    dup = lambda cols: cases.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("n"))
    multi = cases.where(~blank("raw_path")).groupBy("raw_path").agg(F.count_distinct("chief_complaint").alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("n"))
    parts = [
        cases.agg(F.count(F.when(blank("raw_path"), 1)).alias("n")).withColumn("metric", F.lit("blank_raw_path")),
        dup(["raw_path"]).withColumn("metric", F.lit("dup_raw_path")),
        dup(["patient_id"]).withColumn("metric", F.lit("dup_patient_id")),
        dup(["raw_path", "patient_id", "chief_complaint"]).withColumn("metric", F.lit("dup_combined")),
        multi.withColumn("metric", F.lit("multi_case_files")),
    ]
    return _union(parts).select("metric", "n")


def run(db: Database, damaged: list[tuple[str, str]] = ()) -> tuple[bool, DataFrame]:
    """(failed, report): numbers by check; soft names and duplicates are reported only.

    ``damaged`` is what ``snapshots.damaged`` says of the stored version the tables come from.
    """
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n")
    parts = [orphan_counts(db).groupBy().agg(F.sum("n").alias("n")).select(F.lit("orphans").alias("check"), "n")]
    parts.append(count(constraints.doubled_keys(db), "keys"))
    parts.append(constraints.row_violations(db).agg(F.sum("n").alias("n")).select(F.lit("constraints").alias("check"), "n"))
    names = name_findings(db["formulas"]).groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    parts.append(names.select(F.concat(F.lit("name_"), "level").alias("check"), "n"))
    parts.append(count(duplicate_names(db["formulas"]), "duplicates"))
    for t in catalog.ENTITIES:
        if t.json and t.name in db:
            parts.append(count(invalid_json(db[t.name], list(t.json)), f"json:{t.name}"))
    if "evidence" in db:
        index = entity_index(db)
        for side in ("subject", "object"):
            parts.append(count(poly_orphans(db["evidence"].where(f"{side}_id is not null"), index, side), f"evidence_{side}"))
    if "ingestion_quarantine" in db:
        raw = db["ingestion_quarantine"].where("raw_record_json is not null").where(~valid_json(F.col("raw_record_json")))
        parts.append(count(raw, "json:ingestion_quarantine"))
    if damaged:
        parts.append(db["formulas"].sparkSession.createDataFrame([("signature", len(damaged))], "check string, n long"))
    report = materialise(_union(parts).select("check", F.coalesce("n", F.lit(0)).cast("long").alias("n")), "report")  # read here and by the caller
    # a few rows, one for each check
    failed = any(r["n"] and r["check"] not in REPORTED_ONLY for r in report.collect())
    return failed, report


def findings(db: Database) -> DataFrame:
    """(check, subject, detail): what each number of ``run`` stands for, a row a finding."""
    row = lambda df, check, subject, detail: df.select(F.lit(check).alias("check") if isinstance(check, str) else check.alias("check"), subject.cast("string").alias("subject"), detail.cast("string").alias("detail"))
    text = F.concat_ws
    parts = [
        row(constraints.broken_references(db), "orphans", text(".", "table", F.substring_index("rule", ":", -1)), F.col("key")),
        row(constraints.doubled_keys(db), "keys", text(" ", "table", "rule"), text(" x ", "key", F.col("n").cast("string"))),
        row(constraints.row_violations(db).where("n > 0"), "constraints", text(" ", "table", "rule"), F.col("n")),
        row(name_findings(db["formulas"]), F.concat(F.lit("name_"), "level"), F.col("id"), F.col("rule")),
        row(duplicate_names(db["formulas"]), "duplicates", F.col("name"), text(" x ", "ids", F.col("n").cast("string"))),
    ]
    for t in catalog.ENTITIES:
        if t.json and t.name in db:
            parts.append(row(invalid_json(db[t.name], list(t.json)), f"json:{t.name}", F.col("id"), F.col("column")))
    if "evidence" in db:
        index = entity_index(db)
        for side in ("subject", "object"):
            rows = poly_orphans(db["evidence"].where(f"{side}_id is not null"), index, side)
            parts.append(row(rows, f"evidence_{side}", F.col(f"{side}_type"), F.col(f"{side}_id")))
    if "ingestion_quarantine" in db:
        raw = db["ingestion_quarantine"].where("raw_record_json is not null").where(~valid_json(F.col("raw_record_json")))
        parts.append(row(raw, "json:ingestion_quarantine", F.lit("raw_record_json"), F.substring("raw_record_json", 1, 80)))
    return _union(parts)


def human_report(report: DataFrame, found: DataFrame | None = None, limit: int = 10_000) -> str:
    """The report of ``run`` as text: a line a check with its findings below, if given, and the outcome."""
    rows = sorted(report.collect(), key=lambda r: r["check"])  # one row for each check
    lines: dict[str, list[str]] = {}
    if found is not None:
        listed = found.limit(limit + 1).collect()
        if len(listed) > limit:
            raise ValueError(f"more than {limit} findings: write them as a table")
        for f in sorted(listed, key=lambda f: (f["check"], f["subject"] or "", f["detail"] or "")):
            lines.setdefault(f["check"], []).append(f"    - {f['subject']}: {f['detail']}")
    mark = lambda r: "PASS" if not r["n"] else "WARN" if r["check"] in REPORTED_ONLY else "FAIL"
    out = [x for r in rows for x in (f"[{mark(r)}] {r['check']}: {r['n']}", *lines.get(r["check"], ()))]
    return "\n".join([*out, "FAILED" if any(mark(r) == "FAIL" for r in rows) else "PASSED"])
