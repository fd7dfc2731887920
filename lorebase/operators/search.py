"""Keyword search, browsing, facets, detail and statistics over a dict of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lorebase.functions.text import blank_to_null, like_any, markdown_html, preview
from lorebase.sources import catalog

Database = dict[str, DataFrame]


def branch(df: DataFrame, tag: str, order: int, fields: list[str], keyword: str, out: dict[str, Column], key: str = "id", limit: int | None = 20, escape: bool = False) -> DataFrame:
    """One table's matches: a tag, its place in the fixed order, the key and chosen columns."""
    rows = df.where(like_any(fields, keyword, escape)).select(
        F.lit(tag).alias("type"), F.lit(order).alias("type_ord"), F.col(key).cast("long").alias("id"), *[c.alias(n) for n, c in out.items()]
    )
    return rows if limit is None else rows.orderBy("id").limit(limit)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def first_rows(parts: list[DataFrame], limit: int = 20) -> DataFrame:
    """The first rows in the order of tables, so that an early table may use up the limit."""
    return union(parts).orderBy("type_ord", "id").limit(limit)


# What each kind of hit shows, in the order of kinds.
SHOWN = (
    ("herbs", "name category nature flavor indication commentary", "commentary"),
    ("formulas", "name source_book six_channel syndrome indication composition differentiation is_high_risk", ""),
    ("symptoms", "name category description first_gateway target_module", ""),
    ("clinical_cases", "patient_id case_date diagnosis herbal_rx disease_tags", ""),
    ("acupoints", "name meridian indication technique", ""),
    ("syndromes", "name core_symptoms description", ""),
    ("treatment_methods", "name description related_herbs", ""),
    ("classics", "book_name chapter_name content", "content"),
    ("lectures", "title lecture_type content", "content"),
)
EXPORTED = (
    ("herbs", "name", "category"), ("formulas", "name", "source_book"), ("symptoms", "name", "category"), ("syndromes", "name", "six_channel"),
    ("acupoints", "name", "meridian"), ("clinical_cases", "patient_id", "chief_complaint"), ("course_notes", "title", "content"),
)


def search(db: Database, keyword: str, limit: int = 20, escape: bool = False) -> DataFrame:
    """All nine kinds, each up to the limit, then the first of all up to the limit."""
    parts = []
    for order, (name, shown, cut) in enumerate(SHOWN, 1):
        if name in db:
            spec = catalog.table(name)
            out = {c: preview(F.col(c)) if c == cut else F.col(c) for c in shown.split()}
            parts.append(branch(db[name], spec.label, order, list(spec.search), keyword, out, limit=limit, escape=escape))
    return first_rows(parts, limit)


def export_search(db: Database, keyword: str, limit: int = 100) -> DataFrame:
    """table, id, name, description of up to ``limit`` hits a table."""
    parts = []
    for order, (name, title, described) in enumerate(EXPORTED, 1):
        if name in db:
            out = {"name": F.col(title), "description": preview(F.col(described))}
            parts.append(branch(db[name], name, order, [title, described], keyword, out, limit=limit))
    return union(parts).withColumnRenamed("type", "table").drop("type_ord")


def filtered(df: DataFrame, filters: dict[str, str] | None) -> DataFrame:
    """Conjunction of filters on contained text; an empty value filters nothing, an unknown column is refused."""
    for c, v in (filters or {}).items():
        if c not in df.columns:
            raise ValueError(f"unknown column: {c!r}")
        if v:
            df = df.where(F.col(c).ilike(f"%{v}%"))
    return df


def browse(df: DataFrame, page: int = 1, per_page: int = 30, filters: dict[str, str] | None = None, key: str = "id") -> DataFrame:
    return filtered(df, filters).orderBy(key).offset(max(0, (page - 1) * per_page)).limit(per_page)


def browse_after(df: DataFrame, last: object | None = None, per_page: int = 30, filters: dict[str, str] | None = None, key: str = "id") -> DataFrame:
    """The page after the row of key ``last``, from the beginning if that is None.

    The key is a filter that file statistics prune, so a late page costs what an early one does.
    """
    rows = filtered(df, filters)
    return (rows if last is None else rows.where(F.col(key) > F.lit(last))).orderBy(key).limit(per_page)


def facet_values(df: DataFrame, c: str) -> DataFrame:
    return df.select(c).where((F.col(c) != "") & F.col(c).isNotNull()).distinct().orderBy(c)


def stats(db: Database, names: tuple[str, ...] = catalog.STATS_TABLES) -> DataFrame:
    """Rows by table; 0 for a table that is not there."""
    spark = next(iter(db.values())).sparkSession
    parts = [
        db[n].agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table"), "n") if n in db else spark.range(1).select(F.lit(n).alias("table"), F.lit(0).cast("long").alias("n"))
        for n in names
    ]
    return union(parts)


def checked_id(value: object) -> int:
    """A strictly positive whole number, else refused."""
    text = str(value).strip()
    if not text.isascii() or not text.isdigit() or int(text) == 0:
        raise ValueError(f"not an id: {value!r}")
    return int(text)


def with_html(df: DataFrame, names: tuple[str, ...] = catalog.LONG_TEXT) -> DataFrame:
    return df.withColumns({f"{c}_html": F.when(blank_to_null(F.col(c), False).isNotNull(), markdown_html(F.col(c))) for c in names if c in df.columns})


def related(db: Database, name: str, ids: DataFrame) -> dict[str, DataFrame]:
    """Relation name -> rows with ``owner`` for all entities of ``ids`` (one column id) at once."""
    out = {}
    for title, edge, own, other, far, shown, extra, limit in catalog.RELATIONS.get(name, ()):
        if edge not in db or other not in db:
            continue
        rows = db[edge].join(ids.select(F.col("id").alias(own)), own, "left_semi")
        kept = [F.col(c) for c in extra if c in db[edge].columns]
        rows = rows.select(F.col(own).alias("owner"), F.col(far).alias("id"), *kept).join(db[other].select(*shown), "id")
        if limit is not None:
            rows = first_of_each(rows, ["owner"], ["id"], limit)
        out[title] = rows.select("owner", *shown, *[F.col(c) if c in db[edge].columns else F.lit(None).cast("string").alias(c) for c in extra])
    return out


def first_of_each(df: DataFrame, by: list[str], order: list, n: int = 1) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def detail(db: Database, name: str, value: object, redirects: DataFrame | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The row with rendered long texts and its relations; a merged formula's id leads to its canonical row."""
    catalog.table(name)
    wanted = db[name].sparkSession.createDataFrame([(checked_id(value),)], "asked long")
    ids = wanted.select(F.col("asked").alias("id"))
    row = with_html(db[name].join(ids, "id", "left_semi"))
    if redirects is not None and name == "formulas":
        to = wanted.join(db[name], F.col("asked") == F.col("id"), "left_anti").join(redirects, F.col("asked") == F.col("old_id"))
        ids = to.select(F.col("canonical_id").alias("id"), F.col("asked").alias("redirected_from"))
        row = row.withColumn("redirected_from", F.lit(None).cast("long")).unionByName(with_html(db[name].join(ids, "id")))
    return row, related(db, name, row.select("id"))


def by_channel(formulas: DataFrame, channel: str) -> DataFrame:
    return formulas.where(F.col("six_channel") == channel).orderBy("source_book", "name")


def diagnose(db: Database, text: str, limit: int = 10) -> tuple[DataFrame, DataFrame]:
    """Symptoms by name or gateway, all of them; formulas by syndrome, indication or differentiation, the first ones."""
    symptoms = db["symptoms"].where(like_any(["name", "first_gateway"], text)).orderBy("id")
    formulas = db["formulas"].where(like_any(["syndrome", "indication", "differentiation"], text)).orderBy("id").limit(limit)
    return symptoms, formulas


def search_cases(cases: DataFrame, keyword: str, limit: int = 10) -> DataFrame:
    hits = cases.where(like_any(["chief_complaint", "diagnosis", "herbal_rx", "inquiry"], keyword)).orderBy("id").limit(limit)
    return hits.withColumn("tags", F.from_json("disease_tags", "array<string>"))


def equal_filters(df: DataFrame, **values) -> DataFrame:
    """Only the values that are given filter."""
    for c, v in values.items():
        if v:
            df = df.where(F.col(c) == v)
    return df


def reason_chain(db: Database, symptom: str) -> DataFrame:
    """symptom -> syndrome -> formula -> herb by equi-joins along the edges."""
    s = db["symptoms"].where(F.col("name").ilike(f"%{symptom}%")).select(F.col("id").alias("symptom_id"), F.col("name").alias("symptom"))
    named = lambda t, k, n: db[t].select(F.col("id").alias(k), F.col("name").alias(n))
    out = s.join(db["syndrome_symptoms"].select("syndrome_id", "symptom_id"), "symptom_id").join(named("syndromes", "syndrome_id", "syndrome"), "syndrome_id")
    out = out.join(db["formula_syndromes"].select("formula_id", "syndrome_id"), "syndrome_id").join(named("formulas", "formula_id", "formula"), "formula_id")
    herbs = db["formula_herbs"].select("formula_id", "herb_id").join(named("herbs", "herb_id", "herb"), "herb_id")
    return out.join(herbs, "formula_id", "left")


def _or_empty(*names: str) -> list[Column]:
    return [F.coalesce(F.col(n), F.lit("")) for n in names]


def command_search(db: Database, keyword: str, limit: int = 10) -> DataFrame:
    """type, title, info, detail of the first hits, by id, of each of the four kinds that the command line shows."""
    shown = {
        "herbs": (F.col("name"), F.concat(*_or_empty("nature", "flavor")), F.col("indication")),
        "formulas": (F.col("name"), F.concat("six_channel", F.lit(" "), "source_book"), F.concat_ws(" ", *_or_empty("syndrome", "indication"))),
        "clinical_cases": (F.col("chief_complaint"), *_or_empty("diagnosis", "herbal_rx")),
        "folk_formulas": (F.col("name"), *_or_empty("disease"), F.col("commentary")),
    }
    parts = []
    for order, (name, columns) in enumerate(shown.items(), 1):
        if name in db:
            spec = catalog.table(name)
            fields = ["name", *spec.search[1:]] if name == "folk_formulas" else list(spec.search)
            parts.append(branch(db[name], COMMAND_LABELS.get(name, spec.label), order, fields, keyword, dict(zip(("title", "info", "detail"), columns)), limit=limit))
    return union(parts).orderBy("type_ord", "id").select("type", "title", "info", "detail")


# A kind that the command line calls by another name.
COMMAND_LABELS = {"folk_formulas": "妙方"}


def counts(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    """(value, n) of values that are not blank, most frequent first."""
    rows = df.select(value.alias(name)).where((F.col(name) != "") & F.col(name).isNotNull())
    return rows.groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), name)


def year_of(date: Column) -> Column:
    return F.substring(date.cast("string"), 1, 4)


def case_stats(cases: DataFrame) -> DataFrame:
    """(kind, value, n): all cases, cases by year, cases by gender."""
    kind = lambda df, k: df.select(F.lit(k).alias("kind"), F.col("value").cast("string").alias("value"), "n")
    total = cases.agg(F.count(F.lit(1)).alias("n")).withColumn("value", F.lit(""))
    years, genders = counts(cases, year_of(F.col("case_date"))), counts(cases, F.col("gender"))
    return kind(total, "total").unionAll(kind(years, "year")).unionAll(kind(genders, "gender"))
