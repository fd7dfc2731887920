"""Case records from Markdown and plain text, as column expressions over exploded lines.

A document is (path, text). Lines keep their place; a case is a number within its
document; of a field that is given twice the last counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lorebase.functions.text import age, case_date, gender, ustrip, without_markup

FIELDS = (
    "name", "case_date", "gender", "age", "chief_complaint", "inquiry", "pulse_diagnosis",
    "tongue_diagnosis", "eye_diagnosis", "diagnosis", "acupuncture_rx", "herbal_rx", "notes",
)
# Labels in the order in which a line is tried, and the field each gives.
LABELS = (
    ("来诊原因", "chief_complaint"), ("问诊", "inquiry"), ("脉诊", "pulse_diagnosis"), ("舌诊", "tongue_diagnosis"),
    ("眼诊", "eye_diagnosis"), ("诊断", "diagnosis"), ("针灸处方", "acupuncture_rx"), ("中药处方", "herbal_rx"), ("解说", "notes"),
)
ENDS_COMPLAINT = ("问诊", "脉诊", "望诊", "舌诊", "眼诊", "诊断", "针灸", "中药", "解说", "备注")
RECORD = "病案纪录"
TABLE_MARKS = rf"\|\*\*[^|*]*{RECORD}\*\*|\|\*\*来诊原因\*\*\|"
VISIT, LEAST_VISIT = "初诊日期", 50
#: Plain text: label, field, labels one of which ends the section.
SECTIONS = (
    ("问诊", "inquiry", "脉诊|望诊|诊断|针灸|中药|解说|备注"), ("脉诊", "pulse_diagnosis", "望诊|诊断|针灸|中药|解说|备注"),
    ("诊断", "diagnosis", "针灸|中药|解说|备注"), ("针灸处方", "acupuncture_rx", "中药|解说|备注"),
    ("中药处方", "herbal_rx", "解说|备注"), ("解说", "notes", "备注"),
)


def is_table_format(text: Column) -> Column:
    return text.rlike(TABLE_MARKS)


def _after(line: Column, label: str) -> Column:
    return without_markup(F.regexp_replace(line, rf"(?U)(?d).*{label}[：:]?\s*", ""))


def _gathered(rows: DataFrame) -> DataFrame:
    """(path, case_no, field, pos, value) -> one row a case with all fields."""
    return rows.groupBy("path", "case_no").agg(*[F.max_by(F.when(F.col("field") == f, F.col("value")), F.when(F.col("field") == f, F.col("pos"))).alias(f) for f in FIELDS])


ENTRIES = "array<struct<field:string,value:string>>"


def _last(entries: str, field: str) -> Column:
    """The value that a field is given last, or null."""
    return F.try_element_at(F.filter(entries, lambda e: e["field"] == field), F.lit(-1))["value"]


def _one_row(**columns: Column) -> Column:
    """A struct as the only row of a generator, so that no filter on it is moved below and worked out twice."""
    return F.explode(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))).alias("one")


def _people(cells: Column, made) -> Column:
    """The entries that ``made`` makes of a row of four or more cells, else none."""
    return F.flatten(F.transform(F.filter(F.array(cells), lambda c: F.size(c) >= 4), made))


def _person(cells: Column) -> Column:
    """name, gender and age of a row of four or more cells."""
    sex = F.when(cells[1].isin("男", "女"), cells[1]).otherwise("")
    return F.array(
        F.struct(F.lit("name").alias("field"), cells[0].alias("value")), F.struct(F.lit("gender").alias("field"), sex.alias("value")), F.struct(F.lit("age").alias("field"), cells[2].alias("value"))
    )


def _has(*names: str) -> Column:
    return reduce(Column.__or__, [F.coalesce(F.col(n), F.lit("")) != "" for n in names])


def _starts(line: Column) -> Column:
    return line.contains(VISIT) & line.contains(RECORD)


def _table_lines(piece: Column) -> Column:
    """Lines without outer pipes; empty ones and rules are left out."""
    lines = F.filter(F.transform(F.split(piece, "\n"), ustrip), lambda c: (c != "") & ~c.rlike(r"^\|[-:]+\|$"))
    return F.transform(lines, lambda c: F.regexp_replace(F.regexp_replace(c, r"^\|", ""), r"\|$", ""))


def _table_entry(line: Column) -> Column:
    """Field and value of a labelled line; the field of any other is null."""
    field = value = F.lit(None).cast("string")
    for label, name in reversed(LABELS):
        here = line.contains(label)
        if name == "tongue_diagnosis":
            here = here | line.contains("望诊")
            field = F.when(here, F.when(line.contains("舌诊"), name)).otherwise(field)
            value = F.when(here, _after(line, "(?:望诊|舌诊)")).otherwise(value)
            continue
        if name == "diagnosis":
            here = here & ~line.contains("特殊")
        if name == "notes":
            here = here & ~line.contains("备注")
        field, value = F.when(here, name).otherwise(field), F.when(here, _after(line, label)).otherwise(value)
    return F.array(F.struct(field.alias("field"), value.alias("value")))


def table_cases(docs: DataFrame) -> DataFrame:
    """Cases of pipe tables. A line with both marks begins a case; the line after a header row holds the person.

    A document is cut at those lines, and a piece is read within its row: nothing is sorted or shuffled. The person
    may stand in the next piece, so each piece is told whether the last line before it, but for marks, is a header.
    """
    header = lambda c: c.contains("姓名") & c.contains("性别")
    begins = rf"(?md)^(?=[^\n]*{VISIT})(?=[^\n]*{RECORD})"
    pieces = docs.select("path", F.transform(F.split(ustrip(F.col("text")), begins), _table_lines).alias("pieces"))
    last = lambda c: F.try_element_at(F.filter(c, lambda x: ~_starts(x)), F.lit(-1))
    pieces = pieces.withColumn("ends", F.transform("pieces", lambda c: header(last(c))))  # null: marks only
    known = lambda i: F.try_element_at(F.filter(F.slice("ends", 1, i), lambda e: e.isNotNull()), F.lit(-1))
    before = lambda i: F.when(i == 0, False).otherwise(F.coalesce(F.get("ends", i - 1), known(i), F.lit(False)))
    first = F.coalesce(_starts(F.get(F.get("pieces", F.lit(0)), F.lit(0))), F.lit(False)).cast("int")
    made = lambda c, i: F.struct(
        (i + first).alias("case_no"), before(i).alias("before"), F.filter(c, _starts).alias("marks"), F.filter(c, lambda x: ~_starts(x)).alias("rest")
    )
    rows = pieces.select("path", F.explode(F.transform("pieces", made)).alias("p")).select("path", "p.*")
    cells = lambda c: F.transform(F.filter(F.transform(F.split(c, r"\|"), ustrip), lambda x: x != ""), without_markup)
    none = F.array().cast(ENTRIES)
    data = lambda i: F.when(i == 0, F.col("before")).otherwise(header(F.get("rest", i - 1)))
    entry = lambda c, i: F.when(header(c), none).when(data(i), _people(cells(c), _person)).otherwise(_table_entry(c))
    dates = F.transform("marks", lambda c: F.struct(F.lit("case_date").alias("field"), F.translate(F.regexp_extract(c, r"(\d{4}/\d{1,2}/\d{1,2})", 1), "/", "-").alias("value")))
    entries = F.concat(F.filter(dates, lambda e: e["value"] != ""), F.flatten(F.transform("rest", entry)))
    rows = rows.select("path", "case_no", entries.alias("entries"))
    found = rows.select("path", "case_no", _one_row(**{f: _last("entries", f) for f in FIELDS})).select("path", "case_no", "one.*")
    return found.where(_has("chief_complaint", "diagnosis"))


def visit_cases(docs: DataFrame) -> DataFrame:
    """Cases of labelled lines; a visit begins at its date label and is passed over below the least length.

    A visit is read within its row. Lines without label that follow a complaint, up to the next complaint, belong to it.
    """
    visits = docs.select("path", F.posexplode(F.split("text", f"(?={VISIT}[：:])")).alias("case_no", "visit")).withColumn("visit", ustrip(F.col("visit")))
    visits = visits.where(F.length("visit") >= LEAST_VISIT)
    rows = visits.select("path", "case_no", F.transform(F.split("visit", "\n"), ustrip).alias("lines"))
    header = lambda c: c.contains("姓名") & c.contains("性别") & c.contains("年龄")
    data = lambda i: F.when(i == 0, False).otherwise(header(F.get("lines", i - 1)))
    cells = lambda c: F.filter(F.transform(F.split(c, "\t"), ustrip), lambda x: x != "")
    dated = lambda c: F.array(F.struct(F.lit("case_date").alias("field"), case_date(c[3]).alias("value")))
    people = F.flatten(F.transform("lines", lambda c, i: F.when(data(i), _people(cells(c), lambda x: F.concat(_person(x), dated(x)))).otherwise(F.array().cast(ENTRIES))))

    def entry(line: Column) -> Column:
        field = value = F.lit(None).cast("string")
        for label, name in reversed(LABELS):
            here = line.startswith(label)
            field, value = F.when(here, name).otherwise(field), F.when(here, F.regexp_replace(line, rf"(?U)^{label}[：:]?\s*", "")).otherwise(value)
        return F.struct(field.alias("field"), value.alias("value"), line.alias("line"))

    given = F.transform(F.filter("lines", lambda c, i: ~data(i) & ~header(c)), entry)
    rows = rows.select("path", "case_no", F.filter(people, lambda e: e["value"].isNotNull()).alias("people"), given.alias("given"))
    goes_on = lambda e: e["field"].isNull() & ~reduce(Column.__or__, [e["line"].startswith(w) for w in (*ENDS_COMPLAINT, VISIT)])
    back = F.array_position(F.reverse(F.transform("given", lambda e: F.coalesce(e["field"], F.lit("")))), "chief_complaint").cast("int")  # 0: no complaint
    after = F.slice("given", F.size("given") - F.col("back") + 2, F.greatest(F.col("back") - 1, F.lit(0)))
    rows = rows.withColumn("back", back).withColumn("more", F.transform(F.filter(F.when(F.col("back") > 1, after).otherwise(F.slice("given", 1, 0)), goes_on), lambda e: e["line"]))
    of = {f: _last("people" if f in ("name", "gender", "age", "case_date") else "given", f) for f in FIELDS}
    complaint = of["chief_complaint"]
    of["chief_complaint"] = F.when(F.size("more") > 0, F.concat(complaint, F.lit(" "), F.array_join("more", " "))).otherwise(complaint)
    found = rows.select("path", "case_no", _one_row(**of)).select("path", "case_no", "one.*")
    return found.where(_has("chief_complaint", "diagnosis", "herbal_rx"))


def case_records(docs: DataFrame) -> DataFrame:
    """Cases of both formats, told apart by their marks."""
    marked = docs.select("path", _one_row(table=is_table_format(F.col("text")), text=F.col("text"))).select("path", "one.*")
    return table_cases(marked.where("table")).unionByName(visit_cases(marked.where("not table")))


def _section(text: Column, label: str, until: str) -> Column:
    found = F.regexp_extract(text, rf"(?Usd){label}[：:]\s*(.+?)(?=\n(?:{until}|$))", 1)
    return F.nullif(ustrip(found), F.lit(""))


def _one_line(text: Column, label: str) -> Column:
    return F.nullif(ustrip(F.regexp_extract(text, rf"(?Ud){label}[：:]\s*(.+?)(?=\n|$)", 1)), F.lit(""))


def section_case(docs: DataFrame) -> DataFrame:
    """One case a document, from headed sections or, without headings, from labelled plain text."""
    text = F.col("text")
    title = ustrip(F.regexp_replace(ustrip(F.element_at(F.split(ustrip(text), "\n"), 1)), "^#+", ""))
    docs = docs.withColumns({"name": title, "headed": text.rlike("(?m)^#{2,3} ")})
    plain = docs.where("not headed").select(
        "path", "name", case_date(text).alias("case_date"), gender(text).alias("gender"), age(text).alias("age"),
        F.lit(None).cast("string").alias("chief_complaint"), _one_line(text, "舌诊").alias("tongue_diagnosis"), _one_line(text, "眼诊").alias("eye_diagnosis"),
        *[_section(text, label, until).alias(f) for label, f, until in SECTIONS],
    )
    parts = docs.where("headed").select("path", "name", F.posexplode(F.split("text", "(?m)^#{2,3} ")).alias("pos", "part")).withColumn("part", ustrip(F.col("part"))).where("part <> ''")
    head = ustrip(F.element_at(F.split("part", "\n"), 1))
    body = ustrip(F.when(F.instr("part", "\n") > 0, F.expr("substring(part, instr(part, '\\n') + 1)")).otherwise(""))
    parts = parts.withColumns({"head": head, "body": body})
    one = lambda f, c: F.struct(F.lit(f).alias("field"), c.alias("value"))
    b, h = F.col("body"), F.col("head")
    chain = F.array().cast("array<struct<field:string,value:string>>")
    for signs, made in reversed((
        (("来诊日期", "初诊"), F.array(one("case_date", case_date(b)), one("gender", gender(b)), one("age", age(b)))),
        (("来诊原因",), F.array(one("chief_complaint", b))), (("问诊",), F.array(one("inquiry", b))), (("脉诊",), F.array(one("pulse_diagnosis", b))),
        (("望诊",), F.array(one("tongue_diagnosis", _one_line(b, "舌诊")), one("eye_diagnosis", _one_line(b, "眼诊")))),
        (("诊断",), F.array(one("diagnosis", b))), (("针灸处方",), F.array(one("acupuncture_rx", b))), (("中药处方",), F.array(one("herbal_rx", b))), (("解说",), F.array(one("notes", b))),
    )):
        here = reduce(Column.__or__, [h.contains(s) for s in signs])
        chain = F.when(here & ~h.contains("特殊") if signs == ("诊断",) else here, made).otherwise(chain)
    rows = parts.select("path", F.lit(0).alias("case_no"), "pos", F.explode(chain).alias("p")).select("path", "case_no", "pos", "p.field", "p.value").where("value is not null")
    named = docs.where("headed").select("path", F.lit(0).alias("case_no"), F.lit(-1).alias("pos"), F.lit("name").alias("field"), F.col("name").alias("value"))
    return _gathered(rows.unionByName(named)).drop("case_no").unionByName(plain.select("path", *FIELDS))
