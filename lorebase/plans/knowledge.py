"""Queries of the knowledge-base operators: the driver tables read as a knowledge base, with SQL for each.

Parts stand for formulas, suppliers for herbs, nations for syndromes, regions for symptoms. Each table is one list of
expressions that Spark and the SQL share; columns that a table of the catalogue has besides are null.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from lorebase.operators import audit, link, parse, report, resolve, search
from lorebase.plans.catalogue import query, t
from lorebase.sources import catalog
from lorebase.sources.tables import dealt

#: table -> (source, expressions by column)
BASES = {
    "formulas": (
        "part",
        {
            "id": "p_partkey", "name": "p_name", "source_book": "p_brand", "chapter": "case when p_size % 3 = 0 then '' else concat('ch', cast(p_size % 4 as string)) end",
            "six_channel": "case when p_size > 40 then p_brand end", "indication": "p_type", "composition": "case when p_size % 2 = 0 then p_type else '  ' end",
            "raw_path": "concat('f', cast(p_size as string))", "source_repo": "case when p_size % 2 = 0 then 'primary' else 'secondary' end",
        },
    ),
    "herbs": ("supplier", {"id": "s_suppkey", "name": "s_name", "nature": "concat('n', cast(s_nationkey as string))", "category": "concat('c', cast(s_nationkey % 3 as string))"}),
    "syndromes": ("nation", {"id": "cast(n_nationkey as bigint)", "name": "n_name", "six_channel": "concat('r', cast(n_regionkey as string))"}),
    "symptoms": ("region", {"id": "cast(r_regionkey as bigint)", "name": "r_name", "category": "lower(r_name)"}),
    "formula_herbs": ("(select distinct l_partkey, l_suppkey from lineitem)", {"formula_id": "l_partkey", "herb_id": "l_suppkey", "role": "concat('role', cast(l_suppkey % 3 as string))"}),
    "syndrome_symptoms": ("nation", {"syndrome_id": "cast(n_nationkey as bigint)", "symptom_id": "cast(n_regionkey as bigint)"}),
    "formula_syndromes": ("(select distinct l_partkey, l_suppkey % 25 as nation from lineitem)", {"formula_id": "l_partkey", "syndrome_id": "cast(nation as bigint)"}),
}
REFS = [("formula_herbs", "formula_id"), ("formula_syndromes", "formula_id")]
EDGES = [("formula_herbs", "formula_id", ["formula_id", "herb_id"]), ("formula_syndromes", "formula_id", ["formula_id", "syndrome_id"])]


def base(spark, d) -> dict[str, DataFrame]:
    """The knowledge base as a dict of frames."""
    out = {}
    for name, (source, expressions) in BASES.items():
        if source == "(select distinct l_partkey, l_suppkey from lineitem)":
            rows = t(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
        elif source.startswith("("):
            rows = t(spark, d, "lineitem").selectExpr("l_partkey", "l_suppkey % 25 as nation").distinct()
        else:
            rows = t(spark, d, source)
        df = rows.selectExpr(*[f"{e} as {c}" for c, e in expressions.items()])
        rest = [c for c in catalog.columns(name) if c not in expressions] if name not in ("formula_herbs", "syndrome_symptoms", "formula_syndromes") else []
        out[name] = df.withColumns({c: F.lit(None).cast("string") for c in rest})
    return out


def _sql(name: str) -> str:
    source, expressions = BASES[name]
    return f"(select {', '.join(f'{e} as {c}' for c, e in expressions.items())} from {source} as src)"


_FORMULAS = _sql("formulas")
_FULL = " + ".join(f"case when {c} is null or {c} = '' then 0 else 1 end" for c in BASES["formulas"][1] if c not in resolve.META)
_TIER = "case when coalesce(trim(six_channel), '') = '' then 2 when source_repo = 'primary' then 0 else 1 end"
_GROUPS = f"""(select *, first_value(id) over (partition by name order by tier, case when tier = 2 then -full_ else 0 end, case when tier = 2 then rank_ else 0 end, id) as canonical_id
 from (select *, {_TIER} as tier, {_FULL} as full_, case source_repo when 'primary' then 0 else 1 end as rank_ from {_FORMULAS}) qualify count(*) over (partition by name) >= 2)"""


def _long(fields) -> str:
    return " union all ".join(f"select name, id, canonical_id, source_repo, raw_path, '{f}' as field, nullif(trim({f}), '') as value from g" for f in fields)


_MERGED = [f for f in catalog.MERGE_FIELDS if f in BASES["formulas"][1]]
_COMPARED = [f for f in report.COMPARED if f in BASES["formulas"][1]]
_VALUES = f"g as {_GROUPS}, v as ({_long(_MERGED)}), own as (select canonical_id, field, value as own from v where id = canonical_id), o as (select v.*, own.own from v join own using (canonical_id, field) where id <> canonical_id and value is not null)"
_FILLS = "f as (select canonical_id, field, min(value) as value from o where own is null group by all having count(distinct value) = 1)"
_KEPT = "k as (select o.* from o left join f using (canonical_id, field) where f.field is null and (own is null or own <> o.value))"


@query("kb_related", f"select 'herbs' as relation, e.formula_id as owner, h.id, h.name, e.role from {_sql('formula_herbs')} e join {_sql('herbs')} h on h.id = e.herb_id union all select 'syndromes', e.formula_id, s.id, s.name, null from {_sql('formula_syndromes')} e join {_sql('syndromes')} s on s.id = e.syndrome_id")
def kb_related(spark, d):
    db = base(spark, d)
    parts = [rows.withColumn("relation", F.lit(name)) for name, rows in search.related(db, "formulas", db["formulas"].select("id")).items()]
    return search.union(parts).select("relation", "owner", "id", "name", "role")


@query("kb_detail", f"select id, name, 3::bigint as redirected_from, indication as indication_html from {_FORMULAS} where id = 5")
def kb_detail(spark, d):
    db = base(spark, d)
    db["formulas"] = db["formulas"].where("id <> 3")
    redirects = spark.createDataFrame([(3, 5), (8, 9)], "old_id long, canonical_id long")
    row, _ = search.detail(db, "formulas", "3", redirects)
    return row.select("id", "name", "redirected_from", "indication_html")


@query("kb_by_channel", f"select id, name, source_book from {_FORMULAS} where six_channel = 'Brand#12'")
def kb_by_channel(spark, d):
    return search.by_channel(base(spark, d)["formulas"], "Brand#12").select("id", "name", "source_book")


@query("kb_diagnose", f"(select 'symptom' as kind, id, name from {_sql('symptoms')} where name ilike '%a%') union all (select 'formula', id, name from {_FORMULAS} where indication ilike '%steel%' order by id limit 10)")
def kb_diagnose(spark, d):
    db = base(spark, d)
    symptoms, _ = search.diagnose(db, "a")
    _, formulas = search.diagnose(db, "steel")
    kind = lambda df, k: df.select(F.lit(k).alias("kind"), "id", "name")
    return kind(symptoms, "symptom").unionByName(kind(formulas, "formula"))


def _hits(order: int, name: str, like: str) -> str:
    spec = catalog.table(name)
    fields = [c for c in spec.search if c in BASES[name][1]]
    where = " or ".join(f"{c} ilike '%{like}%'" for c in fields)
    return f"(select '{spec.label}' as type, {order} as type_ord, id, name from {_sql(name)} where {where} order by id limit 20)"


@query("kb_search", f"select * from ({_hits(1, 'herbs', 'an')} union all {_hits(2, 'formulas', 'an')} union all {_hits(3, 'symptoms', 'an')} union all {_hits(6, 'syndromes', 'an')}) order by type_ord, id limit 20")
def kb_search(spark, d):
    return search.search(base(spark, d), "an").select("type", "type_ord", "id", "name")


@query("kb_export_search", f"""(select 'herbs' as "table", id, name, coalesce(category, '') as description from {_sql('herbs')} where name ilike '%1%' or category ilike '%1%' order by id limit 100)
 union all (select 'formulas', id, name, coalesce(source_book, '') from {_FORMULAS} where name ilike '%1%' or source_book ilike '%1%' order by id limit 100)
 union all (select 'syndromes', id, name, coalesce(six_channel, '') from {_sql('syndromes')} where name ilike '%1%' or six_channel ilike '%1%' order by id limit 100)""")
def kb_export_search(spark, d):
    return search.export_search(base(spark, d), "1").select("table", "id", "name", "description")


@query("kb_reason_chain", f"""select s.id as symptom_id, s.name as symptom, y.name as syndrome, f.id as formula_id, f.name as formula, h.name as herb from {_sql('symptoms')} s join {_sql('syndrome_symptoms')} ss on ss.symptom_id = s.id
 join {_sql('syndromes')} y on y.id = ss.syndrome_id join {_sql('formula_syndromes')} fs on fs.syndrome_id = y.id join {_FORMULAS} f on f.id = fs.formula_id
 left join {_sql('formula_herbs')} fh on fh.formula_id = f.id left join {_sql('herbs')} h on h.id = fh.herb_id where s.name ilike '%asia%'""")
def kb_reason_chain(spark, d):
    return search.reason_chain(base(spark, d), "asia").select("symptom_id", "symptom", "syndrome", "formula_id", "formula", "herb")


@query("kb_relation_counts", f"select formula_id as id, 'formula_herbs' as edge, count(*) as n from {_sql('formula_herbs')} group by 1 union all select formula_id, 'formula_syndromes', count(*) from {_sql('formula_syndromes')} group by 1")
def kb_relation_counts(spark, d):
    db = base(spark, d)
    return report.relation_counts(db, REFS, db["formulas"])


_CONFLICTS = f"""g as {_GROUPS}, v as ({_long(_COMPARED)}), own as (select canonical_id, field, value as canonical from v where id = canonical_id),
 o as (select name, canonical_id, field, value, string_agg(id::varchar, ',' order by id) as ids from v where id <> canonical_id and value is not null group by all),
 c as (select o.*, own.canonical, count(*) over (partition by canonical_id, field) as kinds from o join own using (canonical_id, field)),
 x as (select * from c where (canonical is not null and canonical <> value) or (canonical is null and kinds > 1))"""


@query("kb_conflicts", f"with {_CONFLICTS} select name, canonical_id, field, canonical, value, ids, field not in ('source_book', 'chapter') as medical from x")
def kb_conflicts(spark, d):
    df = base(spark, d)["formulas"]
    return report.conflicts(df, resolve.canonical_rows(df)).withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))


@query("kb_risk_report", f"""with {_CONFLICTS}, n as (select canonical_id, count(*) filter (field not in ('source_book', 'chapter')) as n_medical, count(*) filter (field in ('source_book', 'chapter')) as n_other from x group by 1),
 s as (select canonical_id, count(distinct herbs) <= 1 as same from (select g.canonical_id, g.id, list_sort(list(e.herb_id)) as herbs from g join {_sql('formula_herbs')} e on e.formula_id = g.id group by all) group by 1),
 m as (select canonical_id, count(*) as moved from g join (select formula_id from {_sql('formula_herbs')} union all select formula_id from {_sql('formula_syndromes')}) e on e.formula_id = g.id where g.id <> canonical_id group by 1),
 r as (select distinct g.name, g.canonical_id, coalesce(n_medical, 0) as n_medical, coalesce(n_other, 0) as n_other, coalesce(same, true) as herbs_consistent, coalesce(moved, 0) as moved from g left join n using (canonical_id) left join s using (canonical_id) left join m using (canonical_id))
 select name, canonical_id, case when n_medical > 0 or not herbs_consistent then 'red' when n_other > 2 or moved > 20 then 'yellow' else 'green' end as risk, n_medical, n_other, herbs_consistent, moved from r""")
def kb_risk_report(spark, d):
    return report.risk_report(base(spark, d), REFS).drop("case_links")


@query("kb_migrate_formulas", f"with {_VALUES}, {_FILLS} select b.id, b.name, " + ", ".join(f"coalesce((select value from f where f.canonical_id = b.id and f.field = '{c}'), b.{c}) as {c}" for c in _MERGED) + f" from {_FORMULAS} b where b.id not in (select id from g where id <> canonical_id)")
def kb_migrate_formulas(spark, d):
    return resolve.migrate(base(spark, d), EDGES)["formulas"].select("id", "name", *_MERGED)


@query("kb_migrate_evidence", f"""with {_VALUES}, {_FILLS}, {_KEPT} select canonical_id as subject_id, 'field_value' as relation_type, field as field_name, value as evidence_text, id::varchar as source_record_id, raw_path as source_path,
 'source_record' as evidence_kind, 'database_row' as source_type, 'formula' as source_record_type, own as kept, source_repo as origin, case when field in ('source_book', 'chapter', 'lesson_ref') then 'false' else 'true' end as detail from k
 union all select canonical_id, 'merged_from', null, '原formula_id=' || id || '已合并入canonical ' || canonical_id, id::varchar, raw_path, 'source_record', 'database_row', 'formula', null, source_repo, name from g where id <> canonical_id""")
def kb_migrate_evidence(spark, d):
    rows = resolve.migrate(base(spark, d), EDGES)["evidence"]
    meta = lambda k: F.get_json_object("metadata_json", f"$.{k}")
    return rows.select(
        "subject_id", "relation_type", "field_name", "evidence_text", "source_record_id", "source_path", "evidence_kind", "source_type", "source_record_type",
        meta("canonical_value").alias("kept"), meta("original_source_repo").alias("origin"), F.coalesce(meta("is_medical_field"), meta("original_name")).alias("detail"),
    )


@query("kb_delete_gates", f"with g as {_GROUPS} " + " union all ".join(f"select 'before' as state, '{e}.{fk}' as gate, count(*) as n, count(*) = 0 as ok from {_sql(e)} e where e.{fk} in (select id from g where id <> canonical_id) union all select 'after', '{e}.{fk}', 0, true" for e, fk in REFS) + " union all select 'after', 'evidence.subject' || x, 0, true from (values (''), ('.orphan')) v(x)")
def kb_delete_gates(spark, d):
    db = base(spark, d)
    groups = resolve.canonical_rows(db["formulas"])
    gone = groups.where("id <> canonical_id")
    states = {"before": db, "after": resolve.migrate(db, EDGES)}
    return search.union([resolve.delete_gates(s, REFS, gone).select(F.lit(name).alias("state"), "gate", "n", "ok") for name, s in states.items()])


#: New and known cases: names that agree, that hold one another, dates only, complaints only.
_NEW = "c_custkey as id, concat('case ', cast(c_custkey % 300 as string)) as name, concat('2020-1-', cast(c_custkey % 7 as string)) as case_date, concat('pain ', cast(c_nationkey as string), ' of old') as chief_complaint"
_OLD = """s_suppkey as id, case s_suppkey % 4 when 0 then concat('Case ', cast(s_suppkey as string), ' 20200101') when 1 then concat('Case ', cast(s_suppkey as string), ' more') else concat('other ', cast(s_suppkey as string)) end as patient_id,
 case when s_suppkey % 4 < 3 then concat('2020-1-', cast(s_suppkey % 5 as string)) else '' end as case_date, concat('a pain ', cast(s_nationkey as string), ' of old days') as chief_complaint"""


@query("link_greedy", f"""with recursive a as (select {_NEW} from customer), b as (select {_OLD}, lower(regexp_replace(patient_id, ' [0-9]{{8}}$', '')) as k from supplier),
 p as (select a.id as n, b.id as o, case when a.name = b.k and a.case_date = b.case_date then 0 when a.name = b.k then 1 when contains(a.name, b.k) or contains(b.k, a.name) then 2
   when a.case_date = b.case_date then 3 when contains(b.chief_complaint, a.chief_complaint) then 4 end as r from a, b),
 w(new_ids, old_ids, best) as (select []::bigint[], []::bigint[], null::struct(r integer, n bigint, o bigint)
  union all select list_append(new_ids, x.n), list_append(old_ids, x.o), x from (select new_ids, old_ids, min(struct_pack(r := r, n := n, o := o)) as x from w, p
   where r is not null and not list_contains(new_ids, n) and not list_contains(old_ids, o) group by new_ids, old_ids))
 select best.n as new_id, best.o as old_id, best.r as rank from w where best is not null""")
def link_greedy(spark, d):
    return link.link(t(spark, d, "customer").selectExpr(*_columns(_NEW)), t(spark, d, "supplier").selectExpr(*_columns(_OLD)))


def _columns(select: str) -> list[str]:
    """The expressions of a select list; every one ends in its alias."""
    return [x.strip(" ,\n") for x in re.findall(r".+? as (?:id|name|case_date|chief_complaint|patient_id)(?=,|$)", select, re.S)]


_TABLE = "|初诊日期 2020/1/{0}|**病案纪录**|\n|---|\n|姓名|性别|年龄|来处|\n|{1}|女|{2}|x|\n|来诊原因：pain {2}|\n|诊断：第{2}型|"
_VISIT = "初诊日期：\n姓名\t性别\t年龄\t日期\n{1}\t男\t{2}\t2020/1/{0}\n来诊原因：pain {2}\nand more\n诊断：第{2}型，宜调理，禁生冷，三日后复诊再议"
_PARTS = ("cast(c_custkey % 28 + 1 as string)", "c_name", "cast(c_nationkey as string)")


def _text(form: str) -> str:
    """SQL of a text with the parts put in."""
    quoted = "concat('" + form.replace("\n", "', chr(10), '").replace("\t", "', chr(9), '") + "')"
    for k, part in enumerate(_PARTS):
        quoted = quoted.replace(f"{{{k}}}", f"', {part}, '")
    return quoted


@query("parse_cases", """select c_custkey as path, case when c_custkey % 3 = 0 then x + 1 else x end as case_no, c_name as name, case when c_custkey % 3 = 0 then '女' else '男' end as gender, c_nationkey::varchar as age,
 '2020-1-' || (c_custkey % 28 + 1) as case_date, 'pain ' || c_nationkey || case when c_custkey % 3 = 0 then '' else ' and more' end as chief_complaint,
 '第' || c_nationkey || '型' || case when c_custkey % 3 = 0 then '' else '，宜调理，禁生冷，三日后复诊再议' end as diagnosis from customer, (values (0), (1)) v(x)""")
def parse_cases(spark, d):
    one = f"case when c_custkey % 3 = 0 then {_text(_TABLE)} else {_text(_VISIT)} end"
    customers = t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    docs = dealt(customers, "c_custkey").selectExpr("c_custkey as path", f"concat({one}, chr(10), {one}) as text")
    return parse.case_records(docs).select("path", F.col("case_no").cast("int").alias("case_no"), "name", "gender", "age", "case_date", "chief_complaint", "diagnosis")


_NAMED = "case p_partkey % 7 when 0 then concat('> ', p_name) when 1 then ' ' when 3 then concat(p_name, '汤和', p_brand, '丸.') else p_name end"
_ASKED = "case when r_regionkey % 2 = 0 then '[1, {\"a\": 2}]' else '{bad' end"


@query("audit_summary", f"""with n as (select {_NAMED} as name, p_partkey as id, p_name from part), e as (select l_partkey, l_suppkey from (select distinct l_partkey, l_suppkey from lineitem))
 select 'orphans' as "check", (select count(*) from e where l_partkey % 5 = 4) as n
 union all select 'name_hard', count(*) from n where id % 7 in (0, 1) union all select 'name_soft', 2 * count(*) from n where id % 7 = 3
 union all select 'duplicates', count(*) from (select trim(name) from n group by 1 having count(*) > 1)
 union all select 'json:symptoms', count(*) from region where r_regionkey % 2 = 1
 union all select 'evidence_subject', count(*) from events where event_id % 3 = 0 and event_id not in (select id from n) union all select 'evidence_object', count(*) from events where event_id not in (select s_suppkey from supplier)
 union all select 'json:ingestion_quarantine', count(*) from events where event_id % 4 = 0
 union all select 'keys', 0 union all select 'constraints', count(*) from events where event_id % 3 <> 0""")
def audit_summary(spark, d):
    full = base(spark, d)
    parts = t(spark, d, "part").selectExpr("p_partkey as id", f"{_NAMED} as name")
    symptoms = t(spark, d, "region").selectExpr("cast(r_regionkey as bigint) as id", "r_name as name", f"{_ASKED} as required_questions", "'' as differential")
    edges = full["formula_herbs"].selectExpr("case when formula_id % 5 = 4 then -formula_id else formula_id end as formula_id", "herb_id")
    events = t(spark, d, "events")
    evidence = events.selectExpr("case when event_id % 3 = 0 then 'formula' else 'page' end as subject_type", "event_id as subject_id", "'herb' as object_type", "event_id as object_id")
    held = events.selectExpr("case when event_id % 4 = 0 then 'no json' else concat('[', cast(event_id as string), ']') end as raw_record_json")
    db = {"formulas": parts, "herbs": full["herbs"], "formula_herbs": edges, "symptoms": symptoms, "evidence": evidence, "ingestion_quarantine": held}
    return audit.run(db)[1]


_HEADED = "# {1}\n### 来诊日期\n2020/1/{0}，女，{2} 岁\n## 来诊原因\npain {2}\n### 特殊诊断\nleft out\n### 诊断\n第{2}型"
_PLAIN = "{1}\n初诊 2020-1-{0} 男 {2}岁\n问诊：ask {2}\nand more\n脉诊：slow\n诊断：第{2}型\n备注：none\n"


@query("parse_sections", """select c_custkey as path, c_name as name, '2020-1-' || (c_custkey % 28 + 1) as case_date, case when h then '女' else '男' end as gender, c_nationkey || '岁' as age, case when h then 'pain ' || c_nationkey end as chief_complaint,
 case when not h then 'ask ' || c_nationkey || chr(10) || 'and more' end as inquiry, case when not h then 'slow' end as pulse_diagnosis, '第' || c_nationkey || '型' as diagnosis from (select *, c_custkey % 2 = 0 as h from customer)""")
def parse_sections(spark, d):
    docs = t(spark, d, "customer").selectExpr("c_custkey as path", f"case when c_custkey % 2 = 0 then {_text(_HEADED)} else {_text(_PLAIN)} end as text")
    return parse.section_case(docs).select("path", "name", "case_date", "gender", "age", "chief_complaint", "inquiry", "pulse_diagnosis", "diagnosis")


#: New and known cases of the walks by file: stems that agree, that hold one another, names, dates and complaints.
_FILES = {
    "id": "c_custkey", "stem": "concat('case ', lpad(cast(c_custkey % 300 as string), 4, '0'))", "name": "concat('other ', lpad(cast(c_custkey % 280 as string), 4, '0'))",
    "case_date": "case when c_custkey % 3 = 0 then '' else concat('2020-1-', cast(c_custkey % 97 as string)) end", "chief_complaint": "concat('pain ', cast(c_custkey % 211 as string), ' of old')",
}
_KNOWN = {
    "id": "s_suppkey", "patient_id": "concat(case when s_suppkey % 4 < 2 then 'case ' else 'other ' end, lpad(cast(s_suppkey as string), 4, '0'), case s_suppkey % 4 when 0 then '' when 1 then ' more' when 2 then ' 20200101' else '-x' end)",
    "case_date": "case when s_suppkey % 4 = 3 then '' else concat('2020-1-', cast(s_suppkey % 89 as string)) end", "chief_complaint": "concat('a pain ', cast(s_suppkey % 5 * 40 as string), ' of old days')",
}


def _files(spark, d):
    return [t(spark, d, s).selectExpr(*[f"{e} as {c}" for c, e in of.items()]) for s, of in (("customer", _FILES), ("supplier", _KNOWN))]


def _walk_sql(key: str, pairs: str) -> str:
    """Every new row in the order of id takes its best pair; a pair of rank 0 that is ``fixed`` even if its old row is used."""
    a, b = (", ".join(f"{e.replace('as string', 'as varchar')} as {c}" for c, e in of.items()) for of in (_FILES, _KNOWN))
    return f"""with recursive a as (select {a} from customer), b as (select *, {key} as k from (select {b} from supplier)), f as (select k, min(id) as place from b group by 1), p as (select n, o, r, fixed, place from ({pairs}) join f using (k)),
 s as (select id as n, coalesce(lag(id) over (order by id), -1) as before from a),
 w(n, used, o, r) as (select (-1)::bigint, []::bigint[], null::bigint, null::integer
  union all select x.n, case when best is null then used else list_append(used, best.o) end, best.o, best.r from (select s.n, w.used, min(struct_pack(r := p.r, place := p.place, o := p.o)) filter (p.o is not null) as best
   from w join s on s.before = w.n left join p on p.n = s.n and (p.fixed or not list_contains(w.used, p.o)) group by s.n, w.used) x)
 select n as new_id, o as old_id, r as rank from w where o is not null"""


_PERSON = "lower(regexp_replace(replace(regexp_replace(patient_id, ' [0-9]{8}$', ''), '-', ' '), ' +', ' ', 'g'))"


@query("link_clinical", _walk_sql(_PERSON, """select a.id as n, b.id as o, b.k, b.id is not null and a.stem = b.k and a.case_date <> '' and a.case_date = b.case_date as fixed,
 case when fixed then 0 when a.stem = b.k then 1 when contains(a.stem, b.k) or contains(b.k, a.stem) then 2 when contains(a.name, b.k) or contains(b.k, a.name) then 3 end as r from a, b where r is not null"""))
def link_clinical(spark, d):
    return link.link_clinical(*_files(spark, d))


@query("link_by_stem", _walk_sql("patient_id", """select a.id as n, b.id as o, b.k, false as fixed,
 case when a.stem = b.patient_id then 0 when a.case_date <> '' and a.case_date = b.case_date then 3 when contains(b.chief_complaint, a.chief_complaint) then 4 end as r from a, b where r is not null"""))
def link_by_stem(spark, d):
    return link.link_by_stem(*_files(spark, d))
