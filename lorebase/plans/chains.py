"""Queries of reasoning chains, linkage, cleanup, audits and snapshots over the driver tables read as a knowledge base."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorebase.functions.text import person_name
from lorebase.operators import chain, cleanup, constraints, extract, link, search
from lorebase.plans.catalogue import _CLASSED, _cleanable, query, t
from lorebase.plans.knowledge import _FORMULAS, _sql, base
from lorebase.sources import documents

#: Orders stand for cases; a case uses the parts it has lines of.
_CASES = "(select o_orderkey as id, concat('patient ', cast(o_custkey as string)) as patient_id, cast(o_orderdate as string) as case_date, o_orderpriority as chief_complaint from orders)"
_CASE_FORMULAS = "(select distinct l_orderkey as case_id, l_partkey as formula_id from lineitem)"


def with_cases(spark, d):
    db = base(spark, d)
    db["clinical_cases"] = t(spark, d, "orders").selectExpr("o_orderkey as id", "concat('patient ', cast(o_custkey as string)) as patient_id", "cast(o_orderdate as string) as case_date", "o_orderpriority as chief_complaint")
    db["case_formulas"] = t(spark, d, "lineitem").selectExpr("l_orderkey as case_id", "l_partkey as formula_id")  # chains make their edges distinct
    return db


_TO_FORMULAS = f"from {_sql('symptoms')} s join {_sql('syndrome_symptoms')} ss on ss.symptom_id = s.id join {_sql('syndromes')} y on y.id = ss.syndrome_id join {_sql('formula_syndromes')} fs on fs.syndrome_id = y.id join {_FORMULAS} f on f.id = fs.formula_id"
_TO_CASES = f"{_TO_FORMULAS} join {_CASE_FORMULAS} cf on cf.formula_id = f.id join {_CASES} c on c.id = cf.case_id"


@query("reason_cases", f"select s.id as symptom_id, s.name as symptom, y.name as syndrome, f.id as formula_id, f.name as formula, c.id as case_id, c.patient_id as patient {_TO_CASES} where s.name ilike '%asia%'")
def reason_cases(spark, d):
    rows = chain.paths(with_cases(spark, d), "asia")
    return rows.selectExpr("symptoms_id as symptom_id", "symptoms as symptom", "syndromes as syndrome", "formulas_id as formula_id", "formulas as formula", "clinical_cases_id as case_id", "clinical_cases as patient")


@query("reason_path_counts", f"select s.id, s.name, coalesce(n, 0)::bigint as paths from {_sql('symptoms')} s left join (select s.id, count(*) as n {_TO_CASES} group by s.id) p on p.id = s.id")
def reason_path_counts(spark, d):
    db = with_cases(spark, d)
    return chain.path_counts(db, db["symptoms"].select("id")).join(db["symptoms"].select("id", "name"), "id").select("id", "name", "paths")


def _hop_sql(source: str, edge: str, own: str, far: str, target: str, nexts: tuple = ()) -> str:
    tables = {"clinical_cases": _CASES, "formulas": _FORMULAS}
    of = lambda n: tables.get(n) or _sql(n)
    edge_of = lambda n: _CASE_FORMULAS if n == "case_formulas" else _sql(n)
    rows = f"(select distinct {own}, {far} from {edge_of(edge)} where {own} in (select id from {of(source)}) and {far} in (select id from {of(target)}))"
    onward = " or ".join(f"{far} in (select {o} from {edge_of(e)} where {f} in (select id from {of(t_)}))" for e, o, f, t_ in nexts)
    reach = f"(select count(distinct {far}) from {rows} where {onward})" if nexts else "null"
    return f"select '{source}>{target}' as hop, (select count(*) from {rows}) as edges, (select count(distinct {own}) from {rows}) as covered_source, (select count(distinct id) from {of(source)}) as total_source, (select count(distinct {far}) from {rows}) as covered_target, (select count(distinct id) from {of(target)}) as total_target, {reach}::bigint as onward"


@query(
    "reason_hops",
    " union all ".join([
        _hop_sql("symptoms", "syndrome_symptoms", "symptom_id", "syndrome_id", "syndromes", (("formula_syndromes", "syndrome_id", "formula_id", "formulas"),)),
        _hop_sql("syndromes", "formula_syndromes", "syndrome_id", "formula_id", "formulas", (("formula_herbs", "formula_id", "herb_id", "herbs"), ("case_formulas", "formula_id", "case_id", "clinical_cases"))),
        _hop_sql("formulas", "formula_herbs", "formula_id", "herb_id", "herbs"),
        _hop_sql("formulas", "case_formulas", "formula_id", "case_id", "clinical_cases"),
    ]),
)
def reason_hops(spark, d):
    return chain.hop_coverage(with_cases(spark, d))


@query("reason_start_coverage", " union all ".join(
    f"select {k}::int as step, '{hop}' as hop, count(distinct s.id) as covered, (select count(*) from {_sql('symptoms')} where name ilike '%a%') as total, count(distinct {far}) as reached {path} where s.name ilike '%a%'"
    for k, hop, far, path in (
        (1, "symptoms>syndromes", "y.id", _TO_FORMULAS.split(" join " + _sql("formula_syndromes"))[0]),
        (2, "syndromes>formulas", "f.id", _TO_FORMULAS),
        (3, "formulas>clinical_cases", "c.id", _TO_CASES),
    )
))
def reason_start_coverage(spark, d):
    return chain.start_coverage(with_cases(spark, d), "a")


#: Names of two figures, so that none holds another.
_PADDED = "lpad(cast({} % 40 as string), 2, '0')"


@query("link_unmatched", f"""with a as (select c_custkey as id, {_PADDED.format('c_custkey').replace('as string', 'as varchar')} as k from customer), b as (select s_suppkey as id, {_PADDED.format('s_suppkey').replace('as string', 'as varchar')} as k from supplier),
 x as (select *, row_number() over (partition by k order by id) as i from a), y as (select *, row_number() over (partition by k order by id) as i from b)
 select x.id, 'case ' || x.k as stem from x left join y on x.k = y.k and x.i = y.i where y.id is null order by x.id limit 10""")
def link_unmatched(spark, d):
    new = t(spark, d, "customer").selectExpr("c_custkey as id", *[f"concat('case ', {_PADDED.format('c_custkey')}) as {c}" for c in ("stem", "name")], "'' as case_date", "'' as chief_complaint")
    old = t(spark, d, "supplier").selectExpr("s_suppkey as id", f"concat('case ', {_PADDED.format('s_suppkey')}) as patient_id", "'' as case_date", "'' as chief_complaint")
    return link.unmatched(new, link.link_clinical(new, old), 10).select("id", "stem")


# ---- cleanup ---------------------------------------------------------------------------------------

_RAW = """'{"id": ' || id || ', "name": "' || name || '"}'"""


@query("quarantine_whole", f"""select 'formulas' as source_table, id as source_record_id, null::varchar as source_snapshot, null::varchar as build_id, sha256({_RAW}) as content_hash, 'v2' as schema_version, {_RAW} as raw_record_json, null::varchar as source_repo, null::varchar as source_path,
 name as original_name, cleaned as cleaned_name, 'run 1' as run_id, case class when 'B' then 'descriptive_non_entity' when 'C' then 'multiple_entities' else 'ambiguous_name' end as reason_code, 'pending_review' as status,
 sha256('["formulas",null,null,' || id || ',"' || sha256({_RAW}) || '"]') as dedupe_key, null::varchar as metadata_json from ({_CLASSED}) where class <> 'A'""")
def quarantine_whole(spark, d):
    return cleanup.clean(_cleanable(spark, d), run_id="run 1")[1]


@query("cleanup_evidence", f"""select 'formula' as subject_type, id as subject_id, 'normalized_from' as relation_type, null::varchar as object_type, null::bigint as object_id, 'source_record' as evidence_kind, 'database_row' as source_type, 'formula' as source_record_type,
 id::varchar as source_record_id, null::bigint as source_id, null::varchar as source_path, 'name' as field_name, name as evidence_text, null::double as confidence, 'normalization' as extraction_method, 'pending' as review_status, null::varchar as metadata_json,
 sha256('["formula",' || id || ',"normalized_from",null,null,"source_record","database_row","formula","' || id || '",null,null,"name"]') as dedupe_key from ({_CLASSED}) where class = 'A'""")
def cleanup_evidence(spark, d):
    return cleanup.clean(_cleanable(spark, d))[2]


@query("cleanup_gate", f"with e as (select distinct l_partkey + 1000 as id, l_suppkey from lineitem where l_partkey % 5 = 0), c as (select distinct l_partkey + 1000 as id, l_orderkey from lineitem where l_partkey % 7 = 0), g as (select id from ({_CLASSED}) where class <> 'A') select 'formula_herbs.formula_id' as gate, id, count(*) as n from e where id in (select id from g) group by id union all select 'case_formulas.formula_id', id, count(*) from c where id in (select id from g) group by id")
def cleanup_gate(spark, d):
    lines = t(spark, d, "lineitem")
    db = {
        "formula_herbs": lines.where("l_partkey % 5 = 0").selectExpr("l_partkey + 1000 as formula_id", "l_suppkey as herb_id").distinct(),
        "case_formulas": lines.where("l_partkey % 7 = 0").selectExpr("l_orderkey as case_id", "l_partkey + 1000 as formula_id").distinct(),
    }
    gone = cleanup.clean(_cleanable(spark, d))[1].selectExpr("source_record_id as id")
    return cleanup.gate(db, gone)


# ---- audits ----------------------------------------------------------------------------------------

#: Tables with a fault of every kind: expressions that Spark and the SQL share.
_FAULTY = {
    "formulas": ("part", {"id": "case when p_partkey % 50 = 0 then p_partkey - 1 else p_partkey end", "name": "case when p_partkey % 40 <> 3 then p_name end"}),
    "herbs": ("supplier", {"id": "s_suppkey", "name": "s_name"}),
    "formula_herbs": ("lineitem", {"formula_id": "case when l_partkey % 60 = 1 then -l_partkey else l_partkey end", "herb_id": "case when l_suppkey % 5 = 2 then l_suppkey + 1000000 else l_suppkey end"}),
    "evidence": (
        "events",
        {
            "id": "event_id", "subject_type": "case when event_id % 3 = 0 then 'formula' else 'page' end", "subject_id": "case when event_id % 17 <> 0 then user_id end", "relation_type": "case when event_id % 19 = 0 then 'seen' else 'textual' end",
            "object_type": "case when event_id % 5 = 0 then 'herb' end", "object_id": "case when event_id % 10 <> 0 then user_id end", "confidence": "cast(event_id % 13 as double) / 10",
            "review_status": "case when event_id % 23 = 0 then 'open' when event_id % 29 <> 0 then 'pending' end", "dedupe_key": "concat('k', cast(event_id % 700 as string))",
        },
    ),
    "ingestion_quarantine": (
        "customer",
        {
            "id": "c_custkey", "source_table": "case when c_custkey % 9 = 0 then 'pages' else 'formulas' end", "run_id": "case when c_custkey % 4 <> 0 then 'r' end", "status": "case when c_custkey % 6 = 0 then 'pending' else 'pending_review' end",
            "reason_code": "case when c_custkey % 11 = 0 then 'other' else 'ambiguous_name' end", "raw_record_json": "'{}'", "dedupe_key": "concat('q', cast(c_custkey as string))",
        },
    ),
}


def _faulty_sql() -> str:
    tables = ", ".join(f"{name}_ as (select {', '.join(f'{e.replace("as string", "as varchar")} as {c}' for c, e in of.items())} from {source})" for name, (source, of) in _FAULTY.items())
    rules = (
        ("formulas", "not_null:name", "name is null"),
        ("evidence", "not_null:subject_id", "subject_id is null"), ("evidence", "not_null:review_status", "review_status is null"), ("evidence", "enum:subject_type", "subject_type <> 'formula'"),
        ("evidence", "enum:relation_type", "relation_type = 'seen'"), ("evidence", "enum:review_status", "review_status = 'open'"), ("evidence", "range:confidence", "confidence > 1"),
        ("evidence", "pair:object_type,object_id", "(object_type is null) <> (object_id is null)"), ("ingestion_quarantine", "enum:source_table", "source_table = 'pages'"),
        ("ingestion_quarantine", "not_null:run_id", "run_id is null"), ("ingestion_quarantine", "enum:status", "status = 'pending'"), ("ingestion_quarantine", "enum:reason_code", "reason_code = 'other'"),
    )
    keys = (("formulas", "id"), ("herbs", "id"), ("formula_herbs", "formula_id,herb_id"), ("evidence", "id"), ("evidence", "dedupe_key"), ("ingestion_quarantine", "id"), ("ingestion_quarantine", "dedupe_key"))
    parts = [f"select '{t_}' as \"table\", '{rule}' as rule, count(*) as n from {t_}_ where {where}" for t_, rule, where in rules]
    parts += [f"select '{t_}', 'key:{k}', count(*) from (select {k} from {t_}_ group by all having count(*) > 1)" for t_, k in keys]
    parts += [f"select 'formula_herbs', 'reference:{fk}', count(*) from formula_herbs_ where {fk} not in (select id from {p}_)" for fk, p in (("formula_id", "formulas"), ("herb_id", "herbs"))]
    return f"with {tables} select * from ({' union all '.join(parts)}) where n > 0"


@query("audit_constraints", _faulty_sql())
def audit_constraints(spark, d):
    db = {name: t(spark, d, source).selectExpr(*[f"{e} as {c}" for c, e in of.items()]) for name, (source, of) in _FAULTY.items()}
    return constraints.violations(db)


# ---- matching --------------------------------------------------------------------------------------

_NAMES = "(select min(p_partkey) as ord, max(p_partkey) as id, lower(p_name) as name from part group by lower(p_name))"
_ASKED = "(select distinct case when c_custkey % 3 = 0 then concat('x', lower(p_name)) when c_custkey % 3 = 1 then upper(substr(p_name, 1, 4)) else concat(upper(p_name), '.') end as token from customer join part on c_custkey = p_partkey union all select 'a' union all select ' ')"
_PLAIN_TOKEN = "trim(regexp_replace(regexp_replace(lower(token), '[,.\\-'']', ' ', 'g'), '\\s+', ' ', 'g'))"


@query("fuzzy_match_normalised", f"with t as (select token, {_PLAIN_TOKEN} as plain from {_ASKED}), n as (select * from {_NAMES}) select token, arg_min(id, case when name = token then -2 when name = plain then -1 else ord end) as id from t join n on (plain <> '' and (contains(n.name, plain) or contains(plain, n.name))) group by token")
def fuzzy_match_normalised(spark, d):
    names = t(spark, d, "part").selectExpr("p_partkey as id", "lower(p_name) as name")
    asked = t(spark, d, "customer").join(t(spark, d, "part"), F.expr("c_custkey = p_partkey")).selectExpr(
        "case when c_custkey % 3 = 0 then concat('x', lower(p_name)) when c_custkey % 3 = 1 then upper(substr(p_name, 1, 4)) else concat(upper(p_name), '.') end as token"
    )
    tokens = asked.unionAll(spark.createDataFrame([("a",), (" ",)], "token string"))
    return extract.match_tokens(tokens, extract.entity_names(names), normalise=person_name)


# ---- documents and pages ---------------------------------------------------------------------------


@query("browse_after", "select o_orderkey as id, o_orderstatus from orders where o_orderkey > (select min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 2 from orders) order by 1 limit 30")
def browse_after(spark, d):
    rows = t(spark, d, "orders").selectExpr("o_orderkey as id", "o_orderstatus")
    least, most = rows.agg(F.min("id"), F.max("id")).first()
    return search.browse_after(rows, least + (most - least) // 2)


_FRONT = "concat('---', chr(10), 'title: \"', p_name, '\"', chr(10), '# left out', chr(10), 'tags: [', p_brand, ', \"', p_type, '\"]', chr(10), 'note: it''s a ', p_type, chr(10), '---', chr(10), 'body: no')"


@query("front_values", "select p_partkey, 3::bigint as n, p_name as title, 2::bigint as n_tags, p_brand || ',' || p_type as tags_text, 'it''s a ' || p_type as note from part")
def front_values(spark, d):
    parts = t(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type").repartition("p_partkey")  # a small file would be read, and parsed, by one task
    rows = parts.selectExpr("p_partkey", f"{_FRONT} as text").select("p_partkey", documents.front_values(F.col("text")).alias("m"))
    of = lambda k, kind: F.try_variant_get(F.col("m")[k], "$", kind)
    return rows.select(
        "p_partkey", F.size("m").cast("long").alias("n"), of("title", "string").alias("title"), F.size(of("tags", "array<string>")).cast("long").alias("n_tags"),
        documents.as_text(F.col("m")["tags"]).alias("tags_text"), of("note", "string").alias("note"),
    )


@query("registry_contributions", "select n_name as source, x as \"table\", case x when 'notes' then '[1,2]' else n_nationkey::varchar end as what from nation, (values ('herbs'), ('notes')) v(x) union all select n_name, 'formulas', '{\"n\":' || n_regionkey || '}' from nation")
def registry_contributions(spark, d):
    entry = "concat('{\"repo\": \"', n_name, '\", \"contributions\": {\"herbs\": ', n_nationkey, ', \"notes\": [1, 2], \"formulas\": {\"n\": ', n_regionkey, '}}}')"
    rows = t(spark, d, "nation").selectExpr(f"concat('{{\"version\": \"1\", \"sources\": [', {entry}, ', {{\"repo\": \"none\"}}]}}') as text")
    found = documents.contributions(rows)
    return found.select("source", "table", F.to_json("what").alias("what"))


@query("kb_command_search", f"""select '中药' as type, name as title, nature as info, null::varchar as detail from (select * from {_sql('herbs')} where name ilike '%1%' order by id limit 10)
 union all select '方剂', name, six_channel || ' ' || source_book, ' ' || indication from (select * from {_FORMULAS} where name ilike '%1%' or indication ilike '%1%' or composition ilike '%1%' order by id limit 10)
 union all select '医案', chief_complaint, '', '' from (select * from {_CASES} where chief_complaint ilike '%1%' order by id limit 10)""")
def kb_command_search(spark, d):
    db = with_cases(spark, d)
    db["clinical_cases"] = db["clinical_cases"].withColumns({c: F.lit(None).cast("string") for c in ("diagnosis", "herbal_rx", "inquiry")})
    return search.command_search(db, "1")


@query("kb_case_stats", "select 'total' as kind, '' as value, count(*) as n from orders union all select 'year', substr(o_orderdate::varchar, 1, 4), count(*) from orders group by 2 union all select 'gender', case o_orderkey % 3 when 1 then '男' else '女' end, count(*) from orders where o_orderkey % 3 > 0 group by 2")
def kb_case_stats(spark, d):
    cases = t(spark, d, "orders").selectExpr("cast(o_orderdate as string) as case_date", "case o_orderkey % 3 when 0 then '' when 1 then '男' else '女' end as gender")
    return search.case_stats(cases)
