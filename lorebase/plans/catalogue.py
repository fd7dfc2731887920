"""Named queries over the driver tables and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lorebase.functions.identity import canonical_json, key_of
from lorebase.functions.text import blank_to_null, like_any, list_of, markdown_html, person_name, preview, without_markup
from lorebase.operators import audit, changes, cleanup, extract, resolve, search
from lorebase.sources.tables import many_partitions, read_table, small_tasks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its equivalent."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return put


def t(spark, d, name):
    small_tasks(spark)
    many_partitions(spark, d, name)
    return read_table(spark, d, name)


def n_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


# ---- search, browsing, detail -------------------------------------------------------------

#: (tag, table, key, searched columns, name, description)
KINDS = (
    ("part", "part", "p_partkey", ["p_name", "p_type"], "p_name", "p_type"),
    ("supplier", "supplier", "s_suppkey", ["s_name"], "s_name", "s_name"),
    ("customer", "customer", "c_custkey", ["c_name", "c_mktsegment"], "c_name", "c_mktsegment"),
    ("nation", "nation", "n_nationkey", ["n_name"], "n_name", "n_name"),
    ("document", "documents", "doc_id", ["text", "source"], "source", "text"),
)


def _branches(spark, d, keyword: str, limit: int | None) -> list[DataFrame]:
    return [
        search.branch(t(spark, d, table), tag, k, fields, keyword, {"title": F.col(title), "detail": preview(F.col(body))}, key, limit)
        for k, (tag, table, key, fields, title, body) in enumerate(KINDS, 1)
    ]


def _branch_sql(keyword: str, limit: int) -> str:
    parts = [
        f"(select '{tag}' as type, {k} as type_ord, {key}::bigint as id, {title} as title, substr(coalesce({body}, ''), 1, 200) as detail from {table} "
        f"where {' or '.join(f"{f} ilike '%{keyword}%'" for f in fields)} order by {key} limit {limit})"
        for k, (tag, table, key, fields, title, body) in enumerate(KINDS, 1)
    ]
    return " union all ".join(parts)


@query("search_all", f"select * from ({_branch_sql('an', 20)}) order by type_ord, id limit 20")
def search_all(spark, d):
    return search.first_rows(_branches(spark, d, "an", 20), 20)


@query("search_per_table", f"select type, id, title || ': ' || detail as info from ({_branch_sql('on', 10)})")
def search_per_table(spark, d):
    return search.union(_branches(spark, d, "on", 10)).select("type", "id", F.concat("title", F.lit(": "), "detail").alias("info"))


@query("search_export", f'select type as "table", id, title as name, detail as description from ({_branch_sql("er", 100)})')
def search_export(spark, d):
    return search.union(_branches(spark, d, "er", 100)).select(F.col("type").alias("table"), "id", F.col("title").alias("name"), F.col("detail").alias("description"))


@query("search_wildcard", "select doc_id from documents where text ilike '%th%er on%'")
def search_wildcard(spark, d):
    return t(spark, d, "documents").where(like_any(["text"], "th%er on")).select("doc_id")


@query("search_escaped", "select page_id, url from pages where contains(url, '_')")
def search_escaped(spark, d):
    return t(spark, d, "pages").where(like_any(["url"], "_", escape=True)).select("page_id", "url")


@query("browse_page", "select * from customer where c_mktsegment ilike '%UILD%' order by c_custkey limit 30 offset 30")
def browse_page(spark, d):
    return search.browse(t(spark, d, "customer"), 2, 30, {"c_mktsegment": "UILD", "c_name": ""}, "c_custkey")


@query("browse_total", "select count(*) as total from customer where c_mktsegment ilike '%UILD%'")
def browse_total(spark, d):
    return n_rows(search.filtered(t(spark, d, "customer"), {"c_mktsegment": "UILD"}), "total")


@query("browse_clamped", "select * from part order by p_partkey limit 30")
def browse_clamped(spark, d):
    return search.browse(t(spark, d, "part"), -3, 30, None, "p_partkey")


@query("facet_values", "select distinct o_orderpriority from orders where o_orderpriority <> ''")
def facet_values(spark, d):
    return search.facet_values(t(spark, d, "orders"), "o_orderpriority")


_COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "missing")


@query("table_stats", " union all ".join(f"select '{n}' as \"table\", count(*) as n from {n}" for n in _COUNTED[:-1]) + " union all select 'missing', 0")
def table_stats(spark, d):
    return search.stats({n: t(spark, d, n) for n in _COUNTED[:-1]}, _COUNTED)


@query("detail_row", "select p_partkey, p_name, p_type, case when p_type <> '' then '<p>' || p_type || '</p>' end as p_type_html from part where p_partkey = 7")
def detail_row(spark, d):
    rows = t(spark, d, "part").where(F.col("p_partkey") == search.checked_id("7"))
    html = F.when(blank_to_null(F.col("p_type"), False).isNotNull(), F.concat(F.lit("<p>"), "p_type", F.lit("</p>")))
    return rows.select("p_partkey", "p_name", "p_type", html.alias("p_type_html"))


_REDIRECTS = "select p_partkey as old_id, min(p_partkey) over (partition by p_name) as canonical_id from part qualify p_partkey <> canonical_id"


@query("detail_redirect", f"select r.old_id, p.* from ({_REDIRECTS}) r join part p on p.p_partkey = r.canonical_id")
def detail_redirect(spark, d):
    return _part_redirects(spark, d).join(t(spark, d, "part"), F.col("canonical_id") == F.col("p_partkey")).drop("canonical_id")


def _part_redirects(spark, d):
    p = t(spark, d, "part")
    least = p.groupBy("p_name").agg(F.min("p_partkey").alias("canonical_id"))
    return p.join(least, "p_name").where("p_partkey <> canonical_id").select(F.col("p_partkey").alias("old_id"), "canonical_id")


@query("rel_forward", "select l_orderkey, p_partkey, p_name, l_quantity from lineitem join part on l_partkey = p_partkey")
def rel_forward(spark, d):
    e = t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return e.join(t(spark, d, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")).drop("l_partkey")


@query("rel_reverse_limited", "select l_partkey, l_orderkey from (select distinct l_partkey, l_orderkey from lineitem) qualify row_number() over (partition by l_partkey order by l_orderkey) <= 20")
def rel_reverse_limited(spark, d):
    return search.first_of_each(t(spark, d, "lineitem").select("l_partkey", "l_orderkey").distinct(), ["l_partkey"], ["l_orderkey"], 20)


@query("rel_three_way", "select distinct o_orderkey, o_custkey, p_name from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey order by o_orderkey, p_name limit 10")
def rel_three_way(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey")
    e = t(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(t(spark, d, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return o.join(e, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_custkey", "p_name").distinct().orderBy("o_orderkey", "p_name").limit(10)


@query("filter_optional", "select p_partkey, p_type, p_size from part where p_size = 15")
def filter_optional(spark, d):
    return search.equal_filters(t(spark, d, "part"), p_size=15, p_type=None).select("p_partkey", "p_type", "p_size").orderBy("p_type", "p_partkey")


@query("by_channel", "select s_suppkey, s_name, s_acctbal from supplier where s_nationkey = 3 order by s_acctbal, s_name")
def by_channel(spark, d):
    return t(spark, d, "supplier").where("s_nationkey = 3").select("s_suppkey", "s_name", "s_acctbal").orderBy("s_acctbal", "s_name")


@query("diagnose", "select 'nation' as kind, n_nationkey::bigint as id, n_name as name from nation where n_name ilike '%an%' union all (select 'part', p_partkey, p_name from part where p_name ilike '%an%' or p_type ilike '%an%' order by p_partkey limit 10)")
def diagnose(spark, d):
    a = t(spark, d, "nation").where(like_any(["n_name"], "an")).select(F.lit("nation").alias("kind"), F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    b = t(spark, d, "part").where(like_any(["p_name", "p_type"], "an")).orderBy("p_partkey").limit(10)
    return a.unionByName(b.select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name")))


# ---- aggregates ------------------------------------------------------------------------------


@query("count_by_year", "select substr(cast(o_orderdate as varchar), 1, 4) as year, count(*) as n from orders group by 1")
def count_by_year(spark, d):
    return search.counts(t(spark, d, "orders"), search.year_of(F.col("o_orderdate")), "year")


@query("count_by_category", "select c_mktsegment, count(*) as n from customer group by 1")
def count_by_category(spark, d):
    return search.counts(t(spark, d, "customer"), F.col("c_mktsegment"), "c_mktsegment")


@query("histogram_desc", "select event_type, count(*) as n from events group by 1 order by n desc, event_type")
def histogram_desc(spark, d):
    return search.counts(t(spark, d, "events"), F.col("event_type"), "event_type")


@query("dup_groups", "select p_name, count(*) as n from part group by 1 having count(*) >= 2")
def dup_groups(spark, d):
    return resolve.duplicate_groups(t(spark, d, "part"), "p_name")


@query("dup_groups_trim_concat", "select trim(p_name) as trimmed, min(p_name) as name, count(*) as n, string_agg(p_partkey::varchar, ',' order by p_partkey) as ids from part group by 1 having count(*) >= 2")
def dup_groups_trim_concat(spark, d):
    return audit.duplicate_names(t(spark, d, "part"), "p_name", "p_partkey")


@query("nested_dup_count", "select count(*) as n from (select l_orderkey, l_partkey, l_suppkey from lineitem group by all having count(*) > 1)")
def nested_dup_count(spark, d):
    return n_rows(t(spark, d, "lineitem").groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


@query("multi_distinct_groups", "select count(*) as n from (select l_orderkey from lineitem group by 1 having count(distinct l_returnflag) > 1)")
def multi_distinct_groups(spark, d):
    return n_rows(t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_distinct("l_returnflag").alias("n")).where("n > 1"))


def _blanked_orders(spark, d):
    return t(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("status"), F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority")).alias("priority"))


_BLANKED = "select o_orderkey, nullif(o_orderstatus, 'F') as status, case when o_orderpriority = '5-LOW' then '' else o_orderpriority end as priority from orders"


@query("blank_rates", f"with b as ({_BLANKED}) select 'status' as \"column\", count(*) filter (status is null or status = '') as blank, count(*) as total from b union all select 'priority', count(*) filter (priority is null or priority = ''), count(*) from b")
def blank_rates(spark, d):
    return audit.blank_counts(_blanked_orders(spark, d), ["status", "priority"])


@query("fill_rates", f"select sum(case when status is not null then 1 else 0 end)::bigint as status_filled, sum(case when priority <> '' then 1 else 0 end)::bigint as priority_filled from ({_BLANKED})")
def fill_rates(spark, d):
    b = _blanked_orders(spark, d)
    return b.agg(F.sum(F.when(F.col("status").isNotNull(), 1).otherwise(0)).alias("status_filled"), F.sum(F.when(F.col("priority") != "", 1).otherwise(0)).alias("priority_filled"))


@query("relation_counts", "select 'lineitem' as edge, l_partkey as id, count(*) as n from lineitem group by 2 union all select 'order', l_partkey, count(distinct l_orderkey) from lineitem group by 2")
def relation_counts(spark, d):
    e = t(spark, d, "lineitem").select(F.col("l_partkey").alias("id"), "l_orderkey")
    a = e.groupBy("id").agg(F.count(F.lit(1)).alias("n")).select(F.lit("lineitem").alias("edge"), "id", "n")
    return a.unionByName(e.groupBy("id").agg(F.count_distinct("l_orderkey").alias("n")).select(F.lit("order").alias("edge"), "id", "n"))


@query("coverage", "select count(distinct c_custkey) filter (c_custkey in (select o_custkey from orders where o_orderpriority = '1-URGENT')) as covered, count(*) as total, count(distinct c_custkey) filter (c_custkey in (select o_custkey from orders where o_orderpriority = '1-URGENT')) / count(*) as ratio from customer")
def coverage(spark, d):
    return audit.coverage(t(spark, d, "customer"), t(spark, d, "orders").where("o_orderpriority = '1-URGENT'"), "o_custkey", "c_custkey")


@query("field_variants", "select p_name, field, value, ids from (select p_name, field, value, string_agg(p_partkey::varchar, ',' order by p_partkey) as ids from (select p_name, p_partkey, 'brand' as field, p_brand as value from part union all select p_name, p_partkey, 'type', p_type from part) group by p_name, field, value) qualify count(*) over (partition by p_name, field) > 1")
def field_variants(spark, d):
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(c).alias("value")) for f, c in (("brand", "p_brand"), ("type", "p_type"))]))
    rows = t(spark, d, "part").select("p_name", "p_partkey", pairs.alias("x")).select("p_name", "p_partkey", "x.*")
    ids = F.array_join(F.array_sort(F.collect_list("p_partkey")).cast("array<string>"), ",")
    values = rows.groupBy("p_name", "field", "value").agg(ids.alias("ids"))
    return values.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("p_name", "field"))).where("n > 1").drop("n")


@query("completeness", f"select o_orderkey, ((case when status is null or status = '' then 0 else 1 end) + (case when priority = '' then 0 else 1 end))::int as fullness from ({_BLANKED})")
def completeness(spark, d):
    b = _blanked_orders(spark, d)
    return b.select("o_orderkey", resolve.fullness(b, ("o_orderkey",)).alias("fullness"))


@query("set_consistency", "select p_name, count(distinct supps)::bigint as n_sets from (select p_name, p_partkey, list_sort(list(distinct l_suppkey)) as supps from part join lineitem on l_partkey = p_partkey group by all) group by 1")
def set_consistency(spark, d):
    p = t(spark, d, "part").select("p_name", "p_partkey")
    each = t(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey").groupBy("p_partkey").agg(F.array_sort(F.collect_set("l_suppkey")).alias("supps"))
    return p.join(each, "p_partkey").groupBy("p_name").agg(F.count_distinct("supps").alias("n_sets"))


# ---- audit -------------------------------------------------------------------------------------


def _open_orders(spark, d):
    return t(spark, d, "orders").where("o_orderstatus = 'F'")


@query("orphans", "select l_orderkey, l_partkey, l_linenumber from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')")
def orphans(spark, d):
    e = t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return audit.orphans(e, "l_orderkey", _open_orders(spark, d), "o_orderkey")


@query("semi_refs", "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'F')")
def semi_refs(spark, d):
    return t(spark, d, "customer").select("c_custkey", "c_name").join(_open_orders(spark, d).select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")


def _index(spark, d):
    p = t(spark, d, "part").where("p_size > 10").select(F.lit("part").alias("entity_type"), F.col("p_partkey").alias("id"))
    return p.unionByName(t(spark, d, "supplier").where("s_acctbal > 0").select(F.lit("supplier").alias("entity_type"), F.col("s_suppkey").alias("id")))


def _evidence(spark, d):
    """Edges as evidence: part to supplier, and some of an unknown type."""
    e = t(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return e.select(
        F.when(F.col("l_partkey") % 10 == 0, "other").otherwise("part").alias("subject_type"), F.col("l_partkey").alias("subject_id"), F.lit("supplier").alias("object_type"), F.col("l_suppkey").alias("object_id"),
        F.lit("database_row").alias("source_type"), F.lit("part").alias("source_record_type"), F.when(F.col("l_partkey") % 9 == 0, "x").otherwise(F.col("l_partkey").cast("string")).alias("source_record_id"),
    )


_EV = "select distinct case when l_partkey % 10 = 0 then 'other' else 'part' end as subject_type, l_partkey as subject_id, l_suppkey as object_id, case when l_partkey % 9 = 0 then 'x' else l_partkey::varchar end as source_record_id from lineitem"
_IDX = "(select p_partkey from part where p_size > 10)"


@query("poly_refs", f"select 'subject' as side, subject_id as id, count(*) as n from ({_EV}) where subject_type = 'part' and subject_id not in {_IDX} group by all union all select 'object', object_id, count(*) from ({_EV}) where object_id not in (select s_suppkey from supplier where s_acctbal > 0) group by all")
def poly_refs(spark, d):
    parts = [audit.poly_orphans(_evidence(spark, d), _index(spark, d), s).groupBy(F.col(f"{s}_id").alias("id")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(s).alias("side"), "id", "n") for s in ("subject", "object")]
    return parts[0].unionByName(parts[1])


@query("historical_refs", f"select source_record_id, count(*) as n from ({_EV}) where try_cast(source_record_id as bigint) is null or try_cast(source_record_id as bigint) not in {_IDX} group by 1")
def historical_refs(spark, d):
    return audit.historical_sources(_evidence(spark, d), _index(spark, d)).groupBy("source_record_id").agg(F.count(F.lit(1)).alias("n"))


@query("json_validity", "select 'props' as \"column\", event_id as id from events where event_id % 4 = 0")
def json_validity(spark, d):
    e = t(spark, d, "events").select("event_id", F.when(F.col("event_id") % 4 == 0, F.concat("props", F.lit("}"))).otherwise(F.col("props")).alias("props"))
    return audit.invalid_json(e, ["props"], "event_id")


@query("json_extract", "select event_id, json_extract_string(props, '$.k')::bigint as k from events")
def json_extract(spark, d):
    return t(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("json_list_or_csv", "select p_partkey, unnest(case when p_partkey % 3 = 0 then ['x', p_brand] when p_partkey % 3 = 1 then string_split(p_name, ' ') else ['[bad'] end) as item from part")
def json_list_or_csv(spark, d):
    k = F.col("p_partkey") % 3
    text = F.when(k == 0, F.to_json(F.array(F.lit("x"), F.col("p_brand")))).when(k == 1, F.replace("p_name", F.lit(" "), F.lit(", "))).otherwise("[bad")
    return t(spark, d, "part").select("p_partkey", F.explode(list_of(text)).alias("item"))


def _dirty_parts(spark, d):
    k = F.col("p_partkey") % 6
    name = F.when(k == 0, F.concat(F.lit("> "), "p_name")).when(k == 1, F.lit("  ")).when(k == 2, F.concat("p_name", F.lit("\t"))).when(k == 3, F.concat("p_name", F.lit("汤和"), "p_brand", F.lit("丸.")))
    return t(spark, d, "part").select(F.col("p_partkey").alias("id"), name.otherwise(F.col("p_name")).alias("name"))


_DIRTY = "select p_partkey as id, case p_partkey % 6 when 0 then '> ' || p_name when 1 then '  ' when 2 then p_name || chr(9) when 3 then p_name || '汤和' || p_brand || '丸.' else p_name end as name from part"


@query("name_hard", f"select id, case when trim(name) = '' then 'empty_name' when name like '>%' then 'blockquote' when contains(name, chr(9)) then 'control_char' end as rule from ({_DIRTY}) where rule is not null")
def name_hard(spark, d):
    return audit.name_findings(_dirty_parts(spark, d)).where("level = 'hard'").select("id", "rule")


@query("name_warn", f"select id, unnest(['descriptive', 'multi_entity']) as rule from ({_DIRTY}) where id % 6 = 3")
def name_warn(spark, d):
    return audit.name_findings(_dirty_parts(spark, d)).where("level = 'soft'").select("id", "rule")


@query("constraint_violations", "select 'key:l_orderkey,l_linenumber' as rule, (select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)) as n union all select 'enum:l_returnflag', count(*) filter (l_returnflag not in ('A', 'N')) from lineitem union all select 'range:l_discount', count(*) filter (l_discount not between 0 and 0.05) from lineitem union all select 'not_null:l_partkey', count(*) filter (l_partkey is null) from lineitem")
def constraint_violations(spark, d):
    return audit.constraint_violations(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey"], {"l_returnflag": ("A", "N")}, {"l_discount": (0, 0.05)})


@query("source_key_check", "with c as (select case when doc_id % 5 = 0 then '' else source end as raw_path, lang as patient_id, text as chief_complaint from documents) select 'blank_raw_path' as metric, count(*) filter (raw_path = '') as n from c union all select 'dup_raw_path', count(*) from (select 1 from c group by raw_path having count(*) > 1) union all select 'dup_patient_id', count(*) from (select 1 from c group by patient_id having count(*) > 1) union all select 'dup_combined', count(*) from (select raw_path, patient_id, chief_complaint from c group by all having count(*) > 1) union all select 'multi_case_files', count(*) from (select 1 from c where raw_path <> '' group by raw_path having count(distinct chief_complaint) > 1)")
def source_key_check(spark, d):
    docs = t(spark, d, "documents")
    cases = docs.select(F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.col("source")).alias("raw_path"), F.col("lang").alias("patient_id"), F.col("text").alias("chief_complaint"))
    return audit.source_keys(cases)


# ---- duplicates, evidence, redirects ----------------------------------------------------------


def _formula_parts(spark, d):
    """Parts as formulas with blanks in two fields."""
    p = t(spark, d, "part")
    return p.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.when(F.col("p_size") > 40, F.col("p_brand")).alias("six_channel"), F.when(F.col("p_size") % 2 == 0, "primary").otherwise("secondary").alias("source_repo"),
        F.when(F.col("p_size") % 3 == 0, F.col("p_type")).alias("chapter"), F.when(F.col("p_size") % 5 == 0, F.col("p_brand")).otherwise("").alias("dosage"), F.lit("").alias("raw_path"),
    )


_FORMULA = """select p_partkey as id, p_name as name, case when p_size > 40 then p_brand end as six_channel, case when p_size % 2 = 0 then 'primary' else 'secondary' end as source_repo,
 case when p_size % 3 = 0 then p_type end as chapter, case when p_size % 5 = 0 then p_brand else '' end as dosage from part"""
_TIERED = f"""select *, case when six_channel is not null and source_repo = 'primary' then 0 when six_channel is not null then 1 else 2 end as tier,
 (six_channel is not null)::int + (chapter is not null)::int + (dosage <> '')::int as fullness, case source_repo when 'primary' then 0 else 1 end as rnk from ({_FORMULA})"""
_CANON = f"""select name, id, first_value(id) over (partition by name order by tier, case when tier = 2 then -fullness else 0 end, case when tier = 2 then rnk else 0 end, id) as canonical_id, six_channel, chapter, dosage
 from ({_TIERED}) qualify count(*) over (partition by name) >= 2"""


@query("canonical_pick", f"select name, canonical_id, id from ({_CANON})")
def canonical_pick(spark, d):
    return resolve.canonical_rows(_formula_parts(spark, d))


_LONG = f"""select name, id, canonical_id, f.field, nullif(trim(f.value), '') as value from ({_CANON}) c, lateral (values ('chapter', c.chapter), ('dosage', c.dosage), ('six_channel', c.six_channel)) f(field, value)"""
_MERGED = f"""with l as ({_LONG}), b as (select o.canonical_id, o.id, o.field, o.value, k.value as kept from l o join l k on k.id = o.canonical_id and k.field = o.field where o.id <> o.canonical_id and o.value is not null),
 f as (select canonical_id, field, min(value) as value from b where kept is null group by 1, 2 having count(distinct value) = 1)"""


@query("field_merge_fill", f"{_MERGED} select * from f")
def field_merge_fill(spark, d):
    df = _formula_parts(spark, d)
    return resolve.merged_fields(df, resolve.canonical_rows(df), ("chapter", "dosage", "six_channel"))[0]


@query("field_merge_evidence", f"{_MERGED} select b.canonical_id, b.id, b.field, b.value, b.kept from b left join f on f.canonical_id = b.canonical_id and f.field = b.field where f.field is null and (b.kept is null or b.kept <> b.value)")
def field_merge_evidence(spark, d):
    df = _formula_parts(spark, d)
    return resolve.merged_fields(df, resolve.canonical_rows(df), ("chapter", "dosage", "six_channel"))[1]


@query("fk_repoint", f"select distinct l_orderkey, coalesce(c.canonical_id, l_partkey) as l_partkey from lineitem left join ({_CANON}) c on c.id = l_partkey")
def fk_repoint(spark, d):
    edge = t(spark, d, "lineitem").select("l_orderkey", "l_partkey").distinct()
    return resolve.repoint(edge, "l_partkey", resolve.canonical_rows(_formula_parts(spark, d)), ["l_orderkey", "l_partkey"])


@query("repoint_reconcile", f"select distinct canonical_id, true as same from ({_CANON}) where canonical_id in (select c.canonical_id from ({_CANON}) c join lineitem on l_partkey = c.id)")
def repoint_reconcile(spark, d):
    groups = resolve.canonical_rows(_formula_parts(spark, d))
    edge = t(spark, d, "lineitem").select("l_orderkey", "l_partkey").distinct()
    return resolve.reconciled(edge, resolve.repoint(edge, "l_partkey", groups, ["l_orderkey", "l_partkey"]), "l_partkey", "l_orderkey", groups)


@query("merged_from_evidence", f"select canonical_id as subject_id, id::varchar as source_record_id, '原formula_id=' || id || '已合并入canonical ' || canonical_id as evidence_text from ({_CANON}) where id <> canonical_id")
def merged_from_evidence(spark, d):
    parts = _formula_parts(spark, d)
    return resolve.merged_from(resolve.canonical_rows(parts), parts).select("subject_id", "source_record_id", "evidence_text")


@query("dedupe_key", """select p_partkey, sha256('["formula",' || p_partkey::varchar || ',' || case when p_size > 25 then '"' || p_brand || '"' else 'null' end || ',""]') as dedupe_key from part""")
def dedupe_key(spark, d):
    parts = [(F.lit("formula"), False), (F.col("p_partkey"), True), (F.when(F.col("p_size") > 25, F.col("p_brand")), False), (F.lit(""), False)]
    return t(spark, d, "part").select("p_partkey", key_of(parts).alias("dedupe_key"))


@query("evidence_collision", f"select canonical_id, p_brand, count(distinct p_type) as n from ({_CANON}) c join part on p_partkey = c.id group by all having count(distinct p_type) > 1")
def evidence_collision(spark, d):
    groups = resolve.canonical_rows(_formula_parts(spark, d)).select("canonical_id", "id")
    rows = t(spark, d, "part").join(groups, F.col("p_partkey") == F.col("id"))
    return rows.groupBy("canonical_id", "p_brand").agg(F.count_distinct("p_type").alias("n")).where("n > 1")


def _redirect_evidence(spark, d, least: int = 1):
    e = t(spark, d, "events").select(
        F.col("event_id").alias("id"), F.lit("merged_from").alias("relation_type"), F.lit("formula").alias("subject_type"), (F.col("user_id") % 50 + 1).alias("subject_id"),
        F.when(F.col("event_id") % 11 == 0, "x").otherwise((F.col("event_id") % 97 + least).cast("string")).alias("source_record_id"),
    )
    return e


_REDIR = "select event_id % 97 + 1 as old_id, arg_min(user_id % 50 + 1, event_id) as canonical_id, count(distinct user_id % 50 + 1) as n_canonical from events where event_id % 11 <> 0 group by 1"


@query("redirect_map", f"select old_id, canonical_id from ({_REDIR})")
def redirect_map(spark, d):
    return resolve.redirect_map(_redirect_evidence(spark, d)).select("old_id", "canonical_id")


@query("redirect_conflicts", f"select old_id, n_canonical from ({_REDIR}) where n_canonical > 1")
def redirect_conflicts(spark, d):
    return resolve.redirect_map(_redirect_evidence(spark, d)).where("n_canonical > 1").select("old_id", "n_canonical")


_REDIR_SHIFTED = _REDIR.replace("event_id % 97 + 1", "event_id % 97 + 31")


@query("redirect_cycles", f"with r as ({_REDIR_SHIFTED}) select old_id, canonical_id from r where canonical_id not in (select old_id from r)")
def redirect_cycles(spark, d):
    return resolve.resolvable(resolve.redirect_map(_redirect_evidence(spark, d, 31))).select("old_id", "canonical_id")


@query("risk_label", "select p_name, case when count(distinct p_type) > 20 or max(p_size) > 49 then 'red' when count(*) filter (p_size > 25) > 5 or count(distinct p_brand) > 2 or count(*) > 20 then 'yellow' else 'green' end as risk from part group by 1")
def risk_label(spark, d):
    g = t(spark, d, "part").groupBy("p_name").agg(F.count_distinct("p_type").alias("types"), F.max("p_size").alias("top"), F.count(F.when(F.col("p_size") > 25, 1)).alias("links"), F.count_distinct("p_brand").alias("brands"), F.count(F.lit(1)).alias("n"))
    return g.select("p_name", resolve.risk(F.col("types") > 20, F.col("top") > 49, F.col("links"), F.col("brands"), F.col("n")).alias("risk"))


# ---- changes -----------------------------------------------------------------------------------


@query("insert_ignore", "select * from (select c_custkey % 1000 as id, c_name from customer where c_custkey % 2 = 0 and c_custkey < 1000 union all select id, arg_min(c_name, c_custkey) from (select c_custkey % 1000 as id, c_name, c_custkey from customer where not (c_custkey % 2 = 0 and c_custkey < 1000)) n where id not in (select c_custkey from customer where c_custkey % 2 = 0 and c_custkey < 1000) group by id)")
def insert_ignore(spark, d):
    c = t(spark, d, "customer").select((F.col("c_custkey") % 1000).alias("id"), "c_name", "c_custkey")
    there = (F.col("c_custkey") % 2 == 0) & (F.col("c_custkey") < 1000)
    return changes.insert_ignore(c.where(there), c.where(~there), ["id"], ["c_custkey"]).select("id", "c_name")


@query("upsert", "select c_custkey, c_name, case when c_custkey % 3 = 0 and c_custkey % 2 = 0 then 'moved' when c_custkey % 2 = 0 then c_mktsegment else 'moved' end as c_mktsegment from customer where c_custkey % 2 = 0 or c_custkey % 3 = 0")
def upsert(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return changes.upsert(c.where("c_custkey % 2 = 0"), c.where("c_custkey % 3 = 0").withColumn("c_mktsegment", F.lit("moved")), ["c_custkey"], ["c_mktsegment"])


@query("patch_nonblank", "select c_custkey, case when c_custkey % 4 = 0 then 'new' else c_name end as c_name from customer")
def patch_nonblank(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_name")
    new = c.where("c_custkey % 2 = 0").withColumn("c_name", F.when(F.col("c_custkey") % 4 == 0, "new").otherwise(""))
    return changes.patch(c, new, "c_custkey", ["c_name"])


@query("patch_null_only", "select c_custkey, case when c_custkey % 4 = 0 then '' else c_name end as c_name from customer")
def patch_null_only(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_name")
    new = c.where("c_custkey % 2 = 0").withColumn("c_name", F.when(F.col("c_custkey") % 4 == 0, ""))
    return changes.patch(c, new, "c_custkey", ["c_name"], blank_is_missing=False)


@query("delete_ids", "select o_orderkey from orders where o_custkey not in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def delete_ids(spark, d):
    gone = t(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return changes.delete(t(spark, d, "orders"), gone, "o_custkey").select("o_orderkey")


@query("append_with_ids", "select row_number() over (order by n_name) + (select max(s_suppkey) from supplier) as s_suppkey, n_name as s_name from nation union all select s_suppkey, s_name from supplier")
def append_with_ids(spark, d):
    old = t(spark, d, "supplier").select("s_suppkey", "s_name")
    return changes.append_with_ids(old, t(spark, d, "nation").select(F.col("n_name").alias("s_name")), ["s_name"], "s_suppkey")


@query("set_diff", "select c_custkey, 'before' as side from customer where c_custkey % 2 = 0 and c_custkey % 3 <> 0 union all select c_custkey, 'after' from customer where c_custkey % 2 <> 0 and c_custkey % 3 = 0")
def set_diff(spark, d):
    c = t(spark, d, "customer").select("c_custkey")
    return changes.differences(c.where("c_custkey % 2 = 0"), c.where("c_custkey % 3 = 0"), ["c_custkey"])


# ---- cleanup --------------------------------------------------------------------------------------


def _cleanable(spark, d):
    k = F.col("p_partkey") % 6
    dirty = F.when(k == 0, F.concat(F.lit("> "), "p_name")).when(k == 1, F.concat(F.lit("> "), "p_name", F.lit("的"))).when(k == 2, F.concat(F.lit("> "), "p_name", F.lit("汤、丸"))).when(k == 3, F.concat(F.lit("> "), "p_name", F.lit("?")))
    return t(spark, d, "part").select((F.col("p_partkey") + 1000).alias("id"), dirty.when(k == 4, F.concat(F.lit("> none"), F.col("p_partkey").cast("string"))).otherwise(F.col("p_name")).alias("name"))


_CLEANABLE = "select p_partkey + 1000 as id, case p_partkey % 6 when 0 then '> ' || p_name when 1 then '> ' || p_name || '的' when 2 then '> ' || p_name || '汤、丸' when 3 then '> ' || p_name || '?' when 4 then '> none' || p_partkey else p_name end as name from part"
_CLASSED = f"with c as ({_CLEANABLE}) select id, name, substr(name, 3) as cleaned, case when id % 6 = 1007 % 6 or (id - 1000) % 6 in (1, 3) then 'B' when (id - 1000) % 6 = 2 then 'C' when substr(name, 3) in (select name from c where name not like '> %') then 'A' else 'ambiguous' end as class from c where name like '> %'".replace("id % 6 = 1007 % 6 or ", "")


@query("cleanup_classify", f"select id, cleaned, class from ({_CLASSED})")
def cleanup_classify(spark, d):
    return cleanup.classified(_cleanable(spark, d)).select("id", "cleaned", "class")


@query("quarantine_rows", f"select id as source_record_id, name as original_name, cleaned as cleaned_name, case class when 'B' then 'descriptive_non_entity' when 'C' then 'multiple_entities' else 'ambiguous_name' end as reason_code from ({_CLASSED}) where class <> 'A'")
def quarantine_rows(spark, d):
    return cleanup.clean(_cleanable(spark, d))[1].select("source_record_id", "original_name", "cleaned_name", "reason_code")


@query("conservation", f"select (select count(*) from part) as before, (select count(*) from part) - (select count(*) from ({_CLASSED}) where class <> 'A') as after, (select count(*) from ({_CLASSED}) where class <> 'A') as held, true as ok")
def conservation(spark, d):
    df = _cleanable(spark, d)
    after, held, _ = cleanup.clean(df)
    return cleanup.conserved(df, after, held)


# ---- text and extraction -----------------------------------------------------------------------


@query("extract_tokens", "select p_partkey, unnest(list_distinct(string_split(p_name, ' '))) as token from part")
def extract_tokens(spark, d):
    return t(spark, d, "part").select("p_partkey", F.explode(F.array_distinct(F.split("p_name", " "))).alias("token"))


@query("extract_patterns", "select doc_id, unnest(list_distinct(regexp_extract_all(text, '([a-z]{2,6}tion)', 1))) as token from documents")
def extract_patterns(spark, d):
    return t(spark, d, "documents").select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("([a-z]{2,6}tion)"), F.lit(1)))).alias("token"))


@query("normalize_name", "select c_custkey, trim(regexp_replace(regexp_replace(lower(c_name || ', Jr.-X'), '[,.\\-'']', ' ', 'g'), '\\s+', ' ', 'g')) as name from customer".replace("\\\\", "\\"))
def normalize_name(spark, d):
    return t(spark, d, "customer").select("c_custkey", person_name(F.concat("c_name", F.lit(", Jr.-X"))).alias("name"))


@query("strip_html", "select page_id, length(trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '\\*\\*', '', 'g'), chr(32) || chr(9) || chr(10) || chr(13)))::bigint as n from pages".replace("\\\\", "\\"))
def strip_html(spark, d):
    return t(spark, d, "pages").select("page_id", F.length(without_markup(F.col("html"))).cast("long").alias("n"))


_TOKENS = "select distinct unnest(regexp_extract_all(lower(text), '[a-z]{4,12}')) as token from documents where doc_id >= 0"


def _document_tokens(spark, d):
    return t(spark, d, "documents").select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,12}"), F.lit(0)))).alias("token")).distinct()


_NATION = "select lower(n_name) as name, min(n_nationkey) as ord, max(n_nationkey) as id from nation group by 1 union all select substr(lower(n_name), 1, 3), 100 + min(n_nationkey), 100 + max(n_nationkey) from nation group by 1"


def _names(spark, d):
    n = t(spark, d, "nation").select(F.lower("n_name").alias("name"), F.col("n_nationkey").alias("id"))
    return extract.entity_names(n).unionByName(extract.entity_names(n.select(F.substring("name", 1, 3).alias("name"), (F.col("id") + 100).alias("id"))))


@query("fuzzy_match", f"select token, arg_min(id, ord) as id from ({_TOKENS}) t join ({_NATION}) n on contains(n.name, t.token) or contains(t.token, n.name) group by 1")
def fuzzy_match(spark, d):
    return extract.match_tokens(_document_tokens(spark, d), _names(spark, d), exact=False)


@query("fuzzy_match_priority", f"select token, arg_min(id, case when name = token then -1 else ord end) as id from (select token || case when hash(token) >= 0 then '' end as token from ({_TOKENS}) union select lower(n_name) from nation) t join ({_NATION}) n on contains(n.name, t.token) or contains(t.token, n.name) group by 1".replace("token || case when hash(token) >= 0 then '' end as token", "token"))
def fuzzy_match_priority(spark, d):
    tokens = _document_tokens(spark, d).union(t(spark, d, "nation").select(F.lower("n_name")))
    return extract.match_tokens(tokens, _names(spark, d))


@query("classify_keywords", "select p_partkey, case when contains(lower(p_name || ' ' || p_type), 'steel') or contains(lower(p_name || ' ' || p_type), 'tin') then 'metal' when contains(lower(p_name || ' ' || p_type), 'small') then 'small' else 'other' end as category from part")
def classify_keywords(spark, d):
    text = F.lower(F.concat_ws(" ", "p_name", "p_type"))
    has = lambda *w: reduce(Column.__or__, [text.contains(x) for x in w])
    return t(spark, d, "part").select("p_partkey", F.when(has("steel", "tin"), "metal").when(has("small"), "small").otherwise("other").alias("category"))


@query("markdown_html", "select p_partkey, '<strong>' || p_name || '</strong><br><h2 style=\"margin:20px 0 10px;\">' || p_brand || '</h2>' as html from part")
def markdown(spark, d):
    return t(spark, d, "part").select("p_partkey", markdown_html(F.concat(F.lit("**"), "p_name", F.lit("**\n# "), "p_brand")).alias("html"))


@query("canonical_json", """select p_partkey, '[' || p_partkey || ',"' || p_brand || '",null]' as json from part""")
def canonical(spark, d):
    return t(spark, d, "part").select("p_partkey", canonical_json([(F.col("p_partkey"), True), (F.col("p_brand"), False), (F.lit(None).cast("string"), False)]).alias("json"))


# ---- chains -----------------------------------------------------------------------------------------


@query("reason_chain", "select r_name, n_name, count(distinct s_suppkey) as suppliers, count(distinct l_partkey) as parts, count(*) as links from region join nation on n_regionkey = r_regionkey join supplier on s_nationkey = n_nationkey join lineitem on l_suppkey = s_suppkey group by all")
def reason_chain(spark, d):
    places = t(spark, d, "region").join(t(spark, d, "nation"), F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "n_name", "n_nationkey")
    s = t(spark, d, "supplier").select("s_suppkey", "s_nationkey").join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    e = t(spark, d, "lineitem").select("l_suppkey", "l_partkey").join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return e.groupBy("r_name", "n_name").agg(F.count_distinct("s_suppkey").alias("suppliers"), F.count_distinct("l_partkey").alias("parts"), F.count(F.lit(1)).alias("links"))


@query("reason_coverage", "select n_name, count(distinct c_custkey) as customers, count(distinct o_custkey) as with_orders from nation join customer on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey and o_orderstatus = 'F' group by 1")
def reason_coverage(spark, d):
    c = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "c_custkey")
    have = _open_orders(spark, d).select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("hit", F.lit(True))
    return c.join(have, "c_custkey", "left").groupBy("n_name").agg(F.count("c_custkey").alias("customers"), F.count("hit").alias("with_orders"))
