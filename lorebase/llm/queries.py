"""The numbered queries over the driver tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

import public_tokenizers
from lorebase.llm import bpe, decontaminate, jaccard_join, language_id, phrases, pii, quality, ranked_search, secrets, sharding, top_k, toxicity, url_filter
from lorebase.sources.tables import read_table

QUERIES, ORACLES = {}, {}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_language_id(spark, d):
    docs = read_table(spark, d, "documents")
    model = language_id.train(docs.where(~language_id.held_out()))
    return language_id.identify(docs, *model)


@query
def op2_jaccard_join(spark, d):
    return jaccard_join.jaccard_components(read_table(spark, d, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op3_url_filter(spark, d):
    return url_filter.filter_urls(read_table(spark, d, "pages"), url_filter.listed_frame(spark)).drop("listed")


@query
def op4_pii(spark, d):
    # the tables are invented; a real run takes its key from a store of secrets
    return pii.pseudonymise(read_table(spark, d, "documents").select("doc_id", "text"), spark.conf.get("lorebase.pii.key", "key of the invented tables"))


@query
def op5_quality(spark, d):
    return quality.classify(read_table(spark, d, "documents"), read_table(spark, d, "labels"))


@query
def op6_sharding(spark, d):
    return sharding.shard_rows(read_table(spark, d, "documents"))


@query
def op7_decontaminate(spark, d):
    return decontaminate.decontaminate(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"))


@query
def op8_bpe(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    return bpe.encode(docs, VOCABULARY, outputs=("n_tokens", "ids_sha256", "decoded_sha256"), keep_text=False)


@query
def op9_top_k(spark, d):
    return top_k.top_k(read_table(spark, d, "embeddings"))


@query
def op10_secrets(spark, d):
    return secrets.secret_report(read_table(spark, d, "documents"))


@query
def op11_ranked_search(spark, d):
    return ranked_search.search(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"))


@query
def op12_phrases(spark, d):
    return phrases.collocations(read_table(spark, d, "documents"))


@query
def op13_toxicity(spark, d):
    return toxicity.classify(read_table(spark, d, "documents"), read_table(spark, d, "labels"))


_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES["op2_jaccard_join"] = f"""
with recursive d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_FOLD}), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
 s as (select distinct doc_id, unnest(case when len(w) = 0 then []::varchar[] when len(w) < 5 then [array_to_string(w, ' ')] else [array_to_string(w[i:i+4], ' ') for i in range(1, len(w) - 3)] end) as x from d),
 n as (select doc_id, count(*) as n from s group by 1),
 p as (select a.doc_id as a, b.doc_id as b, count(*) as i from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
 l as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * i >= 75 * (na.n + nb.n - i)),
 e as (select a, b from l union all select b, a from l),
 r(a, b) as (select doc_id, doc_id from d union select r.a, e.b from r join e on e.a = r.b)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, min(r.b) as component_id from d left join n on n.doc_id = d.doc_id join r on r.a = d.doc_id group by d.doc_id, n.n"""

def _rule_sql(part: str) -> str:
    ordered = sorted(url_filter.RULES, key=lambda r: -len(r[1]) - len(r[2]))
    return " ".join(f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{h + p if part == 'rule' else action}'" for action, h, p in ordered)


_SITES = " or ".join(f"site = '{e[:-1]}' or ends_with(site, '.{e[:-1]}')" for e in url_filter.LISTED)

ORACLES["op3_url_filter"] = f"""
with u as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
 p as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_FOLD}) as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
 q as (select *, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', '', 's'), ':[0-9]*$', ''), '[.]+$', '') as site from p)
select page_id, host, path, case {_rule_sql("rule")} end as rule, case {_rule_sql("action")} when {_SITES} then 'block' else 'allow' end as verdict from q"""

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_FOLD}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES["op7_decontaminate"] = f"""
with d as (select doc_id, {_WORDS} as w from documents),
 i as (select row_number() over () as item, item_id, {_WORDS} as w from benchmark),
 v as (select distinct item, item_id, least(10, len(w)) as n, unnest([array_to_string(w[s:s + least(10, len(w)) - 1], ' ') for s in range(1, len(w) - least(10, len(w)) + 2)]) as x from i where len(w) > 0),
 f as (select doc_id, n, unnest(range(1, greatest(1, len(w) - n + 2))) as s, w from d, (select distinct n from v)),
 h as (select f.doc_id, f.s, f.n, v.item, v.item_id from f join v on v.n = f.n and v.x = array_to_string(f.w[f.s:f.s + f.n - 1], ' ')),
 c as (select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(s, s + n)) as pos from h) group by 1),
 k as (select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids from (select distinct doc_id, item, item_id from h) group by 1)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (doc_id) left join k using (doc_id)"""

ORACLES["op9_top_k"] = """
with v as (select vec_id, [floor(64 * x::double) for x in embedding] as v from embeddings where embedding is not null and len([1 for x in embedding if x is null or not isfinite(x)]) = 0),
 s as (select a.vec_id as query_id, b.vec_id, list_inner_product(a.v, b.v)::bigint as score from v a join v b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id)
select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score from s qualify rank <= 20"""

_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), {_FOLD}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

ORACLES["op11_ranked_search"] = f"""
with d as (select row_number() over () as u, doc_id, {_TERMS} as t from documents),
 c as (select count(*)::bigint as n_docs, sum(len(t))::bigint as total from d where len(t) > 0),
 q as (select i, item_id, term, count(*) as times from (select row_number() over () as i, item_id, unnest({_TERMS}) as term from benchmark) group by all),
 p as (select u, doc_id, n, term, count(*)::bigint as tf from (select u, doc_id, len(t) as n, unnest(t) as term from d) where term in (select term from q) group by all),
 w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from p, c group by term, n_docs),
 s as (select i, item_id, u, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // total))))::bigint as score
  from q join p using (term) join w using (term), c group by all)
select item_id, (row_number() over (partition by i order by score desc, doc_id, u))::int as rank, doc_id, score from s where score > 0 qualify rank <= 10"""

ORACLES["op12_phrases"] = f"""
with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {_FOLD}), '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
 v as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from p),
 t as (select lang, sum(len(w))::bigint as n from v group by lang),
 f as (select lang, x, count(*)::bigint as a from (select lang, unnest([array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)]) as x from v, (select unnest([1, 2, 3, 4]) as k) where len(w) >= k)
  group by all having count(*) >= 30),
 c as (select lang, x as phrase, a, string_split(x, ' ') as w from f where contains(x, ' ')),
 u as (select lang, phrase, a, w, unnest(range(1, len(w))) as k from c),
 s as (select u.lang, phrase, u.a, k, l.a as l, r.a as r, ((2000000::hugeint * u.a) // (l.a + r.a))::bigint as score
  from u join f l on l.lang = u.lang and l.x = array_to_string(w[1:k], ' ') join f r on r.lang = u.lang and r.x = array_to_string(w[k + 1:], ' ')),
 b as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
 i as (select lang, sub as phrase, max(a) as most from (select lang, a, unnest([array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)]) as sub from c, (select unnest([2, 3]) as k) where len(w) > k) group by all)
select b.lang, row_number() over (partition by b.lang order by score desc, b.a desc, b.phrase) as rank, b.phrase, b.a, l, r, n, score
from b join t on t.lang = b.lang left join i on i.lang = b.lang and i.phrase = b.phrase where most is null or 100::hugeint * most < 80 * b.a qualify rank <= 2000"""
