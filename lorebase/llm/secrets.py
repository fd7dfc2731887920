"""Secret scan with corpus-wide ownership frequency, in DataFrame operations only.

Base kinds: assign, access and hex. The method adds kind ``blob``: runs of
``[A-Za-z0-9+/_-]`` of 20+ characters holding an upper-case letter, a lower-case
letter and a digit, outside all base spans. Every candidate's value is hashed and
the hashes are aggregated over the corpus by distinct owners (``source``) and by
distinct repositories (what ``repository`` gives, else each different text). A value
of more than ``max_owners`` owners or ``max_repositories`` repositories is a widely
copied example; any other is owner-specific and looks live. Blobs are reported only
if they look live; base spans are always reported.

Offsets: the matches split the text into gaps; running sums of gaps and matches, in
code points, over the exploded matches of a row are the positions. So work grows in
proportion to text and matches, also within one long text.

Defined results. Null or empty text has no spans. Null owner counts as an owner of
its own, and so does a null repository. Repeated rows each get their spans; one row's
spans never depend on which copy is read. Ties (same start) go in the order assign,
access, hex, blob. An empty table gives an empty result. Extra columns are ignored by
``secret_report`` and kept by ``mask_secrets``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lorebase.sources.tables import materialise

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: In the order in which spans of equal start are listed: kind, pattern, group that is the value, least length of it.
KINDS = (
    ("assign", ASSIGN, 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
    ("blob", r"[A-Za-z0-9+/_-]{20,}", 0, 20),
)
BASE = 3
MAX_OWNERS, MAX_REPOSITORIES = 2, 20
#: Rows with spans that may be broadcast, some 100 MB; beyond, a shuffled join.
MAX_BROADCAST_ROWS = 300_000
#: Code points of a text that are masked at once.
MASK_CHARS = 4096


def _matches(text: Column, kind: int) -> Column:
    """Array of (kind, i, gap, n, value): all matches in order, with the text before each; the value's hash if it is long enough."""
    name, pattern, group, least = KINDS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    ok = lambda v: F.char_length(v) >= least
    if name == "blob":
        ok = lambda v: (F.char_length(v) >= least) & v.rlike("[A-Z]") & v.rlike("[a-z]") & v.rlike("[0-9]")
    made = F.transform(
        F.arrays_zip(F.split(text, pattern, -1).alias("g"), found.alias("m"), values.alias("v")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.char_length(x["g"]).alias("gap"),
            F.char_length(x["m"]).alias("n"),
            F.when(ok(x["v"]), F.sha2(x["v"], 256)).alias("value"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,n:int,value:string>>")
    # the last gap has no match
    return F.when(text.rlike(pattern), F.filter(made, lambda x: x["n"].isNotNull())).otherwise(none)


def candidates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", owner: str = "source", repository: str | None = None) -> DataFrame:
    """One row per document row: uid, doc_id, owner, repository and its matches; written once."""
    t = F.coalesce(F.col(text), F.lit(""))
    repo = F.xxhash64(text).cast("string") if repository is None else F.col(repository).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(owner).cast("string").alias("owner"), repo.alias("repository"), t.alias("t"))
    found = F.concat(*[_matches(F.col("t"), k) for k in range(len(KINDS))])
    rows = rows.select("doc_id", "owner", "repository", found.alias("matches"))
    return materialise(rows.withColumn("uid", F.monotonically_increasing_id()), "matches")


def spans_of(rows: DataFrame) -> DataFrame:
    """(uid, owner, repository, start, kind, end, value): base spans, and blobs that meet none; written once."""
    each = rows.where(F.size("matches") > 0).select("uid", "owner", "repository", F.explode("matches").alias("m")).select("uid", "owner", "repository", "m.*")
    upto = Window.partitionBy("uid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # dealt out by row once; both windows use that
    each = each.repartition("uid").withColumn("end", F.sum(F.col("gap") + F.col("n")).over(upto).cast("int"))
    each = each.where("value is not null").withColumn("start", F.col("end") - F.col("n"))
    order = Window.partitionBy("uid").orderBy("start", "kind")
    base = F.col("kind") < BASE
    before = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    # backwards, as a frame up to the last row would be read anew for every row
    back = Window.partitionBy("uid").orderBy(F.desc("start"), F.desc("kind"))
    after = F.min(F.when(base, F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
    each = each.withColumns({"before": before, "after": after})
    apart = (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.col("after").isNull() | (F.col("after") >= F.col("end")))
    return materialise(each.where(base | apart).select("uid", "owner", "repository", "start", "kind", "end", "value"), "spans")


def ownership(spans: DataFrame) -> DataFrame:
    """value -> n_owners, n_repositories over the whole corpus."""
    tag = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    return spans.groupBy("value").agg(F.count_distinct(tag("owner")).alias("n_owners"), F.count_distinct(tag("repository")).alias("n_repositories"))


def judged(spans: DataFrame, max_owners: int, max_repositories: int) -> DataFrame:
    """The spans with ``live``, without blobs that are examples."""
    examples = ownership(spans).where((F.col("n_owners") > max_owners) | (F.col("n_repositories") > max_repositories))
    examples = materialise(examples.select("value", F.lit(False).alias("live")), "examples")
    small = examples.count() <= MAX_BROADCAST_ROWS
    out = spans.join(F.broadcast(examples) if small else examples, "value", "left").withColumn("live", F.coalesce("live", F.lit(True)))
    return out.where((F.col("kind") < BASE) | F.col("live"))


def scan(
    docs: DataFrame, max_owners: int = MAX_OWNERS, id_col: str = "doc_id", text: str = "text", owner: str = "source",
    repository: str | None = None, max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """doc_id, found (all spans in order, each start, kind, end, value, live), uid for every row."""
    rows = candidates(docs, id_col, text, owner, repository)
    spans = judged(spans_of(rows), max_owners, max_repositories)
    found = spans.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "value", "live"))).alias("found"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string,live:boolean>>")
    return rows.join(found, "uid", "left").select("doc_id", F.coalesce("found", none).alias("found"), "uid")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(name) for name, *_ in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def secret_report(docs: DataFrame, **options) -> DataFrame:
    rows = scan(docs, **options)
    base = F.filter("found", lambda s: s["kind"] < BASE)
    of = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        "doc_id",
        of(0).alias("n_assign"),
        of(1).alias("n_access"),
        of(2).alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("found", lambda s: ~s["live"])).cast("long").alias("n_example"),
    )


MASK = "[SECRET]"


def masked(text: Column, runs: Column) -> Column:
    """The text with each of the sorted, disjoint runs (start, end) replaced by MASK.

    It is cut into pieces of MASK_CHARS, so that no step reads the text from its beginning.
    """
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{MASK_CHARS}}}"), F.lit(0))
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def piece(p: Column, k: Column) -> Column:
        low, n = k * MASK_CHARS, F.char_length(p)
        here = F.filter(runs, lambda s: (s["start"] < low + MASK_CHARS) & (s["end"] > low))
        step = lambda a, s: F.struct(
            F.concat(
                a["out"], F.substring(p, a["at"] + 1, F.greatest(F.lit(0), s["start"] - low - a["at"])), F.when(s["start"] >= low, MASK).otherwise("")
            ).alias("out"),
            F.least(n, s["end"] - low).alias("at"),
        )
        return F.when(F.size(here) == 0, p).otherwise(F.aggregate(here, zero, step, lambda a: F.concat(a["out"], F.substring(p, a["at"] + 1, n))))

    return F.array_join(F.transform(pieces, piece), "")


def live_runs(spans: DataFrame) -> DataFrame:
    """(uid, runs): overlapping live spans of a row as one (start, end), in order."""
    order = Window.partitionBy("uid").orderBy("start", "kind", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") >= F.col("before"), F.lit(True)).cast("int")
    rows = spans.where("live").withColumn("before", before)
    rows = rows.withColumn("run", F.sum(opens).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.groupBy("uid", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return rows.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"))


def mask_secrets(
    docs: DataFrame, max_owners: int = MAX_OWNERS, id_col: str = "doc_id", text: str = "text", owner: str = "source",
    repository: str | None = None, max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """``docs`` with live-looking secrets masked; widely copied examples stay. All rows and columns stay.

    The rows that have live spans are found by id and text hash, and broadcast if they are few.
    """
    names = docs.columns
    at = {c: f"c{names.index(c)}" for c in (id_col, text, owner, *([repository] if repository else []))}
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    key = F.struct(F.col(at[id_col]).alias("i"), F.xxhash64(at[text]).alias("h"))
    rows = candidates(plain.withColumn("key", key), "key", at[text], at[owner], repository and at[repository])
    runs = live_runs(judged(spans_of(rows), max_owners, max_repositories))
    found = rows.select("uid", F.col("doc_id.i").alias("k_id"), F.col("doc_id.h").alias("k_hash")).join(runs, "uid").drop("uid")
    found = materialise(found.dropDuplicates(["k_id", "k_hash"]), "masks")
    small = found.count() <= MAX_BROADCAST_ROWS
    on = F.col(at[id_col]).eqNullSafe(F.col("k_id")) & (F.xxhash64(at[text]) == F.col("k_hash"))
    out = plain.join(F.broadcast(found) if small else found, on, "left")
    fixed = F.when(F.size("runs") > 0, masked(F.col(at[text]), F.col("runs"))).otherwise(F.col(at[text]))
    return out.withColumn(at[text], fixed).select(*plain.columns).toDF(*names)
