"""Benchmark decontamination by winnowing, in DataFrame operations only.

A word is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Fingerprints:
of every WINDOW - K + 1 consecutive K-grams those of least hash are kept, so any
shared span of WINDOW words has a common fingerprint. Document fingerprints are
joined with the benchmark's at their places, and each match is extended: the 10-word windows
around it are compared word by word. Items of fewer than 10 words are one window,
found at a place by the hash of as many words and compared the same way.

Items of equal words are one class, told by 128 bits of their words, and are looked up
once; which items a class has, and the digest of a set of classes, are found once for
each set of classes that some document has. Fingerprints of an item that lie in equal words are
one row. So work grows with the words of documents and items, not with their copies or repeats.

The benchmark side is broadcast in blocks of at most BLOCK_WORDS words, each
fingerprint with the 15 words around it; a larger benchmark takes several passes
over the documents, never a larger broadcast. A document is split once a pass: its
fingerprints and the runs of its words as long as short items are looked up together.
The documents are never shuffled, only the hits are.

Defined results. Null or wordless text has no words and no hits; a null, empty or
wordless item has no window; a null item_id still marks words but is not listed.
Equal items count one by one. Repeated rows have equal results. No item or no
document: no hit or an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lorebase.sources.tables import discard, materialise

WINDOW, K = 10, 5
SPAN = WINDOW - K + 1
#: Words of a document that are handled in one row; a longer one is several rows, which share WINDOW - 1 words.
CHUNK = 2048
#: Words of benchmark text in one broadcast: with 15 words to each of some 75,000 fingerprints about 64 MB.
BLOCK_WORDS = 250_000
#: Rows of two numbers that may be broadcast, 64 MB at most; beyond, a shuffled join.
MAX_BROADCAST_ROWS = 2_000_000
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; the cheap function where it says the same."""
    other = text.rlike(r"[\p{IsUppercase}\p{IsTitlecase}&&[^A-Z]]")
    return F.when(other, F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), F.lit(0))


def _up_to(n: Column) -> Column:
    """1..n, empty below 1."""
    return F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def _pairwise(a: Column, b: Column, ahead: int, f) -> Column:
    """f(a[i], b[i + ahead]) wherever both are."""
    n = F.greatest(F.lit(0), F.least(F.size(a), F.size(b) - ahead))
    return F.zip_with(F.slice(a, 1, n), F.slice(b, ahead + 1, n), f)


def _hash(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def _less(a: Column, b: Column) -> Column:
    return F.least(a, b)


def with_grams(df: DataFrame) -> DataFrame:
    """Adds hashes (of the words) and grams (of each K of them)."""
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.withColumn("two", _pairwise(F.col("hashes"), F.col("hashes"), 1, _hash))
    df = df.withColumn("four", _pairwise(F.col("two"), F.col("two"), 2, _hash))
    return df.withColumn("grams", _pairwise(F.col("four"), F.col("hashes"), 4, _hash)).drop("two", "four")


def _more(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def with_picks(df: DataFrame) -> DataFrame:
    """Adds picks: (gram, at) of the grams that are the least of some SPAN consecutive ones; equal ones all are.

    A gram is the least of a span that covers it exactly if the greatest least of those spans is the gram itself.
    """
    df = df.withColumn("of2", _pairwise(F.col("grams"), F.col("grams"), 1, _less))
    df = df.withColumn("of4", _pairwise(F.col("of2"), F.col("of2"), 2, _less))
    df = df.withColumn("least", _pairwise(F.col("of4"), F.col("of2"), 4, _less)).drop("of2", "of4")
    edge = F.array_repeat(F.lit(-(1 << 63)).cast("long"), SPAN - 1)
    df = df.withColumn("wide", F.concat(edge, "least", edge)).drop("least")
    df = df.withColumn("of2", _pairwise(F.col("wide"), F.col("wide"), 1, _more))
    df = df.withColumn("of4", _pairwise(F.col("of2"), F.col("of2"), 2, _more))
    df = df.withColumn("most", _pairwise(F.col("of4"), F.col("of2"), 4, _more)).drop("wide", "of2", "of4")
    # zipped, as a column that is named inside a function over elements may be computed anew for each of them
    both = F.arrays_zip(F.col("grams").alias("g"), F.col("most").alias("m"))
    marked = F.transform(both, lambda x, i: F.when(x["g"] == x["m"], F.struct(x["g"].alias("gram"), (i + 1).alias("at"))))
    return df.withColumn("picks", F.when(F.size("grams") >= SPAN, F.array_compact(marked))).drop("most")


def _with_runs(df: DataFrame, lengths: list[int]) -> tuple[DataFrame, list[str]]:
    """Adds run<n>, the hashes of each n consecutive words, for the lengths wanted."""
    last = "hashes"
    for n in range(2, max(lengths, default=1) + 1):
        df = df.withColumn(f"run{n}", _pairwise(F.col(last), F.col("hashes"), n - 1, _hash))
        last = f"run{n}"
    return df, ["hashes" if n == 1 else f"run{n}" for n in lengths]


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, item, words): ``item`` tells equal word sequences, 128 bits of them; items without words are left out."""
    words = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
    both = F.struct(F.xxhash64("words").alias("a"), F.xxhash64(F.lit("item"), "words").alias("b"))
    return words.where(F.size("words") > 0).select("item_id", both.alias("item"), "words")


def prints_of(items: DataFrame, short: list[int]) -> DataFrame:
    """(gram, item, i_words, q): what is looked up, with the words around it; equal ones once.

    For an item of WINDOW words or more these are its fingerprints, each with the words of all windows that hold it
    and the fingerprint's place q among them; for a shorter item its one run, q = 0.
    """
    long = with_picks(with_grams(items.where(F.size("words") >= WINDOW)))
    long = long.select("item", "words", F.explode_outer("picks").alias("pick")).select("item", "words", "pick.gram", "pick.at")
    first = F.greatest(F.lit(1), F.col("at") - (SPAN - 1))
    around = F.slice("words", first, F.least(F.size("words"), F.col("at") + (WINDOW - 1)) - first + 1)
    parts = [long.select("gram", "item", around.alias("i_words"), (F.col("at") - first + 1).alias("q"))]
    if short:
        rows, names = _with_runs(items.where(F.size("words") < WINDOW).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))), short)
        run = F.coalesce(*[F.when(F.size("words") == n, F.get(F.col(c), F.lit(0))) for n, c in zip(short, names)])
        parts.append(rows.select(run.alias("gram"), "item", F.col("words").alias("i_words"), F.lit(0).alias("q")))
    return reduce(DataFrame.unionAll, parts).where("gram is not null").distinct()


def _starts(words: Column, p: Column, i_words: Column, q: Column) -> Column:
    """Where the document's words around place p are a window of the item that holds the looked-up hash.

    One comparison for each place that p may have in a window: a slice inside a function over elements would
    walk the whole document.
    """
    n, size = F.size(i_words), F.size(words)

    def window(d: int) -> Column:
        fits = (p > d) & (q > d) & (p - d + WINDOW - 1 <= size) & (q - d + WINDOW - 1 <= n)
        here = lambda c, at: F.slice(c, F.greatest(F.lit(1), at - d), F.lit(WINDOW))
        return F.when(fits, F.when(here(words, p) == here(i_words, q), p - d))

    whole = F.when(F.slice(words, p, F.greatest(n, F.lit(0))) == i_words, p)
    return F.array_compact(F.when(q == 0, F.array(whole)).otherwise(F.array(*[window(d) for d in range(SPAN)])))


def _places(hashes: Column, n: int) -> Column:
    """(gram, at) of the runs of n words at every place."""
    return F.transform(hashes, lambda h, i: F.struct(h.alias("gram"), (i + 1).alias("at")))


def chunked(rows: DataFrame) -> DataFrame:
    """Rows with n_words and base added: each at most CHUNK words from base on, so that every window lies in one of them."""
    n, step = F.size("words"), CHUNK - WINDOW + 1
    last = F.greatest(F.lit(0), F.ceil((n - WINDOW + 1) / F.lit(step)).cast("int") - 1)
    each = rows.withColumn("n_words", n.cast("long")).withColumn("base", F.explode(F.transform(F.sequence(F.lit(0), last), lambda k: k * step)))
    return each.withColumn("words", F.when(F.col("n_words") <= CHUNK, F.col("words")).otherwise(F.slice("words", F.col("base") + 1, CHUNK)))


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", every: bool = False) -> tuple[DataFrame, list[DataFrame]]:
    """Rows (doc_id, text_hash, n_words, item, at, len): document words at..at+len-1 are a window of that class of items.

    With ``every`` there is also one row without item for each document. The second value are tables
    that the rows read.
    """
    classes = materialise(items.select("item", "words").dropDuplicates(["item"]), "classes")
    facts = classes.agg(F.sum(F.size("words")).alias("n"), F.collect_set(F.when(F.size("words") < WINDOW, F.size("words"))).alias("short")).first()
    total, short = facts["n"] or 0, sorted(facts["short"])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), words_of(F.col(text)).alias("words"))
    rows, runs = _with_runs(with_picks(with_grams(chunked(rows))), short)
    n_blocks = -(-total // BLOCK_WORDS) or 1
    none = F.lit(None).cast("struct<gram:bigint,at:int>")
    parts, read = [], [classes]
    for b in range(n_blocks):
        block = classes if n_blocks == 1 else classes.where(F.pmod(F.col("item.a"), F.lit(n_blocks)) == b)
        # written, as a filter on it would be pushed down with the whole chain of expressions
        prints = materialise(prints_of(block, short), "prints")
        read.append(prints)
        # the null stands for the document itself; the outer form, as for the plain one the optimizer repeats the whole expression in a filter
        itself = F.when(F.col("base") == 0, F.array(none)).otherwise(F.array().cast("array<struct<gram:bigint,at:int>>"))
        asked = F.concat(itself, F.coalesce("picks", F.array().cast("array<struct<gram:bigint,at:int>>")), *[_places(F.col(c), n) for c, n in zip(runs, short)])
        probes = rows.select("doc_id", "text_hash", "n_words", "base", "words", F.explode_outer(asked).alias("ask"))
        probes = probes.select("doc_id", "text_hash", "n_words", "base", "words", "ask.gram", F.col("ask.at").alias("p"))
        keep_all = every and b == 0
        met = probes.join(F.broadcast(prints), "gram", "left" if keep_all else "inner")
        if keep_all:
            met = met.where("gram is null or item is not null")
        at = F.when(F.col("item").isNotNull(), _starts(F.col("words"), F.col("p"), F.col("i_words"), F.col("q")))
        found = met.select(
            "doc_id", "text_hash", "n_words", "base", "item", F.explode_outer(at).alias("at"), F.least(F.lit(WINDOW), F.size("i_words")).alias("len"),
        )
        found = found.where("item is null or at is not null")
        parts.append(found.select("doc_id", "text_hash", "n_words", "item", (F.col("at") + F.col("base")).alias("at"), "len"))
    return reduce(DataFrame.unionAll, parts), read


def covered(spans: Column) -> Column:
    """Number of words inside any of the sorted (at, len) spans."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(1).cast("long").alias("next"))
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["at"] + s["len"] - F.greatest(a["next"], s["at"]))).cast("long").alias("n"),
        F.greatest(a["next"], (s["at"] + s["len"]).cast("long")).alias("next"),
    )
    return F.aggregate(spans, zero, step)["n"]


def _digest(item: Column) -> Column:
    """One value for a sorted array of classes."""
    return F.sha2(F.array_join(F.transform(item, lambda i: F.concat_ws(":", i["a"].cast("string"), i["b"].cast("string"))), ","), 256)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``."""
    items = materialise(items_of(benchmark), "items")
    found, read = hits(docs, items, id_col, text, every=True)
    found = materialise(found, "hits")
    discard(*read)
    marks = found.where("item is not null").groupBy(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_hash")).agg(
        covered(F.array_sort(F.collect_set(F.struct("at", "len")))).alias("n_hit"), F.array_sort(F.collect_set("item")).alias("classes")
    )
    marks = materialise(marks.withColumn("digest", _digest(F.col("classes"))), "marks")
    # the items of a set of classes are looked up once, however many documents have it
    each = marks.groupBy("digest").agg(F.first("classes").alias("classes")).select("digest", F.explode("classes").alias("item"))
    listed = each.join(items.select("item", "item_id"), "item").groupBy("digest").agg(
        F.count(F.lit(1)).alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list("item_id")), ","), 256).alias("items_sha256")
    )
    rows = found.where("item is null").select("doc_id", "text_hash", "n_words")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    on = F.col("doc_id").eqNullSafe(F.col("m_id")) & F.col("text_hash").eqNullSafe(F.col("m_hash"))
    return rows.join(marks.drop("classes").join(listed, "digest"), on, "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns, whatever their names."""
    names = docs.columns
    rows = docs.toDF(*[f"c{k}" for k in range(len(names))])
    found, read = hits(docs, items_of(benchmark), id_col, text)
    found = found.select(F.col("doc_id").alias("h_id"), F.col("text_hash").alias("h_hash"))
    found = materialise(found.distinct(), "contaminated")
    discard(*read)
    small = found.count() <= MAX_BROADCAST_ROWS
    on = F.col(f"c{names.index(id_col)}").eqNullSafe(F.col("h_id")) & (F.xxhash64(f"c{names.index(text)}") == F.col("h_hash"))
    return rows.join(F.broadcast(found) if small else found, on, "left_anti").toDF(*names)
