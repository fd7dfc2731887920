"""Ranked lexical search: impact-ordered, score at a time, with exact early stops.

The first pass counts, in every document, the terms that queries ask for and keeps one
narrow row a document, written once; documents are never shuffled. Counts of documents
and terms over the whole corpus give each posting its exact integer impact. The rows are
then read in shards of at most SHARD_ROWS documents. In a shard a term's postings are
grouped by exact impact, highest first. A query takes groups of all its terms in
descending order of what they add, into one accumulator a document. What the next groups
could add at most bounds every score that is not complete: once k documents lie above that
bound, no unseen document can enter, and only documents that could still reach the kth
partial score are completed from their own rows. Each shard sends k rows a query at most.

Queries travel in blocks of about BLOCK_TERMS distinct terms of a query, so that what is
broadcast is bounded; more queries take more passes. Terms of documents are met by
64-bit hashes: a wrong count needs a collision with a term of the block.

Defined results. Null text has no terms. A query without terms, or whose terms no document
holds, has no rows. Every row of ``docs`` is a document of its own, also if ids or texts
repeat; equal scores go by ascending id, a null id last, equal rows in any order. Every row
of ``queries`` is a query of its own. Empty tables: empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lorebase.llm.batches import ASCII_FOLD, in_small_batches, large_list, slices, words
from lorebase.llm.decontaminate import ascii_lower
from lorebase.sources.tables import discard, materialise

K = 10
#: Share of the length in a score, in hundredths.
B = 75
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_TERMS = 200_000
SHARD_ROWS = 1 << 16
#: A level takes all groups that add at least so much of the largest that is left.
LEVEL = 7 / 8
#: A doc id where there is none: sorts last.
_NO_ID = (1 << 63) - 1
_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def query_terms(queries: DataFrame, query_id: str, text: str) -> DataFrame:
    """(query, item_id, term, times) for each distinct term of a query row."""
    rows = queries.select(F.monotonically_increasing_id().alias("query"), F.col(query_id).alias("item_id"), ascii_lower(F.coalesce(text, F.lit(""))).alias("t"))
    rows = rows.select("query", "item_id", F.explode(F.regexp_extract_all("t", F.lit(TERM), F.lit(0))).alias("term"))
    return rows.groupBy("query", "item_id", "term").agg(F.count(F.lit(1)).alias("times"))


def hashes_of(terms: list[str]) -> np.ndarray:
    """The hash under which ``words`` meets each term, whole terms given."""
    out = np.zeros(len(terms), np.uint64)
    for first, end, data, offsets in slices(pa.array(terms, pa.string())):
        out[first:end] = words(data, offsets, _SEPARATOR, ASCII_FOLD)[0]
    return out


def counted(docs: DataFrame, terms: list[str], id_col: str, text: str) -> DataFrame:
    """(doc_id, n, terms, tfs) of each document with a term; ``terms`` are places in the list."""
    hashes = hashes_of(terms)
    order = np.argsort(hashes)
    if (np.diff(hashes[order].astype(object)) == 0).any():
        raise ValueError("two terms have one hash")
    shared = docs.sparkSession.sparkContext.broadcast((hashes[order], order.astype(np.int32)))

    def count(batches):
        known, place = shared.value
        for b in batches:
            for first, end, data, offsets in slices(b.column("text")):
                h, _, _, bounds = words(data, offsets, _SEPARATOR, ASCII_FOLD)
                n = np.diff(bounds)
                at = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
                hit = known[at] == h if len(known) else np.zeros(len(h), bool)
                row = np.repeat(np.arange(end - first, dtype=np.int64), n)[hit]
                key, tf = np.unique(row << 32 | place[at[hit]], return_counts=True)
                some = np.flatnonzero(n)
                lengths = np.bincount(key >> 32, minlength=end - first)[some]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(first, end - first).take(pa.array(some)), pa.array(n[some], pa.int64()),
                     large_list((key & 0xFFFFFFFF).astype(np.int32), lengths, pa.int32()), large_list(tf.astype(np.int32), lengths, pa.int32())],
                    ["doc_id", "n", "terms", "tfs"],
                )

    rows = in_small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n long, terms array<int>, tfs array<int>")


def frequencies(rows: DataFrame) -> DataFrame:
    """(term, df, terms): documents that hold a term; under -1 all documents, and all their terms."""

    def count(batches):
        df, n, length = np.zeros(0, np.int64), 0, 0
        for b in batches:
            here = np.bincount(b.column("terms").flatten().to_numpy())
            if len(here) > len(df):
                df, here = here, df
            df[: len(here)] += here
            n, length = n + b.num_rows, length + int(b.column("n").to_numpy().sum())
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": np.append(at, -1), "df": np.append(df[at], n), "length": np.append(np.zeros(len(at), np.int64), length)})

    counts = rows.select("n", "terms").mapInArrow(count, "term long, df long, length long")
    return counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("length").alias("length"))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, w: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """What a term adds to the score of a document of n terms, in whole numbers."""
    m = 100 - B + B * n * n_docs // length
    return w * (1_000_000_000 * tf // (1000 * tf + 8 * m))


class Shard:
    """Postings of some documents, by document and by term; a term's in groups of equal impact."""

    def __init__(self, bounds: np.ndarray, terms: np.ndarray, impact: np.ndarray, n_terms: int):
        self.bounds, self.terms, self.impact = bounds, terms, impact
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        order = np.lexsort((-impact, terms))
        self.docs, self.adds = doc[order], impact[order]
        self.ends = np.concatenate(([0], np.cumsum(np.bincount(terms, minlength=n_terms))))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(self.adds) != 0) | (np.diff(terms[order]) != 0)
        self.groups = np.flatnonzero(new)  # where a group begins
        self.of_term = np.searchsorted(self.groups, self.ends)

    def best(self, asked: list[tuple[int, int]], k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, whole scores) among which the k best are, and the number of postings read for it."""
        lists = []
        for term, times in asked:
            starts = self.groups[self.of_term[term] : self.of_term[term + 1]]
            if len(starts):
                # negative, so that the values ascend
                lists.append((times, -times * self.adds[starts], np.append(starts, self.ends[term + 1])))
        sums, at, read, tested = np.zeros(len(self.bounds) - 1, np.int64), [0] * len(lists), 0, 0
        while True:
            left = [int(-values[p]) if p < len(values) else 0 for (_, values, _), p in zip(lists, at)]
            rest = sum(left)
            if rest == 0 or read >= 2 * tested + k:
                tested = read
                seen = np.flatnonzero(sums)
                if rest == 0:
                    return seen, sums[seen], read
                if len(seen) >= k:
                    kth = np.partition(sums[seen], len(seen) - k)[len(seen) - k]
                    if kth > rest:  # no unseen document can reach it
                        could = seen[sums[seen] + rest >= kth]
                        return could, self.whole(could, asked), read
            least = max(left) * LEVEL
            for j, (times, values, starts) in enumerate(lists):
                upto = int(np.searchsorted(values, -least, "right"))
                if upto > at[j]:
                    part = slice(starts[at[j]], starts[upto])
                    sums[self.docs[part]] += times * self.adds[part]  # a document is once in a list
                    read += part.stop - part.start
                    at[j] = upto

    def whole(self, docs: np.ndarray, asked: list[tuple[int, int]]) -> np.ndarray:
        """Complete scores, from the documents' own rows."""
        times = np.zeros(len(self.of_term), np.int64)
        for term, n in asked:
            times[term] = n
        sizes = self.bounds[docs + 1] - self.bounds[docs]
        ends = np.cumsum(sizes)
        at = np.arange(sizes.sum()) + np.repeat(self.bounds[docs] - (ends - sizes), sizes)
        sums = np.concatenate(([0], np.cumsum(times[self.terms[at]] * self.impact[at])))
        return sums[ends] - sums[ends - sizes]


def _block(docs: DataFrame, asked: DataFrame, k: int, id_col: str, text: str) -> DataFrame | None:
    """(query, doc_id, score): the k best of each shard for the queries of one block."""
    lines = asked.select("query", "term", "times").collect()  # BLOCK_TERMS or one query
    terms = sorted({r["term"] for r in lines})
    place = {t: i for i, t in enumerate(terms)}
    rows = materialise(counted(docs, terms, id_col, text), "counted")
    facts = {r["term"]: r for r in frequencies(rows).collect()}  # a row a term of the block
    n_docs, length = (facts[-1]["df"], facts[-1]["length"]) if -1 in facts else (0, 0)
    if not n_docs:
        discard(rows)
        return None
    weights = np.zeros(len(terms), np.int64)
    for t, r in facts.items():
        if t >= 0:
            weights[t] = weight(n_docs, r["df"])
    wanted: dict[int, list[tuple[int, int]]] = {}
    for r in lines:
        if weights[place[r["term"]]]:
            wanted.setdefault(r["query"], []).append((place[r["term"]], r["times"]))
    shared = docs.sparkSession.sparkContext.broadcast((weights, wanted))

    def answer(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        weights, wanted = shared.value
        all_rows = pa.Table.from_batches(parts).combine_chunks()
        n, lists, tfs = (all_rows.column(c).chunk(0) for c in ("n", "terms", "tfs"))
        bounds = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
        terms_, tf = lists.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64)
        u = impacts(tf, np.repeat(n.to_numpy().astype(np.int64), np.diff(bounds)), weights[terms_], n_docs, length)
        shard = Shard(bounds, terms_, u, len(weights))
        ids = all_rows.column("doc_id").combine_chunks()
        key = ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False) if pa.types.is_integer(ids.type) else None
        query, doc, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for q, asked_ in wanted.items():
            d, s, _ = shard.best(asked_, k)
            if key is not None:
                top = np.lexsort((key[d], -s))[:k]
            else:  # ids of another type are compared by Spark: all that tie with the kth go on
                top = np.flatnonzero(s >= (np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else 0))
            query.append(np.full(len(top), q))
            doc.append(d[top])
            score.append(s[top])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(query)), ids.take(pa.array(np.concatenate(doc))), pa.array(np.concatenate(score))], ["query", "doc_id", "score"]
        )

    def search(batches):
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= SHARD_ROWS:
                yield answer(held)
                held, size = [], 0
        if size:
            yield answer(held)

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = materialise(rows.mapInArrow(search, f"query long, doc_id {kind}, score long"), "found")
    discard(rows)
    return found


def search(
    docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text: str = "text", query_id: str = "item_id", query_text: str = "text"
) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each row of ``queries``, with a score above 0."""
    asked = materialise(query_terms(queries, query_id, query_text), "terms")
    blocks = -(-asked.count() // BLOCK_TERMS)
    found = []
    for b in range(blocks):
        block = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b)
        part = _block(docs, block, k, id_col, text)
        if part is not None:
            found.append(part)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    if not found:
        kinds = [f"{n} {kind}" for n, kind in (("item_id", dict(asked.dtypes)["item_id"]), ("rank", "int"), ("doc_id", dict(docs.dtypes)[id_col]), ("score", "long"))]
        return docs.sparkSession.createDataFrame([], ", ".join(kinds))
    best = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = asked.select("query", "item_id").distinct()
    return best.join(named, "query").select("item_id", "rank", "doc_id", "score")
