"""Phrase collocations: distinct pieces with multiplicities, counted in DuckDB a hash bucket.

Texts are cut into pieces, and equal pieces of a language become one row with its
multiplicity, so copies are counted once and weighted. Phrases are then found level by
level, from one word to SIZES[-1]: the runs of words whose shorter parts can all be
frequent are counted by hash, weighted and summed within a task first, and the sums are
shuffled to hash buckets. A bucket's task sums its rows out of core in a DuckDB file of its
own. Hashes that reach the least count make a bit table of bounded size, which only tells
which runs of the next level may be frequent. Each sum also names the part of the pieces
that a run was first seen in; a last pass gives the texts of the frequent runs, each from that part,
told by another bit table, and a join by hash puts texts and counts together. Counts of a phrase's parts are
found by requests: every cut of a phrase asks for its two parts, requests are shuffled to
the parts' counts, and the answers come back to the phrase.

Runs are told by 96 bits, pieces within a task by 128. DuckDB's file lies in the
task's temporary folder, as Spark's own spill does, and goes with the task; no other task
reads it.

Defined results. Null text has no words; a null language is ``und``. Repeated rows count as
often as they occur. Ties of a phrase's cuts go to the shortest first part; ties of rank by
count, then by the phrase's bytes. A language without a frequent phrase has no rows. Empty
table: empty result. Extra columns are ignored.
"""

from __future__ import annotations

import tempfile
import zlib
from functools import reduce
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lorebase.llm.batches import _BYTE, _mix, _ODD, _P, _P_INV, _power, ASCII_FOLD, KEEP, in_small_batches, slices, words
from lorebase.sources.tables import discard, materialise

LEAST, SIZES, TOP = 30, (2, 3, 4), 2000
#: A phrase goes if a longer one that holds it has at least so many hundredths of its count.
COVER = 80
#: Different hashes that a task holds before it sends their sums.
HELD_HASHES = 2_000_000
#: Bits of a level's table for each frequent hash, and bits at most (16 MB).
BITS_EACH, MAX_BITS = 128, 1 << 27
#: Words of distinct pieces that a counting task takes at least, as it sums what it meets before it sends it.
TASK_WORDS = 6_000_000
#: Memory of a bucket in DuckDB; beyond, it goes to its file.
BUCKET_MEMORY = "192MB"
_BLANK = np.zeros(256, bool)
_BLANK[0x20] = True
_BLANKS, _CUT = _BLANK.copy(), np.zeros(256, bool)
_BLANKS[0x09] = True
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BYTE2 = _mix(_BYTE + _ODD)
_P2 = np.uint64(0xD1342543DE82EF95)
_P2_INV = np.uint64(pow(int(_P2), -1, 1 << 64))


def pieces_of(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, piece, times, n_words, part): distinct pieces, words parted by one space, with their multiplicity and a number of their own part."""

    def cut(batches):
        for b in batches:
            codes: dict[str, int] = {}
            code = np.array([codes.setdefault(x, len(codes)) for x in b.column("lang").to_pylist()], np.int64)
            held = [_distinct_pieces(data, offsets, code[first:end]) for first, end, data, offsets in slices(b.column("text"))]
            if held:
                yield from Held.together(held).batches(list(codes), ["lang", "piece", "times"])

    rows = in_small_batches(docs).select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    rows = rows.mapInArrow(cut, "lang string, piece string, times long").groupBy("lang", "piece").agg(F.sum("times").alias("times"))
    n_words = F.length("piece") - F.length(F.replace(F.col("piece"), F.lit(" "), F.lit(""))) + 1
    return rows.withColumns({"n_words": n_words.cast("long"), "part": F.spark_partition_id()})


def _distinct_pieces(data: np.ndarray, offsets: np.ndarray, code: np.ndarray) -> Held:
    """The pieces of some texts with their counts; ``code`` is the language of each text."""
    _, starts, ends, first = words(data, offsets, _CUT | _BLANKS, ASCII_FOLD)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    cuts = np.concatenate(([0], np.cumsum(_CUT[data])))[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(row) != 0) | (np.diff(cuts) != 0)
    sizes = ends - starts + 1  # a space after each word
    at = np.concatenate(([0], np.cumsum(sizes)))
    take = np.arange(at[-1]) + np.repeat(starts - at[:-1], sizes)
    joined = ASCII_FOLD[data[np.minimum(take, max(0, len(data) - 1))]] if len(data) else np.zeros(0, np.uint8)
    joined[at[1:] - 1] = 0x20
    begin = np.flatnonzero(new)
    piece_starts, piece_ends = at[:-1][begin], np.append(begin[1:], len(starts))
    piece_ends = at[piece_ends] - 1 if len(begin) else piece_starts
    lang = code[row[begin]]
    one, two = _span_hashes(joined, _BYTE, _P, _P_INV), _span_hashes(joined, _BYTE2, _P2, _P2_INV)
    salt = _mix((lang.astype(np.uint64) + np.uint64(1)) * _ODD)
    return Held(one(piece_starts, piece_ends) ^ salt, two(piece_starts, piece_ends), np.ones(len(begin), np.int64), lang, joined, piece_starts, piece_ends)


def _span_hashes(data: np.ndarray, table: np.ndarray, base: np.uint64, inverse: np.uint64):
    """f(starts, ends) giving the hash of each span of bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * _power(base, len(data)), out=sums[1:])
    back = _power(inverse, len(data))
    return lambda starts, ends: _mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * _ODD)


class Held:
    """Counts of runs with their bytes: equal runs, by 128 bits, are one entry."""

    def __init__(self, h: np.ndarray, g: np.ndarray, n: np.ndarray, lang: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        order = np.lexsort((g, h))
        h, g = h[order], g[order]
        new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1]))) if len(h) else np.zeros(0, np.int64)
        some = order[new]
        self.h, self.g, self.lang = h[new], g[new], lang[some]
        self.n = np.add.reduceat(n[order], new) if len(new) else n
        sizes = ends[some] - starts[some]
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))
        self.data = data[np.arange(self.offsets[-1]) + np.repeat(starts[some] - self.offsets[:-1], sizes)]

    @classmethod
    def together(cls, parts: list[Held]) -> Held:
        join = lambda of: np.concatenate([of(p) for p in parts])
        base = np.cumsum([0, *[len(p.data) for p in parts[:-1]]])
        starts = np.concatenate([p.offsets[:-1] + b for p, b in zip(parts, base)])
        ends = np.concatenate([p.offsets[1:] + b for p, b in zip(parts, base)])
        return cls(join(lambda p: p.h), join(lambda p: p.g), join(lambda p: p.n), join(lambda p: p.lang), join(lambda p: p.data), starts, ends)

    def batches(self, langs: list[str], columns: list[str]):
        """Record batches of language, text and count."""
        names = pa.array(langs, pa.string())
        for first in range(0, len(self.n), 50_000):
            last = min(len(self.n), first + 50_000)
            offsets = self.offsets[first : last + 1]
            text = pa.StringArray.from_buffers(last - first, pa.py_buffer((offsets - offsets[0]).astype(np.int32).tobytes()), pa.py_buffer(self.data[offsets[0] : offsets[-1]].tobytes()))
            yield pa.RecordBatch.from_arrays([names.take(pa.array(self.lang[first:last])), text, pa.array(self.n[first:last])], columns)


class Runs:
    """The words of some pieces, and the runs of n of them inside a piece."""

    def __init__(self, langs: list[str], data: np.ndarray, offsets: np.ndarray):
        self.data = data
        _, self.starts, self.ends, first = words(data, offsets, _BLANK, KEEP)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        salt = {x: np.uint64(zlib.crc32(x.encode())) for x in set(langs)}
        self.salt = _mix(np.array([salt[x] for x in langs], np.uint64) * _ODD)
        self._hash = _span_hashes(data, _BYTE, _P, _P_INV)
        self._second = None

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first words, starts, ends) of all runs of n words."""
        at = np.arange(max(0, len(self.starts) - n + 1))
        at = at[self.row[at] == self.row[at + n - 1]]
        return at, self.starts[at], self.ends[at + n - 1]

    def hashes(self, at: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self._hash(starts, ends) ^ self.salt[self.row[at]]

    def second(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """32 bits more that tell runs apart."""
        if self._second is None:
            self._second = _span_hashes(self.data, _BYTE2, _P2, _P2_INV)
        return (self._second(starts, ends) >> np.uint64(32)).astype(np.uint32)

    def possible(self, n: int, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first words, starts, ends, hashes) of the runs of n words whose two longest parts are in the table before."""
        at, starts, ends = self.of(n)
        if n > 1 and len(at):
            parts, s, e = self.of(n - 1)
            ok = np.zeros(len(self.starts) + 1, bool)
            ok[parts] = _inside(tables[n - 2], self.hashes(parts, s, e))
            keep = ok[at] & ok[at + 1]
            at, starts, ends = at[keep], starts[keep], ends[keep]
        return at, starts, ends, self.hashes(at, starts, ends)


def _inside(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = h & np.uint64(len(table) * 64 - 1)
    return (table[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def _pieces(b: pa.RecordBatch):
    """(languages, Runs, multiplicities, parts) of the pieces of each slice of a batch."""
    langs, times, part = b.column("lang").to_pylist(), b.column("times").to_numpy(), b.column("part").to_numpy()
    for first, end, data, offsets in slices(b.column("piece")):
        yield langs[first:end], Runs(langs[first:end], data, offsets), times[first:end], part[first:end]


def bucket_sums(rows: DataFrame, least: int) -> DataFrame:
    """(h, g, n, part) of the (h, g) whose n reaches ``least`` in sum; each hash bucket is summed in DuckDB, out of core."""

    def run(batches):
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        with tempfile.TemporaryDirectory() as folder:
            config = {"memory_limit": BUCKET_MEMORY, "threads": 1, "temp_directory": folder, "preserve_insertion_order": False}
            with duckdb.connect(f"{folder}/bucket.db", config=config) as con:
                con.execute("create table bucket (h bigint, g integer, n bigint, part integer)")
                for b in chain([first], batches):
                    con.register("fresh", pa.Table.from_batches([b]))
                    con.execute("insert into bucket select * from fresh")
                    con.unregister("fresh")
                yield from con.sql(f"select h, g, sum(n)::bigint as n, min(part) as part from bucket group by h, g having sum(n) >= {least}").to_arrow_reader(50_000)

    return rows.repartition("h").mapInArrow(run, "h long, g int, n long, part int")


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(h, g, n, part) with equal (h, g) put together: n summed, the first part kept."""
    h, g, n, part = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(h, kind="stable")
    h, g = h[order], g[order]
    new = np.append(True, h[1:] != h[:-1]) if len(h) else np.zeros(0, bool)
    clash = np.flatnonzero(~new[1:] & (g[1:] != g[:-1]))
    if len(clash):  # one hash of two runs: in the order of both
        order = np.lexsort((np.concatenate([p[1] for p in parts]), np.concatenate([p[0] for p in parts])))
        h, g = np.concatenate([p[0] for p in parts])[order], np.concatenate([p[1] for p in parts])[order]
        new = np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1]))
    new = np.flatnonzero(new)
    return h[new], g[new], np.add.reduceat(n[order], new) if len(new) else n, part[order[new]]


def frequent_runs(pieces: DataFrame, n: int, tables: list[np.ndarray], least: int) -> DataFrame:
    """(h, g, n, part): hashes of runs of n words whose count reaches ``least``, and a part that holds one."""
    shared = pieces.sparkSession.sparkContext.broadcast(tables)

    def count(batches):
        held, size = [], 0
        for b in batches:
            for _, runs, times, part in _pieces(b):
                at, starts, ends, hashes = runs.possible(n, shared.value)
                row = runs.row[at]
                held.append((hashes, runs.second(starts, ends), times[row], part[row]))
                size += len(at)
                if size >= HELD_HASHES:
                    held = [_summed(held)]
                    size = len(held[0][0])
                    if 2 * size >= HELD_HASHES:
                        yield _counts_batch(held[0])
                        held, size = [], 0
        if size:
            yield _counts_batch(_summed(held))

    counts = pieces.select("lang", "piece", "times", "part").mapInArrow(count, "h long, g int, n long, part int")
    return bucket_sums(counts, least)


def _counts_batch(of: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    h, g, n, part = of
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(g.view(np.int32)), pa.array(n), pa.array(part)], ["h", "g", "n", "part"])


def bit_table(hashes: DataFrame, n: int) -> np.ndarray:
    """A table with the bit of each hash ``h`` set; MAX_BITS at most, whatever n."""
    bits = min(MAX_BITS, 1 << max(6, (BITS_EACH * n - 1).bit_length()))
    bit = F.col("h").bitwiseAND(F.lit(bits - 1).cast("long"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    lines = hashes.select(F.shiftright(bit, 6).alias("at"), one.alias("bits")).groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(bits // 64, np.uint64)  # bits / 64 lines at most
    table[lines.column("at").to_numpy()] = lines.column("bits").to_numpy().view(np.uint64)
    return table


def run_texts(pieces: DataFrame, tables: list[np.ndarray], source: np.ndarray) -> DataFrame:
    """(h, g, lang, phrase) of the frequent runs, from the parts that ``source`` tells; some may come twice."""
    shared = pieces.sparkSession.sparkContext.broadcast((tables, source))

    def texts(batches):
        tables, source = shared.value
        for b in batches:
            for langs, runs, _, part in _pieces(b):
                here = _mix((part.astype(np.uint64) + np.uint64(1)) * _ODD)
                codes: dict[str, int] = {}
                code = np.array([codes.setdefault(x, len(codes)) for x in langs], np.int64)
                for n in range(1, len(tables) + 1):
                    at, starts, ends, h = runs.possible(n, tables)
                    keep = _inside(tables[n - 1], h)
                    keep[keep] = _inside(source, h[keep] ^ here[runs.row[at[keep]]])
                    at, starts, ends, h = at[keep], starts[keep], ends[keep], h[keep]
                    if len(at):
                        some = Held(h, runs.second(starts, ends).astype(np.uint64), np.ones(len(at), np.int64), code[runs.row[at]], runs.data, starts, ends)
                        first = 0
                        for batch in some.batches(list(codes), ["lang", "phrase", "n"]):
                            last = first + batch.num_rows
                            ids = [pa.array(some.h[first:last].view(np.int64)), pa.array(some.g[first:last].astype(np.uint32).view(np.int32))]
                            yield pa.RecordBatch.from_arrays([*ids, batch.column(0), batch.column(1)], ["h", "g", "lang", "phrase"])
                            first = last

    return pieces.select("lang", "piece", "times", "part").mapInArrow(texts, "h long, g int, lang string, phrase string")


def run_counts(pieces: DataFrame, levels: list[DataFrame], tables: list[np.ndarray]) -> DataFrame:
    """(lang, phrase, n): the frequent runs of ``levels`` with their texts."""
    every = reduce(DataFrame.unionAll, levels)
    # the salt of a part as in run_texts
    salted = every.mapInArrow(_salted, "h long")
    texts = run_texts(pieces, tables, bit_table(salted, every.count())).dropDuplicates(["h", "g"])
    return every.join(texts, ["h", "g"]).select("lang", "phrase", "n")


def _salted(batches):
    for b in batches:
        h = b.column("h").to_numpy().view(np.uint64) ^ _mix((b.column("part").to_numpy().astype(np.uint64) + np.uint64(1)) * _ODD)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])


def _joined(words_: Column, first: int | Column, n: int | Column) -> Column:
    return F.array_join(F.slice(words_, first, n), " ")


def best_cuts(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score): each phrase of several words with its lowest-scoring cut."""
    phrases = counts.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 1)
    k = F.sequence(F.lit(1), F.size("w") - 1)
    asks = F.flatten(
        F.transform(
            k,
            lambda i: F.array(
                F.struct(i.alias("k"), F.lit(True).alias("left"), _joined(F.col("w"), 1, i).alias("part")),
                F.struct(i.alias("k"), F.lit(False).alias("left"), _joined(F.col("w"), i + 1, F.size("w") - i).alias("part")),
            ),
        )
    )
    requests = phrases.select("lang", "phrase", F.col("n").alias("a"), F.explode(asks).alias("ask")).select("lang", "phrase", "a", "ask.*")
    answers = requests.join(counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f")), ["lang", "part"])
    side = lambda left: F.max(F.when(F.col("left") == F.lit(left), F.col("f")))
    cuts = answers.groupBy("lang", "phrase", "a", "k").agg(side(True).alias("l"), side(False).alias("r"))
    wide = F.expr("(cast(2000000 as decimal(20, 0)) * a) div (cast(l as decimal(20, 0)) + r)")
    lowest = F.min(F.struct(wide.cast("long").alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def covered(counts: DataFrame, cover: int = COVER) -> DataFrame:
    """(lang, phrase): phrases inside a longer one that has ``cover`` hundredths of their count or more."""
    rows = counts.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 2)
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size("w") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: _joined(F.col("w"), i, n)),
        )
    )
    most = rows.select("lang", F.explode(inner).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    wide = F.expr(f"cast(100 as decimal(20, 0)) * most >= cast({cover} as decimal(20, 0)) * n")
    return most.join(counts, ["lang", "phrase"]).where(wide).select("lang", "phrase")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, sizes: tuple = SIZES, top: int = TOP, cover: int = COVER
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases."""
    pieces = materialise(in_small_batches(pieces_of(docs, text, lang)), "pieces")
    totals = materialise(pieces.groupBy("lang").agg(F.sum(F.col("times") * F.col("n_words")).alias("total"), F.sum("n_words").alias("distinct")), "totals")
    n_words = totals.agg(F.sum("distinct")).first()[0] or 0
    dealt = pieces.coalesce(-(-n_words // TASK_WORDS) or 1)
    tables: list[np.ndarray] = []
    levels: list[DataFrame] = []
    for n in range(1, sizes[-1] + 1):
        level = materialise(frequent_runs(dealt, n, tables, least), "frequent")
        found = level.count()
        levels.append(level)
        if not found:
            break
        tables.append(bit_table(level, found))
    counts = materialise(run_counts(dealt, levels, tables), "runs")
    discard(pieces, *levels)
    best = best_cuts(counts).join(covered(counts, cover), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
