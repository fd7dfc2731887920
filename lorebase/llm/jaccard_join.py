"""N-gram Jaccard self-join: size-aware heavy-light join, and its components.

A document's set holds the 64-bit hashes of its distinct 5-word shingles. Texts of
equal sets form a class (128-bit set hash); one set of each class takes part.

1. Counts. Every shingle of every document is counted in a table of 2 ** BITS
   places. It orders shingles from rare to frequent (ties by hash), the same way
   everywhere, so passages that many documents share come last.
2. Sizes. With Jaccard >= 0.75 two sets of n and m share at least 3/4 of the larger.
   The first n - ceil(3n/4) + k shingles of each then have k in common.
   Light sets (n <= boundary): all 2-subsets of the prefix for k = 2 are keys.
   Heavy sets: each shingle of the prefix for k = 1 is a key, and the inverted list of
   that key is scanned; so are those light sets that a heavy one can reach. The
   boundary is the one of least cost: number of subsets against lengths of lists, from
   sums over all documents by size.
   Shingles that stand in more than HOT places of the count table make lists of their
   own; all other lists of the same sets are merged.
3. Links. Each set is compared with the hub of a list, the set with the fewest prefix
   shingles that nobody else lists, and with a neighbour by size. Sets joined by verified
   links are contracted. In lists that still hold different components, those pairs are
   left that sizes, positions and bitmaps (folded ones in the join) allow. A set's bitmap holds the parity of the
   number of its shingles by place, so two bitmaps differ in no more places than the sets
   in shingles: no pair that links is lost. What is left out are pairs that are connected
   already, so components are exact while no list is expanded within one component.
4. Verification compares whole sets, made again from the texts. A pair carries one text
   to the other's.

Defined results. Null, empty or white-space text: empty set, size 0, linked with
nothing, its own component. Fewer than five words: the sequence is one shingle. Equal
texts link. A null doc_id takes part; component_id is the least doc_id that is not
null, else null. Repeated rows are each returned. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from lorebase.llm.batches import _mix, _ODD, ASCII_FOLD, SPACES, in_small_batches, large_list, runs, slices, words
from lorebase.llm.components import components
from lorebase.sources.tables import discard, materialise

GRAM = 5
#: Jaccard >= PART / WHOLE, in whole numbers.
PART, WHOLE = 3, 4
BITS = 18
#: Largest size up to which subsets are considered.
MAX_LIGHT = 64
#: Rows of two numbers that may be broadcast, 64 MB at most; beyond, a shuffled join.
MAX_BROADCAST_ROWS = 2_000_000
#: Count from which a shingle's list is not merged with others: its sets need not meet in one task.
HOT = 1 << 20
#: Sets of a list among which neighbours by size are sought.
NEIGHBOURS = 1000
#: Pairs of one hub that are verified in one task; a hub with more has its text in several.
HUB_PAIRS = 200
#: Bytes of texts whose sets are held at once.
VERIFY_BYTES = 4 << 20


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    h, _, _, first = words(data, offsets, SPACES, ASCII_FOLD)
    fives = runs(h, GRAM)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= GRAM:
            out.append(np.unique(fives[a : b - GRAM + 1]))
        else:
            out.append(runs(h[a:b], b - a) if b > a else fives[:0])
    return out


def prefix_size(n: int, k: int) -> int:
    return min(n, n - -(-PART * n // WHOLE) + k)


def _place(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def count_table(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Shingles of all documents by place: 2 ** BITS numbers at any size of the corpus."""

    def run(batches):
        total = np.zeros(1 << BITS, np.int64)
        for b in batches:
            for _, _, data, offsets in slices(b.column(0)):
                sets = shingle_sets(data, offsets)
                total += np.bincount(_place(np.concatenate(sets)), minlength=1 << BITS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["at", "n"])

    rows = in_small_batches(docs).select(F.col(text).alias("t")).mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << BITS, np.int64)
    out[rows.column("at").to_numpy()] = rows.column("n").to_numpy()
    return out


def parity_bits(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity of the shingles by place, of at least two places a shingle, and the same folded in half."""
    places = 64
    while places < 2 * len(u):
        places *= 2
    odd = np.bincount((u & np.uint64(places - 1)).astype(np.int64), minlength=places).astype(np.uint8) & 1
    half = odd[: places // 2] ^ odd[places // 2 :]
    return np.packbits(odd).view(np.int64), np.packbits(half).view(np.int64) if places > 64 else np.zeros(0, np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    return large_list(np.concatenate(parts) if parts else np.zeros(0, np.int64), np.array([len(p) for p in parts], np.int64), pa.int64())


def signed_sets(docs: DataFrame, counts: np.ndarray, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``.

    doc_id, text_hash, n, s1, s2 (set hash), prefix (k = 2, rare first), calm (how many of it are not hot),
    load (list lengths expected), bits and half (parity_bits).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(counts.astype(np.int64))

    def run(batches):
        table = shared.value
        even = table.sum() / len(table)
        for b in batches:
            sizes, s1, s2, calm, load = [], [], [], [], []
            prefix, bits, half = [], [], []
            for _, _, data, offsets in slices(b.column("t")):
                for u in shingle_sets(data, offsets):
                    n = len(u)
                    sizes.append(n)
                    s1.append(int(_mix(u + _ODD).sum(dtype=np.uint64)) ^ n)
                    s2.append(int(_mix(u ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)))
                    c = table[_place(u)]
                    p = u[np.lexsort((u, c))[: prefix_size(n, 2)]]
                    prefix.append(p.view(np.int64))
                    k = table[_place(p)]
                    calm.append(int((k <= HOT).sum()))
                    load.append(float((1 + np.maximum(0, k[: prefix_size(n, 1)] - even)).sum()))
                    whole, folded = parity_bits(u)
                    bits.append(whole)
                    half.append(folded)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    b.column("text_hash"),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.array(s1, np.uint64).view(np.int64)),
                    pa.array(np.array(s2, np.uint64).view(np.int64)),
                    _lists(prefix),
                    pa.array(calm, pa.int32()),
                    pa.array(load, pa.float64()),
                    _lists(bits),
                    _lists(half),
                ],
                ["doc_id", "text_hash", "n", "s1", "s2", "prefix", "calm", "load", "bits", "half"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash long, n long, s1 long, s2 long, prefix array<long>, calm int, load double, bits array<long>, half array<long>"
    return rows.mapInArrow(run, schema)


def boundary(sets: DataFrame) -> int:
    """The size up to which subsets cost less than lists, 0 for none."""
    rows = sets.where(F.col("n").between(1, MAX_LIGHT)).groupBy("n").agg(F.count(F.lit(1)).alias("c"), F.sum("load").alias("l")).collect()
    subsets = {r["n"]: r["c"] * math.comb(prefix_size(r["n"], 2), 2) for r in rows}
    lists = {r["n"]: r["l"] for r in rows}

    def cost(x: int) -> float:
        return sum(v for n, v in subsets.items() if n <= x) + sum(v for n, v in lists.items() if n * WHOLE >= PART * (x + 1))

    return min(range(MAX_LIGHT + 1), key=cost)


def postings(reps: DataFrame, x: int) -> DataFrame:
    """(key, node, at): subsets of light sets (pos -1), listed shingles of heavy ones and of those they can reach; at packs n, pos and hot."""
    n, prefix = F.col("n"), F.col("prefix")
    listed = reps.where(_listed(x)).select("node", "n", "calm", F.posexplode(F.slice(prefix, 1, _one())).alias("pos", "key"))
    listed = listed.select("key", "node", _packed(F.col("pos"), F.col("pos") >= F.col("calm")))
    if not x:
        return listed
    pairs = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size(prefix) - 1),
            lambda i: F.transform(
                F.slice(prefix, i + 1, F.size(prefix)),
                lambda b: F.struct(F.xxhash64(F.lit("pair"), F.element_at(prefix, i), b).alias("key"), (i > F.col("calm")).alias("hot")),
            ),
        )
    )
    # a subset is as rare as its rarer shingle at least
    light = reps.where((n <= x) & (F.size(prefix) >= 2)).select("node", "n", F.explode(pairs).alias("p"))
    return listed.unionAll(light.select("p.key", "node", _packed(F.lit(-1), F.col("p.hot"))))


def _packed(pos: Column, hot: Column) -> Column:
    """n, pos + 1 and hot in one number: most postings are of shingles that nobody else has, and are only dealt out."""
    return (F.shiftleft(F.col("n"), 32) + F.shiftleft(pos + 1, 1) + hot.cast("int")).alias("at")


def _unpacked(rows: DataFrame) -> DataFrame:
    n, pos = F.shiftright("at", 32), (F.shiftright("at", 1).bitwiseAND(F.lit((1 << 31) - 1).cast("long")) - 1)
    return rows.withColumns({"n": n, "pos": pos.cast("int")}).drop("at")


def _one() -> Column:
    """Size of the prefix for one shingle in common."""
    return (F.col("n") - F.ceil(F.col("n") * PART / WHOLE) + 1).cast("int")


def _listed(x: int) -> Column:
    return F.col("n") * WHOLE >= PART * (x + 1)


def live_lists(rows: DataFrame) -> DataFrame:
    """(k1, k2, node, n, pos, keys): lists of two sets or more; lists of the same sets, as neighbouring shingles have, are one.

    A set keeps its least position among them, so the bounds that follow still hold. ``keys`` counts the listed shingles.
    """
    whole = Window.partitionBy("key")
    marks = {
        "k1": F.bit_xor(F.xxhash64("node")).over(whole), "k2": F.bit_xor(F.xxhash64(F.lit("2"), "node")).over(whole), "size": F.count(F.lit(1)).over(whole)
    }
    is_hot = F.col("at") % 2 == 1
    live = rows.where(~is_hot).withColumns(marks).where("size > 1").select("k1", "k2", "node", "at")
    hot = rows.where(is_hot).select(F.col("key").alias("k1"), F.lit(0).cast("long").alias("k2"), "node", "at")
    keys = F.sum((F.col("pos") >= 0).cast("int"))
    merged = _unpacked(live.unionAll(hot)).groupBy("k1", "k2", "node")
    return merged.agg(F.min("n").alias("n"), F.greatest(F.min("pos"), F.lit(0)).alias("pos"), keys.alias("keys"))


def _can_link(na: Column, pa_: Column, nb: Column, pb: Column) -> Column:
    """Sizes allow it, and so do the shingles from here on if this is the first one in common."""
    sizes = (F.least(na, nb) * WHOLE >= F.greatest(na, nb) * PART)
    return sizes & (F.least(na - pa_, nb - pb) * (PART + WHOLE) >= PART * (na + nb))


def _unlike(a: Column, b: Column) -> Column:
    """Places in which two bitmaps of one length differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, c: s + c)


#: Numbers in a sketch: a bitmap folded to 256 places, small enough for every row of a list.
SKETCH = 4


def _sketch(bits: Column) -> Column:
    """A bitmap folded to SKETCH numbers, or as it is if it has no more."""
    fold = lambda k: F.aggregate(F.filter(bits, lambda _, i: i % SKETCH == k), F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(x))
    return F.when(F.size(bits) <= SKETCH, bits).otherwise(F.array(*[fold(k) for k in range(SKETCH)]))


def _sketches_allow(a: Column, b: Column, na: Column, nb: Column) -> Column:
    return (F.size(a) != F.size(b)) | (_unlike(a, b) * (PART + WHOLE) <= (na + nb) * (WHOLE - PART))


def _bits_allow(a: str, b: str) -> Column:
    """Sets that link differ in 1 / 7 of their sizes' sum at most, and bitmaps in no more; a larger bitmap is taken folded."""
    wide, other = F.size(f"{a}bits"), F.size(f"{b}bits")
    unlike = (
        F.when(wide == other, _unlike(F.col(f"{a}bits"), F.col(f"{b}bits")))
        .when(wide > other, _unlike(F.col(f"{a}half"), F.col(f"{b}bits")))
        .otherwise(_unlike(F.col(f"{a}bits"), F.col(f"{b}half")))
    )
    return unlike * (PART + WHOLE) <= (F.col(f"{a}n") + F.col(f"{b}n")) * (WHOLE - PART)


def first_pairs(lists: DataFrame, reps: DataFrame, x: int) -> DataFrame:
    """(a, b): each set with the hubs of its lists, and with its neighbours by size in them."""
    alive = lists.groupBy("node").agg(F.sum("keys").alias("keys"))
    alone = alive.join(reps.select("node", "n"), "node")
    alone = alone.select("node", F.when(_listed(x), _one() - F.col("keys")).otherwise(0).alias("alone"))
    lists = lists.join(alone, "node")
    hubs = lists.groupBy("k1", "k2").agg(F.min(F.struct("alone", "node", "n", "pos")).alias("hub"), F.count(F.lit(1)).alias("size"))
    lists = lists.join(hubs, ["k1", "k2"])
    # neighbours are sought in parts of a list, so that a long one is no single task's
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / NEIGHBOURS))
    by_size = Window.partitionBy("k1", "k2", "part").orderBy("n", "node")
    o = F.struct(*[F.col(f"hub.{c}") for c in ("node", "n", "pos")])
    near = lists.withColumn("part", part).withColumn("prev", F.lag(F.struct("node", "n", "pos")).over(by_size))
    near = near.select("node", "n", "pos", F.explode(F.array(o, "prev")).alias("o")).where("o is not null and node <> o.node")
    near = near.where(_can_link(F.col("n"), F.col("pos"), F.col("o.n"), F.col("o.pos")))
    return near.select(F.col("o.node").alias("a"), F.col("node").alias("b")).distinct()


def bounded(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs whose bitmaps allow a link."""
    side = lambda s: reps.select(F.col("node").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("n", "bits", "half")])
    return pairs.join(side("a"), "a").join(side("b"), "b").where(_bits_allow("a_", "b_")).select("a", "b")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Those pairs of nodes whose whole sets link."""
    pairs = materialise(pairs, "pairs")
    hubs = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB_PAIRS).cast("int").alias("parts")).where("parts > 1")
    hubs = F.broadcast(hubs) if pairs.count() <= MAX_BROADCAST_ROWS * HUB_PAIRS else hubs
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = materialise(classes.join(nodes, "node", "left_semi").select("node", F.col("doc_id").alias("w_id"), F.col("text_hash").alias("w_hash")), "wanted")
    small = wanted.count() <= MAX_BROADCAST_ROWS
    rows = docs.select(F.col(id_col).alias("d_id"), F.xxhash64(text).alias("d_hash"), F.col(text).alias("text"))
    on = (F.col("d_hash") == F.col("w_hash")) & F.col("d_id").eqNullSafe(F.col("w_id"))
    # both joins below read one shuffle of the texts by node
    texts = rows.join(F.broadcast(wanted) if small else wanted, on).select("node", "text").dropDuplicates(["node"])

    def run(batches):
        for b in (part for whole in batches for part in _by_bytes(whole)):
            ids = [b.column(c).to_numpy() for c in ("a", "b")]
            every = np.concatenate(ids)
            distinct, at, back = np.unique(every, return_index=True, return_inverse=True)
            column = pa.concat_arrays([b.column("ta"), b.column("tb")]).take(pa.array(at))
            sets = [s for _, _, data, offsets in slices(column) for s in shingle_sets(data, offsets)]
            m, keep = len(ids[0]), []
            for i in range(m):
                x, y = sets[back[i]], sets[back[m + i]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both * WHOLE >= PART * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(mask), b.column("b").filter(mask)], ["a", "b"])

    a = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    # a hub, as a, has its text on a row for each part; what is dealt out with the pairs are the other sides' texts
    parts = F.coalesce("parts", F.lit(1))
    a = a.join(hubs, "a", "left").select("a", "ta", F.explode(F.sequence(F.lit(1), parts)).alias("part"))
    pairs_ = pairs.join(hubs, "a", "left").select("a", "b", (F.pmod(F.xxhash64("b"), parts) + 1).cast("int").alias("part"))
    found = materialise(pairs_.join(b, "b").join(a, ["a", "part"]).select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long"), "links")
    discard(pairs, wanted)
    return found


def _by_bytes(batch: pa.RecordBatch):
    """Consecutive rows with about VERIFY_BYTES of text."""
    size = np.cumsum(sum(pc.binary_length(batch.column(c)).to_numpy(zero_copy_only=False) for c in ("ta", "tb")))
    at = 0
    while at < len(batch):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + VERIFY_BYTES, "right")))
        yield batch.slice(at, end - at)
        at = end


def _row() -> Column:
    """Orders rows by doc_id, null last, then text."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")


def classes_and_links(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with n, s1, s2), (classes with node and least id), (edges that connect all components)."""
    sets = materialise(signed_sets(docs, count_table(docs, text), id_col, text).withColumn("node", F.monotonically_increasing_id()), "sets")
    x = boundary(sets)
    full = sets.where("n > 0")
    by_set = full.groupBy("s1", "s2").agg(F.min("node").alias("node"), F.min("doc_id").alias("min_id"), F.min(_row()).alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = materialise(by_set.select("node", "s1", "s2", "min_id", F.col("rep.doc_id").alias("doc_id"), F.col("rep.text_hash").alias("text_hash"), "copies"), "classes")
    once, repeated = _one_of_each(full, classes)
    reps = full.join(repeated, "node", "left_anti") if once else full

    lists = materialise(live_lists(postings(reps, x)), "lists")
    star = bounded(first_pairs(lists, reps, x), reps)
    first = verified(star, classes, docs, id_col, text)
    labels = materialise(components(first), "labels")

    held = lists.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = held.groupBy("k1", "k2").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("k1", "k2")
    sketches = reps.select("node", _sketch(F.col("bits")).alias("sketch"))
    held = materialise(held.join(mixed, ["k1", "k2"], "left_semi").join(sketches, "node"), "held")
    # the same columns on both sides, so that they share one exchange
    side = lambda s: held.select(*[F.col(c).alias(f"{s}_{c}") for c in ("k1", "k2", "node", "n", "pos", "label", "sketch")])
    l, r = (lambda c: F.col(f"l_{c}")), (lambda c: F.col(f"r_{c}"))  # noqa: E731, E741
    apart = (l("label") < r("label")) & _can_link(l("n"), l("pos"), r("n"), r("pos")) & _sketches_allow(l("sketch"), r("sketch"), l("n"), r("n"))
    rest = side("l").join(side("r"), (l("k1") == r("k1")) & (l("k2") == r("k2")) & apart)
    rest = rest.select(r("node").alias("a"), l("node").alias("b")).distinct()
    more = verified(bounded(rest, reps), classes, docs, id_col, text)
    discard(lists, held, first)
    known = labels.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
    return sets.select("doc_id", "text_hash", "n", "s1", "s2"), classes, known.unionAll(more.select("a", "b"))


def _one_of_each(full: DataFrame, classes: DataFrame) -> tuple[bool, DataFrame]:
    """(whether any set has copies, the nodes that are not their class's)."""
    many = classes.where("copies > 1")
    n = many.agg(F.sum("copies")).first()[0] or 0
    many = many.select(F.col("s1").alias("m1"), F.col("s2").alias("m2"), F.col("node").alias("kept"))
    near = F.broadcast if n <= MAX_BROADCAST_ROWS else lambda df: df
    gone = full.join(near(many), (F.col("s1") == F.col("m1")) & (F.col("s2") == F.col("m2"))).where("node <> kept").select("node")
    return n > 0, near(gone)


def _components(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows of non-empty sets with component_id and the component's first row, rows of empty sets)."""
    rows, classes, links = classes_and_links(docs, id_col, text)
    labels = components(links)
    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("min_id").alias("component_id"), F.min(_row()).alias("first"))
    of_class = named.join(least, "label").select("s1", "s2", "component_id", "first")
    linked = rows.where("n > 0").join(of_class, ["s1", "s2"])
    return linked, rows.where("n = 0")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id for every row."""
    linked, empty = _components(docs, id_col, text)
    cols = ["doc_id", "text_hash", F.col("n").alias("n_shingles")]
    return linked.select(*cols, "component_id").unionAll(empty.select(*cols, F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, the one of least doc_id (null last) and text hash, and all rows of empty sets.

    Of rows that repeat both, the one whose columns sort first stays. All columns stay, whatever their names.
    """
    names = docs.columns
    rows = docs.toDF(*[f"c{k}" for k in range(len(names))])
    i, t = F.col(f"c{names.index(id_col)}"), F.col(f"c{names.index(text)}")
    linked, _ = _components(docs, id_col, text)
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    marked = linked.groupBy(F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_hash"), kept.alias("kept")).agg(F.count(F.lit(1)).alias("copies"))
    marked = materialise(marked.where("not kept or copies > 1"), "gone")
    repeated = marked.where("kept").select("g_id", "g_hash")
    on = i.eqNullSafe(F.col("g_id")) & (F.xxhash64(t) == F.col("g_hash"))
    near = lambda keys: F.broadcast(keys) if keys.count() <= MAX_BROADCAST_ROWS else keys
    rest = rows.join(near(marked.select("g_id", "g_hash")), on, "left_anti")
    if not repeated.isEmpty():
        again = rows.join(near(repeated), on, "left_semi")
        once = again.groupBy(i.alias("g_id"), F.xxhash64(t).alias("g_hash")).agg(F.min(F.struct(*rows.columns)).alias("row"))
        rest = rest.unionAll(once.select("row.*"))
    return rest.toDF(*names)
