"""A walk over new rows, each taking its best old row that is left, without rounds.

What a row may take is told by class: equal new rows are one class, and a class wants pools of
old rows at a rank. So rows of equal keys are never paired with one another. Classes and pools
that are connected make a component, and components are independent of one another. One with a
single pool is a run: its k-th new row takes the pool's k-th row that is left, found by
numbering both sides, whatever their number. Any other component of at most MAX_COMPONENT rows
is walked by one task, in narrow rows; a larger one is walked in blocks of BLOCK new rows, each of
which reads only the first old rows of its pools that are left. Pairs are never written out.
"""

from __future__ import annotations

import heapq
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lorebase.operators.components import components
from lorebase.sources.tables import discard, materialise

#: Rows of a component that one task walks.
MAX_COMPONENT = 200_000
#: New rows of a block of a larger component.
BLOCK = 200_000
LINKS = "new_id long, old_id long, rank int"
#: Ranks of rows of a walk that are no links: an old row that was taken from outside, and the number of the last new row that was walked.
TAKEN, DONE = -2, -1


def numbered(rows: DataFrame, key: list[str], *by: str) -> DataFrame:
    """``rows`` with ``__no``, from 1 by ``by`` within each key.

    Rows are dealt by ranges of (key, by), so that a key with very many rows is
    counted by several tasks; only counts by range and key are added up in one place.
    """
    ranged = rows.repartitionByRange(*key, *by).withColumn("__range", F.spark_partition_id())
    dealt = materialise(ranged, "dealt")
    counts = dealt.groupBy("__range", *key).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("__range", *key, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__range", *key).orderBy(*by))
    return dealt.withColumn("__no", place).join(before, ["__range", *key]).withColumn("__no", F.col("__no") + F.col("__before")).drop("__range", "__before")


def greedy(pairs: DataFrame, rank: str = "rank", order: tuple | None = None) -> DataFrame:
    """Pairs (new_id, old_id, rank) -> a matching; lower (rank, new_id, old_id), or lower ``order``, goes first. In rounds."""
    by = order or (rank, "new_id", "old_id")
    left = materialise(pairs.select(*dict.fromkeys(("new_id", "old_id", rank, *by))).distinct(), "pairs")
    taken = None
    while not left.isEmpty():
        first = F.struct(*by)
        first_new = left.groupBy("new_id").agg(F.min(first).alias("n"))
        first_old = left.groupBy("old_id").agg(F.min(first).alias("o"))
        here = left.join(first_new, "new_id").join(first_old, "old_id").where((F.col("n") == first) & (F.col("o") == first)).select("new_id", "old_id", rank)
        here = materialise(here, "taken")
        taken = here if taken is None else taken.unionAll(here)
        before, left = left, materialise(left.join(here.select("new_id"), "new_id", "left_anti").join(here.select("old_id"), "old_id", "left_anti"), "pairs")
        discard(before)
    discard(left)
    return pairs.limit(0).select("new_id", "old_id", rank) if taken is None else taken


def _skipped(marks: DataFrame) -> DataFrame:
    """(old_id) of rows that a run passes over.

    ``marks`` has (comp, p, c, old_id): the row at place p is taken from outside before the run's
    (c + 1)-th new row asks. The pointer comes to it after p - 1 - (passed over before) rows, so it is
    passed over if that is c or more. A fold over a component's marks, which are as many as the distinct
    dates of a name.
    """
    each = F.array_sort(F.collect_list(F.struct("p", "c", "old_id")))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.array().cast("array<long>").alias("ids"))

    def step(a, m):
        over = m["p"] - 1 - a["n"] >= m["c"]
        return F.struct(
            (a["n"] + F.when(over, 1).otherwise(0)).cast("long").alias("n"), F.when(over, F.array_append(a["ids"], m["old_id"])).otherwise(a["ids"]).alias("ids")
        )

    return marks.groupBy("comp").agg(each.alias("m")).select(F.explode(F.aggregate("m", start, step)["ids"]).alias("old_id"))


def _runs(new: DataFrame, wants: DataFrame, holds: DataFrame, fixed: DataFrame | None) -> DataFrame:
    """Links of components with one pool: new (comp, new_id, c), holds (comp, old_id, place)."""
    free = new if fixed is None else new.join(fixed.select("new_id"), "new_id", "left_anti")
    rows = holds.select("comp", "old_id", "place").distinct()
    if fixed is not None:
        since = fixed.groupBy("old_id").agg(F.min("new_id").alias("since"))
        placed = numbered(rows, ["comp"], "place", "old_id").join(since, "old_id").select("comp", "old_id", "since", F.col("__no").alias("p"))
        events = free.select("comp", F.col("new_id").alias("at"), F.lit(0).alias("mark"), F.lit(None).cast("long").alias("old_id"))
        events = events.unionAll(placed.select("comp", F.col("since").alias("at"), F.lit(1).alias("mark"), "old_id"))
        among = numbered(events, ["comp"], "at", "mark").where("mark = 1").select("comp", "old_id", F.col("__no").alias("n"))
        alone = Window.partitionBy("comp").orderBy("n")  # marks only, as many as the distinct dates of a name
        asked = among.withColumn("c", F.col("n") - F.row_number().over(alone)).select("comp", "old_id", "c")
        gone = materialise(_skipped(placed.join(asked, ["comp", "old_id"]).select("comp", "p", "c", "old_id")), "skipped")
        rows = rows.join(gone, "old_id", "left_anti")
    a = numbered(free, ["comp"], "new_id").select("comp", "__no", "new_id", "c")
    b = numbered(rows, ["comp"], "place", "old_id").select("comp", "__no", "old_id")
    best = wants.groupBy("comp", "c").agg(F.min("rank").alias("rank"))
    return a.join(b, ["comp", "__no"]).join(best, ["comp", "c"]).select("new_id", "old_id", "rank")


def _walk_component(rows: pd.DataFrame) -> pd.DataFrame:
    """Kinds of rows: 0 new (n, c), 1 wanted (c, p, rank), 2 held (p, o, place), 3 taken from outside when n asks (n, o), 4 pool that has more rows than are here (p).

    ``no`` numbers kinds 0 and 3. The walk ends before the first new row that would need more of such a pool.
    """
    kind, comp = rows["kind"].to_numpy(), rows["comp"].iloc[0]
    of = lambda k, *cols: list(zip(*[rows[x].to_numpy()[kind == k].tolist() for x in cols]))
    pools: dict = {}
    for p, o, place in of(2, "p", "o", "place"):
        pools.setdefault(p, []).append((place, o))
    for held in pools.values():
        held.sort(reverse=True)
    tiers: dict = {}
    for c, p, rank in of(1, "c", "p", "rank"):
        if p in pools:
            tiers.setdefault(c, {}).setdefault(rank, []).append((pools[p][-1], p))
    for ranks in tiers.values():
        for heap in ranks.values():
            heapq.heapify(heap)
    more, used, out, last = {p for (p,) in of(4, "p")}, set(), [], 0

    def best(heap):
        """The least old row left of the pools of a heap, None if there is none; False if only rows that are not here can tell. First rows only grow, so an entry may lag behind."""
        while heap:
            was, p = heap[0]
            held = pools[p]
            while held and held[-1][1] in used:
                held.pop()
            if not held:
                if p in more:
                    return False
                heapq.heappop(heap)
            elif held[-1] == was:
                return was
            else:
                heapq.heapreplace(heap, (held[-1], p))
        return None

    for no, n, c, o in sorted([(no, n, c, None) for no, n, c in of(0, "no", "n", "c")] + [(no, n, None, o) for no, n, o in of(3, "no", "n", "o")], key=lambda x: x[0]):
        if o is not None:
            used.add(o)
            out.append((n, o, TAKEN))
        ranks, found = tiers.get(c) or {}, None
        for rank in sorted(ranks):
            found = best(ranks[rank])
            if found is not None:
                break
            del ranks[rank]
        if found is False:
            break
        if found is not None:
            used.add(found[1])
            out.append((n, found[1], rank))
        last = no
    out.append((last, 0, DONE))
    links = pd.DataFrame(out, columns=["new_id", "old_id", "rank"]).astype({"new_id": "int64", "old_id": "int64", "rank": "int32"})
    return links.assign(comp=comp)


def _flat(new: DataFrame, wants: DataFrame, holds: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """The rows of ``_walk_component``: new (comp, no, new_id, c, old_id), where old_id is null but for rows taken from outside."""
    null = lambda kind: F.lit(None).cast(kind)
    row = lambda df, k, no, n, o, c, p, rank, place: df.select(
        "comp", k.alias("kind"), no.cast("long").alias("no"), n.cast("long").alias("n"), o.cast("long").alias("o"), c.alias("c"), p.alias("p"), rank.cast("int").alias("rank"), place.cast("long").alias("place")
    )
    none, text = F.lit(0), null("string")
    taken = F.col("old_id").isNotNull()
    parts = [
        row(new, F.when(taken, 3).otherwise(0), F.col("no"), F.col("new_id"), F.coalesce("old_id", none), F.col("c"), text, none, none),
        row(wants, F.lit(1), none, none, none, F.col("c"), F.col("pool"), F.col("rank"), none),
        row(holds, F.lit(2), none, none, F.col("old_id"), text, F.col("pool"), none, F.col("place")),
    ]
    if more is not None:
        parts.append(row(more, F.lit(4), none, none, none, text, F.col("pool"), none, none))
    return reduce(DataFrame.unionAll, parts)


def _events(new: DataFrame, holds: DataFrame, fixed: DataFrame | None) -> DataFrame:
    """(comp, new_id, c, old_id): new rows that are not fixed, and where an old row is first taken from outside, without class."""
    none = F.lit(None).cast("long").alias("old_id")
    if fixed is None:
        return new.select("comp", "new_id", "c", none)
    since = fixed.groupBy("old_id").agg(F.min("new_id").alias("new_id"))
    taken = holds.select("comp", "old_id").distinct().join(since, "old_id").select("comp", "new_id", F.lit(None).cast("string").alias("c"), "old_id")
    return new.join(fixed.select("new_id"), "new_id", "left_anti").select("comp", "new_id", "c", none).unionAll(taken)


def _in_blocks(new: DataFrame, wants: DataFrame, holds: DataFrame, fixed: DataFrame | None, block: int) -> DataFrame:
    """Links of components of any size, ``block`` new rows of each at a time.

    Of a class no more rows can be linked than its pools hold, and those are its first. A block reads of each pool as many
    old rows as it might take twice over; where that was too few, the next block begins at the row that asked for more.
    """
    key = ["comp", "c"]
    room = wants.join(holds.groupBy("comp", "pool").agg(F.count(F.lit(1)).alias("n")), ["comp", "pool"]).groupBy(*key).agg(F.sum("n").alias("room"))
    events = materialise(_events(new, holds, fixed), "events")
    asking = numbered(events.where("old_id is null"), key, "new_id").join(room, key).where("__no <= room").select("comp", "new_id", "c", "old_id")
    rows = materialise(numbered(asking.unionAll(events.where("old_id is not null")), ["comp"], "new_id").withColumnRenamed("__no", "no"), "asking")
    at = materialise(rows.groupBy("comp").agg(F.max("no").alias("last")).select("comp", F.lit(0).cast("long").alias("at"), "last"), "at")
    left, out = holds, []
    while not at.isEmpty():
        # where the walk goes on: the first row that is taken from outside or whose class has a pool with rows left
        live = wants.join(left.select("comp", "pool").distinct(), ["comp", "pool"], "left_semi").select(*key).distinct()
        ahead = rows.join(F.broadcast(at), "comp").where("no > at")
        ahead = ahead.where("old_id is not null").select("comp", "no").unionAll(ahead.join(live, key, "left_semi").select("comp", "no"))
        first = ahead.groupBy("comp").agg(F.min("no").alias("first"))
        now = materialise(rows.join(F.broadcast(first), "comp").where((F.col("no") >= F.col("first")) & (F.col("no") < F.col("first") + block)).drop("first"), "block")
        asked = now.where("old_id is null").groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        asked = materialise(wants.join(asked, key), "asked")
        need = asked.groupBy("comp", "pool").agg(F.sum("n").alias("n"))
        spare = need.groupBy("comp").agg((F.lit(16 + block) / F.count(F.lit(1))).cast("long").alias("spare"))
        need = need.join(spare, "comp").select("comp", "pool", (2 * F.col("n") + F.col("spare") + 1).alias("most"))
        held = numbered(left.join(need, ["comp", "pool"]), ["comp", "pool"], "place", "old_id")
        held = materialise(held.where("__no <= most + 1"), "held")
        flat = _flat(now, asked, held.where("__no <= most"), held.where("__no > most"))
        done = materialise(flat.groupBy("comp").applyInPandas(_walk_component, f"{LINKS}, comp string"), "walked")
        out.append(done.where("rank >= 0").select("new_id", "old_id", "rank"))
        before = at, now, asked, held, left
        left = materialise(left.join(done.where(f"rank <> {DONE}").select("old_id"), "old_id", "left_anti"), "left")
        at = materialise(at.join(done.where(f"rank = {DONE}").select("comp", F.col("new_id").alias("to")), "comp").select("comp", F.col("to").alias("at"), "last").where("at < last"), "at")
        discard(*(x for x in before if x is not holds))
    discard(events, rows, at)
    return reduce(DataFrame.unionAll, out) if out else new.sparkSession.createDataFrame([], LINKS)


def _fewer_classes(new: DataFrame, wants: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes that want the same pools at the same ranks made one, named by the least of them; equal ones are told by 128 bits and their number."""
    marks = [F.bit_xor(F.xxhash64(F.lit(k), "rank", "pool")).alias(f"h{k}") for k in (0, 1)]
    kinds = wants.groupBy("c").agg(*marks, F.count(F.lit(1)).alias("pools"))
    least = kinds.groupBy("h0", "h1", "pools").agg(F.min("c").alias("least"))
    names = materialise(kinds.join(least, ["h0", "h1", "pools"]).select("c", "least"), "classes")
    fewer = materialise(wants.join(names.where("c = least").select("c"), "c", "left_semi"), "wants")
    discard(wants)
    return new.join(names, "c").select("new_id", F.col("least").alias("c")), fewer


def walked(new: DataFrame, wants: DataFrame, holds: DataFrame, fixed: DataFrame | None = None, max_component: int | None = None) -> DataFrame:
    """(new_id, old_id, rank): each new row, by id, takes the old row of least (rank, place, old_id) that no row before has.

    ``new`` has (new_id, c), ``wants`` (c, pool, rank), ``holds`` (pool, old_id, place); an old row may be in several
    pools. ``fixed`` (new_id, old_id) are taken whatever was taken before, and are used from then on.
    """
    bound = MAX_COMPONENT if max_component is None else max_component
    asked = materialise(wants.groupBy("c", "pool").agg(F.min("rank").alias("rank")), "asked")  # dear to find, and read twice
    holds = materialise(holds.join(asked.select("pool").distinct(), "pool", "left_semi").distinct(), "holds")
    wants = materialise(asked.join(holds.select("pool").distinct(), "pool", "left_semi"), "wants")
    discard(asked)
    new, wants = _fewer_classes(new, wants)
    class_, pool = lambda c: F.concat(F.lit("c"), c), lambda p: F.concat(F.lit("p"), p)
    first = holds.groupBy("old_id").agg(F.min("pool").alias("first"))
    shared = holds.join(first, "old_id").select(pool(F.col("first")).alias("a"), pool(F.col("pool")).alias("b"))
    labels = components(wants.select(class_(F.col("c")).alias("a"), pool(F.col("pool")).alias("b")).unionAll(shared).distinct())
    of = lambda df, key: df.withColumn("node", key).join(labels.withColumnRenamed("label", "comp"), "node").drop("node")
    n, w, h = of(new.select("new_id", "c"), class_(F.col("c"))), of(wants, class_(F.col("c"))), of(holds, pool(F.col("pool")))
    n, w, h = (materialise(x, tag) for x, tag in ((n, "new"), (w, "wants"), (h, "holds")))
    discard(labels, wants, holds)
    sizes = reduce(DataFrame.unionAll, [
        n.select("comp", F.lit(1).alias("rows"), F.lit(0).alias("pools")),
        w.select("comp", F.lit(1).alias("rows"), F.lit(0).alias("pools")),
        h.select("comp", F.lit(1).alias("rows"), F.lit(0).alias("pools")),
        h.select("comp", "pool").distinct().select("comp", F.lit(0).alias("rows"), F.lit(1).alias("pools")),
    ])
    sizes = sizes.groupBy("comp").agg(F.sum("rows").alias("rows"), F.sum("pools").alias("pools"))
    kind = F.when(F.col("pools") == 1, "run").when(F.col("rows") <= bound, "walk").otherwise("blocks")
    kinds = materialise(sizes.select("comp", kind.alias("how")), "kinds")
    present = {r["how"] for r in kinds.select("how").distinct().collect()}  # three at most
    some = lambda df, how: df.join(kinds.where(F.col("how") == how).select("comp"), "comp", "left_semi")
    out = [] if fixed is None else [fixed.select("new_id", "old_id", F.lit(0).alias("rank"))]
    if "run" in present:
        out.append(_runs(some(n, "run"), some(w, "run"), some(h, "run"), fixed))
    if "walk" in present:
        events = _events(some(n, "walk"), some(h, "walk"), fixed).withColumn("no", F.col("new_id"))  # a new row's number may be its id
        done = _flat(events, some(w, "walk"), some(h, "walk")).groupBy("comp").applyInPandas(_walk_component, f"{LINKS}, comp string")
        out.append(done.where("rank >= 0").select("new_id", "old_id", "rank"))
    if "blocks" in present:
        out.append(_in_blocks(some(n, "blocks"), some(w, "blocks"), some(h, "blocks"), fixed, BLOCK))
    links = [x.select(F.col("new_id").cast("long").alias("new_id"), F.col("old_id").cast("long").alias("old_id"), F.col("rank").cast("int").alias("rank")) for x in out]
    result = materialise(reduce(DataFrame.unionAll, links) if links else new.sparkSession.createDataFrame([], LINKS), "links")
    discard(n, w, h, kinds)
    return result
