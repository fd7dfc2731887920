"""Exact top-k inner products: ball-tree branch and bound in each shard.

Rows are dealt to the nearest of at most MAX_PIVOTS centres, which are fitted on a
bounded sample of PER_PIVOT rows a centre; every row is dealt. The rows of a centre make
one shard, or several by hash where there are more than SHARD_ROWS, so that equal vectors
of any number are split. Each shard's rows are split recursively along the line between
two far rows, which gives a tree of balls (centre, radius).

A query meets centres in the order of the bound q.c + |q| r, in waves: its best centre
first, then the next three, then the rest. After each wave its kth score so far goes along
and drops the centres whose bound lies below it before anything is sent. What is left is
grouped by shard, BLOCK_ROWS queries a group, so that a tree travels once a group.
Inside a shard a query sees the leaf of its largest bound first; the nodes are then taken
in the order of their largest bound, for those queries whose kth score they can reach.

Scores are inner products of integers floor(64 x). They are computed in float32 where
all sums stay below 2 ** 24, in float64 below 2 ** 53, in 64-bit integers below 2 ** 62, else
in Python's integers of any size. A component, or a score that is computed, beyond 64 bits is an error.

Defined results. A vector that is null or holds a null, NaN or infinite component
takes no part. Vectors of different lengths count missing components as 0. Ties go to
the smaller vec_id, a null vec_id last. Repeated rows each take part; a row is left
out for itself only. Empty table: empty result. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lorebase.llm.batches import in_small_batches
from lorebase.sources.tables import discard, materialise

K, EVERY, SCALE = 20, 20, 64
SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 8192, 4096, 64
#: A centre for so many rows, MAX_PIVOTS at most, and the sample they are fitted on.
PIVOT_ROWS, MAX_PIVOTS, PER_PIVOT, STEPS = 1024, 1024, 8, 3
LIMIT = float(1 << 62)
_NO_ID = (1 << 63) - 1
#: Centres, by their bounds, in the first and second wave; the last wave takes the rest.
WAVES = (1, 3)
#: Queries whose bounds to all centres are held at once.
ASK_ROWS = 2048


def vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(uid, vec_id, v) of the rows that take part, written once."""
    x = F.col(vector)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    too_large = F.raise_error(F.lit("a scaled component does not fit 64 bits")).cast("long")
    whole = F.transform(
        x, lambda e: F.when(F.abs(e.cast("double") * SCALE) < LIMIT, F.floor(e.cast("double") * SCALE).cast("long")).otherwise(too_large)
    )
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.when(finite, whole).alias("v")).where("v is not null")
    return materialise(rows.withColumn("uid", F.monotonically_increasing_id()), "vectors")


def _matrix(rows: list) -> np.ndarray:
    d = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), d), np.int64)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


def _arrow_matrix(column: pa.ListArray) -> np.ndarray:
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _widened(v: np.ndarray, d: int) -> np.ndarray:
    return np.pad(v, ((0, 0), (0, d - v.shape[1]))) if v.shape[1] < d else v


def _alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = max(a.shape[1], b.shape[1])
    return _widened(a, d), _widened(b, d)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    x, c = _alike(x, centres)
    return ((c * c).sum(1) - 2 * (x @ c.T)).argmin(1)


def bounds(q: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Upper bounds of q.v over the balls, a little above for rounding."""
    q, c = _alike(q, centres)
    size = np.linalg.norm(q, axis=1)[:, None]
    out = q @ c.T + size * radii
    return out + 1e-9 * (np.abs(out) + size * np.linalg.norm(c, axis=1) + 1)


def fit_pivots(rows: DataFrame) -> np.ndarray:
    """Centres, fitted on a sample of PER_PIVOT * MAX_PIVOTS rows at most."""
    pivots = min(MAX_PIVOTS, max(1, rows.count() // PIVOT_ROWS))
    sample = rows.orderBy(F.xxhash64(F.lit("pivot"), "uid")).limit(PER_PIVOT * pivots).select("v").toArrow()
    x = _arrow_matrix(sample.column("v").combine_chunks()).astype(np.float64)
    _, first = np.unique(x, axis=0, return_index=True)
    centres = x[np.sort(first)[:pivots]]
    for _ in range(STEPS if len(centres) else 0):
        near = _nearest(x, centres)
        for k in np.unique(near):
            centres[k] = x[near == k].mean(0)
    return centres


def _small(v: np.ndarray) -> np.ndarray:
    """The same integers in the smallest type that holds them."""
    most = int(np.abs(v).max(initial=0))
    return v.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def build_tree(ids: np.ndarray, uids: np.ndarray, v: np.ndarray) -> dict:
    """Rows in leaf order; nodes as (centre, radius, first row, end row, children or -1)."""
    order = np.arange(len(v))
    x = v.astype(np.float64)
    centres, radii, spans, kids = [], [], [], []

    def node(lo: int, hi: int) -> int:
        here = len(centres)
        rows = x[order[lo:hi]]
        c = rows.mean(0)
        away = np.linalg.norm(rows - c, axis=1)
        centres.append(c)
        radii.append(away.max())
        spans.append((lo, hi))
        kids.append((-1, -1))
        if hi - lo > LEAF_ROWS:
            p = rows[away.argmax()]
            q = rows[np.linalg.norm(rows - p, axis=1).argmax()]
            side = np.argsort(rows @ (q - p), kind="stable")
            order[lo:hi] = order[lo:hi][side]
            mid = (lo + hi) // 2
            kids[here] = (node(lo, mid), node(mid, hi))
        return here

    node(0, len(v))
    return {"ids": ids[order], "uids": uids[order], "v": _small(v[order]), "c": np.array(centres), "r": np.array(radii), "spans": spans, "kids": kids}


def search(tree: dict, uids: np.ndarray, q: np.ndarray, kth: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vec_ids, uids, scores), a line a query: its k best rows that reach its kth score so far; uid _NO_ID where there is none."""
    q, v = _alike(q, tree["v"])
    most = q.shape[1] * float(np.abs(q).max(initial=0)) * float(np.abs(v.astype(np.float64)).max(initial=0))
    kind = np.float32 if most < 2.0**24 else np.float64 if most < 2.0**53 else np.int64 if most < 2.0**62 else object
    reach = bounds(q.astype(np.float64), tree["c"], tree["r"])
    q, v = q.astype(kind), v.astype(kind)
    ids, own, scores = np.full((len(q), k), _NO_ID), np.full((len(q), k), _NO_ID), np.full((len(q), k), -_NO_ID)
    least = kth.copy()

    def score(leaf: int, i: np.ndarray) -> None:
        lo, hi = tree["spans"][leaf]
        s = q[i] @ v[lo:hi].T
        other = tree["uids"][lo:hi] != uids[i][:, None]
        if kind is object:
            s = np.where(other, s, 0)
            if (np.abs(s) >= 1 << 63).any():
                raise OverflowError("a score does not fit 64 bits")
        s = s.astype(np.int64)
        hit = other & (s >= least[i][:, None])
        some = hit.any(1)
        i, s, hit = i[some], s[some], hit[some]
        s = np.concatenate((scores[i], np.where(hit, s, -_NO_ID)), 1)
        a = np.concatenate((ids[i], np.where(hit, tree["ids"][lo:hi], _NO_ID)), 1)
        u = np.concatenate((own[i], np.where(hit, tree["uids"][lo:hi], _NO_ID)), 1)
        best = np.lexsort((u, a, -s), axis=1)[:, :k]
        ids[i], own[i], scores[i] = (np.take_along_axis(x, best, 1) for x in (a, u, s))
        least[i] = np.where(own[i, -1] != _NO_ID, np.maximum(least[i], scores[i, -1]), least[i])

    leaves = np.array([n for n, (left, _) in enumerate(tree["kids"]) if left < 0])
    seen = leaves[reach[:, leaves].argmax(1)]
    for leaf in np.unique(seen):
        i = np.flatnonzero((seen == leaf) & (reach[:, leaf] >= least))
        if len(i):
            score(leaf, i)
    heap = [(0.0, 0, np.arange(len(q)))] if len(q) else []
    while heap:
        _, n, i = heapq.heappop(heap)
        i = i[reach[i, n] >= least[i]]
        if not len(i):
            continue
        left, right = tree["kids"][n]
        if left < 0:
            i = i[seen[i] != n]
            if len(i):
                score(n, i)
            continue
        for child in (left, right):
            heapq.heappush(heap, (-reach[i, child].max(), child, i))
    return ids, own, scores


def top_k(df: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k best other rows."""
    spark = df.sparkSession
    rows = in_small_batches(vectors(df, id_col, vector))
    pivots = fit_pivots(rows)
    if not len(pivots):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def deal(batches):
        for b in batches:
            x = _arrow_matrix(b.column("v")).astype(np.float64)
            near = _nearest(x, pivots)
            x, c = _alike(x, pivots)
            away = np.linalg.norm(x - c[near], axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near, pa.int32()), pa.array(away)], [*b.schema.names, "pivot", "away"])

    dealt = rows.select("uid", "vec_id", "v").mapInArrow(deal, "uid long, vec_id long, v array<long>, pivot int, away double")
    dealt = materialise(dealt, "dealt")
    discard(rows)
    # a line a centre, MAX_PIVOTS at most
    parts = F.ceil(F.count(F.lit(1)) / F.lit(SHARD_ROWS)).cast("int")
    stats = materialise(dealt.groupBy("pivot").agg(parts.alias("parts"), F.max("away").alias("radius")), "centres")
    lines = stats.collect()
    used = np.array([r["pivot"] for r in lines])
    centres, radii = pivots[used], np.array([r["radius"] for r in lines])
    n_parts = dict((r["pivot"], r["parts"]) for r in lines)
    stats = F.broadcast(stats.select("pivot", "parts"))

    def plant(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = build_tree(pdf["vec_id"].to_numpy(np.int64), pdf["uid"].to_numpy(np.int64), _matrix(list(pdf["v"])))
        return pd.DataFrame({"pivot": [int(pdf["pivot"].iloc[0])], "part": [int(pdf["part"].iloc[0])], "tree": [pickle.dumps(tree)]})

    shards = sum(n_parts.values())
    sharded = dealt.join(stats, "pivot").withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts").cast("long")).cast("int"))
    sharded = sharded.select("pivot", "part", "uid", F.coalesce("vec_id", F.lit(_NO_ID)).alias("vec_id"), "v").repartition(_tasks(shards), "pivot", "part")
    trees = materialise(sharded.groupBy("pivot", "part").applyInPandas(plant, "pivot int, part int, tree binary"), "trees")
    queries = materialise(dealt.where(F.col("vec_id") % every == 0).select("uid", F.col("vec_id").alias("query_id"), "v"), "queries")
    discard(dealt)

    def asked_of(first: int, last: int):
        """For each part of a batch: its first row, and which query meets which centre in a wave."""

        def ask(b):
            for at in range(0, b.num_rows, ASK_ROWS):
                part = b.slice(at, ASK_ROWS)
                reach = bounds(_arrow_matrix(part.column("v")).astype(np.float64), centres, radii)
                rank = np.empty(reach.shape, np.int32)
                np.put_along_axis(rank, np.argsort(-reach, 1, kind="stable"), np.arange(len(used), dtype=np.int32)[None], 1)
                yield part, (rank >= first) & (rank < last) & (reach >= part.column("kth").to_numpy()[:, None])

        return ask

    def visit(trees_: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if asked.empty:
            return pd.DataFrame({n: pd.Series(dtype="int64") for n in ("uid", "vec_id", "other", "score")})
        uids = asked["uid"].to_numpy(np.int64)
        ids, own, scores = search(pickle.loads(trees_["tree"].iloc[0]), uids, _matrix(list(asked["v"])), asked["kth"].to_numpy(np.int64), k)
        some = own != _NO_ID
        return pd.DataFrame({"uid": np.repeat(uids, some.sum(1)), "vec_id": ids[some], "other": own[some], "score": scores[some]})

    best, first = None, 0
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id", "other")
    for wave in [*WAVES, len(used)]:
        last = min(len(used), first + wave)
        if first >= last:
            break
        if best is None:
            asked = queries.withColumn("kth", F.lit(-_NO_ID))
        else:
            so_far = best.groupBy("uid").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(-_NO_ID).alias("kth"))
            asked = queries.join(so_far, "uid", "left").withColumn("kth", F.coalesce("kth", F.lit(-_NO_ID)))
        asked = materialise(asked.select("uid", "v", "kth"), "asked")
        ask = asked_of(first, last)

        def count(batches, ask=ask):
            n = np.zeros(len(used), np.int64)
            for b in batches:
                for _, meets in ask(b):
                    n += meets.sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(n)], ["pivot", "n"])

        met = asked.mapInArrow(count, "pivot int, n long").groupBy("pivot").agg(F.sum("n").alias("n")).where("n > 0").collect()
        blocks = {r["pivot"]: -(-r["n"] // BLOCK_ROWS) for r in met}

        def send(batches, ask=ask, blocks=blocks):
            for b in batches:
                for part, meets in ask(b):
                    for j in np.flatnonzero(meets.any(0)):
                        here = part.take(pa.array(np.flatnonzero(meets[:, j])))
                        pivot = int(used[j])
                        mixed = here.column("uid").to_numpy() * 0x9E3779B1 >> 16
                        keys = [pa.array(np.full(here.num_rows, pivot), pa.int32()), pa.array(mixed % blocks[pivot], pa.int32())]
                        yield pa.RecordBatch.from_arrays([*keys, *[here.column(c) for c in ("uid", "v", "kth")]], ["pivot", "block", "uid", "v", "kth"])

        found = None
        if blocks:
            groups = _tasks(sum(blocks[p] * n_parts[p] for p in blocks))
            key = ["pivot", "part", "block"]
            sent = asked.mapInArrow(send, "pivot int, block int, uid long, v array<long>, kth long").join(stats, "pivot")
            sent = sent.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
            wide = F.broadcast(spark.createDataFrame(list(blocks.items()), "pivot int, blocks int"))
            copies = trees.join(wide, "pivot").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
            left, right = copies.repartition(groups, *key).groupBy(*key), sent.repartition(groups, *key).groupBy(*key)
            found = left.cogroup(right).applyInPandas(visit, "uid long, vec_id long, other long, score long")
        if found is not None:
            found = found if best is None else found.unionAll(best.select("uid", "vec_id", "other", "score"))
            best, before = materialise(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best"), best
            if before is not None:
                discard(before)
        discard(asked)
        first = last
    if best is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    named = queries.select("uid", "query_id").join(best, "uid")
    return named.select("query_id", "rank", F.nullif("vec_id", F.lit(_NO_ID)).alias("vec_id"), "score")


def _tasks(groups: int) -> int:
    return max(1, min(groups, 8192))
