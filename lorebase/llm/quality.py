"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal.

Features of a text are the words and word pairs split at white space, and the same
of the words' shapes (letters of either case, digits and other signs, runs cut to
one), pairs of equal words as one feature, hashed into DIM places. A feature's value is its count over the square root of
the sum of squared counts. The score is the logistic of the sparse dot product.

Training takes a sample of about MAX_TRAIN labelled ids, drawn by hash of the id at
a rate that follows from the exact count, with MAX_PER_ID documents of one id at most;
the sample's labels, two an id at most, are broadcast. Weights are updated document by document in the order of a hash, in a
task of its own, and the non-zero ones, DIM at most, are what comes back.

Defined results. Null or empty text has only the bias. Without training rows of
both labels the score is the training mean, 0.5 if there is none. Null quality is
not learned; repeated labels of an id count once, contradicting ones both. Empty table: empty result. Extra columns
are ignored by ``score`` and kept by ``keep_good``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from lorebase.llm.batches import _mix, _ODD, KEEP, SPACES, in_small_batches, runs, slices, with_columns, words

DIM = 1 << 20
MAX_TRAIN, MAX_PER_ID = 6000, 4
EPOCHS, ALPHA, BETA, L1, L2 = 5, 1.0, 1.0, 0.02, 0.01
THRESHOLD = 0.3
#: Place of all pairs of a word with itself, whichever word it is.
REPEAT = 7
_SHAPE = np.full(256, ord("."), np.uint8)
_SHAPE[[*range(97, 123), *range(128, 256)]] = ord("a")
_SHAPE[[*range(65, 91)]] = ord("A")
_SHAPE[[*range(48, 58)]] = ord("9")
for _sign in b".,;:!?'\"()-":
    _SHAPE[_sign] = _sign
_SHAPE[[0x20, *range(0x09, 0x0E)]] = 0x20


def _cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shapes with runs of one class cut to one byte, and the offsets in them."""
    shape = _SHAPE[data]
    keep = np.ones(len(shape), bool)
    keep[1:] = shape[1:] != shape[:-1]
    starts = offsets[:-1]
    keep[starts[starts < len(shape)]] = True
    return shape[keep], np.concatenate(([0], np.cumsum(keep)))[offsets]


def _pairs(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pair hashes within rows, and the row bounds of them."""
    pairs = runs(h, 2)
    keep = np.ones(len(pairs), bool)
    cut = first[1:-1] - 1
    keep[cut[(cut >= 0) & (cut < len(pairs))]] = False
    return pairs[keep], np.concatenate(([0], np.cumsum(keep)))[np.minimum(first, len(keep))]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, row of each) of all n-grams of some texts, repeated as often as they occur."""
    places, rows = [], []
    cut, cut_offsets = _cut(data, offsets)
    for k, (d, o) in enumerate(((data, offsets), (cut, cut_offsets))):
        h, _, _, first = words(d, o, SPACES, KEEP)
        for j, (x, bounds) in enumerate(((h, first), _pairs(h, first))):
            places.append((_mix(x + np.uint64(2 * k + j + 1) * _ODD) >> np.uint64(44)).astype(np.int64))
            rows.append(np.repeat(np.arange(len(offsets) - 1), np.diff(bounds)))
        if k == 0:
            row = rows[0]
            again = row[1:][(h[1:] == h[:-1]) & (row[1:] == row[:-1])]
            places.append(np.full(len(again), REPEAT))
            rows.append(again)
    return np.concatenate(places), np.concatenate(rows)


def counted(places: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (place, row) with the value of each."""
    key, count = np.unique(rows * DIM + places, return_counts=True)
    row, place = key // DIM, key % DIM
    count = count.astype(np.float64)
    norm = np.sqrt(np.bincount(row, count**2, minlength=n))
    return place, row, count / norm[row]


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """Weights and bias after EPOCHS passes over (places, values, label)."""
    z, n = np.zeros(DIM), np.zeros(DIM)
    bias = bias_n = 0.0
    for _ in range(EPOCHS):
        for at, x, y in examples:
            zi, ni = z[at], n[at]
            w = np.where(np.abs(zi) > L1, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(ni)) / ALPHA + L2), 0.0)
            error = 1 / (1 + np.exp(-np.clip(w @ x + bias, -35, 35))) - y
            g = error * x
            s = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[at] = zi + g - s * w
            n[at] = ni + g * g
            bias_n += error * error
            bias -= ALPHA * error / (BETA + np.sqrt(bias_n))
    w = np.where(np.abs(z) > L1, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)
    return w, bias


def _model_rows(w: np.ndarray, bias: float):
    at = np.flatnonzero(w)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(w[at], bias), pa.float64())], ["at", "w"]
    )


def _train_task(batches):
    seen: list[tuple[int, np.ndarray, np.ndarray, int]] = []
    for b in batches:
        ys, order = b.column("y").to_pylist(), b.column("o").to_pylist()
        for first, end, data, offsets in slices(b.column("text")):
            place, row, x = counted(*features(data, offsets), end - first)
            cut = np.searchsorted(row, np.arange(end - first + 1))
            for k in range(end - first):
                part = slice(cut[k], cut[k + 1])
                seen.append((order[first + k], place[part].astype(np.int32), x[part].astype(np.float32), ys[first + k]))
    seen.sort(key=lambda e: e[0])
    ys = {e[3] for e in seen}
    if len(ys) < 2:
        mean = 35.0 if ys == {1} else -35.0 if ys == {0} else 0.0
        yield _model_rows(np.zeros(DIM), mean)
    else:
        yield _model_rows(*ftrl([e[1:] for e in seen]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", quality: str = "quality", max_train: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    """Weights by place, and bias, from labelled rows outside the held-out fifth."""
    known = labels.select(F.col(id_col).alias("i"), F.col(quality).cast("int").alias("y")).where("i is not null and y in (0, 1)")
    known = known.where(F.crc32(F.col("i").cast("string").cast("binary")) % 5 != 0)
    known = known.distinct()
    n = known.select("i").distinct().count()
    draw = F.pmod(F.xxhash64(F.lit("quality"), "i"), F.lit(1 << 30).cast("long")) / F.lit(float(1 << 30))
    sample = known.where(draw < min(1.0, max_train / max(1, n)))
    rows = in_small_batches(docs).select(F.col(id_col).alias("i"), F.col(text).alias("text")).join(F.broadcast(sample), "i")
    rows = rows.select("i", "text", "y", F.xxhash64(F.lit("order"), "i", "text", "y").alias("o"))
    few = F.row_number().over(Window.partitionBy("i", "y").orderBy("o"))
    rows = rows.withColumn("few", few).where(F.col("few") <= MAX_PER_ID).select("text", "y", "o").repartition(1)
    # a sample of bounded size; with no row there is no task to answer, hence the default
    w, bias = np.zeros(DIM), 0.0
    for batch in [rows.mapInArrow(_train_task, "at int, w double").toArrow()]:
        at, x = batch.column("at").to_numpy(), batch.column("w").to_numpy()
        w[at[at >= 0]] = x[at >= 0]
        bias = float(x[at < 0].sum())
    return w, bias


def scores(column: pa.Array, w: np.ndarray, bias: float) -> np.ndarray:
    out = np.zeros(len(column))
    for first, end, data, offsets in slices(column):
        place, row, x = counted(*features(data, offsets), end - first)
        out[first:end] = np.bincount(row, w[place] * x, minlength=end - first)
    return 1 / (1 + np.exp(-np.clip(out + bias, -35, 35)))


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score as the last column; all columns stay, also such as are named alike."""
    schema = docs.schema
    place = [f.name for f in schema].index(text)
    at = np.flatnonzero(model[0])
    shared = docs.sparkSession.sparkContext.broadcast((at, model[0][at], model[1]))  # DIM pairs at most

    def run(batches):
        at, x, bias = shared.value
        w = np.zeros(DIM)
        w[at] = x
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores(b.column(place), w, bias))], names)

    rows, kind = with_columns(docs, {"s": T.DoubleType()})
    names = kind.names
    return rows.mapInArrow(run, kind).toDF(*schema.names, name)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    scored = score(rows, train(docs, labels, id_col, text))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns, whatever their names."""
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    scored = score(plain, train(docs, labels, id_col, text), f"c{names.index(text)}", "score")
    return scored.where(F.col("score") >= THRESHOLD).select(*plain.columns).toDF(*names)
