"""Language identification with hyperdimensional profiles.

Every letter class has a random +-1 vector. A letter trigram is the product
(binding) of its letters' vectors, the first rotated twice and the second once
(permutation marks the place). A document is the sum (bundle) of its trigrams'
vectors, a language's prototype the sum of its training documents' unit vectors
less the mean of all prototypes. The language of largest cosine wins, a tie going
to the name that sorts first; the score is (1 + cosine) / 2.

Documents are bundled as (document x distinct trigram counts) times (trigram
vectors) in batches of bounded size, whole texts included.

Training reads a sample of about MAX_PER_LANG documents a language at most, drawn
by hash of id and text at a rate that follows from exact counts. More than MAX_LANGS
different names are an error.

Defined results. Null text, or text without a letter: ``und`` with score 0. A
corpus without training rows gives ``und`` for all. Null lang is not learned.
Repeated rows score alike; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lorebase.llm.batches import in_small_batches, slices
from lorebase.sources.tables import materialise

DIM, CLASSES = 1024, 48
MAX_PER_LANG = 3000
#: More names than these are no languages: an error. Their prototypes are what reaches the driver.
MAX_LANGS = 4096
#: Characters, and documents, bundled in one product.
BUNDLE_CHARS, BUNDLE_DOCS = 1 << 18, 64


@lru_cache(maxsize=1)
def letter_classes() -> np.ndarray:
    """Code point -> 0 (no letter), 1-26 (a-z), 27-47 (any other letter, by code)."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()[0]
            out[c] = ord(low) - 96 if "a" <= low <= "z" else 27 + (ord(low) * 2654435761 >> 7) % (CLASSES - 27)
    return out


@lru_cache(maxsize=1)
def letter_vectors() -> np.ndarray:
    return np.random.default_rng(20240101).choice(np.array([-1, 1], np.int8), (CLASSES, DIM))


def trigram_vectors(ids: np.ndarray) -> np.ndarray:
    v = letter_vectors()
    a, b, c = ids // CLASSES**2, ids // CLASSES % CLASSES, ids % CLASSES
    return np.roll(v, 2, 1)[a] * np.roll(v, 1, 1)[b] * v[c]


def _bundle(codes: list[np.ndarray]) -> np.ndarray:
    """Unit bundle vectors of some documents' code points; a zero row where there is no letter."""
    table = letter_classes()
    parts, which = [], []
    for k, c in enumerate(codes):
        x = np.zeros(len(c) + 2, np.int64)
        x[1:-1] = table[c]
        x = x[np.concatenate(([True], (x[1:] != 0) | (x[:-1] != 0)))]  # one gap between words
        if len(x) > 2:
            parts.append((x[:-2] * CLASSES + x[1:-1]) * CLASSES + x[2:])
            which.append(np.full(len(x) - 2, k))
    out = np.zeros((len(codes), DIM), np.float32)
    if parts:
        ids, which = np.concatenate(parts), np.concatenate(which)
        seen = np.zeros(CLASSES**3, bool)
        seen[ids] = True
        distinct = np.flatnonzero(seen)
        place = np.cumsum(seen) - 1
        counts = np.bincount(which * len(distinct) + place[ids], minlength=len(codes) * len(distinct))
        for at in range(0, len(distinct), 8192):
            block = trigram_vectors(distinct[at : at + 8192]).astype(np.float32)
            out += counts.reshape(len(codes), -1)[:, at : at + 8192].astype(np.float32) @ block
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        out /= np.where(norm > 0, norm, 1)
    return out


def bundles(column: pa.Array) -> np.ndarray:
    """Unit vectors of a text column."""
    out, codes, size = [], [], 0

    for _, _, data, offsets in slices(column):
        for s, e in zip(offsets[:-1], offsets[1:]):
            codes.append(np.frombuffer(data[s:e].tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32))
            size += len(codes[-1])
            if size >= BUNDLE_CHARS or len(codes) == BUNDLE_DOCS:
                out.append(_bundle(codes))
                codes, size = [], 0
    if codes:
        out.append(_bundle(codes))
    return np.concatenate(out) if out else np.zeros((0, DIM), np.float32)


def held_out(id_col: str = "doc_id", of: int = 4, remainder: int = 2) -> Column:
    """False for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % of == remainder, F.lit(False))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", max_per_lang: int = MAX_PER_LANG, id_col: str = "doc_id") -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and their prototypes. One vector a language reaches the driver."""
    known = in_small_batches(docs).select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts, "languages")
    if counts.count() > MAX_LANGS:
        raise ValueError(f"column {lang} has more than {MAX_LANGS} different names")
    rate = F.least(F.lit(1.0), F.lit(float(max_per_lang)) / F.col("n"))
    draw = F.pmod(F.xxhash64(F.lit("draw"), "id", "text"), F.lit(1 << 30).cast("long")) / F.lit(float(1 << 30))
    sample = known.join(F.broadcast(counts), "lang").where(draw < rate).select("lang", "text")

    def partial(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            vectors = bundles(b.column("text"))
            names = np.array(b.column("lang").to_pylist(), object)
            for name in set(names):
                sums[name] = sums.get(name, 0) + vectors[names == name].sum(0, dtype=np.float64)
        for name, v in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [name] * DIM, "at": np.arange(DIM, dtype=np.int32), "x": v})

    total = sample.mapInArrow(partial, "lang string, at int, x double").groupBy("lang", "at").agg(F.sum("x").alias("x"))
    rows = total.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v")).collect()
    langs = sorted(r["lang"] for r in rows)
    by = {r["lang"]: np.array([p["x"] for p in r["v"]]) for r in rows}
    protos = np.array([by[name] for name in langs]).reshape(len(langs), DIM)
    protos /= np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-12)
    if len(langs) > 1:
        protos -= protos.mean(0)
        protos /= np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-12)
    return langs, protos.astype(np.float32)


def judge(column: pa.Array, langs: list[str], protos: np.ndarray) -> tuple[list[str], np.ndarray]:
    vectors = bundles(column)
    if not langs:
        return ["und"] * len(vectors), np.zeros(len(vectors))
    cosine = vectors.astype(np.float64) @ protos.T.astype(np.float64)
    best = cosine.argmax(1)
    none = ~vectors.any(1)
    score = np.where(none, 0.0, np.clip((1 + cosine[np.arange(len(best)), best]) / 2, 0, 1))
    return ["und" if no else langs[k] for k, no in zip(best, none)], score


def identify(docs: DataFrame, langs: list[str], protos: np.ndarray, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out, lang_pred, score for every row."""

    def run(batches):
        for b in batches:
            names, score = judge(b.column("text"), langs, protos)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = in_small_batches(docs).select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
