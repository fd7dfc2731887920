"""BPE encoding by a distinct-word table, and decoding by an id-to-piece join.

Texts are split at the tokenizer's added tokens and then by the byte-level pattern.
The words of all documents are aggregated to a table of distinct words with counts.
Its frequent words, those from a count on that leaves MAX_WORDS at most, are encoded
once and broadcast; the count comes from a histogram, no sort is needed. In a second
pass every text is split the same way and the words' ids are put back by position; a
word outside the head is encoded once a part of about PART_BYTES of text, by the task
that meets it. Ids are decoded by looking them up in the table of pieces, whose size
is the vocabulary's.

The documents are never shuffled; what is shuffled are the distinct words of each
task with their counts.

Defined results. Null text is empty text: no tokens, decoded to ''. Repeated rows
have equal results. Texts
of any length are read whole. An empty table gives an empty result. All columns stay,
also such as are named like the added ones, which come last. Tokenizers whose added
tokens strip their surroundings or match single words only are refused.
"""

from __future__ import annotations

import json
import os
from array import array
from collections import Counter
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from lorebase.llm.batches import giving_back, in_small_batches, with_columns
from lorebase.sources.tables import discard, materialise

MAX_WORDS, MAX_WORD_BYTES = 200_000, 24
#: Distinct words a task counts before it passes them on.
FLUSH = 100_000
#: Bytes of text whose words are held at once.
PART_BYTES = 1 << 19
_W = r"\p{White_Space}"
_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_W}\p{{L}}\p{{N}}]+|{_W}+(?!\P{{White_Space}})|{_W}+"
OUTPUTS = {
    "ids": T.ArrayType(T.IntegerType()),
    "n_tokens": T.LongType(),
    "ids_sha256": T.StringType(),
    "decoded": T.StringType(),
    "decoded_sha256": T.StringType(),
}


class Words:
    """Splitting, encoding and pieces of one tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads of the library would each hold memory for as long as the worker lives
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added) or spec.get("normalizer"):
            raise ValueError("added tokens that match by their surroundings, and normalizers, are not supported")
        pre = spec["pre_tokenizer"]
        if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True):
            raise ValueError("only byte-level tokenizers without a prefix space are supported")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        either = [regex.escape(n) for n in names] + [_SPLIT]
        self.find = regex.compile("|".join(either)).findall if not names else self._find_around(names)
        self.pieces = self._pieces(spec, added)

    @staticmethod
    def _find_around(names: list[str]):
        plain = regex.compile(_SPLIT).findall
        cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split
        special = set(names)

        def find(text: str) -> list[str]:
            if not any(n in text for n in names):
                return plain(text)
            out: list[str] = []
            for part in cut(text):
                if part in special:
                    out.append(part)
                elif part:
                    out += plain(part)
            return out

        return find

    @staticmethod
    def _pieces(spec: dict, added: list[dict]) -> list[bytes]:
        """Bytes by id: a piece spells each byte as one printable character."""
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        sign = {chr(b): b for b in keep}
        sign |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in keep)}
        by_id = {i: bytes(sign[c] for c in piece) for piece, i in spec["model"]["vocab"].items()}
        by_id |= {t["id"]: t["content"].encode() for t in added}
        return [by_id.get(i, b"") for i in range(max(by_id) + 1)]

    def encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    return Words(path)


def word_table(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(word, n): every distinct word of the corpus with its count."""

    def count(batches):
        find, seen = words_of(path).find, Counter()
        for b in batches:
            for t in b.column(0):
                if t.is_valid:
                    seen.update(find(t.as_py()))
                if len(seen) >= FLUSH:
                    yield pa.RecordBatch.from_pydict({"word": list(seen), "n": list(seen.values())})
                    seen = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    return in_small_batches(docs).select(F.col(text).alias("t")).mapInArrow(giving_back(count), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


#: Steps of the histogram in a doubling of the count.
STEPS = 16


def head_of(table: DataFrame, path: str, max_words: int = MAX_WORDS) -> DataFrame:
    """(word, ids) of the most frequent short words, max_words at most, each encoded once."""

    def encode(batches):
        w = words_of(path)
        for b in batches:
            ids = w.encode(b.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("word"), pa.array(ids, pa.list_(pa.int32()))], ["word", "ids"])

    short = table.where(F.octet_length("word") <= MAX_WORD_BYTES).withColumn("step", F.floor(F.log2("n") * STEPS).cast("int"))
    steps = short.groupBy("step").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("step")).collect()  # 64 * STEPS rows at most
    least, total = None, 0
    for row in steps:
        total += row["words"]
        if total > max_words:
            break
        least = row["step"]
    return short.where(F.lit(False) if least is None else F.col("step") >= least).select("word").mapInArrow(giving_back(encode), "word string, ids array<int>")


def encode(docs: DataFrame, path: str, text: str = "text", outputs: tuple = ("ids",), max_words: int = MAX_WORDS, keep_text: bool = True) -> DataFrame:
    """``docs`` with the columns named in ``outputs``, see OUTPUTS; without the text if that is not kept."""
    spark = docs.sparkSession
    table = materialise(word_table(docs, path, text), "words")
    head = head_of(table, path, max_words).toArrow()
    discard(table)
    # at most max_words short words with their ids
    shared = spark.sparkContext.broadcast({w.as_py(): packed(i.as_py()) for w, i in zip(head.column("word"), head.column("ids"))})
    schema = docs.schema
    place = [f.name for f in schema].index(text)
    rows, kind = with_columns(docs, {o: OUTPUTS[o] for o in outputs})
    kept = [k for k in range(len(schema)) if keep_text or k != place]
    kind = T.StructType([*[kind[k] for k in kept], *kind[len(schema) :]])
    names = kind.names

    def run(batches):
        w = words_of(path)
        known = shared.value
        text_of = [str(i) for i in range(len(w.pieces))]
        for b in (part for whole in batches for part in _parts(whole, place)):
            texts = [w.find(t.as_py()) if t.is_valid else [] for t in b.column(place)]
            new = list({x for t in texts for x in t if x not in known})
            here = dict(zip(new, map(packed, w.encode(new))))
            out: dict[str, list] = {o: [] for o in outputs}
            for t in texts:
                ids = unpacked(b"".join([known[x] if x in known else here[x] for x in t]))
                if "ids" in out:
                    out["ids"].append(ids)
                if "n_tokens" in out:
                    out["n_tokens"].append(len(ids))
                if "ids_sha256" in out:
                    out["ids_sha256"].append(sha256(",".join([text_of[i] for i in ids]).encode()).hexdigest())
                if "decoded" in out or "decoded_sha256" in out:
                    decoded = joined(ids, w.pieces)
                    if "decoded" in out:
                        out["decoded"].append(decoded)
                    if "decoded_sha256" in out:
                        out["decoded_sha256"].append(sha256(decoded.encode()).hexdigest())
            added = [pa.array(out[o], to_arrow_type(OUTPUTS[o])) for o in outputs]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in kept], *added], names)

    return rows.mapInArrow(giving_back(run), kind).toDF(*[schema.names[k] for k in kept], *outputs)


def packed(ids: list[int]) -> bytes:
    """Ids as one object of four bytes each: a table of words in every worker takes less than half the memory of lists."""
    return array("i", ids).tobytes()


def unpacked(ids: bytes) -> list[int]:
    return array("i", ids).tolist()


def _parts(batch: pa.RecordBatch, place: int):
    """Consecutive rows of a batch that hold about PART_BYTES of text; a longer text is a part of its own."""
    first = size = 0
    for k, n in enumerate(pc.fill_null(pc.binary_length(batch.column(place)), 0).to_pylist()):
        if k > first and size + n > PART_BYTES:
            yield batch.slice(first, k - first)
            first, size = k, 0
        size += n
    yield batch.slice(first)


def joined(ids: list[int], pieces: list[bytes]) -> str:
    """The pieces of the ids, one after the other."""
    return b"".join([pieces[i] for i in ids]).decode("utf-8", "replace")


def decode(rows: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` with the text of an id array; a null array gives null, an unknown id nothing."""
    schema = rows.schema
    place = [f.name for f in schema].index(ids)
    plain, kind = with_columns(rows, {"d": T.StringType()})
    names = kind.names

    def run(batches):
        pieces = words_of(path).pieces
        for b in batches:
            texts = [joined([i for i in x.as_py() if i is not None and 0 <= i < len(pieces)], pieces) if x.is_valid else None for x in b.column(place)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names)

    return plain.mapInArrow(run, kind).toDF(*schema.names, name)
