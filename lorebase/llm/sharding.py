"""Shards by a keyed Feistel permutation of global row numbers (law ``rows``).

Rows get gapless global numbers 0..N-1 in the order of (doc_id, text CRC, size),
equal rows in any order among themselves. A Feistel network over the smallest
even number of bits that holds N, walked until it lands below N, permutes the
numbers; shard = p mod S and slot = p div S. Any row's place can be computed from
its number, N and the key; shard counts differ by one at most.

Row numbers come from one range partitioning: rows are numbered inside each
partition and shifted by the partitions' running counts. The numbered rows are
checkpointed before the counts are taken, so that both see the same partitions.

Defined results. Null text has size 1 and CRC 0 of no bytes; null doc_id sorts
first. Repeated rows get a place each. An empty table gives an empty result.
Extra columns are dropped. ``grown_shard`` is null: only law ``key`` has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lorebase.sources.tables import shared_dir

KEY, ROUNDS = "shuffle-1", 6


def feistel(x: Column, half_bits: int, key: str = KEY, rounds: int = ROUNDS) -> Column:
    """Keyed permutation of the integers below 2 ** (2 * half_bits)."""
    low = F.lit((1 << half_bits) - 1).cast("long")
    left, right = F.shiftrightunsigned(x, half_bits), x.bitwiseAND(low)
    pair = F.struct(left.alias("l"), right.alias("r"))
    step = lambda p, i: F.struct(
        p["r"].alias("l"),
        p["l"].bitwiseXOR(F.xxhash64(F.lit(key), i, p["r"]).bitwiseAND(low)).alias("r"),
    )
    end = F.aggregate(F.array(*[F.lit(i) for i in range(rounds)]), pair, step)
    return F.shiftleft(end["l"], half_bits).bitwiseOR(end["r"])


def half_bits_for(n: int) -> int:
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def permuted(df: DataFrame, column: str, n: int, key: str = KEY) -> DataFrame:
    """Replaces ``column``, numbers below n, by their permutation: cycle walking.

    The domain is less than 4n, so a walk ends after four steps on average; each
    pass of the fold steps only the walks that have not ended.
    """
    h = half_bits_for(n)
    end = F.lit(n).cast("long")
    walk = feistel(F.col(column), h, key)
    # 160 further steps: a walk longer than that has a chance below 1e-19; the guard below still stops on one.
    done = F.aggregate(
        F.sequence(F.lit(1), F.lit(160)), walk, lambda x, _: F.when(x < end, x).otherwise(feistel(x, h, key))
    )
    return df.withColumn(column, F.when(done < end, done).otherwise(F.raise_error(F.lit("cycle walk did not end"))))


def number_rows(rows: DataFrame, order: list[str], name: str = "row_no") -> tuple[DataFrame, int]:
    """Gapless numbers in the given order, and how many there are."""
    spark = rows.sparkSession
    shared_dir(spark)
    dealt = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*order, "__tie")
    local = dealt.sortWithinPartitions(*order, "__tie").select(
        *rows.columns, F.monotonically_increasing_id().alias("__at")
    )
    local = local.withColumns(
        {"__part": F.shiftright("__at", 33), "__at": F.col("__at").bitwiseAND(F.lit((1 << 33) - 1).cast("long"))}
    ).checkpoint()
    counts = local.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    n = local.count()
    # one row for each partition: bounded by the partition count
    out = local.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__at"))
    return out.drop("__part", "__at", "__start"), n


def shard_rows(docs: DataFrame, shards: int = 16, key: str = KEY, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long") + 1).alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )
    numbered, n = number_rows(rows, ["doc_id", "text_crc32", "size"])
    s = F.lit(shards).cast("long")
    return permuted(numbered, "row_no", n, key).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("row_no") % s).cast("int").alias("shard"),
        F.floor(F.col("row_no") / s).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
