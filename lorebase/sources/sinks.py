"""Exports, snapshots and publishing."""

from __future__ import annotations

import csv
import io
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lorebase.sources.snapshots import measured, write_measured


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path, ignoreNullFields=False)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").csv(path, header=True, escape='"', lineSep="\r\n", nullValue="", emptyValue="")


def small_csv(df: DataFrame, limit: int = 100_000) -> str:
    """Byte-exact CSV of a bounded result; no rows give no header either."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows: use write_csv")
    if not rows:
        return ""
    out = io.StringIO()
    w = csv.DictWriter(out, df.columns)
    w.writeheader()
    w.writerows(r.asDict() for r in rows)
    return out.getvalue()


def small_json(df: DataFrame, limit: int = 100_000, indent: int | None = None) -> str:
    """JSON of a bounded result; indented for an artefact that people read."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows: use write_json")
    return json.dumps([r.asDict(recursive=True) for r in rows], ensure_ascii=False, default=str, indent=indent)


def signature(df: DataFrame) -> DataFrame:
    """(n, digest): equal for equal bags of rows."""
    h = F.pmod(F.xxhash64(*df.columns), F.lit((1 << 31) - 1).cast("long"))
    return df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(h), F.lit(0)).alias("digest"))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(db: dict[str, DataFrame], folder: str, dry_run: bool = False, gates=()) -> str | None:
    """Write all tables to a staging folder, check them, then rename it to ``folder``; ``snapshots`` keeps versions instead.

    ``gates`` are functions from the tables to a DataFrame of violations; any row stops
    the whole batch. A dry run checks and writes nothing. Returns the published folder.
    """
    for gate in gates:
        if not gate(db).isEmpty():
            raise ValueError(f"refused by {getattr(gate, '__name__', 'a gate')}")
    if dry_run or not db:
        return None
    spark = next(iter(db.values())).sparkSession
    staging = f"{folder.rstrip('/')}.staging-{uuid.uuid4().hex}"
    for name, df in db.items():
        passed = write_measured(df, f"{staging}/{name}.parquet")
        if measured(spark.read.parquet(f"{staging}/{name}.parquet")) != passed:
            raise ValueError(f"{name}: what was written is not what was computed")
    source, fs = _fs(spark, staging)
    target, _ = _fs(spark, folder)
    if fs.exists(target):
        raise ValueError(f"{folder} is there already; snapshots are not overwritten")
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {staging}")
    return folder


def verify_copy(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: both signatures and whether they agree."""
    x, y = signature(a).withColumn("side", F.lit("a")), signature(b).withColumn("side", F.lit("b"))
    both = x.unionByName(y).agg(F.count_distinct("n", "digest").alias("kinds"), F.min("n").alias("n"))
    return both.select("n", (F.col("kinds") == 1).alias("same"))
