"""Versioned snapshots: tables written once, measured while they are written, and committed by one new file.

``commit`` writes every table to a folder of its own and observes number and digest of the rows
as they pass, so no table is computed or read a second time for that. Gates and reconciliations
then run over the written tables. Last, a manifest is created in the log under the next number;
that file must not be there yet, which file systems and object stores that create conditionally
decide for one writer. Until then readers see the version before; what a stopped writer leaves
is never read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

LOG, DATA = "_versions", "data"


class Refused(ValueError):
    """A gate found violations; nothing was published."""


class Conflict(RuntimeError):
    """Another writer published first."""


def measures(df: DataFrame) -> dict[str, Column]:
    """Aggregates that are equal for equal bags of rows: count, and sums of two hashes."""
    of = lambda seed: F.coalesce(F.sum(F.pmod(F.xxhash64(F.lit(seed), *df.columns), F.lit((1 << 31) - 1).cast("long"))), F.lit(0).cast("long"))
    return {"n": F.count(F.lit(1)), "first": of(1), "second": of(2)}


def measured(df: DataFrame) -> dict[str, int]:
    return df.agg(*[c.alias(k) for k, c in measures(df).items()]).first().asDict()


def _paths(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _put_if_absent(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _paths(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as e:
        if fs.exists(p):
            raise Conflict(f"{path} is there already") from e
        raise
    out.write(bytearray(text.encode()))
    out.close()


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions."""
    p, fs = _paths(spark, f"{root}/{LOG}")
    if not fs.exists(p):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict | None:
    """The manifest of a version, by default the last; None where nothing is published."""
    known = versions(spark, root)
    if not known:
        return None
    version = known[-1] if version is None else version
    if version not in known:
        raise ValueError(f"no version {version}")
    rows = spark.read.option("wholetext", True).text(f"{root}/{LOG}/{version:020d}.json").collect()  # one file
    return json.loads("\n".join(r[0] for r in rows))


def read(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    found = manifest(spark, root, version)
    return {} if found is None else {name: spark.read.parquet(f"{root}/{of['path']}") for name, of in found["tables"].items()}


def write_measured(df: DataFrame, path: str) -> dict[str, int]:
    """Write a table and return its measures, taken from the rows as they pass."""
    seen = Observation(f"m{uuid.uuid4().hex}")
    df.observe(seen, *[c.alias(k) for k, c in measures(df).items()]).write.parquet(path)
    return {k: int(v or 0) for k, v in seen.get.items()}


def commit(db: dict[str, DataFrame], root: str, gates=(), note: str = "", dry_run: bool = False, base: int | None = None) -> dict | None:
    """Publish all tables as the next version and return its manifest.

    ``gates`` are functions from the tables to a DataFrame of violations; any row refuses the
    whole batch. They see the written tables, in a dry run the computed ones. ``base`` is the version
    that the tables come from; where another has been published since, Conflict is raised.
    """
    spark = next(iter(db.values())).sparkSession
    known = versions(spark, root)
    last = known[-1] if known else 0
    if base is not None and base != last:
        raise Conflict(f"version {last} was published after {base}")
    if dry_run:
        _check(db, gates)
        return None
    place = f"{DATA}/{uuid.uuid4().hex}"
    tables = {name: {"path": f"{place}/{name}.parquet", "schema": df.schema.simpleString(), **write_measured(df, f"{root}/{place}/{name}.parquet")} for name, df in db.items()}
    _check({name: spark.read.parquet(f"{root}/{of['path']}") for name, of in tables.items()}, gates)
    made = {"version": last + 1, "note": note, "tables": tables}
    _put_if_absent(spark, f"{root}/{LOG}/{last + 1:020d}.json", json.dumps(made, ensure_ascii=False, indent=2))
    return made


def _check(db: dict[str, DataFrame], gates) -> None:
    for gate in gates:
        if not gate(db).isEmpty():
            raise Refused(f"refused by {getattr(gate, '__name__', 'a gate')}")


def differences(a: dict, b: dict) -> list[tuple[str, str]]:
    """(table, what differs) between two manifests, without reading any table."""
    out = []
    for name in sorted({*a["tables"], *b["tables"]}):
        x, y = a["tables"].get(name), b["tables"].get(name)
        if x is None or y is None:
            out.append((name, "missing"))
        else:
            out += [(name, k) for k in ("schema", "n", "first", "second") if x[k] != y[k]]
    return out


def damaged(spark: SparkSession, root: str, version: int | None = None) -> list[tuple[str, str]]:
    """(table, why) of stored tables that are no longer what their manifest says; one pass a table."""
    found, out = manifest(spark, root, version), []
    for name, of in (found or {"tables": {}})["tables"].items():
        try:
            df = spark.read.parquet(f"{root}/{of['path']}")
        except AnalysisException:
            out.append((name, "missing"))
            continue
        if df.schema.simpleString() != of["schema"]:
            out.append((name, "schema"))
        else:
            now = measured(df)
            out += [(name, k) for k in ("n", "first", "second") if now[k] != of[k]]
    return out


def backup(spark: SparkSession, root: str, to: str) -> dict:
    """Copy the last version to another root, and refuse it if the manifests differ."""
    source = manifest(spark, root)
    if source is None:
        raise ValueError("nothing is published")
    copy = commit(read(spark, root), to, note=f"copy of version {source['version']}")
    found = differences(source, copy)
    if found:
        raise Refused(f"the copy differs: {found}")
    return copy
