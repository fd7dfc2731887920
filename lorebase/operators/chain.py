"""Reasoning chains along edge tables: symptom, syndrome, formula, and from there herbs or cases.

Before anything is joined every edge table is reduced from both ends by semi-joins: first to
what the wanted symptoms reach, then to what leads to an end. Each row that is left lies on a
whole path, so the joins that follow make no row that a later join drops. Coverage and numbers
of paths are kept as counts a node, added up hop by hop, and need no list of paths.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lorebase.sources.tables import discard, materialise

Database = dict[str, DataFrame]


@dataclass(frozen=True)
class Hop:
    """From ``source`` to ``target`` by the rows of ``edge``."""

    source: str
    edge: str
    own: str
    far: str
    target: str

    @property
    def name(self) -> str:
        return f"{self.source}>{self.target}"


# The hops of the chain, and its two ends.
TO_FORMULAS = (
    Hop("symptoms", "syndrome_symptoms", "symptom_id", "syndrome_id", "syndromes"),
    Hop("syndromes", "formula_syndromes", "syndrome_id", "formula_id", "formulas"),
)
TO_HERBS = (*TO_FORMULAS, Hop("formulas", "formula_herbs", "formula_id", "herb_id", "herbs"))
TO_CASES = (*TO_FORMULAS, Hop("formulas", "case_formulas", "formula_id", "case_id", "clinical_cases"))


def ids(db: Database, table: str, name: str) -> DataFrame:
    return db[table].select(F.col("id").alias(name)).where(F.col(name).isNotNull()).distinct()


def valid_edges(db: Database, hop: Hop) -> DataFrame:
    """(own, far): distinct rows of the hop's edge table both of whose ends exist."""
    rows = db[hop.edge].select(F.col(hop.own).alias("own"), F.col(hop.far).alias("far")).distinct()
    return rows.join(ids(db, hop.source, "own"), "own", "left_semi").join(ids(db, hop.target, "far"), "far", "left_semi")


def reached(db: Database, hops: tuple[Hop, ...], start: DataFrame) -> list[DataFrame]:
    """(own, far) of each hop, written: rows that a path from the ids of ``start`` (one column id) comes to."""
    out, at = [], start.select(F.col("id").alias("own")).distinct()
    for hop in hops:
        # first what is reached: making rows distinct and looking up their own end then need no shuffle besides
        edge = db[hop.edge].join(at.withColumnRenamed("own", hop.own), hop.own, "left_semi")
        rows = materialise(valid_edges({**db, hop.edge: edge}, hop), "hop")
        out.append(rows)
        at = rows.select(F.col("far").alias("own")).distinct()
    return out


def leading(forward: list[DataFrame]) -> list[DataFrame]:
    """Of what ``reached`` gives, the rows that lead to the last hop; all but the last are written anew."""
    backward = [forward[-1]]
    for rows in reversed(forward[:-1]):
        leads = backward[0].select(F.col("own").alias("far")).distinct()
        backward.insert(0, materialise(rows.join(leads, "far", "left_semi"), "hop"))
    return backward


def reduced(db: Database, hops: tuple[Hop, ...], start: DataFrame) -> list[DataFrame]:
    """(own, far) of each hop, written: only rows on a whole path from the ids of ``start`` (one column id)."""
    forward = reached(db, hops, start)
    backward = leading(forward)
    discard(*forward[:-1])
    return backward


def matching(db: Database, symptom: str) -> DataFrame:
    return db["symptoms"].where(F.col("name").ilike(f"%{symptom}%")).select("id")


def paths(db: Database, symptom: str, hops: tuple[Hop, ...] = TO_CASES, names: dict[str, str] | None = None) -> DataFrame:
    """One row a whole path: for each table on it its id and, where it has one, its name column (``names`` by table)."""
    shown = {t: "name" for t in ("symptoms", "syndromes", "formulas", "herbs")} | {"clinical_cases": "patient_id"} | (names or {})
    edges = reduced(db, hops, matching(db, symptom))
    tables = (hops[0].source, *(h.target for h in hops))
    label = lambda table: db[table].select(F.col("id").alias(f"{table}_id"), F.col(shown[table]).alias(table))
    rows = [e.select(F.col("own").alias(f"{h.source}_id"), F.col("far").alias(f"{h.target}_id")) for h, e in zip(hops, edges)]
    # the last table's names are put to edges, not to paths, of which there are many times as many; so no path is shuffled after the last hop
    rows[-1] = rows[-1].join(label(tables[-1]), f"{tables[-1]}_id")
    out = rows[0]
    for hop, more in zip(hops[1:-1], rows[1:-1]):
        out = out.join(more, f"{hop.source}_id")
    for table in tables[:-1]:
        out = out.join(label(table), f"{table}_id")
    if len(hops) > 1:
        out = out.join(rows[-1], f"{hops[-1].source}_id")
    return out.select(*[c for t in tables for c in (f"{t}_id", t)])


def path_counts(db: Database, start: DataFrame, hops: tuple[Hop, ...] = TO_CASES) -> DataFrame:
    """(id, paths) of each id of ``start``: whole paths from it, counted node by node from the end; 0 where there is none."""
    edges = reduced(db, hops, start)
    counts = None
    for rows in reversed(edges):
        if counts is None:
            counts = rows.groupBy("own").agg(F.count(F.lit(1)).alias("paths"))
        else:
            counts = rows.join(counts.select(F.col("own").alias("far"), "paths"), "far").groupBy("own").agg(F.sum("paths").alias("paths"))
    out = start.select("id").distinct().join(counts.select(F.col("own").alias("id"), "paths"), "id", "left")
    return out.select("id", F.coalesce("paths", F.lit(0)).cast("long").alias("paths"))


def hop_coverage(db: Database, hops: tuple[Hop, ...] = (*TO_HERBS, TO_CASES[-1])) -> DataFrame:
    """A row a hop: valid edges, and how many rows of either side have one, of how many.

    ``onward`` is the number of covered targets that some next hop goes on from; null at an end.
    """
    parts = []
    edges = {hop: materialise(valid_edges(db, hop), "valid") for hop in hops}
    for hop in hops:
        rows = edges[hop]
        facts = [
            rows.agg(F.count(F.lit(1)).alias("edges"), F.count_distinct("own").alias("covered_source"), F.count_distinct("far").alias("covered_target")),
            db[hop.source].agg(F.count_distinct("id").alias("total_source")),
            db[hop.target].agg(F.count_distinct("id").alias("total_target")),
        ]
        after = [edges[h].select(F.col("own").alias("far")) for h in hops if h.source == hop.target]
        if after:
            facts.append(rows.select("far").distinct().join(reduce(DataFrame.unionAll, after).distinct(), "far", "left_semi").agg(F.count(F.lit(1)).alias("onward")))
        parts += [f.withColumn("hop", F.lit(hop.name)) for f in facts]
    columns = ("edges", "covered_source", "total_source", "covered_target", "total_target", "onward")
    return _side_by_side(parts, ["hop"], columns)


def _side_by_side(parts: list[DataFrame], key: list[str], columns: tuple[str, ...]) -> DataFrame:
    """Rows that each have some of the columns, put together by key; all parts are single rows."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.groupBy(*key).agg(*[F.max(c).alias(c) for c in columns])


def start_coverage(db: Database, symptom: str = "", hops: tuple[Hop, ...] = TO_CASES) -> DataFrame:
    """A row a hop: how many of the matching symptoms a path of so many hops begins at, of how many, and how many nodes it reaches."""
    start = matching(db, symptom).distinct()
    parts, forward = [], reached(db, hops, start)  # shorter paths begin with the same rows
    for k, hop in enumerate(hops, 1):
        edges = leading(forward[:k])
        facts = [edges[0].agg(F.count_distinct("own").alias("covered")), edges[-1].agg(F.count_distinct("far").alias("reached")), start.agg(F.count(F.lit(1)).alias("total"))]
        parts += [f.withColumns({"step": F.lit(k), "hop": F.lit(hop.name)}) for f in facts]
    return _side_by_side(parts, ["step", "hop"], ("covered", "total", "reached"))
