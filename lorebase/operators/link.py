"""Greedy one-to-one linkage of parsed cases with existing rows.

``link`` takes better ranks first. ``link_clinical`` and ``link_by_stem`` give what the
two walks case by case, in the order of id, give. Candidates are found between distinct
names, dates and complaints, never between rows, and the choice is made by ``walk``. An
empty name or complaint is inside no other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lorebase.functions.text import patient_name, person_name
from lorebase.operators.contain import contained, either
from lorebase.operators.walk import greedy, numbered, walked  # noqa: F401 (also used by callers)
from lorebase.sources.tables import discard, materialise

def zipped(new: DataFrame, old: DataFrame, key: list[str], rank: int) -> DataFrame:
    """(new_id, old_id, rank): the i-th new row of a key with its i-th old row, both by id.

    That is what the greedy choice makes of all pairs of equal keys, without the pairs.
    """
    known = " and ".join(f"{k} is not null" for k in key)
    a, b = numbered(new.where(known), key, "new_id"), numbered(old.where(known), key, "old_id")
    return a.select(*key, "__no", "new_id").join(b.select(*key, "__no", "old_id"), [*key, "__no"]).select("new_id", "old_id", F.lit(rank).alias("rank"))


def link(new: DataFrame, old: DataFrame) -> DataFrame:
    """(new_id, old_id, rank): exact names, then contained ones, same dates, contained complaints; each row of a side once.

    Equal keys are zipped, so pairs within a name or a date are never written out; only
    contained names and complaints go through rounds. Blank dates agree with nothing.
    """
    a = new.select(F.col("id").alias("new_id"), person_name(F.col("name")).alias("k"), F.nullif("case_date", F.lit("")).alias("day"))
    b = old.select(F.col("id").alias("old_id"), person_name(patient_name(F.col("patient_id"))).alias("k"), F.nullif("case_date", F.lit("")).alias("day"))
    left_new, left_old, taken = materialise(a, "new"), materialise(b, "old"), []

    def take(pairs: DataFrame) -> None:
        nonlocal left_new, left_old
        taken.append(materialise(pairs, "linked"))
        before = left_new, left_old
        left_new = materialise(left_new.join(taken[-1], "new_id", "left_anti"), "new")
        left_old = materialise(left_old.join(taken[-1], "old_id", "left_anti"), "old")
        discard(*before)

    def still(df: DataFrame, left: DataFrame, key: str) -> DataFrame:
        return df.join(left.select(F.col(key).alias("id")), "id", "left_semi")

    take(zipped(left_new, left_old, ["k", "day"], 0))
    take(zipped(left_new, left_old, ["k"], 1))
    keys = either(left_new.select(F.col("k").alias("x")), left_old.select(F.col("k").alias("y")))
    wants = keys.select(F.col("x").alias("c"), F.col("y").alias("pool"), F.lit(2).alias("rank"))
    take(walked(left_new.select("new_id", F.col("k").alias("c")), wants, left_old.select(F.col("k").alias("pool"), "old_id", F.lit(0).cast("long").alias("place"))))
    take(zipped(left_new, left_old, ["day"], 3))
    asked = still(new, left_new, "new_id").select(F.col("id").alias("new_id"), F.substring("chief_complaint", 1, 50).alias("c"))
    held = still(old, left_old, "old_id").select(F.col("id").alias("old_id"), F.col("chief_complaint").alias("pool"), F.lit(0).cast("long").alias("place"))
    take(walked(asked, _complaint_wants(asked, held), held))
    return reduce(DataFrame.unionByName, [x.select("new_id", "old_id", F.col("rank").cast("int").alias("rank")) for x in taken])


def _complaint_wants(asked: DataFrame, held: DataFrame) -> DataFrame:
    """(c, pool, rank): beginnings of complaints and the complaints that hold them."""
    found = contained(asked.select(F.col("c").alias("x")), held.select(F.col("pool").alias("y")))
    return found.select(F.col("x").alias("c"), F.col("y").alias("pool"), F.lit(4).alias("rank"))


def _keyed(old: DataFrame, key: Column) -> DataFrame:
    """(old_id, k, place, day, complaint): the place of a key is its first row."""
    rows = old.select(F.col("id").alias("old_id"), key.alias("k"), F.col("case_date").alias("day"), F.col("chief_complaint").alias("complaint")).where("k is not null")
    return rows.join(rows.groupBy("k").agg(F.min("old_id").alias("place")), "k")


def link_clinical(new: DataFrame, old: DataFrame) -> DataFrame:
    """(new_id, old_id, rank) of the walk over clinical cases; ``new`` has the file's ``stem`` besides.

    Rank 0: name is the stem, and same date. Rank 1: name is the stem. Rank 2: name and
    stem hold one another. Rank 3: so do name and the case's name. Rank 0 takes the first
    such row even if used, so an old row may come twice.
    """
    a = new.select(F.col("id").alias("new_id"), person_name(F.col("stem")).alias("stem"), person_name(F.col("name")).alias("name"), F.nullif("case_date", F.lit("")).alias("day"))
    a = materialise(a.withColumn("c", F.to_json(F.array("stem", "name"))), "new")
    b = materialise(_keyed(old, person_name(patient_name(F.col("patient_id")))), "old")
    dated = b.where("day is not null").groupBy(F.col("k").alias("stem"), "day").agg(F.min("old_id").alias("old_id"))
    fixed = materialise(a.join(dated, ["stem", "day"]).select("new_id", "old_id"), "dated")
    classes, keys = a.select("c", "stem", "name").distinct(), b.select(F.col("k").alias("y"))
    same = classes.join(keys.distinct(), F.col("stem") == F.col("y")).select("c", F.col("y").alias("pool"), F.lit(1).alias("rank"))
    parts = [same]
    for rank, column in ((2, "stem"), (3, "name")):
        held = either(classes.select(F.col(column).alias("x")), keys)
        parts.append(classes.join(held, F.col(column) == F.col("x")).select("c", F.col("y").alias("pool"), F.lit(rank).alias("rank")))
    out = walked(a.select("new_id", "c"), reduce(DataFrame.unionAll, parts), b.select(F.col("k").alias("pool"), "old_id", "place"), fixed)
    discard(a, b, fixed)
    return out


def link_by_stem(new: DataFrame, old: DataFrame, prefix: int = 50) -> DataFrame:
    """(new_id, old_id, rank) of the walk over cases known by their file: rank 0 the stem is the patient id, 3 same date, 4 complaint."""
    begins = F.nullif(F.substring("chief_complaint", 1, prefix), F.lit(""))
    a = new.select(F.col("id").alias("new_id"), "stem", F.nullif("case_date", F.lit("")).alias("day"), begins.alias("begins"))
    a = materialise(a.withColumn("c", F.to_json(F.array("stem", "day", "begins"))), "new")
    b = materialise(_keyed(old, F.col("patient_id")), "old")
    classes = a.select("c", "stem", "day", "begins").distinct()
    pool = lambda kind, c: F.concat(F.lit(kind), c)
    held = contained(classes.select(F.col("begins").alias("x")), b.select(F.col("complaint").alias("y"))).toDF("begins", "complaint")
    wants = [
        classes.where("stem is not null").select("c", pool("k", F.col("stem")).alias("pool"), F.lit(0).alias("rank")),
        classes.where("day is not null").select("c", pool("d", F.col("day")).alias("pool"), F.lit(3).alias("rank")),
        classes.join(held, "begins").select("c", pool("q", F.col("complaint")).alias("pool"), F.lit(4).alias("rank")),
    ]
    pools = F.explode(F.array_compact(F.array(pool("k", F.col("k")), pool("d", F.col("day")), pool("q", F.col("complaint")))))
    out = walked(a.select("new_id", "c"), reduce(DataFrame.unionAll, wants), b.select(pools.alias("pool"), "old_id", "place"))
    discard(a, b)
    return out


def unmatched(new: DataFrame, links: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` new rows, by id, that no link has."""
    return new.join(links.select(F.col("new_id").alias("id")), "id", "left_anti").orderBy("id").limit(n)


def link_summary(new: DataFrame, old: DataFrame, links: DataFrame) -> DataFrame:
    """(metric, n): rows updated, new rows without a link, old rows that no link uses."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n")
    return reduce(DataFrame.unionAll, [
        count(links, "linked"),
        count(new.join(links.select(F.col("new_id").alias("id")), "id", "left_anti"), "unmatched"),
        count(old.join(links.select(F.col("old_id").alias("id")), "id", "left_anti"), "unused"),
    ])


def not_known(new: DataFrame, old: DataFrame, stem: Column) -> DataFrame:
    """New files whose stem is no known patient, whatever the case."""
    known = old.select(F.lower(patient_name(F.col("patient_id"))).alias("__k"))
    return new.withColumn("__k", F.lower(stem)).join(known, "__k", "left_anti").drop("__k")
