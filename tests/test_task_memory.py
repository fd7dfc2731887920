"""Work of a task does not follow the size of a table."""

from pyspark.sql import functions as F

from lorebase.operators import chain, constraints, contain, parse, walk
from lorebase.plans import catalogue, chains  # noqa: F401 (registers its queries)
from lorebase.sources import tables


def test_shuffled_partitions_stay_small(spark):
    """A query of the catalogue puts no more than a few MB of a shuffle into one task."""
    spark.range(5).write.mode("overwrite").parquet("/tmp/small-tasks/region.parquet")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        catalogue.t(spark, "/tmp/small-tasks", "region")
        rows = spark.range(3_000_000).select((F.col("id") * 7919 % 3_000_017).alias("k"), F.rand(1).alias("v"), F.rand(2).alias("w"), F.rand(3).alias("x"))
        grouped = rows.groupBy("k").agg(F.max("v"), F.max("w"), F.max("x"))
        assert grouped.rdd.getNumPartitions() >= 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_front_matter_is_dealt_out(spark):
    """A small file with many rows is not parsed by the one task that reads it."""
    plan = catalogue.QUERIES["front_values"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().logical().toString()
    assert "RepartitionByExpression" in plan


def test_cases_are_parsed_within_their_row(spark):
    """Lines of a document are neither sorted nor shuffled, and a small file of documents is not parsed by the task that reads it."""
    plan = catalogue.QUERIES["parse_cases"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan
    assert "RepartitionByExpression" in plan


def test_person_after_a_mark(spark):
    """A header row that ends a case names the person in the next one, also after pieces that hold marks only."""
    mark = "|初诊日期 2020/1/{}|**病案纪录**|"
    text = "\n".join([mark.format(1), "|诊断：a|", "|姓名|性别|年龄|来处|", mark.format(2), mark.format(3), "|Li|女|3|x|", "|诊断：b|"])
    rows = spark.createDataFrame([("p", text)], "path string, text string")
    found = {r["case_no"]: (r["name"], r["case_date"], r["diagnosis"]) for r in parse.case_records(rows).collect()}
    assert found == {1: (None, "2020-1-1", "a"), 3: ("Li", "2020-1-3", "b")}


def test_strings_are_read_once(spark, tmp_path):
    """What is compared are the distinct strings, written once, not the tables they come from."""
    for name, column in (("a", "x"), ("b", "y")):
        spark.createDataFrame([(v,) for v in ("pain", "a pain of old", "", "none")], f"{column} string").write.parquet(f"{tmp_path}/{name}")
    a, b = spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b")
    for found in (contain.contained(a, b), contain.either(a, b)):
        assert not [f for f in found.inputFiles() if str(tmp_path) in f]
        assert ("pain", "a pain of old") in {tuple(r) for r in found.collect()}


def test_wants_are_found_once(spark):
    """The walk works out what is wanted once."""
    asked = spark.sparkContext.accumulator(0)

    def seen(v):
        asked.add(1)
        return v

    wants = spark.createDataFrame([("c", "p"), ("c", "q"), ("d", "q")], "c string, pool string").withColumn("c", F.udf(seen, "string")("c")).withColumn("rank", F.lit(1))
    new = spark.createDataFrame([(1, "c"), (2, "d")], "new_id long, c string")
    holds = spark.createDataFrame([("p", 7, 0), ("q", 8, 0)], "pool string, old_id long, place long")
    assert sorted(map(tuple, walk.walked(new, wants, holds).collect())) == [(1, 7, 1), (2, 8, 1)]
    assert asked.value == 3


def test_what_is_made_of_a_small_file_is_not_broadcast(spark, tmp_path):
    """A file of much less than 10 MB may hold a million rows; it is shuffled, and only what is measured as small is broadcast."""
    spark.range(1_000_000).select("id", (F.col("id") % 7).alias("v")).write.parquet(f"{tmp_path}/part.parquet")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    part = catalogue.t(spark, str(tmp_path), "part")
    plan = part.join(part.select(F.col("id").alias("o"), F.explode(F.array(F.lit(1), F.lit(2))).alias("x")), F.col("id") == F.col("o"))._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_edges_of_a_hop_are_found_once(spark, monkeypatch):
    """Coverage of shorter paths does not look the edge tables up again."""
    seen, valid = [], chain.valid_edges
    monkeypatch.setattr(chain, "valid_edges", lambda db, hop: (seen.append(hop.name), valid(db, hop))[1])
    catalogue.QUERIES["reason_start_coverage"](spark, "/root/testdata/sf0.001")
    assert len(seen) == 3


def test_partitions_follow_the_tables(spark, tmp_path, monkeypatch):
    """A large table is shuffled into more partitions than the session has by default, so that none grows with it."""
    spark.range(200_000).select("id", F.rand(1).alias("v")).write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(tables, "PER_PARTITION", 50_000)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.conf.unset(key)
    try:
        rows = catalogue.t(spark, str(tmp_path), "part")
        asked = int(spark.conf.get(key))
        assert asked > 20 and rows.repartition("id")._jdf.queryExecution().executedPlan().toString().count(f", {asked})") == 1
    finally:
        spark.conf.unset(key)


def test_paths_are_not_shuffled_for_names(spark):
    """Names of the last table are joined to the edges of the last hop; what is joined last are the paths."""
    plan = catalogue.QUERIES["reason_cases"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "formulas_id" in joins[0] and "clinical_cases_id" not in joins[0]


def test_keys_are_counted_as_they_are(spark):
    """Rows are dealt by the key's own columns, without the names of table and key; strings with commas stay apart."""
    edges = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "formula_id long, herb_id long")
    found = constraints.doubled_keys({"formula_herbs": edges, "formulas": spark.createDataFrame([(5,), (5,), (6,)], "id long")})
    assert {tuple(r) for r in found.collect()} == {("formula_herbs", "key:formula_id,herb_id", "1,2", 2), ("formulas", "key:id", "5", 2)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "hashpartitioning" in line and "key:" in line or "hashpartitioning(table" in line]
    apart = spark.createDataFrame([("a,b", "c"), ("a", "b,c")], "formula_id string, herb_id string")
    assert constraints.doubled_keys({"formula_herbs": apart}).count() == 0
