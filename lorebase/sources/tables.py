"""Table loading and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Lazy scan of one Parquet table below ``base``."""
    return spark.read.parquet(f"{base}/{name}.parquet")


#: What a task reads of a shuffle where partitions are put together; repeated values shrink so much there that its sorts may hold twenty times as much.
SHUFFLED = "8m"


#: Files up to this size may be broadcast unasked. What is made of a file may be a hundred times as large, and Spark guesses it by the file's size.
SMALL_FILE = "256k"
#: What has been shuffled, and so is measured, may still be broadcast up to this size.
SMALL_ROWS = "8m"

#: A shuffle is dealt into a partition for so many bytes of the largest table, so that one of four times the table still has partitions of SHUFFLED.
PER_PARTITION = 2 << 20

#: What a task reads of a file; it sets how much a first count or distinct holds.
SCANNED = "32m"


def small_tasks(spark: SparkSession) -> None:
    """From now on a task reads SCANNED of a file and shuffled partitions are put together up to SHUFFLED, so that a task's sorts and hash tables stay small in large tables, and only measured or very small tables are broadcast."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", SHUFFLED)
    spark.conf.set("spark.sql.files.maxPartitionBytes", SCANNED)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", SMALL_FILE)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", SMALL_ROWS)


def many_partitions(spark: SparkSession, base: str, name: str) -> None:
    """From now on shuffles are dealt into enough partitions for the table ``name``: they are put together up to SHUFFLED but never split, so a fixed number of them would grow with the tables."""
    context, key = spark.sparkContext, "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    path = context._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}.parquet")
    needed = -(-path.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(path).getLength() // PER_PARTITION)
    if needed > int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(key, str(needed))


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by ``key`` to as many tasks as a shuffle has, for work that makes much of a row: a small file is read by one task, which would do all of it."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (local tests) a temporary folder is made; on a cluster it must be set.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if named is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-ckpt-"))
    return sc.getCheckpointDir()


def materialise(df: DataFrame, tag: str = "t") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage so that a lost executor costs a re-read, and so that two
    consumers do not compute the same rows twice.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Remove what ``materialise`` wrote for these frames; nothing may read them afterwards."""
    for df in frames:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
