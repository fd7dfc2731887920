"""Incremental import of case files: new files as a stream, known patients passed over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lorebase.operators.link import not_known
from lorebase.operators.parse import case_records
from lorebase.sources.documents import stem


def import_cases(spark: SparkSession, folder: str, target: str, checkpoint: str, known: DataFrame | None = None) -> StreamingQuery:
    """Appends the cases of files that arrive below ``folder``; each file counts once, by the checkpoint.

    ``source_locator`` is the file and the case's number in it. Cases have no key of
    their own, so a batch that is written twice is told by its batch number's folder.
    """
    files = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").schema("value string").load(folder)
    files = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))

    def append(batch: DataFrame, number: int) -> None:
        fresh = batch if known is None else not_known(batch, known, stem(F.col("path")))
        cases = case_records(fresh).withColumn("source_locator", F.concat_ws("#", "path", "case_no"))
        cases.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return files.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
