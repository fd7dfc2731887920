"""Source documents: Markdown trees, bytes of unknown encoding, front matter, registries."""

from __future__ import annotations

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

PASSED_OVER = ("README", "INDEX")


def markdown_tree(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of all .md files below a folder, but for those passed over."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(folder, wholetext=True)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    name = F.element_at(F.split("path", "/"), -1)
    for word in PASSED_OVER:
        rows = rows.where(~name.contains(word))
    return rows


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def files_by_folder(spark: SparkSession, folder: str, glob: str = "*.md") -> DataFrame:
    """(folder, n); the content is not read."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder).select("path")
    return rows.groupBy(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")).agg(F.count(F.lit(1)).alias("n"))


@F.pandas_udf(T.StringType())
def decoded(content: pd.Series) -> pd.Series:
    """UTF-8, else GBK, else Latin-1."""

    def one(b):
        if b is None:
            return ""
        for name in ("utf-8", "gbk"):
            try:
                return bytes(b).decode(name)
            except UnicodeDecodeError:
                pass
        return bytes(b).decode("latin-1")

    return content.map(one)


def text_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    rows = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)
    return rows.select("path", decoded("content").alias("text"), F.sha2("content", 256).alias("sha256"))


def pdf_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of PDF files; needs an optional library on the executors, '' for what cannot be read."""

    @F.pandas_udf(T.StringType())
    def read(content: pd.Series) -> pd.Series:
        import fitz

        def one(b):
            try:
                with fitz.open(stream=bytes(b), filetype="pdf") as pages:
                    return "\n".join(p.get_text() for p in pages)
            except (RuntimeError, ValueError):
                return ""

        return content.map(one)

    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", True).load(folder)
    return rows.select("path", read("content").alias("text"))


def front_matter(text: Column) -> Column:
    """Map of the keys between the first two ``---`` lines; lists keep their commas, quotes go."""
    block = F.regexp_extract(text, r"(?s)^---\s*\n(.*?)\n---", 1)
    lines = F.filter(F.split(block, "\n"), lambda s: s.contains(":") & ~F.trim(s).startswith("#"))
    value = lambda s: F.trim(F.regexp_replace(s, "^[^:]*:", ""))
    plain = lambda v: F.regexp_replace(F.regexp_replace(v, r"^\[|\]$", ""), "[\"']", "")
    entry = lambda s: F.struct(F.trim(F.regexp_extract(s, "^([^:]*):", 1)).alias("key"), plain(value(s)).alias("value"))
    pairs = F.transform(lines, entry)
    # a key given twice: the last counts
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def front_values(text: Column) -> Column:
    """Map of the keys of the front matter to variants: a list stays a list, a quoted text keeps what is inside its quotes.

    The block lies between a leading ``---`` and the next one. Of a key given twice the last counts; no block gives an empty map.
    """
    block = F.regexp_extract(text, r"(?s)^---(.*?)---", 1)
    lines = F.transform(F.split(block, "\n"), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    lines = F.filter(lines, lambda s: s.rlike(r"^[^#\s]\S*:\s*\S"))
    unquoted = lambda v: F.regexp_replace(v, '^"+|"+$', "")

    def entry(s: Column) -> Column:
        items = F.transform(F.split(F.regexp_extract(s, r"^\S+:\s*\[(.+?)\]", 1), ","), lambda v: unquoted(F.trim(v)))
        quoted = F.regexp_extract(s, r'^\S+:\s*"([^"]*)"', 1)
        plain = unquoted(F.trim(F.regexp_extract(s, r"^\S+:\s*(.+)$", 1)))
        one = F.to_json(F.array(F.when(s.rlike(r'^\S+:\s*"[^"]*"'), quoted).otherwise(plain)))
        value = F.when(s.rlike(r"^\S+:\s*\[.+?\]"), F.to_json(items)).otherwise(F.substring(one, 2, F.length(one) - 2))
        return F.struct(F.regexp_extract(s, r"^(\S+):", 1).alias("key"), value.alias("value"))

    pairs = F.transform(lines, entry)
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.transform_values(F.map_from_entries(last), lambda _, v: F.parse_json(v))


def as_text(value: Column) -> Column:
    """A variant as text: a list's members with commas between, '' for null."""
    items = F.try_variant_get(value, "$", "array<string>")
    return F.coalesce(F.array_join(items, ","), F.try_variant_get(value, "$", "string"), F.lit(""))


def file_count(spark: SparkSession, folder: str, glob: str = "*.md") -> int:
    """Files of a folder itself; 0 for one that is not there."""
    try:
        return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path").count()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def contributions(registries: DataFrame, text: str = "text") -> DataFrame:
    """(source, table, what): a row for each contribution that a registry in JSON lists; ``what`` is a variant, so it may have any shape."""
    sources = F.try_variant_get(F.try_parse_json(text), "$.sources", "array<variant>")
    each = registries.select(F.explode(sources).alias("s"))
    rows = each.select(F.try_variant_get("s", "$.repo", "string").alias("source"), F.try_variant_get("s", "$.contributions", "variant").alias("c"))
    listed = registries.sparkSession.tvf.variant_explode(F.col("c").outer())
    return rows.lateralJoin(listed).select("source", F.coalesce("key", F.col("pos").cast("string")).alias("table"), F.col("value").alias("what"))


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Source registries in JSON."""
    return spark.read.json(path, multiLine=True)
