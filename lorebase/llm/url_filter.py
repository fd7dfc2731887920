"""URL filter: host/path rules, then a blocked Bloom filter in front of an exact join.

Method. A list of canonical URL expressions (``host/path-prefix``) is hashed into
a blocked Bloom filter: every entry sets four bits inside one 64-bit block. Each
URL without a fitting rule is expanded into its host suffixes x path prefixes, up
to the most labels and folders that an entry has; user part, port and trailing dots
of the host do not count there, and percent escapes are decoded (invalid ones stay). Expressions whose bits are all set are possible hits and go to an exact hash join
with the list, which removes the filter's false positives. The filter has a fixed
number of blocks at most, so what is broadcast is bounded whatever the list holds.

Defined results. A null URL or one without ``://`` has empty host and path, fits
no rule and is allowed. Repeated rows each keep their own row. An empty list
allows whatever no rule decides; an empty table gives an empty result. Extra
columns of the input are not returned and may have any name but the URL's.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from lorebase.sources.tables import materialise

#: Decided first; the longest fitting rule wins. (action, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Listed canonical URLs of the production query: whole sites.
LISTED = tuple(
    f"{site}.example.{top}/"
    for site in ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for top in ("com", "net", "org")
)

#: At most this many 64-bit blocks, 16 MB as joined rows, are ever broadcast.
MAX_BLOCKS = 1 << 20
#: Listed pairs of host and path that may be broadcast, some 50 MB; beyond, a shuffled join.
MAX_BROADCAST_ROWS = 300_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, action) of the longest fitting rule, or null."""
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for action, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return out


def unescaped(part: Column) -> Column:
    """Percent escapes decoded; a plus is a plus, and a part with an invalid escape stays as it is."""
    decoded = F.try_url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(part, F.lit("%")), F.coalesce(decoded, part)).otherwise(part)


def site_of(host: Column) -> Column:
    """The host without user part, port and trailing dots, escapes decoded, A-Z lower-cased."""
    host = F.translate(unescaped(host), _UPPER, _LOWER)
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "(?s)^.*@", ""), ":[0-9]*$", ""), r"\.+$", "")


def _labels(site: Column) -> Column:
    return F.size(F.split(site, r"\."))


def _folders(path: Column) -> Column:
    return F.size(F.split(path, "/")) - 1


def lookup_keys(site: Column, path: Column, most_labels: int, most_folders: int) -> Column:
    """Expressions under which a URL may be listed: host suffixes x path prefixes."""
    labels = F.split(site, r"\.")
    n = F.size(labels)
    hosts = F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(most_labels))),
        lambda i: F.array_join(F.slice(labels, n - i + 1, i), "."),
    )
    full = F.when(path == "", "/").otherwise(unescaped(path))
    parts = F.split(full, "/")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.least(_folders(full), F.lit(most_folders))),
        lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")),
    )
    paths = F.array_distinct(F.concat(F.array(full), prefixes))
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("long"))


def _mask(key: Column) -> Column:
    h = F.xxhash64(F.lit("bits"), key)
    return _bit(h, 0).bitwiseOR(_bit(h, 6)).bitwiseOR(_bit(h, 12)).bitwiseOR(_bit(h, 18))


def _bit(h: Column, at: int) -> Column:
    place = F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63).cast("long")).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter as rows (block, word): at most ``blocks`` of them."""
    return listed.groupBy(_block(F.col("key"), blocks).alias("block")).agg(F.bit_or(_mask(F.col("key"))).alias("word"))


def filter_urls(pages: DataFrame, listed: DataFrame, rules=RULES, url: str = "url", keep: tuple = ("page_id",)) -> DataFrame:
    """``keep`` columns plus host, path, rule, verdict and ``listed``, one row per input row.

    ``listed`` has one string column ``key`` of canonical expressions.
    """
    listed = listed.select(F.col("key")).where(F.col("key").isNotNull()).distinct()
    # of the list's longest entries; 1 for an empty list
    most = listed.agg(
        F.count("key").alias("n"),
        F.max(_labels(F.substring_index("key", "/", 1))).alias("labels"),
        F.max(_folders(F.col("key"))).alias("folders"),
    ).first()
    n, most_labels, most_folders = most["n"], max(1, most["labels"] or 1), max(1, most["folders"] or 1)
    blocks = min(MAX_BLOCKS, 1 << max(4, math.ceil(math.log2(max(1, n) * 16 / 64 + 1))))
    rows = pages.select(*keep, F.col(url).alias("__url"))
    rows = rows.withColumns({"host": host_of(F.col("__url")), "path": path_of(F.col("__url"))})
    rows = rows.withColumn("__fit", fitting_rule(F.col("host"), F.col("path"), rules))
    keys = (
        rows.where(F.col("__fit").isNull() & (site_of(F.col("host")) != ""))
        .select("host", "path", F.explode(lookup_keys(site_of(F.col("host")), F.col("path"), most_labels, most_folders)).alias("key"))
        .withColumns({"block": _block(F.col("key"), blocks), "__mask": _mask(F.col("key"))})
    )
    bits = F.broadcast(bloom_blocks(listed, blocks))
    possible = keys.join(bits, "block").where(F.col("word").bitwiseAND(F.col("__mask")) == F.col("__mask"))
    hits = possible.join(listed, "key", "left_semi").select("host", "path").distinct().withColumn("listed", F.lit(True))
    hits = materialise(hits, "listed")
    # pages are not dealt out by host and path unless very many are listed; Spark then splits a hot pair, as each is once among the hits
    small = hits.count() <= MAX_BROADCAST_ROWS
    return rows.join(F.broadcast(hits) if small else hits, ["host", "path"], "left").select(
        *keep,
        "host",
        "path",
        F.col("__fit.rule").alias("rule"),
        F.coalesce(F.col("__fit.action"), F.when(F.col("listed"), "block"), F.lit("allow")).alias("verdict"),
        F.coalesce("listed", F.lit(False)).alias("listed"),
    )


def listed_frame(spark, entries=LISTED) -> DataFrame:
    return spark.createDataFrame([(e,) for e in entries], "key string")
