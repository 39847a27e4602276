"""URL filters by a temporal list join.

A list is a log of dated entries: on a day, a domain or a path prefix is added for blocking or for
allowing, or removed. The last state of a day holds; consecutive days of a key make validity intervals
from one entry to the next. A capture is judged by the entries that are active on the day it was
fetched, among the keys that its URL has: all domain suffixes of the host and all path prefixes. Of
several active entries the most specific (longest path, then longest domain) decides.

The as-of join is an equality join on key and 32-day period: an interval has one row per period that it
touches, at most one per day and key. A key that a third of all captures has meets at most 32 intervals a
capture; captures are joined as different (URL, day) pairs, so repeated captures do not multiply.

A null or unreadable URL, or a null day, has no keys: verdict ``none``. Entries with a null in key, day or
operation are ignored. Of several entries of a key on one day a block wins over an allow, an allow over a
removal. Repeated rows stay; empty tables give no rows, or captures with verdict ``none``. Other columns
of both tables do not matter, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PERIOD = 32
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def path_parts(url: Column) -> Column:
    return F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda x: x != "")


def domain_key(url: Column) -> Column:
    """The host without all but its last two labels."""
    labels = F.split(host(url), r"\.")
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")


def prefix_key(url: Column) -> Column:
    """Host and first part of the path."""
    parts = path_parts(url)
    return F.concat(host(url), F.lit("/"), F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit("")))


def url_keys(url: Column) -> Column:
    """All domain suffixes and all path prefixes of a URL."""
    labels, parts, name = F.split(host(url), r"\."), path_parts(url), host(url)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(name, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")))
    root = F.array(F.concat(name, F.lit("/")))
    return F.when(name != "", F.concat(suffixes, root, F.when(F.size(parts) > 0, prefixes).otherwise(F.array().cast("array<string>"))))


def validity(entries: DataFrame) -> DataFrame:
    """(key, action, since, until): intervals in days of the entries (key, day, operation block, allow or remove)."""
    order = F.expr("array_position(array('remove', 'allow', 'block'), operation)")
    known = entries.where("key IS NOT NULL AND day IS NOT NULL AND operation IN ('block', 'allow', 'remove')")
    days = known.groupBy("key", "day").agg(F.max(order).alias("state"))
    by_key = Window.partitionBy("key").orderBy("day")
    until = F.lead("day").over(by_key)
    action = F.when(F.col("state") == 3, "block").otherwise("allow")
    return days.withColumn("until", until).where("state > 1").select("key", action.alias("action"), F.col("day").alias("since"), "until")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """The captures (page_id, url, day) with n_active, decided_by and verdict (block, allow or none)."""
    asked = captures.select("url", "day").where("url IS NOT NULL AND day IS NOT NULL").distinct()
    keys = asked.select("url", "day", F.explode(url_keys(F.col("url"))).alias("key")).withColumn("period", F.floor(F.col("day") / PERIOD))
    last = F.lit(captures.agg(F.max("day").alias("last")).first()["last"]).cast("int")
    intervals = validity(entries).where(F.col("since") <= last)
    ends = F.least(F.coalesce(F.col("until") - 1, last), last)
    parts = intervals.select("key", "action", "since", "until", F.explode(F.sequence(F.floor(F.col("since") / PERIOD), F.floor(ends / PERIOD))).alias("period"))
    active = keys.join(parts, ["key", "period"]).where("since <= day AND (until IS NULL OR day < until)")
    rank = F.struct(F.col("key").contains("/").alias("path"), F.length("key").alias("length"), F.col("key"))
    judged = active.groupBy("url", "day").agg(F.count("*").alias("n_active"), F.max_by(F.struct("key", "action"), rank).alias("by"))
    return captures.select("page_id", "url", "day").join(judged, ["url", "day"], "left").select(
        "page_id", "url", "day", F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active"), F.col("by.key").alias("decided_by"), F.coalesce("by.action", F.lit("none")).alias("verdict")
    )
