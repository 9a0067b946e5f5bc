"""URL filters with a history, by DataFrame functions only.

Filter lists change: an entry is added on one date and taken off on another.
Dated list entries become validity intervals, and an as-of join evaluates
every capture against the entries that were active when it was fetched.

An entry names a host with all hosts below it, or the beginning of a path on
such hosts.  A capture looks up each key it falls under, and the interval is
joined on the key and the calendar month, so a key with a long history or many
captures is spread over its months, and no capture meets an interval that ended
in another month.  Of the active entries the longest key decides; an allowing
entry wins over a blocking one on the same key.

Entries are brought into the form of the keys: without scheme, user, port and
``*.`` in front, hosts in lower case, paths without empty parts.  What cannot
match any URL then is left out and can be listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)"
ENTRY = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?(?:[^/?#@\s]*@)?(?:\*?\.)?(\[[^\]\s]*\]|[^/?#:*\s]*)(?::[0-9]*)?(?:/([^?#\s]*))?\s*$"


def url_host(url: Column) -> Column:
    """Lowered host of a URL without user, port and closing dot; empty when there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)), r"\.+$", "")


def path_parts(path: Column) -> Column:
    """The parts of a path that hold something."""
    return F.filter(F.split(path, "/"), lambda p: p != "")


def url_keys(url: Column, deepest: int | None = None) -> Column:
    """Keys that a capture falls under: its host and each parent with a dot in it, alone and with each beginning of the path.

    ``deepest`` leaves out beginnings of more parts, which no entry has.
    """
    host = url_host(url)
    labels = F.split(host, r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = path_parts(F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1))
    n = F.size(parts) if deepest is None else F.least(F.size(parts), F.lit(deepest))
    begins = F.transform(F.sequence(F.lit(0), n), lambda j: F.when(j == 0, "").otherwise(
        F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), j), "/"))))
    keys = F.flatten(F.transform(begins, lambda b: F.transform(parents, lambda h: F.concat(h, b))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(keys))


def entry_key(key: Column) -> Column:
    """An entry in the form of ``url_keys``; null if no URL can have such a key."""
    host = F.regexp_replace(F.lower(F.regexp_extract(key, ENTRY, 1)), r"\.+$", "")
    parts = path_parts(F.regexp_extract(key, ENTRY, 2))
    made = F.when(F.size(parts) > 0, F.concat(host, F.lit("/"), F.array_join(parts, "/"))).otherwise(host)
    return F.when(F.rlike(key, F.lit(ENTRY)) & (host != ""), made)


def unusable_entries(entries: DataFrame) -> DataFrame:
    """The entries that can decide nothing: a column is null, or the key cannot match any URL."""
    whole = F.lit(True)
    for name in ("list_name", "key", "action", "since"):
        whole = whole & F.col(name).isNotNull()
    return entries.filter(~(whole & entry_key(F.col("key")).isNotNull()))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``list_name, key, verdict, since, until`` from dated entries.

    ``entries`` has ``list_name, key, action, since``; an action is ``block``,
    ``allow`` or ``remove`` and holds until the next one for the same list and
    key, without one for ever (``until`` is null).  Of several actions at one
    time the last in the alphabet holds.  Keys that are alike in the form of
    ``entry_key`` are one.  Rows with a null, and keys without that form, are
    left out; ``unusable_entries`` has them.
    """
    known = entries.select("list_name", entry_key(F.col("key")).alias("key"), "action", "since").dropna()
    one = known.groupBy("list_name", "key", "since").agg(F.max("action").alias("action"))
    after = Window.partitionBy("list_name", "key").orderBy("since")
    return one.withColumn("until", F.lead("since").over(after)).filter(F.col("action") != "remove").select(
        "list_name", "key", F.col("action").alias("verdict"), "since", "until")


def by_month(intervals: DataFrame, last) -> DataFrame:
    """Each interval once per calendar month that it touches, up to the month of the time ``last``."""
    end = F.coalesce("until", F.lit(last).cast(intervals.schema["since"].dataType))
    months = F.sequence(F.trunc("since", "month"), F.trunc(F.greatest(end, F.col("since")), "month"),
                        F.expr("interval 1 month"))
    return intervals.withColumn("month", F.explode(months))


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``capture_id, n_active, decided_by, verdict`` for every capture.

    ``captures`` has ``capture_id, url, fetched``.  ``n_active`` counts the
    active entries; ``verdict`` is that of the longest key, null if none is
    active, as for a null URL, one without a host, or a null time.  Equal rows
    are one capture; different rows with one key, null too, make one result
    with all their active entries.  Without entries every verdict is null.
    """
    last = captures.agg(F.max("fetched")).first()[0]
    intervals = validity_intervals(entries)
    deepest = intervals.agg(F.max(F.size(F.split("key", "/")) - 1)).first()[0] or 0
    spread = by_month(intervals, last).filter("month IS NOT NULL")
    asked = captures.select("capture_id", "url", "fetched").distinct()
    probes = asked.select("capture_id", "fetched", F.trunc("fetched", "month").alias("month"),
                          F.explode(url_keys(F.col("url"), deepest)).alias("key"))
    active = probes.join(spread, ["key", "month"]).filter(
        (F.col("since") <= F.col("fetched")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until"))))
    rank = F.struct(F.length("key").alias("length"), F.when(F.col("verdict") == "allow", 1).otherwise(0).alias("allows"),
                    F.col("key").alias("key"), F.col("verdict").alias("verdict"))
    hits = active.select("capture_id", F.lit(1).alias("hit"), rank.alias("rank"))
    every = asked.select("capture_id", F.lit(0).alias("hit"), F.lit(None).cast(hits.schema["rank"].dataType).alias("rank"))
    # One aggregation instead of an outer join: each capture is there once without a hit.
    return every.unionByName(hits).groupBy("capture_id").agg(
        F.sum("hit").alias("n_active"), F.max("rank").alias("top")
    ).select("capture_id", "n_active", F.col("top.key").alias("decided_by"), F.col("top.verdict").alias("verdict"))
