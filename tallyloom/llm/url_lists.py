"""URL filtering against a dated list: every capture is judged by the entries active when it was fetched.

A list is a log of dated additions and removals. It becomes validity intervals, and captures meet them in a
join on the entry and the interval that holds their day. An entry is a host (with all its subdomains) or a host
and leading path segments. Look-ups are made once per key and day, so a host with very many captures meets the
list at most once a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import bounded_broadcast
from tallyloom.plans.durable import written

_AUTHORITY = "^\\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if there is none."""
    return F.lower(F.regexp_replace(F.regexp_extract(url, _AUTHORITY + "([^/?#:]*)", 1), "\\.$", ""))


def segments_of(url: Column) -> Column:
    """Path segments that are not empty."""
    path = F.regexp_extract(url, _AUTHORITY + "[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def intervals(events: DataFrame) -> DataFrame:
    """(entry, since, until) from events (entry, action 'add' or 'remove', day); ``until`` is exclusive, null if open.

    The host of an entry is lower-cased, its path keeps its case as those of URLs do. Of several events of an entry
    on one day a removal comes last. Rows with nulls or other actions are ignored.
    """
    host, path = F.regexp_extract("entry", "^[^/]*", 0), F.regexp_extract("entry", "(?s)/.*", 0)
    known = (
        events.where("entry IS NOT NULL AND day IS NOT NULL AND action IN ('add', 'remove')")
        .select(F.concat(F.lower(host), path).alias("entry"), "action", F.col("day").cast("date").alias("day"))
        .distinct()
        # Only the last action of a day counts.
        .groupBy("entry", "day").agg(F.max("action").alias("action"))
    )
    after = Window.partitionBy("entry").orderBy("day")
    return (
        known.withColumn("until", F.lead("day").over(after))
        .where("action = 'add'")
        .select("entry", F.col("day").alias("since"), "until")
    )


def judged(captures: DataFrame, events: DataFrame) -> DataFrame:
    """One row per distinct (page_id, url, fetched) of ``captures``: with host, n_entries, entry, since, blocked.

    ``n_entries`` counts the entries active on the day of the capture that cover its URL, ``entry`` is the longest
    of them and ``since`` when it came on the list; without any both are null and ``blocked`` is false. URLs that
    are null or have no host, and captures without a day, are not blocked. Other columns are not read.
    """
    list_ = written(intervals(events), "url-list")
    deepest = list_.agg(F.max(F.size(F.split("entry", "/")) - 1)).first()[0] or 0
    rows = captures.select("page_id", F.col("url").cast("string").alias("url"), F.col("fetched").cast("date").alias("fetched")).distinct()
    rows = rows.withColumn("host", F.coalesce(host_of(F.col("url")), F.lit("")))
    labels, segments = F.split("host", "\\."), segments_of(F.col("url"))
    # The host and what is left behind each of its dots, then the host with 1, 2, ... leading segments.
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    depth = F.least(F.size(segments), F.lit(deepest))
    paths = F.when(depth > 0, F.transform(
        F.sequence(F.lit(1), depth), lambda i: F.concat(F.col("host"), F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/"))
    )).otherwise(F.array().cast("array<string>"))
    keyed = rows.where("host <> '' AND fetched IS NOT NULL").select(
        "page_id", "url", "fetched", F.explode(F.concat(parents, paths)).alias("key")
    )
    asked = keyed.select("key", "fetched").distinct()
    answers = asked.join(
        bounded_broadcast(list_, F.lit(3)),
        (F.col("key") == F.col("entry")) & (F.col("fetched") >= F.col("since")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until"))),
    ).select("key", "fetched", "since")
    found = (
        keyed.join(answers, ["key", "fetched"])
        .groupBy("page_id", "url", "fetched")
        .agg(F.count(F.lit(1)).alias("n_entries"), F.max(F.struct(F.length("key").alias("size"), "key", "since")).alias("best"))
    )
    mine, theirs = rows.alias("a"), found.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("page_id", "url", "fetched")]
    return mine.join(theirs, same, "left").select(
        "a.page_id", "a.url", "a.fetched", "a.host", F.coalesce("n_entries", F.lit(0)).alias("n_entries"),
        F.col("best.key").alias("entry"), F.col("best.since").alias("since"), F.col("best").isNotNull().alias("blocked"),
    )
