"""Conversations from messages that quote each other.

Quote levels are read from leading ``>`` signs. Quoted passages, whole and line by line, are hashed in a normal
form and joined to the messages that wrote them; the source of the shallowest quotation that is found is the
message replied to. Replies are followed to their root, and messages come out in reply order without quotes.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.plans.durable import written
from tallyloom.plans.ranks import ordered_rank

# Lines of fewer normalised characters link by themselves only if a single message of the scope wrote them.
TELLING = 24
SHORT, LINE, WHOLE = range(3)

_MARKS = "^((?:[ \\t]*>)+)"
_ATTRIBUTION = "(?i)^(?:on|am|le|el)\\b.*\\b(?:wrote|schrieb|écrit|escribió)\\b.*:\\s*$"


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "\\s+", " "))


def _lines(messages: DataFrame) -> DataFrame:
    """(msg_id, scope, pos, level, content): every line with its quote level and without its signs."""
    lines = messages.select("msg_id", "scope", F.posexplode(F.split("text", "\\r?\\n", -1)).alias("pos", "line"))
    marks = F.regexp_extract("line", _MARKS, 1)
    level = F.length(F.regexp_replace(marks, "[^>]", ""))
    content = F.regexp_replace(F.regexp_replace("line", _MARKS, ""), "^ ", "")
    return lines.select("msg_id", "scope", "pos", level.alias("level"), F.when(level > 0, content).otherwise(F.col("line")).alias("content"))


def passages(messages: DataFrame) -> DataFrame:
    """(msg_id, scope, first, level, lines): runs of lines of one level; a line that introduces a quotation is left out."""
    order = Window.partitionBy("msg_id").orderBy("pos")
    lines = _lines(messages).withColumn("next", F.lead("level").over(order))
    lines = lines.where(~((F.col("level") < F.col("next")) & F.col("content").rlike(_ATTRIBUTION)))
    runs = lines.withColumn("new", F.coalesce((F.lag("level").over(order) != F.col("level")).cast("int"), F.lit(0)))
    runs = runs.withColumn("run", F.sum("new").over(order))
    return runs.groupBy("msg_id", "scope", "run", "level").agg(
        F.min("pos").alias("first"), F.array_sort(F.collect_list(F.struct("pos", "content"))).alias("lines")
    ).select("msg_id", "scope", "first", "level", F.transform("lines", lambda x: x["content"]).alias("lines"))


def _keys(rows: DataFrame) -> DataFrame:
    """(msg_id, scope, level, part, key): the hash of each passage and of each of its lines."""
    whole = _normal(F.array_join("lines", " "))
    each = F.array_distinct(F.transform("lines", _normal))
    both = F.concat(
        F.array(F.struct(F.lit(WHOLE).alias("part"), whole.alias("text"))),
        F.transform(each, lambda x: F.struct(F.when(F.length(x) >= TELLING, LINE).otherwise(SHORT).alias("part"), x.alias("text"))),
    )
    return rows.select("msg_id", "scope", "level", F.explode(both).alias("k")).where("k.text <> ''").select(
        "msg_id", "scope", "level", F.col("k.part").alias("part"), F.md5(F.col("k.text").cast("binary")).alias("key")
    )


def reply_threads(messages: DataFrame) -> DataFrame:
    """One row per message of ``messages`` (msg_id, scope, text): thread_id, parent_id, depth, position, text, n_quoted.

    msg_id is unique and grows with time; ``scope`` (a mailbox or list, may be null) bounds where originals are
    looked for. A passage belongs to the earliest message of its scope that wrote it. The parent is the source,
    earlier than the message, of its shallowest quote level that has one: by whole passages before single lines,
    then by the number of parts found (passages and lines, then short lines, which link only if one message of the scope
    wrote them), then the earliest. ``thread_id`` is the root reached over parents,
    ``depth`` the number of replies to it, ``position`` (from 0) the place in the thread by msg_id, which puts
    every message behind the one it answers. ``text`` is the message without quotes, attributions and outer blank
    lines (null if null), ``n_quoted`` its number of quoted passages. Empty texts have no parent. Rows without
    msg_id are left out, of repeated ones one is used. Other columns are not read.
    """
    rows = (
        messages.select(F.col("msg_id").cast("long"), F.col("scope").cast("string"), F.col("text").cast("string"))
        .where("msg_id IS NOT NULL")
        .groupBy("msg_id").agg(F.max(F.struct("text", "scope")).alias("m"))
        .select("msg_id", F.coalesce("m.scope", F.lit("")).alias("scope"), "m.text")
    )
    rows = written(rows, "messages")
    runs = written(passages(rows.where("text IS NOT NULL")), "passages")
    keys = written(_keys(runs), "passage-keys")
    sources = keys.where("level = 0").groupBy("scope", "key").agg(
        F.min("msg_id").alias("source"), (F.min("msg_id") == F.max("msg_id")).alias("single")
    )

    def distinct(short: bool) -> Column:
        return F.count_distinct(F.when((F.col("part") == SHORT) == short, F.col("key")))

    found = (
        keys.where("level > 0").join(sources, ["scope", "key"]).where("source < msg_id").where((F.col("part") != SHORT) | F.col("single"))
        .groupBy("msg_id", "level", "source")
        .agg((F.max("part") == WHOLE).alias("whole"), distinct(False).alias("parts"), distinct(True).alias("short"))
    )
    best = F.max(F.struct(-F.col("level"), "whole", "parts", "short", (-F.col("source")).alias("source")))
    parents = written(found.groupBy("msg_id").agg((-best["source"]).alias("parent_id")), "parents")

    # Pointer doubling over the replies: ``up`` is an ancestor ``steps`` replies above, and the row is settled once
    # that is known to be the root. Only unsettled rows are joined again.
    replies = parents.select("msg_id", F.col("parent_id").alias("up"), F.lit(1).alias("steps"), F.lit(False).alias("settled"))
    state = written(replies, "ancestors")
    while not state.where("NOT settled").isEmpty():
        above = state.select(
            F.col("msg_id").alias("at"), F.col("up").alias("next"), F.col("steps").alias("more"), F.col("settled").alias("known")
        )
        moved = state.where("NOT settled").join(above, F.col("up") == F.col("at"), "left").select(
            "msg_id", F.coalesce("next", "up").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            (F.col("at").isNull() | F.col("known")).alias("settled"),
        )
        state = written(state.where("settled").union(moved), "ancestors")
    state = rows.select("msg_id").join(state, "msg_id", "left").select(
        "msg_id", F.coalesce("up", "msg_id").alias("up"), F.coalesce("steps", F.lit(0)).alias("steps")
    )
    placed = ordered_rank(state.select("msg_id", F.col("up").alias("thread_id"), F.col("steps").alias("depth")), ["thread_id"], ["msg_id"], "position")

    own = runs.groupBy("msg_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("level") == 0, F.struct("first", "lines")))).alias("own"),
        F.sum((F.col("level") > 0).cast("long")).alias("n_quoted"),
    )
    text = F.array_join(F.flatten(F.transform("own", lambda r: r["lines"])), "\n")
    trimmed = F.regexp_replace(F.regexp_replace(text, "\\A(?:[ \\t]*\\n)+", ""), "(?:\\n[ \\t]*)+\\z", "")
    cleaned = own.select("msg_id", trimmed.alias("text"), "n_quoted")
    return (
        placed.join(parents, "msg_id", "left").join(cleaned, "msg_id", "left")
        .select("msg_id", "thread_id", "parent_id", "depth", "position", "text", F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"))
    )
