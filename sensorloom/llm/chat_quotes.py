"""Conversations in reply order: quoted passages linked to the messages they come from, and left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import discard, numbered, staged, text_or_empty

MARKS = r"^(?:[ \t]*>)+"


def lines(messages: DataFrame) -> DataFrame:
    """(row, nth, level, body) per line of a message's text; the level is the number of quote marks before it."""
    each = messages.select("row", F.posexplode(F.split("text", r"\r?\n")).alias("nth", "line"))
    marks = F.regexp_extract("line", MARKS, 0)
    return each.select("row", "nth", F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
                       F.trim(F.regexp_replace("line", MARKS, "")).alias("body"))


def passages(each: DataFrame) -> DataFrame:
    """(row, level, begins, passage): runs of lines of one level without a blank line, with single spaces.

    The runs of one message are found by windows over that message's lines.
    """
    order = Window.partitionBy("row").orderBy("nth")
    new = (F.lag("level").over(order) != F.col("level")) | (F.lag("body").over(order) == "") | F.lag("level").over(order).isNull()
    run = F.sum(new.cast("int")).over(order)
    grouped = each.withColumn("run", run).groupBy("row", "run").agg(
        F.first("level").alias("level"), F.min("nth").alias("begins"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", "body"))), lambda x: x["body"]), " ").alias("passage"))
    tidy = F.trim(F.regexp_replace("passage", r"\s+", " "))
    return grouped.select("row", "level", "begins", tidy.alias("passage")).where("passage <> ''")


def _digest(passage: str) -> Column:
    return F.sha2(passage, 256)


def quote_links(messages: DataFrame, parts: DataFrame) -> DataFrame:
    """(row, parent): the message that each message quotes most at its outermost level; staged.

    A quoted passage belongs to the earliest message of its conversation that says it in its own words, if that
    is earlier than the quote. Both sides meet on (conversation, digest), where the originals are one row each,
    so common passages are neither a hot pair nor multiplied. Deeper levels name earlier messages of
    the chain and break ties; then the later message wins.
    """
    place = messages.select("row", "conv", "turn")
    own = parts.where("level = 0").select("row", _digest("passage").alias("digest")).distinct().join(place, "row")
    first = staged(own.groupBy("conv", "digest").agg(F.min(F.struct("turn", "row")).alias("original")))
    quoted = parts.where("level > 0").select("row", "level", _digest("passage").alias("digest")).distinct().join(place, "row")
    found = quoted.alias("q").join(first.alias("o"), F.col("q.conv").eqNullSafe(F.col("o.conv")) & (F.col("q.digest") == F.col("o.digest")))
    earlier = F.struct("original.turn", "original.row") < F.struct("q.turn", "q.row")
    votes = found.where(earlier).groupBy("q.row", F.col("original.row").alias("parent")).agg(
        F.min("q.level").alias("level"), F.count("*").alias("passages"), F.max("original.turn").alias("turn"))
    best = F.max_by("parent", F.struct((-F.col("level")).alias("l"), "passages", "turn", "parent")).alias("parent")
    return staged(votes.groupBy("row").agg(best))


def previous(messages: DataFrame, width: int = 512) -> DataFrame:
    """(row, before): the message before each in its conversation, by turn and row.

    A long conversation is ordered in slices of `width` turns; only the last message of each slice is ordered
    over the whole conversation.
    """
    sliced = messages.select("row", "conv", "turn", F.floor(F.col("turn") / width).alias("slice"))
    within = Window.partitionBy("conv", "slice").orderBy("turn", "row")
    near = sliced.withColumn("before", F.lag("row").over(within))
    last = near.groupBy("conv", "slice").agg(F.max(F.struct("turn", "row"))["row"].alias("last"))
    border = staged(last.withColumn("entering", F.lag("last").over(Window.partitionBy("conv").orderBy("slice"))).select("conv", "slice", "entering"))
    a, b = near.alias("a"), border.alias("b")
    return a.join(b, F.col("a.conv").eqNullSafe(F.col("b.conv")) & F.col("a.slice").eqNullSafe(F.col("b.slice")), "left").select(
        "a.row", F.coalesce("a.before", "b.entering").alias("before"))


def threads(parents: DataFrame) -> DataFrame:
    """(row, root, depth) from (row, parent): ancestors by doubling, staged each round, log2 of the depth rounds.

    Parents come earlier than their children, so there are no cycles.
    """
    at = staged(parents.select("row", F.coalesce("parent", "row").alias("up"), F.col("parent").isNotNull().cast("int").alias("depth")))
    while True:
        up = at.select(F.col("row").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        after = staged(at.join(up, "up").select("row", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth")))
        moved = not at.join(after.select("row", F.col("up").alias("then")), "row").where("up <> then").isEmpty()
        discard(at)
        at = after
        if not moved:
            return at.select("row", F.col("up").alias("root"), "depth")


def conversations(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                  follow: bool = True) -> DataFrame:
    """Messages without their quotes, in reply order, one row each.

    (conv_id, turn, role, reply_to, link, thread, depth, quotes, content, chat): `reply_to` is the turn of the message
    it replies to and `link` tells how that is known: 'quote', or 'turn' for the message before it where nothing
    quoted is found (`follow`), or null. `thread` is the turn that the chain of replies begins with, `depth` its length. A
    thread ordered by (depth, turn) or by turn has every message after the one it replies to. `content` is the text
    without quoted lines, `quotes` the number of quoted passages, and `chat` the content after its role mark.

    Null texts are empty, a null role is 'unknown'. Null conversation ids are one conversation, null turns come
    first in theirs, and rows that repeat are messages of their own, in no set order. An empty table gives an empty
    result; other columns are not looked at. Only messages that hold a quote mark, and passages of others, are cut
    into lines; a conversation of any length is worked on in slices and by joins, never gathered.
    """
    rows = numbered(messages.select(
        F.col(conv_id).alias("conv"), F.coalesce(F.col(turn), F.lit(-1)).cast("long").alias("turn"), F.col(turn).alias("own_turn"),
        F.coalesce(F.col(role), F.lit("unknown")).alias("role"), text_or_empty(text).alias("text")))
    quoting = rows.where(F.col("text").rlike(r"(?m)^[ \t]*>"))
    talked = staged(quoting.select("conv").distinct())
    # Lines matter only in conversations in which somebody quotes.
    cut = staged(lines(rows.alias("r").join(talked.alias("t"), F.col("r.conv").eqNullSafe(F.col("t.conv")), "left_semi").select("row", "text")))
    parts = staged(passages(cut))
    links = quote_links(rows, parts)
    before = previous(rows)
    joined = rows.select("row").join(links, "row", "left").join(before, "row", "left").select(
        "row", F.coalesce("parent", *([F.col("before")] if follow else [])).alias("parent"),
        F.when(F.col("parent").isNotNull(), "quote").when(F.lit(follow) & F.col("before").isNotNull(), "turn").alias("link"))
    placed = staged(joined)
    tree = threads(placed)
    text_of = cut.where("level = 0").groupBy("row").agg(
        F.btrim(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", "body"))), lambda x: x["body"]), "\n"),
                F.lit(" \t\r\n")).alias("plain"))
    quotes = parts.where("level > 0").groupBy("row").agg(F.count("*").alias("quotes"))
    turns = rows.select(F.col("row").alias("at"), F.col("own_turn").alias("at_turn"))
    quoting_rows = quoting.select("row").join(text_of, "row", "left").select("row", F.coalesce("plain", F.lit("")).alias("plain"))
    out = (rows.join(placed, "row").join(tree, "row").join(quoting_rows, "row", "left").join(quotes, "row", "left")
           .join(turns.select(F.col("at").alias("parent"), F.col("at_turn").alias("reply_to")), "parent", "left")
           .join(turns.select(F.col("at").alias("root"), F.col("at_turn").alias("thread")), "root", "left"))
    content = F.coalesce("plain", "text")
    return out.select(
        F.col("conv").alias("conv_id"), F.col("own_turn").alias("turn"), "role", "reply_to", "link", "thread", "depth",
        F.coalesce("quotes", F.lit(0)).alias("quotes"), content.alias("content"),
        F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), content, F.lit("\n")).alias("chat"))
