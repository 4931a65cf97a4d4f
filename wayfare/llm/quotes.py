"""Operator 7: chat formatting by quotation linking (DataFrame functions only).

A line's quote level is the number of ``>`` marks it starts with. Lines of one level that
follow each other are a passage. Passages, and their single lines, are normalised (lower
case, white space collapsed) and hashed with SHA-256. A quoted passage is joined to the
first message of its conversation whose own words hold it, at every level; the message
that replies takes as its parent the earlier message that most of its passages of one
level come from (ties: the later one), at the lowest level with an earlier original.
``quotation_links`` gives the links of all levels. Parents form threads. Each message is returned without its quotes, with its
thread, depth and the text of a chat turn; (conv_id, thread_turn, depth, turn) is the
reply order, in which no message precedes its parent.

A hot conversation or passage is never gathered: originals are a grouped minimum for each
(conversation, hash), and only links between messages are followed, by pointer doubling.

Defined results: a null text is empty; a message of quotes alone has an empty text; null
conv_id, turn or role are values like others but link with nothing when conv_id or turn is
null. Rows that repeat (conv_id, turn) with other texts are messages of their own that
share links; equal rows are each returned. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.shared import Scratch

# Quote marks and blanks up to the last mark: one class without a repeated group, which the
# JVM would match by recursion, a frame for each mark.
PREFIX = r"^[ \t>]*>[ \t]?"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def message_lines(messages: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, line, level, body) of every line of (keys, text)."""
    lines = messages.select(*keys, F.posexplode(F.split("text", "\n", -1)).alias("line", "raw"))
    prefix = F.regexp_extract("raw", PREFIX, 0)
    return lines.select(*keys, "line", F.length(F.regexp_replace(prefix, "[^>]", "")).alias("level"),
                        F.regexp_replace("raw", PREFIX, "").alias("body"))


def passages(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, first_line, level, passage): runs of consecutive lines of one level."""
    order = Window.partitionBy(*keys).orderBy("line")
    starts = (F.col("level") != F.lag("level", 1, -1).over(order)).cast("int")
    runs = lines.withColumn("new", starts).withColumn("run", F.sum("new").over(order))
    return runs.groupBy(*keys, "run", "level").agg(
        F.min("line").alias("first_line"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", "body"))), lambda x: x["body"]), "\n")
        .alias("passage")).drop("run")


def _hashes(found: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, hash, size): each text and its lines, normalised; empty ones are left out."""
    parts = F.array_distinct(F.concat(F.array(F.col(text)), F.split(text, "\n", -1)))
    return (found.select(*keys, F.explode(parts).alias("part")).select(*keys, normalised(F.col("part")).alias("part"))
            .filter("part != ''")
            .select(*keys, F.sha2("part", 256).alias("hash"), F.length("part").cast("long").alias("size")))


def _threads(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, turn, thread_turn, depth) from (conv_id, turn, parent), by doubling."""
    state = scratch.write(links.select("conv_id", "turn", F.col("parent").alias("thread_turn"),
                                       F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        up = state.select("conv_id", F.col("turn").alias("thread_turn"), F.col("thread_turn").alias("_next"),
                          F.col("depth").alias("_more"))
        joined = state.join(up, ["conv_id", "thread_turn"], "left")
        following = scratch.write(joined.select(
            "conv_id", "turn", F.coalesce("_next", "thread_turn").alias("thread_turn"),
            (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"),
            F.col("_next").isNotNull().alias("_moved")), "threads")
        moved = not following.filter("_moved").isEmpty()
        state = following.drop("_moved")
        if not moved:
            return state


def _linked(messages: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of ``messages`` with ``mid``, their quoters' clean texts, and the links
    (conv_id, turn, mid, level, hash, size, parent) of quoted passages of every level."""
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           "role", F.coalesce("text", F.lit("")).alias("text"))
    quoting = F.col("text").rlike(r"(?m)^[ \t]*>")
    keys = ["conv_id", "turn", "mid"]
    marked = rows.withColumn("mid", F.sha2("text", 256))
    quoters = marked.filter(quoting).select(*keys, "text").dropDuplicates(keys)
    parts = scratch.write(passages(message_lines(quoters, keys), keys), "passages")
    quoted = parts.filter("level > 0")
    per_message = parts.groupBy(*keys).agg(
        F.max("level").alias("quote_level"), F.sum((F.col("level") > 0).cast("long")).alias("n_quotes"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("level") == 0, F.struct(
            "first_line", "passage")))), lambda x: x["passage"]), "\n").alias("own"))
    clean = scratch.write(per_message, "clean")
    # Where each passage was first written: unquoted words only. Only conversations that
    # quote are looked at.
    wanted = scratch.write(_hashes(quoted, [*keys, "level"], "passage")
                           .filter("conv_id IS NOT NULL AND turn IS NOT NULL")
                           .groupBy(*keys, "level", "hash").agg(F.max("size").alias("size")), "quoted")
    plain = (marked.filter(~quoting).select("conv_id", "turn", "text")
             .unionByName(clean.select("conv_id", "turn", F.col("own").alias("text")))
             .filter("conv_id IS NOT NULL AND turn IS NOT NULL")
             .join(wanted.select("conv_id").distinct(), "conv_id", "left_semi"))
    firsts = scratch.write(_hashes(plain, ["conv_id", "turn"], "text").groupBy("conv_id", "hash")
                           .agg(F.min("turn").alias("parent")), "originals")
    found = scratch.write(wanted.join(firsts, ["conv_id", "hash"]).filter("parent < turn")
                          .select(*keys, "level", "hash", "size", "parent"), "found")
    return marked, clean, found


def quotation_links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, hash, size, parent): each normalised passage or line that a
    message of ``messages`` quotes at any level, with the first message that wrote it."""
    _, _, found = _linked(messages, Scratch(messages.sparkSession, "quotes"))
    return found.drop("mid").distinct()


def link_quotations(messages: DataFrame) -> DataFrame:
    """Each row of ``messages`` (conv_id, turn, role, text) with reply_to, thread_turn,
    depth, quote_level (the deepest), n_quotes (quoted passages), text without quotes and
    formatted (the chat turn)."""
    scratch = Scratch(messages.sparkSession, "quotes")
    marked, clean, found = _linked(messages, scratch)
    links = scratch.write(
        found.groupBy("conv_id", "turn", "level", "parent").agg(F.sum("size").alias("size"))
        .groupBy("conv_id", "turn").agg(F.max(F.struct(-F.col("level"), "size", "parent")).alias("best"))
        .select("conv_id", "turn", F.col("best.parent").alias("parent")), "links")
    threads = _threads(links, scratch)
    replies = scratch.write(links.join(threads, ["conv_id", "turn"]), "replies")
    scratch.keep_only(clean, replies)
    text = F.when(F.col("n_quotes").isNotNull(), F.col("own")).otherwise(F.col("text"))
    return (marked.join(clean.withColumnsRenamed({"conv_id": "_c", "turn": "_t"}),
                        F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t"))
                        & (marked["mid"] == clean["mid"]), "left").drop("_c", "_t", "mid")
            .join(replies, ["conv_id", "turn"], "left")
            .select("conv_id", "turn", "role", F.col("parent").alias("reply_to"),
                    F.coalesce("thread_turn", "turn").alias("thread_turn"),
                    F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
                    F.coalesce("quote_level", F.lit(0)).cast("long").alias("quote_level"),
                    F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"), text.alias("text"),
                    F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), text, F.lit("\n"))
                    .alias("formatted")))


def chat_query(conversations: DataFrame) -> DataFrame:
    """Query ``op7_quotation_linking``."""
    return link_quotations(conversations)
