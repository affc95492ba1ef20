"""Transcript lines and sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.functions.text import SPACE
from tandem.operators.ranking import running_total


def final_transcripts(events: DataFrame) -> DataFrame:
    """Final, non-empty transcripts, trimmed; interim ones are for display only."""
    text = F.regexp_replace("text", f"^{SPACE}+|{SPACE}+$", "")
    return events.withColumn("text", text).where(F.col("is_final") & (F.col("text") != ""))


def line_index(finals: DataFrame, session: str, position: str) -> DataFrame:
    """Adds `idx`: 0, 1, 2, ... per session in order of `position`, a number or a time; a session may be of any length."""
    numbered = running_total(finals, [session], [position], "_n")
    return numbered.withColumn("idx", F.col("_n") - 1).drop("_n")


def turn_pairs(turns: DataFrame, unanswered: bool = False) -> DataFrame:
    """Each source line with the translation in the next turn; with `unanswered`, also lines without one, whose is null.

    Joined on (conversation, turn), so a long conversation is spread like many short ones.
    """
    source = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("source"))
    answer = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("translated")
    )
    return source.join(answer, ["conv_id", "turn"], "left" if unanswered else "inner")


#: What an update may give of a line.
LINE_FIELDS = ("source", "translated", "pending")


def collapse_updates(updates: DataFrame) -> DataFrame:
    """Per (session, idx): of each field, the last given value beside its `seq`. Collapsed tables collapse further, in any
    order and grouping, to the same; of values with one seq the largest stays."""
    given = [F.when(F.col(name).isNotNull(), F.struct("seq", F.col(name).alias("value"))).alias(name) for name in LINE_FIELDS]
    return merge_lines(updates.select("session", "idx", "seq", *given))


def merge_lines(collapsed: DataFrame) -> DataFrame:
    return collapsed.groupBy("session", "idx").agg(F.max("seq").alias("seq"), *(F.max(name).alias(name) for name in LINE_FIELDS))


def line_values(collapsed: DataFrame) -> DataFrame:
    return collapsed.select("session", "idx", "seq", *(F.col(f"{name}.value").alias(name) for name in LINE_FIELDS))


def latest_lines(updates: DataFrame) -> DataFrame:
    """Current state per (session, idx): of each field, the given value with the highest `seq`."""
    return line_values(collapse_updates(updates))


def answered(translated: Column, error: Column) -> Column:
    """What a line shows for an answer: the translation, or the error in its place."""
    return F.when(error.isNull(), translated).otherwise(F.concat(F.lit("Error: "), error))


def line_text(idx: Column, source: Column, translated: Column) -> Column:
    shown = F.when(F.coalesce(translated, F.lit("")) == "", "...").otherwise(translated)
    return F.concat(F.lit("["), (idx + 1).cast("string"), F.lit("] "), source, F.lit("\n  \u2192 "), shown)


def transcript_export(lines: DataFrame, page_lines: int = 1000) -> DataFrame:
    """Readable transcript per session in pages: (session, page, lines, text).

    Lines are separated by a blank line, and so are the pages when put together in order. A page has
    a fixed number of lines, so no session has to fit into one row.
    """
    entry = F.struct("idx", line_text(F.col("idx"), F.col("source"), F.col("translated")).alias("text"))
    ordered = F.array_sort(F.collect_list(entry))
    return lines.groupBy("session", F.floor(F.col("idx") / page_lines).alias("page")).agg(
        F.count("*").alias("lines"),
        F.array_join(F.transform(ordered, lambda e: e["text"]), "\n\n").alias("text"),
    )


def session_summary(events: DataFrame, user: str, ts: str, gap_seconds: int = 1800, block: str = "hour") -> DataFrame:
    """Sessions per user: a pause of at least the gap starts a new one.

    First sessions within (user, block of time), then only the first and last of each block are
    compared over the whole user, since those alone can continue across blocks. A user with a large
    share of all events is thus spread over the blocks.
    """
    gap = gap_seconds * 1_000_000
    rows = events.select(F.col(user).alias("user"), F.unix_micros(F.col(ts).cast("timestamp")).alias("at"))
    rows = rows.withColumn("block", F.date_trunc(block, F.timestamp_micros("at")))
    in_block = Window.partitionBy("user", "block").orderBy("at")
    starts = F.coalesce(F.col("at") - F.lag("at").over(in_block) >= gap, F.lit(True)).cast("int")
    whole_block = Window.partitionBy("user", "block")
    fragments = (
        rows.withColumn("starts", starts)
        .withColumn("no", F.sum("starts").over(in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("user", "block", "no")
        .agg(F.min("at").alias("start"), F.max("at").alias("end"), F.count("*").alias("events"))
        .withColumn("edge", (F.col("no") == 1) | (F.col("no") == F.max("no").over(whole_block)))
    )
    over_blocks = Window.partitionBy("user").orderBy("start")
    continues = F.coalesce(F.col("start") - F.lag("end").over(over_blocks) < gap, F.lit(False))
    edges = (
        fragments.where("edge")
        .withColumn("opens", (~continues).cast("int"))
        .withColumn("session", F.sum("opens").over(over_blocks.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("user", "session")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("events").alias("events"))
    )
    columns = ["user", "start", "end", "events"]
    return (
        fragments.where(~F.col("edge"))
        .select(*columns)
        .unionByName(edges.select(*columns))
        .select(
            "user",
            F.timestamp_micros("start").alias("start"),
            F.timestamp_micros("end").alias("end"),
            "events",
            ((F.col("end") - F.col("start")) / 1_000_000).alias("seconds"),
        )
    )
