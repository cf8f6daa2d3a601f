"""Chat formatting by prefix-target expansion, in built-in column expressions only.

A conversation becomes one transcript of marked turns. Every assistant turn then becomes an
example of its own: all turns before it are context, and only that reply is under the loss mask.

Template of a turn: ``<|start|>role<|message|>text<|end|>``. Inside roles and texts each ``<``,
n backslashes, ``|`` gets one backslash more, so no text can hold a marker, and taking one
backslash away restores it.

Defined results: turns are ordered by turn (nulls first), then role, then text, so repeated rows
all stay; null roles and texts are empty; a null conversation id is one conversation; one without
a reply has a transcript and no example; an empty table gives no rows; other columns are ignored.
A conversation is one output row, so its text has to fit one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query, read

START, MESSAGE, END = "<|start|>", "<|message|>", "<|end|>"
REPLY_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def transcripts(turns: DataFrame) -> DataFrame:
    """One row per conversation: transcript, and per reply where it starts and ends in it."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(
        F.col("conv_id"), F.col("turn"), text("role").alias("role"),
        F.concat(F.lit(START), escape(text("role")), F.lit(MESSAGE)).alias("head"), escape(text("text")).alias("body"),
    )
    packed = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "body", "head"))).alias("turns")
    )
    marked = packed.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("transcript"),
        F.aggregate(
            "turns",
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,chars:int>>").alias("replies")),
            lambda acc, t: F.struct(
                (acc["at"] + F.char_length(t["head"]) + F.char_length(t["body"]) + len(END)).alias("at"),
                F.when(
                    t["role"] == REPLY_ROLE,
                    F.concat(acc["replies"], F.array(F.struct(
                        (acc["at"] + F.char_length(t["head"])).alias("start"), F.char_length(t["body"]).alias("chars"),
                    ))),
                ).otherwise(acc["replies"]).alias("replies"),
            ),
        )["replies"].alias("replies"),
    )
    return marked


def prefix_target_examples(formatted: DataFrame) -> DataFrame:
    """One row per assistant turn: formatted text up to its end, and the loss span in that text.

    Conversations without a reply stay as one row whose example columns are null.
    """
    spread = formatted.select("*", F.posexplode_outer("replies").alias("example", "reply"))
    return spread.select(
        *[c for c in formatted.columns if c != "replies"], "example",
        F.substring("transcript", F.lit(1), F.col("reply.start") + F.col("reply.chars") + len(END)).alias("text"),
        (F.col("reply.start") + 1).alias("loss_start"), F.col("reply.chars").alias("loss_chars"),
    )


def read_turns(transcript: Column) -> Column:
    """Parse a transcript back into an array of (role, text)."""
    pieces = F.filter(F.split(transcript, r"<\|end\|>"), lambda p: p != "")
    def turn(piece: Column) -> Column:
        both = F.split(F.substring(piece, len(START) + 1, 2**31 - 1), r"<\|message\|>")
        return F.struct(unescape(both[0]).alias("role"), unescape(both[1]).alias("text"))
    return F.transform(pieces, turn)


@query("op5_chat_formatting")
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(REPLY_ROLE).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    formatted = transcripts(given.unionByName(planted)).withColumn("turns", read_turns(F.col("transcript")))
    read_back = formatted.select(
        "conv_id", "transcript", "replies", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(
            "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("transcript").cast("long").alias("formatted_chars"),
    )
    examples = prefix_target_examples(read_back).select(
        "conv_id", "n_turns", "turns_sha256", "formatted_chars", "example",
        unescape(F.expr("substring(text, loss_start, loss_chars)")).alias("reply"),
        F.char_length("text").cast("long").alias("chars"),
    )
    loss = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.when(F.col("example").isNotNull(), F.struct("example", "reply")))), lambda e: e["reply"]), "")
    return examples.groupBy("conv_id", "n_turns", "turns_sha256", "formatted_chars").agg(
        loss.alias("loss"), F.count("example").alias("n_examples"), F.coalesce(F.sum("chars"), F.lit(0)).alias("example_chars"),
    ).select(
        "conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars", "n_examples", "example_chars",
    )
