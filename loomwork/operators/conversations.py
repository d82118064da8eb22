"""Message rows ``(conv_id, turn, role, text)`` to training turns.

The natural unit at scale is the pair row ``(conv_id, t, query, response)``.
``encode.encode_conversations`` brings a conversation onto one row only after its cut;
``assemble_conversations`` does it with the whole texts, for tables that are wanted nested. Unless a conversation
is hot, every step here runs on one shuffle by conversation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.operators import blocks

MESSAGE_BLOCK = 8192


def pair_rows(messages: DataFrame, key: str, width: int, hot_rows: int) -> DataFrame:
    """Pairs with what the encoder needs: ``key, turn, t, query, response, system, is_last``.

    ``system`` is the first system message of the conversation; only its first pair carries it.
    ``_block`` is kept when there are hot conversations.
    """
    rows = blocks.add_blocks(messages.select(key, "turn", "role", "text"), [key], F.col("turn"), width, hot_rows)
    whole = blocks.in_block(rows, [key]).orderBy("turn").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    said = F.first(F.when(F.col("role") == "system", F.col("text")), ignorenulls=True).over(whole)
    paired = blocks.next_row(rows.withColumn("system", said), [key], "turn", ["role", "text"], "_next")
    pairs = (
        paired.filter((F.col("role") == "user") & (F.col("_next.role") == "assistant"))
        .withColumn("query", F.col("text")).withColumn("response", F.col("_next.text"))
        .drop("role", "text", "_next")
    )
    numbered = blocks.row_index(pairs, [key], ["turn"], "t").withColumn("system", F.when(F.col("t") == 0, F.col("system")))
    if blocks.has_blocks(rows):
        # A hot conversation may have its system message in another block. Joining by number as
        # well spreads its pairs over all tasks.
        hot = system_texts(blocks.hot_part(rows), key).withColumnRenamed("system", "_hot_system")
        numbered = (
            numbered.join(hot.withColumn("t", F.lit(0).cast("bigint")), [key, "t"], "left")
            .withColumn("system", F.coalesce("_hot_system", "system")).drop("_hot_system")
        )
    return blocks.next_row(numbered, [key], "turn", ["t"], "_following") \
        .withColumn("is_last", F.col("_following").isNull()).drop("_following")


def pair_turns(messages: DataFrame, key: str = "conv_id", width: int = MESSAGE_BLOCK,
               hot_rows: int = blocks.HOT_ROWS) -> DataFrame:
    """A user message and the assistant message directly after it, numbered ``t`` from 0.

    Output ``(key, t, query, response, system)``; the system text is on the first pair only. A user
    message with no answer yields no pair.
    """
    return pair_rows(messages, key, width, hot_rows).select(key, "t", "query", "response", "system")


def system_texts(messages: DataFrame, key: str = "conv_id") -> DataFrame:
    """First system message of each conversation that has one."""
    return (
        messages.filter(F.col("role") == "system")
        .groupBy(key).agg(F.min_by("text", "turn").alias("system"))
    )


def assemble_conversations(messages: DataFrame, key: str = "conv_id", width: int = MESSAGE_BLOCK,
                           hot_rows: int = blocks.HOT_ROWS) -> DataFrame:
    """One row per conversation: ``system, history, query, response``, ready for the nested encoder.

    The last pair is ``query, response``; the earlier ones are ``history``. A nested row is as large as its
    conversation, by definition; where that may not fit a task, encode the message rows instead.
    """
    pairs = pair_rows(messages, key, width, hot_rows)
    nested = pairs.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("t", "query", "response"))).alias("_pairs"),
        F.max("system").alias("system"))
    turns = nested.withColumn("_turns", F.transform("_pairs", lambda p: F.struct(p["query"], p["response"])))
    return turns.select(
        key, "system",
        F.slice("_turns", F.lit(1), F.size("_turns") - 1).alias("history"),
        F.element_at("_turns", -1)["query"].alias("query"),
        F.element_at("_turns", -1)["response"].alias("response"),
    )
