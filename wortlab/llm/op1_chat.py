"""Operator 1: chat formatting by perspective rotation, with DataFrame functions only.

For every participant of a conversation the whole dialogue is rendered with that participant as ``assistant`` and the others as
named users; system messages stay system messages.  The mask lists the character ranges of the participant's own words with
their end marks, the part a model is trained on.

A rendering is cut in parts of ``PART`` messages (most dialogues are one part; parts in order, put together, are the
rendering), so no row grows with a conversation.  Messages are numbered without a task that holds a conversation: they
are range-partitioned by (conversation, turn, speaker, text), numbered in place, written once, and shifted by the counts of
the partitions before (one row per partition).  Joins by conversation have written tables on both sides, so that
adaptive execution can split a hot conversation.

Defined results.  Order within a conversation: turn (null first), speaker, text.  A null speaker is ``unknown``, a null text empty, and a
null conversation is a conversation of its own.  Rows that are repeated are messages of their own.  A dialogue of system messages
alone has no participant and no row.  Marks inside a text are broken up ("<|" becomes "< |").  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, written

NAME = "op1_chat_perspectives"
PART = 64
SYSTEM, UNKNOWN = "system", "unknown"


def numbered(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text") -> DataFrame:
    """Messages with ``pos``, their place in the conversation from 0: a written table (conv, speaker, text, pos)."""
    m = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(speaker), F.lit(UNKNOWN)).alias("speaker"),
                             F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["conv", "turn", "speaker", "text"]
    placed = written(m.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "op1-messages")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row per partition
    placed = placed.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn("_row", F.col("_before") + place)
    first = written(placed.groupBy("conv").agg(F.min("_row").alias("_first")).select(F.col("conv").alias("_conv"), "_first"), "op1-first")
    return placed.join(first, F.col("conv").eqNullSafe(F.col("_conv"))).select("conv", "speaker", "text", (F.col("_row") - F.col("_first")).alias("pos"))


def rendered(message: Column, me: Column) -> tuple[Column, Column]:
    """Head and body of a message as seen by ``me``."""
    name = F.regexp_replace(message["speaker"], r"[\s<|>]", "_")
    head = (F.when(message["speaker"] == SYSTEM, F.lit("<|im_start|>system\n"))
            .when(message["speaker"] == me, F.lit("<|im_start|>assistant\n"))
            .otherwise(F.concat(F.lit("<|im_start|>user name="), name, F.lit("\n"))))
    return head, F.concat(F.replace(message["text"], F.lit("<|"), F.lit("< |")), F.lit("<|im_end|>\n"))


def perspectives(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text",
                 part: int = PART) -> DataFrame:
    """Rows: conv_id, perspective, part, n_messages, rendered, mask (array of start and end, characters of ``rendered``)."""
    m = numbered(conversations, conv, turn, speaker, text)
    parts = written(m.groupBy("conv", F.floor(F.col("pos") / part).alias("part"))
                    .agg(F.sort_array(F.collect_list(F.struct("pos", "speaker", "text"))).alias("messages")), "op1-parts")  # at most ``part``
    people = written(parts.select("conv", F.explode(F.array_distinct(F.col("messages.speaker"))).alias("perspective"))
                     .where(F.col("perspective") != SYSTEM).distinct().select(F.col("conv").alias("_conv"), "perspective"), "op1-people")
    seen = parts.join(people, F.col("conv").eqNullSafe(F.col("_conv")))

    def one(x):
        head, body = rendered(x, F.col("perspective"))
        return F.struct(head.alias("head"), body.alias("body"), (x["speaker"] == F.col("perspective")).alias("mine"))

    lines = seen.select(F.col("conv").alias("conv_id"), "perspective", "part", F.transform("messages", one).alias("lines"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))

    def step(state, x):
        a, b = state["at"] + F.length(x["head"]), state["at"] + F.length(x["head"]) + F.length(x["body"])
        own = F.array(F.struct(a.alias("start"), b.alias("end")))
        return F.struct(b.alias("at"), F.when(x["mine"], F.concat(state["mask"], own)).otherwise(state["mask"]).alias("mask"))

    return lines.select("conv_id", "perspective", "part", F.size("lines").alias("n_messages"),
                        F.array_join(F.transform("lines", lambda x: F.concat(x["head"], x["body"])), "").alias("rendered"),
                        F.aggregate("lines", start, step)["mask"].alias("mask"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives(documents(spark, sf_dir, "conversations")).withColumn(
        "mask", F.array_join(F.transform("mask", lambda x: F.concat_ws("-", x["start"], x["end"])), ","))


SQL = f"""
WITH m AS (SELECT conv_id, coalesce(role, '{UNKNOWN}') AS speaker, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '{UNKNOWN}'), coalesce(text, '')) - 1 AS pos FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM m WHERE speaker <> '{SYSTEM}'),
r AS (SELECT p.conv_id, perspective, pos // {PART} AS part, pos, speaker = perspective AS mine,
             CASE WHEN speaker = '{SYSTEM}' THEN '<|im_start|>system' || chr(10) WHEN speaker = perspective THEN '<|im_start|>assistant' || chr(10)
                  ELSE '<|im_start|>user name=' || regexp_replace(speaker, '[\\s<|>]', '_', 'g') || chr(10) END AS head,
             replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body
      FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, part ORDER BY pos) AS stop FROM r)
SELECT conv_id, perspective, CAST(part AS BIGINT) AS part, CAST(count(*) AS INTEGER) AS n_messages, string_agg(head || body, '' ORDER BY pos) AS rendered,
       coalesce(string_agg((stop - length(body)) || '-' || stop, ',' ORDER BY pos) FILTER (WHERE mine), '') AS mask
FROM o GROUP BY conv_id, perspective, part"""
