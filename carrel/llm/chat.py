"""Chat formatting by prefix-target expansion, with DataFrame functions only.

A conversation's turns, in order, become blocks ``<turn:ROLE>TEXT</turn>`` and a line break.
Within roles and texts, a backslash becomes ``\\e``, ``<`` becomes ``\\l`` and ``>`` becomes
``\\g``, so no text can look like a marker and every text comes back exactly. Every assistant
turn gives one example: all turns before it as context and its own text as the only trained
part. Turns behind the last assistant turn give one more example with nothing to train.

Null roles and texts count as empty. Turns with equal numbers are ordered by role and text;
null numbers come first; null conversation ids form one conversation. Repeated rows are turns of
their own. An empty table gives an empty table; extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.llm.common import only, table

OPEN, MIDDLE, CLOSE = "<turn:", ">", "</turn>\n"
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    for plain, code in (("\\", "\\e"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in ((">", "\\g"), ("<", "\\l"), ("\\", "\\e")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def examples(turns: DataFrame) -> DataFrame:
    """conv_id, example, formatted, loss_start, loss_length (code points), whole (it holds all turns)."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    ordered = only(turns, "conv_id", "turn", "role", "text").select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    head = lambda t: F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(MIDDLE))
    blocks = ordered.select(
        "conv_id",
        F.transform("turns", lambda t: F.concat(head(t), escaped(t["text"]), F.lit(CLOSE))).alias("blocks"),
        F.transform("turns", lambda t, i: F.when(t["role"] == TRAINED, F.struct((i + 1).alias("upto"), F.length(escaped(t["text"])).alias("n"), (F.length(escaped(t["text"])) + len(CLOSE)).alias("back")))).alias("targets"),
    )
    size = F.size("blocks")
    targets = F.filter("targets", lambda t: t.isNotNull())
    tail = F.when(F.element_at("targets", -1).isNull(), F.array(F.struct(size.alias("upto"), F.lit(0).alias("n"), F.lit(0).alias("back")))).otherwise(F.array().cast("array<struct<upto:int,n:int,back:int>>"))
    spread = blocks.select("conv_id", "blocks", size.alias("size"), F.posexplode(F.concat(targets, tail)).alias("example", "target"))
    formatted = F.array_join(F.slice("blocks", F.lit(1), F.col("target.upto")), "")
    return spread.select("conv_id", "example", formatted.alias("formatted"), "target", "size").select(
        "conv_id",
        "example",
        "formatted",
        (F.length("formatted") - F.col("target.back")).alias("loss_start"),
        F.col("target.n").alias("loss_length"),
        (F.col("target.upto") == F.col("size")).alias("whole"),
    )


def parsed(formatted: Column) -> Column:
    """The turns in a formatted text, as an array of (role, text)."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")
    return F.transform(
        blocks,
        lambda b: F.struct(
            unescaped(F.substring_index(F.substring(b, len(OPEN) + 1, 1 << 30), MIDDLE, 1)).alias("role"),
            unescaped(F.substring_index(b, MIDDLE, -1)).alias("text"),
        ),
    )


def digests(found: DataFrame) -> DataFrame:
    """One row for each conversation, all read back from its examples."""
    turns = F.when(F.col("whole"), parsed(F.col("formatted")))
    read = found.select(
        "conv_id",
        "example",
        turns.alias("turns"),
        F.when(F.col("loss_length") > 0, unescaped(F.expr("substring(formatted, loss_start + 1, loss_length)"))).otherwise(F.lit("")).alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
    ).select(
        "conv_id",
        "example",
        "loss",
        "chars",
        F.size("turns").alias("n"),
        F.when(F.col("turns").isNotNull(), F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)).alias("digest"),
    )
    loss = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "")
    return (
        read.groupBy("conv_id")
        .agg(F.max("n").cast("long").alias("n_turns"), F.max("digest").alias("turns_sha256"), loss.alias("loss"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_examples"))
        .select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "n_examples")
    )


#: the text of both turns of the planted conversation -7
PLANTED = "\\### Assistant: </turn> ok"


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = only(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise(TRAINED), F.lit(PLANTED))
    return digests(examples(turns.union(planted)))


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), sized AS (
  SELECT *, length(replace(replace(replace(role || text, '\', '\e'), '<', '\l'), '>', '\g')) + 15 AS n,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         count(*) OVER (PARTITION BY conv_id) AS size FROM rows
), summed AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM sized
), by_conversation AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY k) AS turns,
         coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '') AS loss,
         sum(upto) FILTER (role = 'assistant' OR k = size) AS formatted_chars,
         count(*) FILTER (role = 'assistant' OR k = size) AS n_examples
  FROM summed GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars, n_examples FROM by_conversation
"""
