"""Chat formatting: a dialogue from the perspective of each of its participants.

For every participant the dialogue is rendered with that speaker as the assistant,
system turns as system turns and everybody else as a named user; only what the
speaker says, and the mark that ends it, is trained on. The result has a row per
turn and perspective: the rendered segment, where it starts in the rendered
dialogue, and which part of that is trained on, in code points. The segments of a
perspective by ``position`` are the dialogue; no conversation is ever gathered,
since one may hold a third of all turns. Turns are dealt out by blocks of a
conversation, whose places come from narrow sums; texts are shuffled once.

Turns stand in order of ``turn``, missing ones first, ties by role and text;
repeated rows are turns of their own. A missing text is empty, a missing role the
speaker ``unknown``. ``<|`` inside texts and roles becomes ``< |``, so that nobody
can write marks. A missing ``conv_id`` is a conversation of its own. A
conversation with system turns alone has no perspective, an empty table no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURNS = 64
SYSTEM = "system"
END = "<|end|>\n"


def header(role: Column, speaker: Column) -> Column:
    """What a turn of ``role`` begins with, seen by ``speaker``."""
    other = F.concat(F.lit("<|user name="), role, F.lit("|>\n"))
    return F.when(role == SYSTEM, "<|system|>\n").when(role == speaker, "<|assistant|>\n").otherwise(other)


def _plain(column: Column, missing: str) -> Column:
    return F.replace(F.coalesce(column.cast("string"), F.lit(missing)), F.lit("<|"), F.lit("< |"))


def perspectives(turns: DataFrame, size: int = TURNS) -> DataFrame:
    """One row per turn and participant."""
    number = turns["turn"].cast("long")
    rows = turns.select(
        turns["conv_id"].cast("long").alias("conv_id"),
        number.alias("turn"),
        _plain(turns["role"], "unknown").alias("role"),
        _plain(turns["text"], "").alias("text"),
        F.coalesce(F.floor(number / size), F.lit(-(1 << 62))).alias("block"),
    )
    per_role = rows.groupBy("conv_id", "block", "role").agg(F.sum(F.char_length("text")).alias("chars"), F.count(F.lit(1)).alias("n"))
    speakers = rows.filter(F.col("role") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("role").alias("speaker")).distinct()
    chars = F.col("chars") + F.col("n") * (F.char_length(header(F.col("role"), F.col("speaker"))) + len(END))
    earlier = Window.partitionBy("c", "speaker").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        per_role.join(speakers, F.col("conv_id").eqNullSafe(F.col("c")))
        .groupBy("c", F.col("block").alias("b"), "speaker")
        .agg(F.sum(chars).alias("chars"), F.sum("n").alias("n"))
        .select(
            "c",
            "b",
            "speaker",
            F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars_before"),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("turns_before"),
        )
    )
    order = Window.partitionBy("conv_id", "block", "speaker").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    head = header(F.col("role"), F.col("speaker"))
    before = F.coalesce(F.sum("n_chars").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own, start = F.col("role") == F.col("speaker"), F.col("start")
    return (
        rows.join(blocks, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
        .withColumn("segment", F.concat(head, "text", F.lit(END)))
        .withColumn("n_chars", F.char_length("segment").cast("long"))
        .withColumn("position", F.col("turns_before") + F.row_number().over(order) - 1)
        .withColumn("start", F.col("chars_before") + before)
        .select(
            "conv_id",
            "speaker",
            "position",
            "turn",
            F.when(F.col("role") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user").alias("rendered_role"),
            "segment",
            "start",
            "n_chars",
            F.when(own, start + F.char_length(head)).alias("train_start"),
            F.when(own, start + F.col("n_chars")).alias("train_end"),
        )
    )


SQL = """
    WITH t AS (
        SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS role,
               replace(coalesce(text, ''), '<|', '< |') AS text
        FROM conversations
    ),
    s AS (SELECT DISTINCT conv_id AS c, role AS speaker FROM t WHERE role <> 'system'),
    h AS (
        SELECT t.conv_id, speaker, turn, role, text,
               CASE WHEN role = 'system' THEN '<|system|>' || chr(10)
                    WHEN role = speaker THEN '<|assistant|>' || chr(10)
                    ELSE '<|user name=' || role || '|>' || chr(10) END AS head
        FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.c
    ),
    r AS (SELECT *, head || text || '<|end|>' || chr(10) AS segment FROM h),
    p AS (
        SELECT *, row_number() OVER w - 1 AS position,
               CAST(coalesce(sum(length(segment)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
        FROM r WINDOW w AS (PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, role, text)
    )
    SELECT conv_id, speaker, position, turn,
           CASE WHEN role = 'system' THEN 'system' WHEN role = speaker THEN 'assistant' ELSE 'user' END AS rendered_role,
           segment, start, CAST(length(segment) AS BIGINT) AS n_chars,
           CASE WHEN role = speaker THEN start + length(head) END AS train_start,
           CASE WHEN role = speaker THEN start + length(segment) END AS train_end
    FROM p
"""
