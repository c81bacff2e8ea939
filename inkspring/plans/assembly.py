"""Utterance assembly: the flagship plan, from raw turns to ordered utterances."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspring.functions.text import squeeze
from inkspring.registry import query, table


@query(
    "A1_utterance_assembly",
    oracle=r"""
    WITH t AS (
      SELECT conv_id, turn, role, trim(regexp_replace(text, '[\s\x{00A0}]+', ' ', 'g'), ' ') AS text FROM conversations
    ), k AS (SELECT * FROM t WHERE text <> '')
    SELECT conv_id, count(*) AS n_turns, string_agg(text, ' ' ORDER BY turn, role, text) AS text,
           min(turn) AS first_turn, arg_min(role, (turn, role, text)) AS first_role
    FROM k GROUP BY conv_id
    """,
)
def utterance_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation, white space normalised and blanks excluded, joined in reading order."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", squeeze("text").alias("text")).where("text <> ''")
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return turns.groupBy("conv_id").agg(ordered.alias("rows")).select(
        "conv_id",
        F.size("rows").cast("long").alias("n_turns"),
        F.array_join(F.transform("rows", lambda r: r["text"]), " ").alias("text"),
        F.col("rows")[0]["turn"].alias("first_turn"),
        F.col("rows")[0]["role"].alias("first_role"),
    )
