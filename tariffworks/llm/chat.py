"""Multi-party chat formatting by perspective rotation.

For every participant of a conversation the whole dialogue is rendered with that speaker as the
assistant and all others as named users; the assistant's own words are marked as what is learnt.
System turns are context for everyone and no perspective.

A dialogue is rendered in parts of 64 turn numbers with the offset of each, so that a conversation
with a share of all turns is many rows, not one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = 64
CONTEXT = "system"
UNNAMED = "unknown"
END = "<|end|>"


def escaped(text: Column) -> Column:
    """Text in which no mark can start: one bar more after each `<|`."""
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def rotate(turns: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, speaker, part, n_turns, start, text, mask of turns (conv_id, turn, role, text).

    start is the code point of the dialogue at which the part starts; mask lists start:end (code
    points of the part, end exclusive) of what is learnt, comma-joined.  Turns are in the order of
    turn, role and text; a null turn comes first, in part -1.  A null role is a speaker named
    unknown, a null text is empty.  Repeated rows are rendered each.  A conversation with system
    turns only has no perspective.  A null conv_id is a conversation.  Extra columns are ignored.
    """
    said = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(UNNAMED)).alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("body"),
        F.coalesce(F.floor(F.col("turn") / part), F.lit(-1)).cast("long").alias("part"))
    viewers = said.where(F.col("role") != CONTEXT).select(F.col("conv_id").alias("viewed"), F.col("role").alias("speaker")).distinct()
    seen = said.join(viewers, F.col("conv_id").eqNullSafe(F.col("viewed")))
    own = F.col("role") == F.col("speaker")
    header = (
        F.when(own, F.lit("<|assistant|>\n"))
        .when(F.col("role") == CONTEXT, F.lit("<|system|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), escaped(F.col("role")), F.lit("|>\n")))
    )
    turn = F.struct("turn", "role", "body", header.alias("header"), own.alias("own"))
    parts = seen.groupBy("conv_id", "speaker", "part").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def step(acc: Column, t: Column) -> Column:
        text = F.concat(t["header"], t["body"], F.lit(END + "\n"))
        start = acc["at"] + F.length(t["header"])
        mark = F.concat(start.cast("string"), F.lit(":"), (start + F.length(t["body"]) + len(END)).cast("string"))
        return F.struct((acc["at"] + F.length(text)).alias("at"), F.array_append(acc["text"], text).alias("text"),
                        F.when(t["own"], F.array_append(acc["mask"], mark)).otherwise(acc["mask"]).alias("mask"))

    none = F.expr("cast(array() as array<string>)")
    zero = F.struct(F.lit(0).alias("at"), none.alias("text"), none.alias("mask"))
    rendered = parts.select("conv_id", "speaker", "part", F.size("turns").cast("long").alias("n_turns"),
                            F.aggregate("turns", zero, step).alias("whole"))
    before = Window.partitionBy("conv_id", "speaker").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return rendered.select(
        "conv_id", "speaker", "part", "n_turns",
        F.coalesce(F.sum("whole.at").over(before), F.lit(0)).cast("long").alias("start"),
        F.array_join("whole.text", "").alias("text"), F.array_join("whole.mask", ",").alias("mask"))


#: The same in DuckDB.
ROTATE_SQL = """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '<||') AS body,
           coalesce(CAST(floor(turn / 64.0) AS BIGINT), -1) AS part
    FROM conversations),
viewers AS (SELECT DISTINCT conv_id AS viewed, role AS speaker FROM said WHERE role <> 'system'),
seen AS (
    SELECT said.*, speaker, role = speaker AS own,
           CASE WHEN role = speaker THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>'
                ELSE '<|user name=' || replace(role, '<|', '<||') || '|>' END || chr(10) AS header
    FROM said JOIN viewers ON conv_id IS NOT DISTINCT FROM viewed),
placed AS (
    SELECT *, header || body || '<|end|>' || chr(10) AS written,
           coalesce(sum(length(header) + length(body) + 8) OVER (
               PARTITION BY conv_id, speaker, part ORDER BY turn NULLS FIRST, role, body
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(header) AS learnt
    FROM seen),
parts AS (
    SELECT conv_id, speaker, part, count(*) AS n_turns,
           string_agg(written, '' ORDER BY turn NULLS FIRST, role, body) AS text,
           coalesce(string_agg(CASE WHEN own THEN CAST(CAST(learnt AS BIGINT) AS VARCHAR) || ':' ||
                CAST(CAST(learnt + length(body) + 7 AS BIGINT) AS VARCHAR) END, ',' ORDER BY turn NULLS FIRST, role, body), '') AS mask
    FROM placed GROUP BY conv_id, speaker, part)
SELECT conv_id, speaker, part, n_turns,
       CAST(coalesce(sum(length(text)) OVER (PARTITION BY conv_id, speaker ORDER BY part
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start, text, mask
FROM parts
"""
