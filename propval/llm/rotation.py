"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the whole dialogue is rendered once
with that speaker as the assistant, all others as named users, and the spans
that the assistant says are masked for training.  System turns are context
of every perspective; their speakers take no perspective.

A turn is ``<|system|>``, ``<|assistant|>`` or ``<|user:NAME|>``, a line
break, its text, ``<|end|>`` and a line break.  The mask covers text and
``<|end|>`` of the assistant's turns.  ``<|`` in texts and names is written
``< |``, so no text can forge a marker.

A dialogue comes in parts of ``PART_TURNS`` turns, (conversation,
perspective, part), with offsets inside the part; the parts in order are the
dialogue.  Turns are numbered without gathering a conversation: counts of
ranges of turn numbers are summed, then turns are ranked in their range.

Defined results: turns go by number, null numbers last, then role, then text
(nulls first); repeated rows are turns of their own; a null or empty role is
the speaker ``unknown``; a null text is empty; null conversation ids are one
conversation; one with system turns alone has no perspective and no row; an
empty table gives an empty result.  Only built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART_TURNS = 64
RANGE = 64               # turn numbers of a range
SYSTEM = ("system",)
UNKNOWN = "unknown"


def _safe(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def numbered(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, position, speaker, text): positions from 0 in each conversation."""
    speaker = F.when(F.coalesce(F.col(role), F.lit("")) == "", UNKNOWN).otherwise(F.col(role))
    own = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("raw"),
                       speaker.alias("speaker"), F.coalesce(text, F.lit("")).alias("text"),
                       F.expr(f"cast(floor(`{turn}` / {RANGE}) as long)").alias("range"))
    earlier = Window.partitionBy("c").orderBy(F.col("r").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    before = (own.groupBy(F.col("conv_id").alias("c"), F.col("range").alias("r")).agg(F.count("*").alias("n"))
              .select("c", "r", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    rank = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy("turn", F.col("role").asc_nulls_first(), F.col("raw").asc_nulls_first()))
    return (own.join(before, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("range").eqNullSafe(F.col("r")))
            .select("conv_id", (F.col("before") + rank - 1).alias("position"), "speaker", "text"))


def rotate(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, perspective, part, n_turns, rendered, mask (array of start
    and end offsets in characters)."""
    rows = numbered(turns, conv_id, turn, role, text)
    is_system = F.col("speaker").isin(*SYSTEM)
    speaker = F.when(F.coalesce(F.col(role), F.lit("")) == "", UNKNOWN).otherwise(F.col(role))
    people = (turns.select(F.col(conv_id).alias("c"), speaker.alias("perspective")).where(~F.col("perspective").isin(*SYSTEM)).distinct())
    parts = (rows.groupBy("conv_id", F.expr(f"position div {PART_TURNS}").alias("part"))
             .agg(F.array_sort(F.collect_list(F.struct("position", "speaker", is_system.alias("system"), _safe(F.col("text")).alias("text")))).alias("turns")))
    each = parts.join(people, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")

    def head(t: Column) -> Column:
        return (F.when(t["system"], F.lit("<|system|>\n")).when(t["speaker"] == F.col("perspective"), F.lit("<|assistant|>\n"))
                .otherwise(F.concat(F.lit("<|user:"), _safe(t["speaker"]), F.lit("|>\n"))))

    def add(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(head(t))
        end = begin + F.length(t["text"]) + len("<|end|>")
        own = ~t["system"] & (t["speaker"] == F.col("perspective"))
        span = F.struct(begin.alias("start"), end.alias("end"))
        return F.struct((end + 1).alias("at"), F.when(own, F.concat(state["mask"], F.array(span))).otherwise(state["mask"]).alias("mask"))
    empty = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("mask"))
    rendered = F.array_join(F.transform("turns", lambda t: F.concat(head(t), t["text"], F.lit("<|end|>\n"))), "")
    return each.select("conv_id", "perspective", "part", F.size("turns").cast("long").alias("n_turns"), rendered.alias("rendered"),
                       F.aggregate("turns", empty, add, lambda s: s["mask"]).alias("mask"))


def digest(rotated: DataFrame) -> DataFrame:
    """Parts with the mask as text, start:end and ; between, and counts."""
    spans = F.array_join(F.transform("mask", lambda m: F.concat(m["start"].cast("string"), F.lit(":"), m["end"].cast("string"))), ";")
    said = F.aggregate("mask", F.lit(0).cast("long"), lambda n, m: n + m["end"] - m["start"])
    return rotated.select("conv_id", "perspective", "part", "n_turns", "rendered", spans.alias("mask"), said.alias("n_masked"))


ORACLE = f"""
WITH own AS (
  SELECT conv_id, CASE WHEN coalesce(role, '') = '' THEN '{UNKNOWN}' ELSE role END AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS body,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) - 1 AS position
  FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM own WHERE speaker <> 'system'),
turns AS (
  SELECT o.conv_id, p.perspective, o.position // {PART_TURNS} AS part, o.position, o.body,
         o.speaker <> 'system' AND o.speaker = p.perspective AS says,
         CASE WHEN o.speaker = 'system' THEN '<|system|>' || chr(10) WHEN o.speaker = p.perspective THEN '<|assistant|>' || chr(10)
              ELSE '<|user:' || replace(o.speaker, '<|', '< |') || '|>' || chr(10) END AS head
  FROM own o JOIN people p ON o.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 8) OVER (PARTITION BY conv_id, perspective, part ORDER BY position
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS begin
  FROM turns)
SELECT conv_id, perspective, CAST(part AS BIGINT) AS part, count(*) AS n_turns,
       string_agg(head || body || '<|end|>' || chr(10), '' ORDER BY position) AS rendered,
       coalesce(string_agg(CAST(CAST(begin AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(begin + length(body) + 7 AS BIGINT) AS VARCHAR), ';' ORDER BY position)
                FILTER (WHERE says), '') AS mask,
       CAST(coalesce(sum(length(body) + 7) FILTER (WHERE says), 0) AS BIGINT) AS n_masked
FROM placed GROUP BY conv_id, perspective, part
"""
