"""Multi-party chat formatting with perspective rotation.

For every participant of a conversation the whole dialogue is rendered once
with that participant as the assistant and everybody else as a named user;
the loss mask covers exactly the assistant's own words.  A ``system`` turn
is context, not a participant.  The result is long: one row per perspective
and turn, in order, with its character range in the rendered dialogue, so a
conversation of any length is a matter of more rows and never of one value.

Character positions are running sums over a conversation.  They are taken in
two levels, inside runs of ``RUN`` turn numbers and then over the runs'
totals, so a conversation that holds a large share of all turns is spread
over many tasks.

Edge cases: a null text renders as empty; a null role is the participant
``unknown``; a null turn sorts first; equal turn numbers are ordered by role
and text, repeated rows are each rendered; a null conv_id is a conversation
of its own; a conversation of ``system`` turns alone has no participant and
gives no rows, like an empty table; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table

RUN = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"




def perspectives(turns: DataFrame, run: int = RUN) -> DataFrame:
    """conv_id, perspective, seq, turn, speaker, chat_role, rendered,
    char_start, mask_start, mask_end (equal: nothing to learn)."""
    base = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # runs of turn numbers: the unit that one task orders
    base = base.withColumn("run", F.floor(F.coalesce("turn", F.lit(-1)) / run))
    who = base.filter("speaker <> 'system'").groupBy("conv_id", "speaker").agg(F.lit(1).alias("one")) \
        .groupBy("conv_id").agg(F.collect_set("speaker").alias("who"))
    all_turns = base.join(who, base.conv_id.eqNullSafe(who.conv_id), "left").drop(who.conv_id)
    seen = all_turns.select("conv_id", "turn", "speaker", "text", "run", F.explode("who").alias("perspective"))
    own = F.col("speaker") == F.col("perspective")
    head = F.when(F.col("speaker") == "system", F.lit("system")) \
        .when(own, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), "speaker"))
    seen = seen.withColumn("head", F.concat(F.lit(OPEN), head, F.lit("\n"))) \
        .withColumn("n", F.length("head") + F.length("text") + F.lit(len(CLOSE)))
    key = ["conv_id", "perspective"]
    inside = W.partitionBy(*key, "run").orderBy(F.col("turn").asc_nulls_first(), "speaker", "text")
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    seen = seen.withColumn("seq_in", F.row_number().over(inside)) \
        .withColumn("at_in", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # one row per run of 256 turn numbers: the second level of the running sum
    totals = seen.groupBy(*key, "run").agg(F.count("*").alias("turns"), F.sum("n").alias("chars"))
    earlier = W.partitionBy(*key).orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(
        F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("run").alias("r"),
        F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("seq_at"),
        F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("char_at"))
    out = seen.join(totals, seen.conv_id.eqNullSafe(totals.c) & (seen.perspective == totals.p) & (seen.run == totals.r))
    start = F.col("char_at") + F.col("at_in")
    mask = start + F.length("head")
    return out.select(
        "conv_id", "perspective", (F.col("seq_at") + F.col("seq_in")).alias("seq"), "turn", "speaker",
        F.when(F.col("speaker") == "system", "system").when(own, "assistant").otherwise("user").alias("chat_role"),
        F.concat("head", "text", F.lit(CLOSE)).alias("rendered"), start.alias("char_start"),
        mask.alias("mask_start"), F.when(own, mask + F.length("text")).otherwise(mask).alias("mask_end"))


def op2_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every perspective of every conversation."""
    return perspectives(table(spark, sf_dir, "conversations"))


ORACLE = r"""
with b as (
  select conv_id, cast(turn as bigint) as turn, coalesce(role, 'unknown') as speaker, coalesce(text, '') as text
  from conversations),
w as (select distinct conv_id, speaker as perspective from b where speaker <> 'system'),
s as (
  select b.*, perspective,
         '<|im_start|>' || case when speaker = 'system' then 'system' when speaker = perspective then 'assistant'
                                else 'user name=' || speaker end || chr(10) as head
  from b join w on b.conv_id is not distinct from w.conv_id),
o as (
  select *, row_number() over k as seq,
         coalesce(sum(length(head) + length(text) + 11) over (k rows between unbounded preceding and 1 preceding), 0) as char_start
  from s window k as (partition by conv_id, perspective order by turn nulls first, speaker, text))
select conv_id, perspective, seq, turn, speaker,
       case when speaker = 'system' then 'system' when speaker = perspective then 'assistant' else 'user' end as chat_role,
       head || text || '<|im_end|>' || chr(10) as rendered, cast(char_start as bigint) as char_start,
       cast(char_start + length(head) as bigint) as mask_start,
       cast(char_start + length(head) + case when speaker = perspective then length(text) else 0 end as bigint) as mask_end
from o
"""
