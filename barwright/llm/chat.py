"""Chat formatting by perspective rotation: every participant's view of a dialogue, with loss masks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

#: Marks around a turn, and the turns whose lengths are summed before the sums are added up.
OPEN, CLOSE, STRETCH = "<|", "|>", 256
SYSTEM = "system"


def rotated(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text") -> DataFrame:
    """One row for each turn in each participant's view: (conversation, perspective, turn, role, name, segment, mask, char_start, char_end).

    Participants are the distinct speakers of a conversation but the system (case and outer blanks of names do not count); a null or blank speaker is the
    participant `unknown`. In a participant's view, that participant's turns are the assistant's and have mask 1; turns of the system stay the system's, and all
    others are a user's with the speaker's name; their mask is 0. Segments in order of turn (ties: role, text) make up the view's text, in which
    a segment stands at [char_start, char_end). A null text is empty. Offsets are sums over stretches of turns, then within a stretch, so that a long
    conversation is spread over tasks. A conversation of the system alone has no view. Marks of turns inside a text or a name are parted by a blank, so that
    none can open or close a turn. Rows that repeat are turns of their own; an empty table gives no row; other columns are ignored, so names can't clash.
    """
    inert = lambda c: F.replace(F.replace(c, F.lit(OPEN), F.lit("< |")), F.lit(CLOSE), F.lit("| >"))
    name = inert(F.coalesce(F.nullif(F.lower(F.trim(F.col(speaker))), F.lit("")), F.lit("unknown")))
    said = turns.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"), name.alias("name"), inert(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    people = said.where(F.col("name") != SYSTEM).select(F.col("conv").alias("_conv"), F.col("name").alias("perspective")).distinct()
    views = said.join(people, F.col("conv").eqNullSafe(F.col("_conv")))
    own = F.col("name") == F.col("perspective")
    role = F.when(F.col("name") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    header = F.concat(F.lit(OPEN), role, F.when(role == "user", F.concat(F.lit(" name="), F.col("name"))).otherwise(F.lit("")), F.lit(CLOSE + "\n"))
    segment = F.concat(header, F.col("text"), F.lit("\n" + OPEN + "end" + CLOSE + "\n"))
    views = views.select("conv", "perspective", "turn", role.alias("role"), "name", segment.alias("segment"), F.when(own, 1).otherwise(0).alias("mask"))
    rows = views.withColumns({"length": F.length("segment"), "stretch": F.floor(F.coalesce("turn", F.lit(0)) / STRETCH)})
    sums = rows.groupBy("conv", "perspective", "stretch").agg(F.sum("length").alias("n"))
    before = Window.partitionBy("conv", "perspective").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    key = ("conv", "perspective", "stretch")
    sums = sums.select(*(F.col(c).alias(f"_{c}") for c in key), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("conv", "perspective", "stretch").orderBy(F.col("turn").asc_nulls_first(), "name", "segment").rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(sums, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
    start = F.col("offset") + F.coalesce(F.sum("length").over(within), F.lit(0))
    out = joined.withColumn("char_start", start).withColumn("char_end", F.col("char_start") + F.col("length"))
    return out.select(F.col("conv").alias(conversation), "perspective", F.col("turn").alias(turn), "role", "name", "segment", "mask", "char_start", "char_end")


def op9_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every participant's view of every conversation, turn by turn, with a digest of each segment."""
    views = rotated(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    digest, offsets = F.md5(F.col("segment").cast("binary")).alias("digest"), [F.col(c).cast("long").alias(c) for c in ("char_start", "char_end")]
    return views.select("conv_id", "perspective", "turn", "role", "name", digest, "mask", *offsets)


OP9_SQL = """
with said as (
    select conv_id, turn, replace(replace(coalesce(nullif(lower(trim(role)), ''), 'unknown'), '<|', '< |'), '|>', '| >') as name,
        replace(replace(coalesce(text, ''), '<|', '< |'), '|>', '| >') as text from conversations
), people as (select distinct conv_id, name as perspective from said where name <> 'system'
), views as (
    select s.conv_id, p.perspective, s.turn, s.name, s.text,
        case when s.name = 'system' then 'system' when s.name = p.perspective then 'assistant' else 'user' end as role
    from said s join people p on s.conv_id is not distinct from p.conv_id
), seen as (
    select *, '<|' || role || case when role = 'user' then ' name=' || name else '' end || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10) as segment from views
), placed as (
    select *, sum(length(segment)) over (partition by conv_id, perspective order by turn nulls first, name, segment rows unbounded preceding) as char_end from seen
)
select conv_id, perspective, turn, role, name, md5(segment) as digest, cast(role = 'assistant' as int) as mask,
    cast(char_end - length(segment) as bigint) as char_start, cast(char_end as bigint) as char_end
from placed
"""
