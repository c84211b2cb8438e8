"""Operator 1: preference formatting of chosen and rejected conversations.

Two conversations of a pair share their first turns. The longest common prefix
of turns (same role and text) is rendered once as the prompt; what follows on
either side becomes a completion, cut into segments that say whether they are
trained on (what an assistant says, with the end mark) or masked.

Defined cases: null role is ``unknown``, null text is empty; turns are ordered by
turn, then role, then text, and a row that repeats another fully counts once;
rows without pair id belong to no pair. Equal conversations give two empty
completions; a side without turns gives an empty prompt. Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.llm.common import stored, table

#: Marks of the rendered form, fixed values.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"

TRAINED_ROLE = "assistant"


def conversations(turns: DataFrame, key: str) -> DataFrame:
    """(key, turns): one row per conversation, turns an ordered array of (role, text)."""
    row = F.struct(F.col("turn"), F.coalesce("role", F.lit("unknown")).alias("role"),
                   F.coalesce("text", F.lit("")).alias("text"))
    ordered = F.sort_array(F.collect_set(row))
    return (turns.where(F.col(key).isNotNull()).groupBy(key).agg(ordered.alias("_t"))
            .select(key, F.transform("_t", lambda t: F.struct(t.role.alias("role"), t.text.alias("text")))
                    .alias("turns")))


def header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn.role, F.lit(CLOSE))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(
        turns, lambda t: F.concat(header(t), t.text, F.lit(END))), "")


def common_turns(a: Column, b: Column) -> Column:
    """How many first turns are equal."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs == 0, F.size(a)).otherwise(differs - 1).cast("int")


def segments(turns: Column) -> Column:
    """The rendered turns as an array of (text, train)."""
    def parts(t):
        said = F.concat(t.text, F.lit(END))
        return (F.when(t.role == TRAINED_ROLE, F.array(
            F.struct(header(t).alias("text"), F.lit(False).alias("train")),
            F.struct(said.alias("text"), F.lit(True).alias("train"))))
            .otherwise(F.array(F.struct(F.concat(header(t), said).alias("text"),
                                        F.lit(False).alias("train")))))
    return F.flatten(F.transform(turns, parts))


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Replaces two columns of turns by prompt, prompt_turns and the masked completions.

    ``chosen`` and ``rejected`` become arrays of (text, train); joining their texts
    after the prompt gives the whole rendered conversation.
    """
    def rest(side: str) -> Column:
        return F.slice(side, F.col("prompt_turns") + 1, F.greatest(
            F.size(side) - F.col("prompt_turns"), F.lit(0)))

    others = [c for c in pairs.columns if c not in (chosen, rejected, "prompt", "prompt_turns")]
    return (pairs.withColumn("prompt_turns", common_turns(F.col(chosen), F.col(rejected)))
            .select(*others, "prompt_turns",
                    rendered(F.slice(chosen, F.lit(1), F.col("prompt_turns"))).alias("prompt"),
                    segments(rest(chosen)).alias(chosen), segments(rest(rejected)).alias(rejected)))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """Formats two tables of turns (key, turn, role, text); pairs need both sides."""
    a = conversations(chosen, key).withColumnRenamed("turns", "chosen")
    b = conversations(rejected, key).withColumnRenamed("turns", "rejected")
    return format_pairs(a.join(b, key))


def with_stale_reply(turns: Column) -> Column:
    """The conversation with its last assistant reply replaced by the reply before it
    (empty, if there is none), and what came after dropped; without a reply, all but
    the last turn."""
    replies = F.filter(turns, lambda t: t.role == TRAINED_ROLE)
    backwards = F.reverse(F.transform(turns, lambda t: t.role == TRAINED_ROLE))
    keep = (F.size(turns) - F.array_position(backwards, True)).cast("int")
    stale = F.struct(F.lit(TRAINED_ROLE).alias("role"),
                     F.coalesce(F.try_element_at(replies, F.lit(-2)).text, F.lit("")).alias("text"))
    return F.when(F.size(replies) > 0, F.concat(F.slice(turns, F.lit(1), keep), F.array(stale))).otherwise(
        F.slice(turns, F.lit(1), F.greatest(F.size(turns) - 1, F.lit(0))))


def pairs_from(turns: DataFrame) -> DataFrame:
    """One pair per conversation: (conv_id, rejected_from, chosen, rejected).

    Among conversations that open with the same turn, the briefest (fewest
    characters, then smallest conv_id) is what the fuller ones are preferred to: each
    of the others is joined with that one row, so a very common opening gives as many
    pairs as it has conversations, and never more text than twice the input.
    A conversation without such a sibling is preferred to itself with a stale reply.
    """
    convs = stored(conversations(turns, "conv_id").select(
        "conv_id", "turns", F.sha2(F.to_json(F.element_at("turns", 1)), 256).alias("opening"),
        F.aggregate("turns", F.lit(0).cast("long"),
                    lambda n, t: n + F.length(t.role) + F.length(t.text)).alias("size")), "conversations")
    briefest = (convs.groupBy("opening")
                .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("size", "conv_id")).alias("b"))
                .where("n > 1").select(F.col("b.conv_id").alias("rejected_from")))
    other = briefest.join(convs, briefest.rejected_from == convs.conv_id).select(
        "rejected_from", F.col("opening").alias("_o"), F.col("turns").alias("_r"))
    joined = convs.join(other, (convs.opening == other._o) & (convs.conv_id != other.rejected_from), "left")
    return joined.select("conv_id", "rejected_from", F.col("turns").alias("chosen"),
                         F.coalesce("_r", with_stale_reply(F.col("turns"))).alias("rejected"))


def _mask(side: str) -> Column:
    """Segment lengths, + for trained ones: ``14-120+``."""
    return F.array_join(F.transform(side, lambda s: F.concat(
        F.length(s.text).cast("string"), F.when(s.train, "+").otherwise("-"))), "")


def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = format_pairs(pairs_from(table(spark, sf_dir, "conversations")))
    text = lambda side: F.array_join(F.transform(side, lambda s: s.text), "")
    return done.select("conv_id", "rejected_from", "prompt_turns", "prompt",
                       text("chosen").alias("chosen"), _mask("chosen").alias("chosen_mask"),
                       text("rejected").alias("rejected"), _mask("rejected").alias("rejected_mask"))


#: The same rows by DuckDB.
ORACLE_SQL = """
with t as (
  select distinct conv_id, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
c as (
  select conv_id, list({'role': role, 'text': text} order by turn nulls first, role, text) as turns,
         sum(length(role) + length(text)) as size
  from t group by conv_id),
ranked as (
  select *, count(*) over (partition by turns[1]) as n,
         first_value(conv_id) over (partition by turns[1] order by size, conv_id) as brief
  from c),
sided as (
  select a.conv_id, case when a.n > 1 and a.brief <> a.conv_id then a.brief end as rejected_from,
         a.turns as chosen, b.turns as sibling,
         list_filter(a.turns, lambda x: x.role = 'assistant') as replies,
         list_max(list_transform(a.turns, lambda x, i: case when x.role = 'assistant' then i else 0 end)) as last
  from ranked a join ranked b on b.conv_id = a.brief),
p as (
  select conv_id, rejected_from, chosen,
         case when rejected_from is not null then sibling
              when last > 0 then list_concat(chosen[1:last - 1], [{'role': 'assistant', 'text':
                   case when len(replies) > 1 then replies[len(replies) - 1].text else '' end}])
              else chosen[1:len(chosen) - 1] end as rejected
  from sided),
n as (
  select *, coalesce(list_min(list_filter(list_transform(range(1, greatest(len(chosen), len(rejected)) + 1),
           lambda i: case when i > len(chosen) or i > len(rejected) or chosen[i] <> rejected[i] then i end),
           lambda i: i is not null)) - 1, len(chosen)) as k
  from p),
r as (
  select *, chosen[k + 1:] as c, rejected[k + 1:] as r, chosen[1:k] as q from n)
select conv_id, rejected_from, k::int as prompt_turns,
  coalesce(array_to_string(list_transform(q, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), ''), '') as prompt,
  coalesce(array_to_string(list_transform(c, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), ''), '') as chosen,
  coalesce(array_to_string(list_transform(c, lambda x: case when x.role = 'assistant'
     then (length(x.role) + 5) || '-' || (length(x.text) + 8) || '+' else (length(x.role) + length(x.text) + 13) || '-' end), ''), '') as chosen_mask,
  coalesce(array_to_string(list_transform(r, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), ''), '') as rejected,
  coalesce(array_to_string(list_transform(r, lambda x: case when x.role = 'assistant'
     then (length(x.role) + 5) || '-' || (length(x.text) + 8) || '+' else (length(x.role) + length(x.text) + 13) || '-' end), ''), '') as rejected_mask
from r
"""
