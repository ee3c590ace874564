"""Preference formatting: paired completions behind a common prompt.

A pair is two conversations, one chosen over the other.  Their longest common prefix of turns (same role, same text) is
rendered once as the prompt; what follows in each is rendered as its completion.  The loss mask of a completion is given as
spans of the rendered text: only what the assistant says, with its end mark, counts.

Turns of one conversation are gathered first (a conversation is one row of the output, so that is no larger than the
result).  Nothing is compared across pairs.  ``pairs_by_opening`` and ``swapped_replies`` make pairs where none are given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>\n"  # fixed values: a usual chat template
TURN = "array<struct<role:string,text:string>>"


def conversations_of(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turns): each conversation's turns in order.

    Turns are ordered by number, then role and text; repeated rows count once.  A null number comes first, a null role is
    ``user``, a null text empty.  Turns without a conversation id belong to none and are left out.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("user")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).where("conv is not null")
    parts = F.array_sort(F.collect_set(F.struct(F.col("turn").isNotNull().alias("numbered"), F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text")))
    return rows.groupBy("conv").agg(F.transform(parts, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def rendered(turns: Column) -> Column:
    """Each turn as text."""
    return F.transform(turns, lambda t: F.concat(F.lit(BEGIN), t["role"], F.lit("\n"), t["text"], F.lit(END)))


def loss_spans(turns: Column, role: str = "assistant") -> Column:
    """Spans (start, end) of the rendered turns, in code points, that the role wrote, end mark included."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"))

    def add(state, t):
        begin = state["at"] + len(BEGIN) + F.length(t["role"]) + 1
        end = begin + F.length(t["text"]) + len(END)
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == role, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, start, add, lambda s: s["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns that two conversations share."""
    same = F.transform(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y) & x.isNotNull() & y.isNotNull()), lambda x: ~x)
    return F.when(F.array_contains(same, True), F.array_position(same, True) - 1).otherwise(F.size(same))


def format_preferences(pairs: DataFrame, chosen_col: str, rejected_col: str) -> DataFrame:
    """``pairs``, with two arrays of turns (role, text) a row, as n_common, prompt, chosen, rejected (rendered), chosen_loss
    and rejected_loss (arrays of spans of the completions) beside the other columns.

    Equal conversations share all their turns: both completions are empty.  Null arrays count as empty.
    """
    a, b = (F.coalesce(F.col(c), F.array().cast(TURN)) for c in (chosen_col, rejected_col))
    kept = [c for c in pairs.columns if c not in (chosen_col, rejected_col)]
    both = pairs.select(*kept, a.alias("_a"), b.alias("_b")).withColumn("n_common", common_turns(F.col("_a"), F.col("_b")).cast("int"))
    rest = {side: F.slice(F.col(c), F.col("n_common") + 1, F.size(c) - F.col("n_common")) for side, c in (("chosen", "_a"), ("rejected", "_b"))}
    return both.select(
        *kept, "n_common",
        F.array_join(rendered(F.slice("_a", F.lit(1), F.col("n_common"))), "").alias("prompt"),
        *[F.array_join(rendered(x), "").alias(side) for side, x in rest.items()],
        *[loss_spans(x).alias(f"{side}_loss") for side, x in rest.items()],
    )


def pairs_by_opening(conversations: DataFrame, score: Column, part: Column | None = None) -> DataFrame:
    """(chosen, rejected): ids of conversations with the same first turn, paired along their score.

    Under each opening the conversations are put in order of score (ties: larger id first), and each is chosen over
    the next; so n conversations give n - 1 pairs.  A popular opening is dealt into parts (64 by the id's hash, unless
    ``part`` says otherwise), which are chained by their first ones, so that none is ordered whole in one task.
    """
    opening = F.md5(F.to_json(F.element_at("turns", 1)).cast("binary"))
    part = F.pmod(F.xxhash64("conv"), F.lit(64)) if part is None else part
    rows = conversations.where(F.size("turns") > 0).select("conv", opening.alias("opening"), score.alias("score"), part.alias("part"))
    window = Window.partitionBy("opening", "part").orderBy(F.desc("score"), F.desc("conv"))
    inner = rows.select(F.col("conv").alias("chosen"), F.lead("conv").over(window).alias("rejected"))
    ends = rows.groupBy("opening", "part").agg(F.max(F.struct("score", "conv")).alias("top"))
    chain = Window.partitionBy("opening").orderBy(F.desc("top.score"), F.desc("top.conv"))
    ends = ends.select(F.col("top.conv").alias("chosen"), F.lead("top.conv").over(chain).alias("rejected"))
    return inner.union(ends).where("rejected is not null")


def swapped_replies(conversations: DataFrame, block: Column, role: str = "assistant") -> DataFrame:
    """(chosen_id, rejected_id, chosen_turns, rejected_turns): each conversation, chosen over itself with its last reply taken from
    the next conversation (by id, the last one from the first) of its ``block``.

    Conversations without a reply, or alone in their block, give no pair.  Blocks should be small.
    """
    last = F.array_max(F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == role, i)), lambda i: i.isNotNull()))
    rows = conversations.select("conv", "turns", last.alias("last"), block.alias("block")).where("last is not null")
    window = Window.partitionBy("block").orderBy("conv")
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    reply = F.struct("conv", F.element_at("turns", F.col("last") + 1).alias("turn"))
    rows = rows.withColumn("donor", F.coalesce(F.lead(reply).over(window), F.first(reply).over(whole))).where("donor.conv <> conv")
    turns = F.concat(F.slice("turns", F.lit(1), F.col("last")), F.array("donor.turn"))
    return rows.select(F.col("conv").alias("chosen_id"), F.col("donor.conv").alias("rejected_id"), F.slice("turns", F.lit(1), F.col("last") + 1).alias("chosen_turns"), turns.alias("rejected_turns"))


def op9_preference_format(spark, sf_dir: str) -> DataFrame:
    """Formatted preference pairs of ``conversations``: those with the same opening, the one with more assistant text chosen,
    and each one against itself with the last reply of another (in blocks of 64 ids).

    The spans of the loss masks are given as start:end, comma-joined.
    """
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    conversations = conversations_of(turns, "conv_id", "turn", "role", "text")
    said = F.filter("turns", lambda t: t["role"] == "assistant")
    score = F.aggregate(said, F.lit(0).cast("long"), lambda s, t: s + F.length(t["text"]))
    pairs = pairs_by_opening(conversations, score, F.pmod("conv", F.lit(64)))
    side = [conversations.select(F.col("conv").alias(c), F.col("turns").alias(f"{c}_turns")) for c in ("chosen", "rejected")]
    opened = pairs.join(side[0], "chosen").join(side[1], "rejected").select(
        F.lit("opening").alias("pairing"), F.col("chosen").alias("chosen_id"), F.col("rejected").alias("rejected_id"), "chosen_turns", "rejected_turns"
    )
    swapped = swapped_replies(conversations, F.floor(F.col("conv") / 64)).select(F.lit("swapped").alias("pairing"), "*")
    out = format_preferences(opened.union(swapped), "chosen_turns", "rejected_turns")
    flat = [F.array_join(F.transform(f"{c}_loss", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(f"{c}_loss") for c in ("chosen", "rejected")]
    return out.select("pairing", "chosen_id", "rejected_id", "n_common", "prompt", "chosen", "rejected", *flat)


ORACLE_SQL = r"""WITH c AS (
  SELECT conv_id AS conv, list({'role': role, 'text': text} ORDER BY turn) AS turns FROM conversations GROUP BY conv_id),
o AS (
  SELECT conv, turns[1].role || chr(31) || turns[1].text AS opening, conv % 64 AS part,
    coalesce(list_sum(list_transform(list_filter(turns, lambda t: t.role = 'assistant'), lambda t: length(t.text))), 0)::BIGINT AS score FROM c),
first_of AS (SELECT opening, part, score, conv FROM o QUALIFY row_number() OVER (PARTITION BY opening, part ORDER BY score DESC, conv DESC) = 1),
by_opening AS (
  SELECT conv AS chosen, lead(conv) OVER (PARTITION BY opening, part ORDER BY score DESC, conv DESC) AS rejected FROM o
  UNION ALL
  SELECT conv, lead(conv) OVER (PARTITION BY opening ORDER BY score DESC, conv DESC) FROM first_of),
r AS (SELECT conv, turns, conv // 64 AS block, list_max(list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant')) AS last FROM c),
d AS (
  SELECT conv, turns, last, coalesce(lead(conv) OVER (PARTITION BY block ORDER BY conv), min(conv) OVER (PARTITION BY block)) AS donor
  FROM r WHERE last IS NOT NULL),
p AS (
  SELECT 'opening' AS pairing, chosen AS chosen_id, rejected AS rejected_id, a.turns AS a, b.turns AS b
  FROM by_opening JOIN c a ON a.conv = chosen JOIN c b ON b.conv = rejected
  UNION ALL
  SELECT 'swapped', d.conv, donor, d.turns[1:d.last], list_concat(d.turns[1:d.last - 1], [e.turns[e.last]])
  FROM d JOIN r e ON e.conv = donor WHERE donor <> d.conv),
n AS (
  SELECT *, coalesce(list_min(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] <> b[i])) - 1, least(len(a), len(b)))::INT AS k FROM p),
t AS (SELECT pairing, chosen_id, rejected_id, k, a[1:k] AS q, a[k + 1:] AS x, b[k + 1:] AS y FROM n),
l AS (
  SELECT *, list_transform(x, lambda t: 24 + length(t.role) + length(t.text)) AS lx, list_transform(y, lambda t: 24 + length(t.role) + length(t.text)) AS ly FROM t)
SELECT pairing, chosen_id, rejected_id, k AS n_common,
  coalesce(list_aggregate(list_transform(q, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)), 'string_agg', ''), '') AS prompt,
  coalesce(list_aggregate(list_transform(x, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)), 'string_agg', ''), '') AS chosen,
  coalesce(list_aggregate(list_transform(y, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)), 'string_agg', ''), '') AS rejected,
  coalesce(list_aggregate(list_transform(list_filter(range(1, len(x) + 1), lambda i: x[i].role = 'assistant'),
    lambda i: (coalesce(list_sum(lx[1:i - 1]), 0) + 13 + length(x[i].role))::BIGINT::VARCHAR || ':' || list_sum(lx[1:i])::BIGINT::VARCHAR), 'string_agg', ','), '') AS chosen_loss,
  coalesce(list_aggregate(list_transform(list_filter(range(1, len(y) + 1), lambda i: y[i].role = 'assistant'),
    lambda i: (coalesce(list_sum(ly[1:i - 1]), 0) + 13 + length(y[i].role))::BIGINT::VARCHAR || ':' || list_sum(ly[1:i])::BIGINT::VARCHAR), 'string_agg', ','), '') AS rejected_loss
FROM l"""
