"""Preference formatting of chosen and rejected conversations; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.llm.common import table

RENDER = "concat('<|', {0}.role, '|>\n', {0}.text, '\n')"


def format_preferences(turns: DataFrame) -> DataFrame:
    """turns(pair_id, side 'chosen' or 'rejected', turn, role, text) -> one row per pair: pair_id, n_prompt_turns, prompt,
    chosen, rejected, and for each side the [start, end) places in its completion that are trained (assistant texts).

    The longest common prefix of turns, by role and text, is rendered once as the prompt. Turns are ordered by turn, role
    and text, a null turn first; repeated turns are each rendered; null role or text is empty; a missing side is an empty
    completion. A row without id is a pair of its own. No rows give none; other columns are not read. A pair is one row of
    output, so its turns, and only those, meet in one row."""
    lone = F.when(F.isnull("pair_id"), F.monotonically_increasing_id()).alias("_lone")
    clean = turns.select("pair_id", lone, "side", "turn", "role", "text")
    clean = clean.selectExpr("pair_id", "_lone", "side", "struct(turn, coalesce(role, '') AS role, coalesce(text, '') AS text) AS t")
    pairs = clean.groupBy("pair_id", "_lone").agg(*[F.sort_array(F.expr(f"collect_list(t) FILTER (WHERE side = '{s}')")).alias(f"_{s}") for s in ("chosen", "rejected")])
    short = "least(size(_chosen), size(_rejected))"
    differ = "NOT (_chosen[i].role = _rejected[i].role AND _chosen[i].text = _rejected[i].text)"
    pairs = pairs.selectExpr("*", f"CASE WHEN {short} = 0 THEN 0 ELSE coalesce(get(filter(sequence(0, {short} - 1), i -> {differ}), 0), {short}) END AS n")
    join = lambda e: f"array_join(transform({e}, x -> {RENDER.format('x')}), '')"
    pairs = pairs.selectExpr("pair_id", "n", f"{join('slice(_chosen, 1, n)')} AS prompt", *[f"slice(_{s}, n + 1, greatest(size(_{s}) - n, 0)) AS _{s}" for s in ("chosen", "rejected")])

    def mask(side: str) -> str:
        length = f"length({RENDER.format('x')})"
        step = f"struct(a.at + {length} AS at, CASE WHEN x.role = 'assistant' THEN concat(a.m, array(concat(a.at + length(x.role) + 5, '-', a.at + {length} - 1))) ELSE a.m END AS m)"
        return f"array_join(aggregate(_{side}, struct(0 AS at, cast(array() AS array<string>) AS m), (a, x) -> {step}, a -> a.m), ',')"

    return pairs.selectExpr("pair_id", "n AS n_prompt_turns", "prompt", *[f"{join(f'_{s}')} AS {s}" for s in ("chosen", "rejected")], *[f"{mask(s)} AS {s}_trained" for s in ("chosen", "rejected")])


def op10_preferences(spark, sf_dir):
    """Chosen: each conversation. Rejected: the same with its last assistant text replaced by that of the conversation with
    the next id; without one the turn is missing. Turns without conv_id belong to no conversation and are left out."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    last = turns.where("role = 'assistant'").groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("l"))
    last = last.selectExpr("conv_id", "l.turn AS last_turn", "l.text AS last_text")
    other = last.selectExpr("conv_id - 1 AS conv_id", "last_text AS other_text", "true AS present")
    plan = last.join(other, "conv_id", "left").select("conv_id", "last_turn", "other_text", "present")
    both = turns.join(plan, "conv_id", "left").selectExpr("*", "coalesce(turn = last_turn AND role = 'assistant', false) AS swap")
    chosen = both.selectExpr("conv_id AS pair_id", "'chosen' AS side", "turn", "role", "text")
    rejected = both.where("NOT swap OR present").selectExpr("conv_id AS pair_id", "'rejected' AS side", "turn", "role", "CASE WHEN swap THEN other_text ELSE text END AS text")
    return format_preferences(chosen.union(rejected)).withColumnRenamed("pair_id", "conv_id")
