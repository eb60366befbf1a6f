"""Mixing of sources to target weights over a tree of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetpulse.llm.common import table
from assetpulse.session import materialize

#: Source to domain: the first matching pattern over the whole name; any other name, empty or null is DEFAULT_DOMAIN, which
#: has weight 1 unless given one. The first ten numbered sources stand for the web, the others for curated text.
DOMAINS = [("src0*[0-9]", "web"), ("src[0-9]+", "curated")]
DEFAULT_DOMAIN = "other"
#: domain, language, source.
LEVELS = {
    "domain": f"CASE {' '.join(f"WHEN source RLIKE '^({p})$' THEN '{d}'" for p, d in DOMAINS)} ELSE '{DEFAULT_DOMAIN}' END",
    "language": "lang",
    "leaf": "source",
}
#: Target weights by path from the top, "*" for any names above, and the budget as a share of all tokens: those of the query and
#: of the pipeline's stage.
WEIGHTS = {("web",): 1.0, ("curated",): 1.0, ("*", "en"): 2.0}
SHARE = 0.8
TOKENS = "greatest(1L, ceil(octet_length(coalesce(text, '')) / 4))"


def weight_of(own: list[str], weights: dict[tuple[str, ...], float]) -> Column:
    """Weight of the node whose path the columns own hold: that of the whole path, else of ("*", ..., name), else 1."""
    named = {"\x1f".join(path): float(w) for path, w in weights.items() if len(path) == len(own)}
    if not named:
        return F.lit(1.0)
    table_ = F.create_map(*[F.lit(v) for kv in named.items() for v in kv])
    exact = F.concat_ws("\x1f", *own)
    anywhere = F.concat_ws("\x1f", *[F.lit("*")] * (len(own) - 1), own[-1])
    return F.coalesce(F.try_element_at(table_, exact), F.try_element_at(table_, anywhere), F.lit(1.0))


def budgets(leaves: DataFrame, levels: list[str], weights: dict[tuple[str, ...], float], total: float, epochs: int) -> DataFrame:
    """leaves(levels..., tokens) -> with budget. A node offers its tokens times epochs. A parent's budget goes to its
    children by weight (weight_of); a child that offers less gives all, and its siblings share the rest. Only what a whole
    subtree lacks goes to the parent's siblings, since a node's budget never exceeds what its leaves offer."""
    nodes = leaves.withColumn("budget", F.lit(float(total)))
    for depth, level in enumerate(levels):
        above, own = levels[:depth], levels[: depth + 1]
        kids = leaves.groupBy(*own).agg((F.sum("tokens") * epochs).cast("double").alias("offer"))
        kids = kids.withColumn("w", weight_of(own, weights))
        on = [nodes[c].eqNullSafe(kids[c]) for c in above]
        parents = nodes.select(*above, "budget").distinct() if depth else None
        if parents is not None:
            on = [parents[c].eqNullSafe(kids[c]) for c in above]
            cond = on[0]
            for c in on[1:]:
                cond = cond & c
            kids = kids.join(parents, cond).select(*[kids[c] for c in kids.columns], parents["budget"])
        else:
            kids = kids.withColumn("budget", F.lit(float(total)))
        part = ", ".join(above) or "1"
        order = f"PARTITION BY {part} ORDER BY offer / w, {level}"
        kids = kids.selectExpr(
            "*", f"sum(offer) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - offer AS before",
            f"sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest",
        )
        kids = kids.selectExpr("*", "before + offer / w * rest <= budget AS whole")
        kids = kids.selectExpr("*", f"sum(CASE WHEN whole THEN offer ELSE 0D END) OVER (PARTITION BY {part}) AS given", f"sum(CASE WHEN whole THEN 0D ELSE w END) OVER (PARTITION BY {part}) AS open_w")
        nodes = kids.selectExpr(*own, "CASE WHEN whole THEN offer ELSE (budget - given) * w / open_w END AS budget")
    return materialize(nodes)


def with_leaves(rows: DataFrame, small: DataFrame, names: list[str], how: str, most: int) -> DataFrame:
    """Rows joined with a written table of one row per leaf: broadcast if that has been counted to have most rows at most,
    else joined by leaf and one of 64 salts, so that a hot leaf is spread."""
    if small.count() <= most:
        return rows.join(F.broadcast(small), names, how)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
    rows = rows.withColumn("_salt", F.expr("cast(pmod(xxhash64(_row.doc_id, _row.text), 64) AS int)"))
    return rows.join(salted, [*names, "_salt"], how).drop("_salt")


def mix(docs: DataFrame, levels: dict[str, str], weights: dict[tuple[str, ...], float], share: float = SHARE, epochs: int = 2, seed: int = 7,
        tokens: str = TOKENS, broadcast_rows: int = 100_000) -> DataFrame:
    """docs with _epoch, once per epoch in which a row is taken; share of all tokens is the budget.

    An epoch orders a leaf by a seeded hash. Whole epochs come first; of the last one, the prefix of rows that begins
    within the budget. Prefix sums run over 4096 hash ranges a leaf; rows are ordered in the cut range only, so
    a hot leaf never meets in one task. Null levels are leaves of their own. Repeated rows are taken or left each for
    itself; rows of one hash are ordered by doc_id. Columns of docs may have any names. No rows give none.
    """
    names = [f"_{n}" for n in levels]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    base = docs.select(row, *[F.expr(f"coalesce(cast({e} AS string), '')").alias(f"_{n}") for n, e in levels.items()], F.expr(tokens).alias("_tokens"))
    small = materialize(base.select(*names, F.col("_tokens").alias("tokens")).groupBy(*names).agg(F.sum("tokens").alias("tokens")))
    total = small.agg(F.sum("tokens")).first()[0] or 0
    plan = budgets(small, names, weights, total * share, epochs).join(small, names)
    plan = plan.selectExpr(*names, "least(floor(budget / tokens), %d) AS _full" % epochs, "budget - floor(budget / tokens) * tokens AS _left")
    plan = materialize(plan)
    planned = with_leaves(base, plan, names, "inner", broadcast_rows)
    ranged = planned.withColumn("_h", F.expr(f"xxhash64({seed}, _full, _row.doc_id, _row.text)"))
    ranged = ranged.withColumn("_range", F.expr("pmod(shiftright(_h, 52), 4096)")).withColumn("_h2", F.expr("_h & 4503599627370495L"))
    sums = materialize(ranged.groupBy(*names, "_range").agg(F.sum("_tokens").alias("t")))
    part = ", ".join(names)
    upto = sums.selectExpr("*", f"sum(t) OVER (PARTITION BY {part} ORDER BY _range) - t AS _before").join(plan, names)
    cut = materialize(upto.where("_before < _left AND _before + t >= _left").select(*names, F.col("_range").alias("_cut"), "_before"))
    chosen = with_leaves(ranged.where("_left > 0"), cut, names, "left", broadcast_rows)
    below = chosen.where("_cut IS NULL OR _range < _cut").selectExpr("_row.*", "cast(_full AS int) AS _epoch")
    edge = chosen.where("_range = _cut").selectExpr("*", f"_before + sum(_tokens) OVER (PARTITION BY {part} ORDER BY _h2, _row.doc_id ROWS UNBOUNDED PRECEDING) - _tokens AS _at")
    edge = edge.where("_at < _left").selectExpr("_row.*", "cast(_full AS int) AS _epoch")
    whole = planned.where("_full > 0").selectExpr("_row.*", "explode(sequence(0, cast(_full AS int) - 1)) AS _epoch")
    return whole.union(below).union(edge)


def op4_mix(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), LEVELS, WEIGHTS).selectExpr("doc_id", "source", "lang", "_epoch AS epoch")
