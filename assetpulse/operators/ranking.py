"""Ranking operators behind the precision, gain and ROC reports.

A report date has one row per asset, so nothing here may order a whole date in one task. Rows are first
grouped to one row per distinct score with its row and failure counts: a score shared by a third of the
rows becomes one row. Everything else is arithmetic on that table and on counts of better scores, which
are running sums inside score ranges plus the totals of the better ranges.

Items are ordered by score, best first; among equal scores failures come first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetpulse.constants import DATE
from assetpulse.functions import ratio

SCORE_RANGES = 4096  # ranges on either side of zero
FULL_SHARE = 1000  # a range with more than this part of a date's scores is split
SPLITS = 1  # how many times a range may be split; each reads the scores once more
CHUNK_ROWS = 1_000_000  # curve points one task may emit


def score_range(score: Column, ranges: int = SCORE_RANGES) -> Column:
    """Range of a score, by a fixed rising function of its value: sign * (1 - 1 / (1 + |score| ** 0.25)), cut evenly.

    Subtraction, division and square roots are correctly rounded, so a larger score never falls into a lower range. The
    roots spread probabilities and counts of any size over many ranges; no statistics of the data are needed."""
    root = F.sqrt(F.sqrt(F.abs(score)))
    return F.floor(F.signum(score) * (1 - 1 / (1 + root)) * ranges)


def split_full(ranged: DataFrame, by: list[str], path: list[str], part: str, full_share: int) -> DataFrame:
    """Adds the column part: place of the score inside its range, where the range has more than 1 / full_share of the date's
    distinct scores; else 0. The range between its least and largest score is cut evenly into about twice as many parts as
    full_share allows it.

    At most full_share ranges of a date are that full, whatever the data, so the table of them is broadcast."""
    sizes = ranged.groupBy(*by, *path).agg(F.count("*").alias("rows"), F.min("score").alias("least"), F.max("score").alias("most"))
    share = F.col("rows") * full_share / F.sum("rows").over(Window.partitionBy(*by))
    width = F.col("most") - F.col("least")
    full = sizes.withColumn("share", share).filter((F.col("share") > 1) & (width > 0) & (width < float("inf")))
    full = full.select(*by, *path, "least", "most", F.ceil(F.col("share") * 2).alias("parts"))
    place = F.floor((F.col("score") - F.col("least")) / width * F.col("parts"))
    joined = ranged.join(F.broadcast(full), [*by, *path], "left")
    return joined.select(*ranged.columns, F.coalesce(F.least(place, F.col("parts") - 1), F.lit(0)).alias(part))


def score_groups(
    scored: DataFrame,
    score: str,
    label: str,
    ranges: int = SCORE_RANGES,
    by: Sequence[str] = (DATE,),
    full_share: int = FULL_SHARE,
    splits: int = SPLITS,
) -> DataFrame:
    """One row per (date, score): rows n and failures pos at the score, n_before and pos_before at better
    scores, and the date's totals n_all and pos_all. Rows whose score is null or NaN are left out.

    by: the columns that stand for a date, e.g. with the name of a curve. Scores go to fixed ranges; ranges that hold more than
    1 / full_share of a date are split, and split parts again, so that scores in a narrow band spread as well. Results
    depend on none of these settings.
    """
    by, value = list(by), F.col(score).cast("double")
    grouped = (
        scored.filter(value.isNotNull() & ~F.isnan(value))
        .groupBy(*by, value.alias("score"))
        .agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("pos"))
    )
    ranged = grouped.withColumn("range", score_range(F.col("score"), ranges))
    path = ["range"]
    for level in range(splits):
        ranged = split_full(ranged, by, path, f"part{level}", full_share)
        path.append(f"part{level}")

    # At most twice as many rows per date as there are ranges, and a few times full_share for each split.
    totals = ranged.groupBy(*by, *path).agg(F.sum("n").alias("range_n"), F.sum("pos").alias("range_pos"))
    by_date = Window.partitionBy(*by)
    better_ranges = by_date.orderBy(*map(F.desc, path)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        *path,
        F.coalesce(F.sum("range_n").over(better_ranges), F.lit(0)).alias("range_n_before"),
        F.coalesce(F.sum("range_pos").over(better_ranges), F.lit(0)).alias("range_pos_before"),
        F.sum("range_n").over(by_date).alias("n_all"),
        F.sum("range_pos").over(by_date).alias("pos_all"),
    )
    better = (
        Window.partitionBy(*by, *path)
        .orderBy(F.desc("score"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = ranged.withColumns(
        {
            "n_inside": F.coalesce(F.sum("n").over(better), F.lit(0)),
            "pos_inside": F.coalesce(F.sum("pos").over(better), F.lit(0)),
        }
    )
    return inside.join(offsets, [*by, *path]).select(
        *by,
        "score",
        "n",
        "pos",
        (F.col("n_inside") + F.col("range_n_before")).alias("n_before"),
        (F.col("pos_inside") + F.col("range_pos_before")).alias("pos_before"),
        "n_all",
        "pos_all",
    )


def captured(position: Column) -> Column:
    """Failures among the first `position` items, for a position inside the row's score group."""
    return F.col("pos_before") + F.least(position - F.col("n_before"), F.col("pos"))


def _positions(groups: DataFrame, last: Column, chunk_rows: int, by: Sequence[str]) -> DataFrame:
    """One row per item position of each group, up to last. Long groups are cut into chunks and spread."""
    first = F.col("n_before") + 1
    chunks = groups.withColumn("chunk", F.explode(F.sequence(first, last, F.lit(chunk_rows).cast("long"))))
    partitions = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = chunks.repartition(partitions, *by, "chunk")
    chunk_end = F.least(F.col("chunk") + chunk_rows - 1, last)
    return spread.withColumn("k", F.explode(F.sequence("chunk", chunk_end))).drop("chunk")


def precision_curve(groups: DataFrame, top: int = 100, by: Sequence[str] = (DATE,)) -> DataFrame:
    """Precision among the k best items, for k up to top, with the base rate of the date."""
    wanted = groups.filter(F.col("n_before") < top)
    last = F.least(F.col("n_before") + F.col("n"), F.lit(top).cast("long"))
    points = _positions(wanted, last, CHUNK_ROWS, by)
    return points.select(
        *by,
        "k",
        ratio(captured(F.col("k")), F.col("k")).alias("precision"),
        ratio(F.col("pos_all"), F.col("n_all")).alias("base_rate"),
    )


def gain_curve(groups: DataFrame, chunk_rows: int = CHUNK_ROWS, by: Sequence[str] = (DATE,)) -> DataFrame:
    """For each item: share of items before it (x) and share of all failures up to and with it (y)."""
    points = _positions(groups, F.col("n_before") + F.col("n"), chunk_rows, by)
    return points.select(
        *by,
        "k",
        ratio(F.col("k") - 1, F.col("n_all")).alias("x"),
        ratio(captured(F.col("k")), F.col("pos_all")).alias("y"),
    )


def curve_area(groups: DataFrame, by: Sequence[str] = (DATE,)) -> DataFrame:
    """Trapezoid area under the gain curve, and the same less 0.5.

    The sum of captured failures over the items of one score group has a closed form, so the points
    are never listed.
    """
    n, pos, before = F.col("n").cast("double"), F.col("pos").cast("double"), F.col("pos_before").cast("double")
    group_sum = before * n + pos * (pos + 1) / 2 + (n - pos) * pos
    first = F.when(F.col("n_before") == 0, F.least(F.col("pos"), F.lit(1)))
    sums = groups.groupBy(*by).agg(
        F.sum(group_sum).alias("total"),
        F.max(first).alias("first"),
        F.max("n_all").alias("n_all"),
        F.max("pos_all").alias("pos_all"),
    )
    inner = F.col("total") - (F.col("first") + F.col("pos_all")) / F.lit(2.0)
    area = ratio(inner, F.col("n_all").cast("double") * F.col("pos_all"))
    return sums.select(*by, area.alias("area"), (area - 0.5).alias("area_over_random"))


def roc_auc(groups: DataFrame, by: Sequence[str] = (DATE,)) -> DataFrame:
    """Share of (failure, non-failure) pairs ordered right, ties counting half; from the rank sums."""
    worse = (F.col("n_all") - F.col("pos_all")) - (F.col("n_before") - F.col("pos_before")) - (F.col("n") - F.col("pos"))
    same = F.col("n") - F.col("pos")
    won = F.col("pos").cast("double") * (worse + same / F.lit(2.0))
    sums = groups.groupBy(*by).agg(
        F.sum(won).alias("won"), F.max("n_all").alias("n_all"), F.max("pos_all").alias("pos_all")
    )
    pairs = F.col("pos_all").cast("double") * (F.col("n_all") - F.col("pos_all"))
    return sums.select(*by, ratio(F.col("won"), pairs).alias("roc_auc"))


def cutoff_points(groups: DataFrame, report: DataFrame, value: str, cutoffs: Mapping[str, float]) -> DataFrame:
    """Percentile of each cutoff within the report column, and the gain-curve point at that percentile.

    The percentile is the mean of the strict and the weak percentage; the point interpolates linearly
    between the two neighbouring curve points.
    """
    col = F.col(value).cast("double")
    # One row per date; the cutoff list is a handful of constants.
    shares = report.groupBy(DATE).agg(
        F.count("*").alias("rows"),
        *[F.count_if(col < cut).alias(f"below_{name}") for name, cut in cutoffs.items()],
        *[F.count_if(col <= cut).alias(f"upto_{name}") for name, cut in cutoffs.items()],
    )
    bands = F.array(
        *[
            F.struct(
                F.lit(name).alias("band"),
                F.lit(float(cut)).alias("cutoff"),
                F.col(f"below_{name}").alias("below"),
                F.col(f"upto_{name}").alias("upto"),
            )
            for name, cut in cutoffs.items()
        ]
    )
    step = (F.col("upto") > F.col("below")).cast("int")
    percentile = (F.col("below") + F.col("upto") + step) * F.lit(50.0) / F.col("rows")
    position = (F.col("rows") - 1) * (F.lit(100.0) - F.col("percentile")) / F.lit(100.0)
    wanted = (
        shares.select(DATE, "rows", F.explode(bands).alias("b"))
        .select(DATE, "rows", "b.*")
        .withColumn("percentile", percentile)
        .withColumn("position", position)
        .withColumn("low", F.floor("position") + 1)
        .withColumn("high", F.ceil("position") + 1)
    )
    # Broadcast is bounded: one row per report date and cutoff.
    hits = groups.join(F.broadcast(wanted), DATE).filter(
        (F.col("n_before") < F.col("high")) & (F.col("low") <= F.col("n_before") + F.col("n"))
    )

    def at(which: str) -> Column:
        inside = (F.col("n_before") < F.col(which)) & (F.col(which) <= F.col("n_before") + F.col("n"))
        return F.max(F.when(inside, captured(F.col(which)))).cast("double")

    found = hits.groupBy(DATE, "band", "cutoff", "percentile", "position", "low").agg(
        F.max("n_all").alias("n_all"), F.max("pos_all").alias("pos_all"), at("low").alias("y_low"), at("high").alias("y_high")
    )
    weight = F.col("position") - (F.col("low") - 1)
    y = F.col("y_low") + (F.col("y_high") - F.col("y_low")) * weight
    return found.select(
        DATE,
        "band",
        "cutoff",
        "percentile",
        ratio(F.col("position"), F.col("n_all")).alias("x"),
        ratio(y, F.col("pos_all")).alias("y"),
    )


def reference_lines(report: DataFrame, label: str) -> DataFrame:
    """Corner points of the ideal and the random line; the ideal line bends at the base rate."""
    rate = report.groupBy(DATE).agg(F.avg(F.col(label).cast("double")).alias("rate"))

    def point(line: str, position: int, x: Column, y: float) -> Column:
        return F.struct(
            F.lit(line).alias("line"), F.lit(position).alias("position"), x.alias("x"), F.lit(y).alias("y")
        )

    points = F.array(
        point("ideal", 1, F.lit(0.0), 0.0),
        point("ideal", 2, F.col("rate"), 1.0),
        point("ideal", 3, F.lit(1.0), 1.0),
        point("random", 1, F.lit(0.0), 0.0),
        point("random", 2, F.lit(1.0), 1.0),
    )
    return rate.select(DATE, F.explode(points).alias("p")).select(DATE, "p.*")


def baseline_score(
    report: DataFrame, value: str = "notes_in_last_pm", label: str = "failure_event", output: str = "pctl_bl"
) -> DataFrame:
    """Ascending rank of value within its date, ties sharing their mean rank, over the largest rank of all dates."""
    groups = score_groups(report, value, label)
    rank = (F.col("n_all") - F.col("n_before") - F.col("n")) + (F.col("n") + 1) / F.lit(2.0)
    ranks = groups.select(DATE, F.col("score").alias("rank_value"), rank.alias("rank"))
    largest = ranks.agg(F.max("rank").alias("largest")).scalar()
    scored = ranks.select(F.col(DATE).alias("rank_date"), "rank_value", (F.col("rank") / largest).alias(output))
    same = (F.col(DATE) == F.col("rank_date")) & (F.col(value).cast("double") == F.col("rank_value"))
    return report.join(scored, same, "left").drop("rank_date", "rank_value")


def report_dates(df: DataFrame, dates: Sequence | None) -> DataFrame:
    """Restrict to a list of report dates."""
    return df if dates is None else df.filter(F.col(DATE).isin(list(dates)))
