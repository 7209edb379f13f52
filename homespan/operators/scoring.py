"""Min-max scores, weighted composites, and the cut average rank."""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homespan.config import HIGHER_IS_BETTER, LOWER_IS_BETTER, WEIGHTS_B
from homespan.functions.numeric import ratio
from homespan.sources.tables import materialize

RANK_RANGES = 200


def with_good_income(combined: DataFrame) -> DataFrame:
    """Drop places whose income is null or a negative placeholder."""
    return combined.filter(F.col("MEDIAN_INCOME") > 0)


def min_max_scores(
    df: DataFrame,
    higher: Mapping[str, str] = HIGHER_IS_BETTER,
    lower: Mapping[str, str] = LOWER_IS_BETTER,
) -> DataFrame:
    """Add 0..100 scores; a constant metric has no spread and scores null.

    All extremes come from one aggregation, attached as one scalar, so no window spans
    the whole frame.
    """
    metrics = sorted({*higher.values(), *lower.values()})
    extremes = F.struct(*[e for m in metrics for e in (F.min(m).alias(f"lo_{m}"), F.max(m).alias(f"hi_{m}"))])
    bounds = df.agg(extremes.alias("BOUNDS")).scalar()

    def position(metric: str) -> Column:
        lo, hi = F.col(f"BOUNDS.lo_{metric}"), F.col(f"BOUNDS.hi_{metric}")
        return ratio(F.col(metric) - lo, hi - lo)

    scores = {name: position(metric) * 100 for name, metric in higher.items()}
    scores |= {name: (1 - position(metric)) * 100 for name, metric in lower.items()}
    return df.withColumn("BOUNDS", bounds).withColumns(scores).drop("BOUNDS")


def weighted_score(weights: Mapping[str, float]) -> Column:
    """Weighted sum of score columns; the weights must add up to one."""
    if not math.isclose(sum(weights.values()), 1.0, abs_tol=1e-9):
        raise ValueError(f"weights add up to {sum(weights.values())}, not 1")
    return reduce(add, [F.col(name) * F.lit(float(w)) for name, w in weights.items()])


def average_rank(
    df: DataFrame, score: str = "OVERALL_SCORE", rank: str = "RANK", ranges: int = RANK_RANGES
) -> DataFrame:
    """Add the descending rank; ties share their mean position, cut to a whole number.

    Null and NaN scores have a null rank; infinite scores are ranked. Ties fold into one row per distinct score,
    scores are cut at their quantiles into ``ranges`` ranges, ranges are ordered in parallel, and each starts from the
    row count of the ranges above it. The same plan serves every size.

    Rows are read three times: for the cuts, the ties and the result. They are stored in the checkpoint folder first, so that
    all three see the same doubles, whatever the order in which ``df`` adds them up when it is computed again.
    """
    df = materialize(df)
    scored = df.filter(F.col(score).isNotNull() & ~F.isnan(score))
    ties = scored.groupBy(score).agg(F.count(F.lit(1)).alias("TIES"))
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    cuts = scored.agg(F.percentile_approx(score, shares, 50 * ranges).alias("CUTS")).scalar()
    cut = ties.withColumn("CUTS", cuts).withColumn("RANGE", F.size(F.filter("CUTS", lambda c: c <= F.col(score))))
    # One row per range, so this window and the broadcast are bounded by the number of ranges.
    sizes = cut.groupBy("RANGE").agg(F.sum("TIES").alias("RANGE_ROWS"))
    start = F.sum("RANGE_ROWS").over(_descending(Window.orderBy(F.desc("RANGE"))))
    starts = sizes.select("RANGE", F.coalesce(start, F.lit(0)).alias("RANGE_START"))
    within = F.sum("TIES").over(_descending(Window.partitionBy("RANGE").orderBy(F.desc(score))))
    above = F.col("RANGE_START") + F.coalesce(within, F.lit(0))
    whole_rank = (above + 1 + F.floor((F.col("TIES") - 1) / 2)).cast("int")
    ranks = cut.join(F.broadcast(starts), "RANGE").select(F.col(score).alias("RANKED_SCORE"), whole_rank.alias(rank))
    return df.join(ranks, df[score] == ranks["RANKED_SCORE"], "left").drop("RANKED_SCORE")


def _descending(ordered: Window) -> Window:
    return ordered.rowsBetween(Window.unboundedPreceding, -1)


def composite_ranking(
    combined: DataFrame,
    weights: Mapping[str, float] = WEIGHTS_B,
    drop_bad_income: bool = True,
) -> DataFrame:
    """Scores, weighted total and rank for every place.

    ``combined`` is read twice, for the extremes and for the rows: pass a stored or materialized frame.
    """
    places = with_good_income(combined) if drop_bad_income else combined
    scored = min_max_scores(places).withColumn("OVERALL_SCORE", weighted_score(weights))
    return average_rank(scored)
