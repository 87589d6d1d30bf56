"""Median, mean and sample deviation overall and per group, and the leader boards made from group means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statquarry.functions.parsing import leader_text
from statquarry.operators.quantiles import describe

ALL_ROWS = "all"


def _summary(rows: DataFrame, keys: Sequence[str], approx: bool) -> DataFrame:
    if approx:
        # bounded sketch: one pass, rank error below one in ten thousand
        return rows.groupBy(*keys).agg(
            F.percentile_approx("value", 0.5, 10_000).alias("median"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.count("value").alias("n"),
        )
    return describe(rows, keys).select(*keys, F.col("q0").alias("median"), "mean", "std", "n")


def overall_stats(long: DataFrame, approx: bool = False) -> DataFrame:
    """``metric, median, mean, std, n`` over all rows."""
    return _summary(long.select("metric", "value"), ["metric"], approx)


def group_stats(long: DataFrame, approx: bool = False) -> DataFrame:
    """The same per (metric, group); rows without a group are left out."""
    rows = long.where(F.col("grp").isNotNull()).select("metric", "grp", "value")
    return _summary(rows, ["metric", "grp"], approx)


def stats_with_all(long: DataFrame, approx: bool = False) -> DataFrame:
    """Overall rows (``is_all``) and group rows in one result.

    A row without a group counts in the overall row only.  Both levels go through the same narrowing passes: each
    input row is seen at two levels and collapses map-side before any shuffle.
    """
    overall = F.struct(F.lit(True).alias("is_all"), F.lit(ALL_ROWS).alias("grp"))
    own = F.struct(F.lit(False).alias("is_all"), F.col("grp").cast("string").alias("grp"))
    levels = F.when(F.col("grp").isNull(), F.array(overall)).otherwise(F.array(overall, own))
    rows = long.select("metric", "value", F.inline(levels))
    return _summary(rows, ["is_all", "grp", "metric"], approx)


def stats_wide(stats: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One row per group, ``Median of X``, ``Mean of X``, ``Std of X`` per metric.

    Works on the small statistics table; the metric list is given, so the pivot needs no extra pass.
    """

    def pick(metric: str, statistic: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col(statistic)))

    cells = [
        pick(metric, statistic).alias(f"{statistic.capitalize()} of {metric}")
        for metric in metrics
        for statistic in ("median", "mean", "std")
    ]
    return stats.groupBy("is_all", "grp").agg(*cells)


def group_means(long: DataFrame) -> DataFrame:
    """``metric, grp, mean``; a plain partial aggregate."""
    return long.where(F.col("grp").isNotNull()).groupBy("metric", "grp").agg(F.avg("value").alias("mean"))


def leaders(means: DataFrame, lowest_wins: Sequence[str] = ()) -> DataFrame:
    """Best group per metric, ``metric, grp, mean``; first group name on ties, no group when no mean exists."""
    merit = F.when(F.col("metric").isin(list(lowest_wins)), -F.col("mean")).otherwise(F.col("mean"))
    best_first = Window.partitionBy("metric").orderBy(F.desc_nulls_last(merit), "grp")
    return (
        means.withColumn("rank", F.row_number().over(best_first))
        .where("rank = 1")
        .select("metric", F.when(F.col("mean").isNotNull(), F.col("grp")).alias("grp"), "mean")
    )


def leader_texts(best: DataFrame) -> DataFrame:
    text = F.coalesce(leader_text("grp", "mean"), F.lit("N/A"))
    return best.select("metric", text.alias("leader"))


def leader_counts(best: DataFrame) -> DataFrame:
    """How many metrics each group leads.  Metrics without a leader count for nobody."""
    return best.where(F.col("grp").isNotNull()).groupBy("grp").agg(F.count("*").alias("times_leading"))


def top_group(best: DataFrame) -> DataFrame:
    """The group leading most metrics, first name on ties."""
    return leader_counts(best).orderBy(F.desc("times_leading"), "grp").limit(1)


def key_metric_report(means: DataFrame, key_metrics: Sequence[str], lowest_wins: Sequence[str] = ()) -> DataFrame:
    """Leader of each listed metric in list order; a metric absent from the data stays with status ``missing``.

    The list is an argument, a handful of literals, so the small side is the list itself.
    """
    spark = means.sparkSession
    wanted = spark.createDataFrame(
        [(i + 1, m, "lowest" if m in lowest_wins else "highest") for i, m in enumerate(key_metrics)],
        "position int, metric string, side string",
    )
    best = leaders(means.where(F.col("metric").isin(list(key_metrics))), lowest_wins).withColumn("seen", F.lit(True))
    status = F.when(F.col("seen").isNull(), "missing").when(F.col("grp").isNull(), "no data").otherwise("ok")
    return wanted.join(best, "metric", "left").select(
        "position", "metric", "side", "grp", "mean", status.alias("status")
    )
