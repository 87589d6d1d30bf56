"""Histogram and density tables (what a chart of them would show)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statquarry.operators.quantiles import describe
from statquarry.session import materialise, small_join

GRID_POINTS = 200
_REACH = 39.0  # exp(-z * z / 2) is exactly 0.0 in double precision from |z| = 38.7 on


def _count_bins(rows: DataFrame, bounds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, bin, bin_from, bin_to, n`` from per-key ``lo, hi, bins``; empty bins included, last bin closed.

    Counts are reduced map-side to at most ``bins`` rows per key and task; the bounds side is one row per key.
    """
    bounds = materialise(bounds)
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    index = F.least(F.floor((F.col("value") - F.col("lo")) / width) + 1, F.col("bins")).cast("int")
    counts = small_join(rows, bounds, keys).groupBy(*keys, index.alias("bin")).agg(F.count("*").alias("n"))
    spine = bounds.select(*keys, "lo", width.alias("width"), F.explode(F.sequence(F.lit(1), F.col("bins"))).alias("bin"))
    return spine.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin",
        (F.col("lo") + (F.col("bin") - 1) * F.col("width")).alias("bin_from"),
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_to"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def _filled(long: DataFrame, fill: float | None, *keys: str) -> DataFrame:
    value = F.col("value") if fill is None else F.coalesce("value", F.lit(fill))
    return long.select(*keys, value.alias("value")).where(F.col("value").isNotNull())


def _range(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))


def histogram_fixed(long: DataFrame, bins: int = 15, fill: float | None = 0.0) -> DataFrame:
    """Equal-width bins per metric over all rows; NULL counts as ``fill``; constant metrics are left out."""
    rows = _filled(long, fill, "metric")
    bounds = _range(rows, ["metric"]).where(F.col("lo") < F.col("hi")).withColumn("bins", F.lit(bins))
    return _count_bins(rows, bounds, ["metric"])


def histogram_by_group(long: DataFrame, bins: int = 15, fill: float | None = 0.0) -> DataFrame:
    """Equal-width bins per (metric, group), each over the group's own range.

    A constant group gets a range of one unit around its value.  Metrics constant over all rows are left out.
    """
    keys = ["metric", "grp"]
    rows = _filled(long, fill, *keys)
    overall = Window.partitionBy("metric")  # over one row per group
    own = _range(rows, keys).withColumn("varies", F.min("lo").over(overall) < F.max("hi").over(overall))
    flat = F.col("lo") == F.col("hi")
    bounds = own.where(F.col("varies") & F.col("grp").isNotNull()).select(
        *keys,
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        F.lit(bins).alias("bins"),
    )
    return _count_bins(rows, bounds, keys)


def histogram_auto(
    long: DataFrame, fill: float | None = 0.0, integer_metrics: Sequence[str] = (), limit_bins: bool = False
) -> DataFrame:
    """Bin count chosen per metric: the smaller of the Freedman-Diaconis and Sturges widths.

    With no inter-quartile range Sturges alone decides; whole-number metrics get a width of at least one.
    ``limit_bins`` adds the newer rule that the width is no smaller than half the square-root rule's.  The
    quartiles are exact.  A constant metric gives one bin of one unit around its value.
    """
    rows = _filled(long, fill, "metric")
    facts = describe(rows, ["metric"], probs=(0.25, 0.75))
    spread, n = F.col("max") - F.col("min"), F.col("n")
    rice = F.lit(2.0) * (F.col("q1") - F.col("q0")) / F.pow(n.cast("double"), F.lit(1 / 3))
    sturges = spread / (F.log2(n.cast("double")) + 1.0)
    if limit_bins:
        width = F.least(F.greatest(rice, spread / F.sqrt(n.cast("double")) / 2.0), sturges)
    else:
        width = F.when(rice > 0, F.least(rice, sturges)).otherwise(sturges)
    width = F.when(F.col("metric").isin(list(integer_metrics)), F.greatest(width, F.lit(1.0))).otherwise(width)
    flat = spread == 0
    bounds = facts.select(
        "metric",
        F.when(flat, F.col("min") - 0.5).otherwise(F.col("min")).alias("lo"),
        F.when(flat, F.col("max") + 0.5).otherwise(F.col("max")).alias("hi"),
        F.when(flat, F.lit(1)).otherwise(F.greatest(F.ceil(spread / width), F.lit(1))).cast("int").alias("bins"),
    )
    return _count_bins(rows, bounds, ["metric"])


def kde_curve(long: DataFrame, bins: int = 15, fill: float | None = 0.0, points: int = GRID_POINTS) -> DataFrame:
    """``metric, point, x, density``: Gaussian density on an even grid, scaled to the histogram's counts.

    Bandwidth is the sample deviation times ``n ** (-1/5)``.  Equal values are merged first.  Each distinct value then
    meets only the grid points where its kernel is not exactly zero in double precision - a share of the fixed grid
    that shrinks as ``n`` grows - and contributions are summed map-side, so at most ``points`` rows per metric leave
    a task.
    """
    rows = _filled(long, fill, "metric")
    facts = (
        rows.groupBy("metric")
        .agg(
            F.count("*").alias("n"), F.stddev_samp("value").alias("sd"),
            F.min("value").alias("lo"), F.max("value").alias("hi"),
        )
        .where(F.col("lo") < F.col("hi"))
        .select(
            "metric", "n", "lo", "hi",
            (F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("h"),
            ((F.col("hi") - F.col("lo")) / (points - 1)).alias("step"),
        )
    )

    def grid(offset: Column) -> Column:
        return (F.col("value") + offset * _REACH * F.col("h") - F.col("lo")) / F.col("step")

    first = F.greatest(F.ceil(grid(F.lit(-1.0))), F.lit(0)).cast("int")
    last = F.least(F.floor(grid(F.lit(1.0))), F.lit(points - 1)).cast("int")
    x = F.col("lo") + F.col("point") * F.col("step")
    counted = rows.groupBy("metric", "value").agg(F.count("*").alias("c"))
    bumps = (
        counted.join(F.broadcast(facts), "metric")  # one row per metric
        .select("metric", "value", "c", "lo", "step", "h", F.explode(F.sequence(first, last)).alias("point"))
        .groupBy("metric", "point")
        .agg(F.sum(F.col("c") * F.exp(-0.5 * F.pow((x - F.col("value")) / F.col("h"), F.lit(2.0)))).alias("bump"))
    )
    spine = facts.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    norm = F.col("h") * F.sqrt(F.lit(2.0) * F.pi())
    bin_width = (F.col("hi") - F.col("lo")) / bins
    # density * n * bin width, where density = bump / (n * norm)
    return spine.join(bumps, ["metric", "point"], "left").select(
        "metric", "point", x.alias("x"), (F.coalesce("bump", F.lit(0.0)) / norm * bin_width).alias("density")
    )
