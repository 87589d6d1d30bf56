"""Exact quantiles (and moments) per group without gathering a group anywhere.

``percentile`` / ``median`` keep every distinct value of a group in one aggregation buffer, which for a group that
holds a third of a huge table does not fit a task.  Here a quantile is found by narrowing a value range:

1. count rows per logarithmic bucket of the value (sixteen buckets per power of two),
2. count rows per 65,536th of the buckets that hold a wanted rank,
3. count rows per distinct value inside the slice that holds it.

Each step reads the input with only the key and value columns, keeps the few matching rows by a join with a small
"wanted" table, and shuffles map-side aggregated counts, never rows.  Windows run over counts.  Moments are merged
from per-bucket mean and squared deviation, so they come out of step 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statquarry.session import small_join

_PER_OCTAVE = 16
_OFFSET = 20_000  # above the largest |log2(double)| * _PER_OCTAVE
_NULL_BUCKET = 100_000  # sorts after every value bucket
_SLICES = 65_536


def _bucket(value: Column) -> Column:
    """Order-preserving bucket number of a finite double."""
    magnitude = (F.floor(F.log2(F.abs(value)) * _PER_OCTAVE) + _OFFSET).cast("int")
    return (
        F.when(value > 0, magnitude).when(value < 0, -magnitude).when(value == 0, F.lit(0))
        .otherwise(F.lit(_NULL_BUCKET))
    )


def _anchor(bucket: Column) -> Column:
    """Lower end (towards zero) of a bucket; deviations from it sum up without losing digits of large values."""
    size = F.pow(F.lit(2.0), (F.abs(bucket) - _OFFSET) / F.lit(float(_PER_OCTAVE)))
    return F.when((bucket == 0) | (bucket == _NULL_BUCKET), F.lit(0.0)).otherwise(F.signum(bucket) * size)


def _slice(value: Column, low: Column, high: Column) -> Column:
    position = F.floor((value - low) / (high - low) * _SLICES).cast("int")
    return F.when((high > low) & value.isNotNull(), position).otherwise(F.lit(0))


def _position(q: float) -> Column:
    """Fractional zero-based rank of quantile ``q`` among ``n`` values."""
    return F.lit(float(q)) * (F.col("n") - 1)


def _holds_rank(probs: Sequence[float], start: Column, count: Column) -> Column:
    """Whether ranks ``start .. start + count - 1`` include one that a quantile needs (rank 0 when all is NULL)."""
    hit = (F.col("n") == 0) & (start == 0)
    for q in probs:
        for rank in (F.floor(_position(q)), F.ceil(_position(q))):
            hit = hit | ((rank >= start) & (rank < start + count))
    return hit


def describe(
    rows: DataFrame, keys: Sequence[str], probs: Sequence[float] = (0.5,), value: str = "value"
) -> DataFrame:
    """``keys, n, mean, std, min, max, q0, q1, …`` with exact linear-interpolated quantiles.

    ``std`` is the sample deviation, NULL for a single value.  A key whose values are all NULL keeps a row with
    ``n = 0`` and NULL statistics.  Key columns may be NULL.
    """
    keys = list(keys)
    rows = rows.select(*keys, F.col(value).cast("double").alias("v"), _bucket(F.col(value).cast("double")).alias("b"))

    offset = F.col("v") - _anchor(F.col("b"))
    profile = rows.groupBy(*keys, "b").agg(
        F.count("*").alias("c"),
        F.count("v").alias("nb"),
        F.avg(offset).alias("mb"),
        F.var_pop(offset).alias("vb"),
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
    )
    profile = profile.withColumn("mb", F.col("mb") + _anchor(F.col("b")))
    per_key = Window.partitionBy(*keys)
    n = F.sum("nb").over(per_key)
    running = per_key.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ["n", "mean", "ss", "low", "high"]  # constants of a key, carried along by the small tables
    wanted = (
        profile.withColumns(
            {
                "n": n,
                "mean": F.sum(F.col("nb") * F.col("mb")).over(per_key) / F.nullif(n, F.lit(0)),
                "before": F.sum("c").over(running) - F.col("c"),
                "low": F.min("lo").over(per_key),
                "high": F.max("hi").over(per_key),
            }
        )
        .withColumn(
            "ss", F.sum(F.col("nb") * (F.col("vb") + F.pow(F.col("mb") - F.col("mean"), F.lit(2.0)))).over(per_key)
        )
        .where(_holds_rank(probs, F.col("before"), F.col("c")))
        .select(*keys, "b", "lo", "hi", "before", *whole)
    )

    inside = small_join(rows, wanted, [*keys, "b"], null_safe=True).withColumn("s", _slice(F.col("v"), F.col("lo"), F.col("hi")))
    sliced = inside.groupBy(*keys, "b", "s").agg(
        F.count("*").alias("c"), *[F.any_value(x).alias(x) for x in ("before", "lo", "hi", *whole)]
    )
    running = Window.partitionBy(*keys, "b").orderBy("s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = (
        sliced.withColumn("start", F.col("before") + F.sum("c").over(running) - F.col("c"))
        .where(_holds_rank(probs, F.col("start"), F.col("c")))
        .select(*keys, "b", "s", "start", "lo", "hi", *whole)
    )

    inside = small_join(rows, wanted, [*keys, "b"], null_safe=True).where(_slice(F.col("v"), F.col("lo"), F.col("hi")) == F.col("s"))
    valued = inside.groupBy(*keys, "b", "s", "v").agg(
        F.count("*").alias("c"), *[F.any_value(x).alias(x) for x in ("start", *whole)]
    )
    running = Window.partitionBy(*keys, "b", "s").orderBy("v")
    running = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    picked = valued.withColumn("first", F.col("start") + F.sum("c").over(running) - F.col("c")).where(
        _holds_rank(probs, F.col("first"), F.col("c"))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("first")) & (rank < F.col("first") + F.col("c")), F.col("v")))

    ends = [
        end
        for i, q in enumerate(probs)
        for end in (at(F.floor(_position(q))).alias(f"low{i}"), at(F.ceil(_position(q))).alias(f"high{i}"))
    ]
    found = picked.groupBy(*keys).agg(*[F.any_value(x).alias(x) for x in whole], *ends)

    def interpolated(i: int, q: float) -> Column:
        low, high = F.col(f"low{i}"), F.col(f"high{i}")
        return low + (high - low) * (_position(q) - F.floor(_position(q)))

    return found.select(
        *keys,
        "n",
        "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("ss") / (F.col("n") - 1))).alias("std"),
        F.col("low").alias("min"),
        F.col("high").alias("max"),
        *[interpolated(i, q).alias(f"q{i}") for i, q in enumerate(probs)],
    )
