"""Top and bottom entities per metric, and the text report made from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---- fixed values: report wording ---------------------------------------------------------------------------
HEADING = "Metric: "
NO_DATA = "No valid data"
ALL_EQUAL = "All entities share the value: "
TOP_TITLE = "Highest {k} entities:"
BOTTOM_TITLE = "Lowest {k} entities:"
INDENT = "   "
# -------------------------------------------------------------------------------------------------------------


def metric_flags(long: DataFrame) -> DataFrame:
    """``metric, n, is_constant``; constant means one distinct value, found from min and max."""
    return long.groupBy("metric").agg(
        F.count("value").alias("n"),
        F.coalesce(F.min("value") == F.max("value"), F.lit(False)).alias("is_constant"),
    )


def ranked_entities(long: DataFrame, k: int = 3, side: str = "top") -> DataFrame:
    """``metric, side, rank, entity, value, is_constant`` for the ``k`` best (or worst) rows per metric.

    NULL values do not compete.  Ties go by entity, then ``row_no``.  A constant metric lists its first ``k`` rows
    in input order instead.  The rank filter becomes a partial and a final group limit, so every task forwards at
    most ``k`` rows per metric, however many rows a metric has.
    """
    # one row per metric, that is per column of the wide table: always small enough to broadcast
    flags = F.broadcast(metric_flags(long).select("metric", "is_constant"))
    rows = long.where(F.col("value").isNotNull()).join(flags, "metric")
    merit = -F.col("value") if side == "top" else F.col("value")
    order: list[Column] = [
        F.when(F.col("is_constant"), F.lit(0.0)).otherwise(merit),
        F.when(F.col("is_constant"), F.lit("")).otherwise(F.col("entity")),
        F.col("row_no"),
    ]
    return (
        rows.withColumn("rank", F.row_number().over(Window.partitionBy("metric").orderBy(*order)))
        .where(F.col("rank") <= k)
        .select("metric", F.lit(side).alias("side"), "rank", "entity", "value", "is_constant")
    )


def top_and_bottom(long: DataFrame, k: int = 3) -> DataFrame:
    return ranked_entities(long, k, "top").unionByName(ranked_entities(long, k, "bottom"))


def number_text(value: Column, integer: Column) -> Column:
    """Whole-number metrics print without a decimal point, the others as plain decimals with at least one place."""
    plain = F.regexp_replace(value.cast("decimal(38,10)").cast("string"), r"(\.\d+?)0+$", "$1")
    text = F.when((F.abs(value) >= 1e7) & (F.abs(value) < 1e16), plain).otherwise(value.cast("string"))
    return F.when(integer, value.cast("bigint").cast("string")).otherwise(text)


def topk_report(long: DataFrame, k: int = 3, integer_metrics: Sequence[str] = ()) -> DataFrame:
    """``metric, block``: one text block per metric, ready for a text sink.

    At most ``2k`` ranked rows per metric are collected into a block.
    """
    integer = F.col("metric").isin(list(integer_metrics))
    line = F.concat(F.lit(INDENT), F.col("entity"), F.lit(": "), number_text(F.col("value"), integer))
    listed = top_and_bottom(long, k).withColumn("line", line)

    def lines(side: str) -> Column:
        entries = F.collect_list(F.when(F.col("side") == side, F.struct("rank", "line")))
        return F.array_join(F.transform(F.sort_array(entries), lambda e: e["line"]), "\n")

    blocks = listed.groupBy("metric").agg(
        lines("top").alias("top"),
        lines("bottom").alias("bottom"),
        F.any_value(F.when(F.col("is_constant"), number_text(F.col("value"), integer))).alias("constant"),
    )
    heading = F.concat(F.lit(HEADING), F.col("metric"), F.lit("\n"))
    body = F.concat(
        F.coalesce(F.concat(F.lit(ALL_EQUAL), F.col("constant"), F.lit("\n")), F.lit("")),
        F.lit(TOP_TITLE.format(k=k) + "\n"), F.col("top"), F.lit("\n"),
        F.lit(BOTTOM_TITLE.format(k=k) + "\n"), F.col("bottom"), F.lit("\n"),
    )
    return (
        metric_flags(long).select("metric").join(blocks, "metric", "left")
        .select("metric", F.concat(heading, F.coalesce(body, F.lit(NO_DATA + "\n"))).alias("block"))
    )
