"""Global order without a single-task sort window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statquarry.functions.parsing import first_token
from statquarry.operators.shape import q

_BLOCKS = 1_000


def running_number(df: DataFrame, page: str, position: str, name: str = "scrape_order", start: int = 1) -> DataFrame:
    """Gap-free numbers over ``(page, position)`` order, ``page`` numeric.

    Rows are numbered inside their page; pages get offsets from row counts.  Offsets are prefix sums over pages, taken
    in two levels: pages fall into at most a thousand blocks of about equal page counts, one window runs inside
    each block and one over the block totals.  No window ever sees more than one page, one block of page counts or
    the thousand block totals.
    """
    per_page = df.groupBy(q(page).alias("__page")).agg(F.count("*").alias("__n"))
    cuts = per_page.approxQuantile("__page", [i / _BLOCKS for i in range(1, _BLOCKS)], 1 / (4 * _BLOCKS))
    edges = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<double>")
    block = F.size(F.filter(edges, lambda e: e <= F.col("__page")))
    per_page = per_page.withColumn("__block", block)

    earlier = (Window.unboundedPreceding, -1)
    totals = per_page.groupBy("__block").agg(F.sum("__n").alias("__total"))
    block_offset = totals.select(
        "__block",
        F.coalesce(F.sum("__total").over(Window.orderBy("__block").rowsBetween(*earlier)), F.lit(0)).alias("__before"),
    )
    in_block = Window.partitionBy("__block").orderBy("__page").rowsBetween(*earlier)
    offsets = (
        per_page.withColumn("__inside", F.coalesce(F.sum("__n").over(in_block), F.lit(0)))
        .join(F.broadcast(block_offset), "__block")  # at most a thousand rows
        .select("__page", (F.col("__before") + F.col("__inside")).alias("__offset"))
    )
    in_page = F.row_number().over(Window.partitionBy(q(page)).orderBy(q(position)))
    return (
        df.withColumn("__in_page", in_page)
        .join(offsets, q(page) == F.col("__page"))
        .withColumn(name, (F.col("__offset") + F.col("__in_page") + F.lit(start - 1)).cast("bigint"))
        .drop("__page", "__offset", "__in_page")
    )


def sort_by_first_name(df: DataFrame, name: str, row_no: str) -> DataFrame:
    """Order by lower-case first name, then input order (range-partitioned sort; ties spread over ``row_no``)."""
    return df.orderBy(F.lower(first_token(q(name))), q(row_no))
