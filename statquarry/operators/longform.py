"""Wide table to the canonical long metric table.

``long(row_no, entity, grp, metric, value)`` lets one aggregate or one window serve every metric at once instead of
one pass per metric column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statquarry.functions.parsing import clean_num, finite

NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def is_numeric(df: DataFrame, column: str) -> bool:
    kind = dict(df.dtypes)[column]
    return kind in NUMERIC or kind.startswith("decimal")


def as_number(df: DataFrame, column: str, parse: Callable[[str], Column] = clean_num) -> Column:
    """Numeric columns pass through (without NaN); text columns go through ``parse``."""
    return finite(column) if is_numeric(df, column) else parse(column)


def to_long(
    df: DataFrame,
    metrics: Sequence[str],
    entity: str,
    group: str | None = None,
    row_no: str | None = None,
    parse: Callable[[str], Column] = clean_num,
) -> DataFrame:
    """One row per (input row, metric); ``value`` is a finite double or NULL.

    The metric columns are unpivoted by a generator over a literal-sized array, a narrow step: no shuffle.
    """
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), as_number(df, m, parse).alias("value")) for m in metrics])
    keys = [F.col(f"`{entity}`").alias("entity")]
    if row_no is not None:
        keys.insert(0, F.col(f"`{row_no}`").alias("row_no"))
    if group is not None:
        keys.append(F.col(f"`{group}`").alias("grp"))
    return df.select(*keys, F.inline(cells))
