"""Equality joins: update-join, suffixed right join, semi joins by name, lookup with fallback.

No join here is hinted: the planner broadcasts a side only below its size threshold and otherwise shuffles both.  The side
that could multiply rows is reduced to one row per key beforehand; ``splittable_join`` keeps hot keys of the other side
splittable by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statquarry.functions.parsing import MISSING, name_key, strip_space
from statquarry.operators.shape import q
from statquarry.session import splittable_join


def latest_details(details: Sequence[tuple[DataFrame, Sequence[str]]], key: str, row_no: str) -> DataFrame:
    """One row per key: for each detail table the struct ``d<i>`` of its last row, NULL when it has none.

    All detail tables are stacked and reduced by one aggregate, so they cost one shuffle together.  ``max_by`` combines
    map-side: a key that holds a third of all rows leaves each task as one row.
    """
    stacked = None
    for i, (detail, fields) in enumerate(details):
        values = F.struct(*[q(f).alias(f) for f in fields]).alias(f"d{i}")
        part = detail.where(q(key).isNotNull()).select(q(key).alias(key), q(row_no).alias("seen"), values)
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked.groupBy(q(key)).agg(
        *[
            F.max_by(q(f"d{i}"), F.when(q(f"d{i}").isNotNull(), q("seen"))).alias(f"d{i}")
            for i in range(len(details))
        ]
    )


def update_join(
    base: DataFrame,
    details: Sequence[tuple[DataFrame, Sequence[str]]],
    key: str,
    row_no: str = "row_no",
    default: str | None = MISSING,
) -> DataFrame:
    """Overwrite fields of every base row that has the key in a detail table.

    ``details`` are ``(table, fields)`` in order of application.  Within a table the last row of a key wins, for
    every base row of that key; a later table wins over an earlier one.  A matched row writes even its absent cells
    (as ``default``); an unmatched base row keeps its old values.  New fields of unmatched rows stay NULL.
    """
    joined = splittable_join(base, latest_details(details, key, row_no), [key], "left")
    values: dict[str, Column] = {c: q(c) for c in base.columns}
    for i, (detail, fields) in enumerate(details):
        types = dict(detail.dtypes)
        for field in fields:
            cell = F.col(f"d{i}").getField(field)
            if default is not None and types[field] == "string":
                cell = F.coalesce(cell, F.lit(default))
            old = values.get(field, F.lit(None))
            values[field] = F.when(F.col(f"d{i}").isNotNull(), cell).otherwise(old)
    return joined.select(*[value.alias(name) for name, value in values.items()])


def right_join_suffix(left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Right equi-join; columns present on both sides get suffixes, the key stays single."""
    shared = (set(left.columns) & set(right.columns)) - {key}
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return left.join(right, key, "right")


def semi_join_exact(rows: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Rows whose trimmed name is among the allowed names."""
    names = allowed.select(strip_space(q(key)).alias("trimmed__")).distinct()
    return splittable_join(rows.withColumn("trimmed__", strip_space(q(key))), names, ["trimmed__"], "left_semi").drop("trimmed__")


def semi_join_namekey(rows: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Rows whose accent-free name key is among the allowed keys; empty keys never match.

    Names are deduplicated before folding, so Python sees each allowed name once.
    """
    keys = allowed.select(q(key).alias("name__")).distinct().select(name_key(F.col("name__")).alias("folded__"))
    keys = keys.where(F.col("folded__") != "").distinct()
    return splittable_join(rows.withColumn("folded__", name_key(q(key))), keys, ["folded__"], "left_semi").drop("folded__")


def detail_fallback(listing: DataFrame, details: DataFrame, on: str, value: str, fallback: str) -> DataFrame:
    """Listing rows with the detail table's ``value``, or the listing's own ``fallback`` where the detail has none.

    The detail table keeps its first non-NULL value per key, so listing rows never multiply.
    """
    found = details.where(q(value).isNotNull()).groupBy(q(on)).agg(F.min(q(value)).alias("detail__"))
    joined = splittable_join(listing, found, [on], "left")
    return joined.withColumn(value, F.coalesce(F.col("detail__"), q(fallback))).drop("detail__")


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(strip_space(q(key)).alias(key)).distinct()
