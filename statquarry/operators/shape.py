"""Projection, filters, schema contracts and the decisions about which columns are metrics."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from statquarry.functions.parsing import (
    MISSING,
    NA_TOKENS,
    PLACEHOLDER_NAMES,
    clean_num,
    null_tokens,
    num,
    safe_int,
    strip_percent,
    strip_space,
)
from statquarry.operators.longform import as_number, is_numeric


def q(name: str) -> Column:
    """Column by literal name; stat headers hold dots, colons and blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


# ---- projection and schema ----------------------------------------------------------------------------------
def export_projection(
    df: DataFrame, fields: Sequence[tuple[str, str]], default: str = MISSING, keep: Sequence[str] = ()
) -> DataFrame:
    """Ordered output columns from ``(header, field)`` pairs, after the columns in ``keep``.

    A field may feed several headers; a field the input lacks, and a NULL cell, give ``default``.
    """
    have = set(df.columns)
    return df.select(
        *[q(c) for c in keep],
        *[
            (F.coalesce(q(field).cast("string"), F.lit(default)) if field in have else F.lit(default)).alias(header)
            for header, field in fields
        ]
    )


def rename_select(df: DataFrame, renames: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """Rename, then keep the listed columns that exist, in list order."""
    renamed = df.withColumnsRenamed(dict(renames))
    return renamed.select(*[q(c) for c in columns if c in renamed.columns])


def require_columns(df: DataFrame, required: Iterable[str], wanted: Sequence[str] = ()) -> list[str]:
    """Fail on a missing required column before any job runs; return the wanted columns that exist."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return [c for c in wanted if c in df.columns]


def backfill_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add absent columns as typed NULLs (``{name: type}``)."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def drop_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def choose_columns(
    columns: Iterable[str], exclude: Iterable[str] = (), prefix: str = "", contains: str = ""
) -> list[str]:
    """Columns by exclude list, prefix and substring, in their own order."""
    excluded = set(exclude)
    return [c for c in columns if c not in excluded and c.startswith(prefix) and contains in c]


def union_aligned(top: DataFrame, bottom: DataFrame) -> DataFrame:
    """Rows of both; a column one side lacks is NULL there."""
    return top.unionByName(bottom, allowMissingColumns=True)


def field_sets(df: DataFrame, wanted: Iterable[str]) -> tuple[set[str], set[str]]:
    """(present, missing) of the wanted fields."""
    have, want = set(df.columns), set(wanted)
    return want & have, want - have


# ---- row filters --------------------------------------------------------------------------------------------
def drop_placeholders(df: DataFrame, entity: str, placeholders: Sequence[str] = PLACEHOLDER_NAMES) -> DataFrame:
    name = q(entity)
    return df.where(name.isNotNull() & ~strip_space(name).isin(list(placeholders)))


def min_threshold(df: DataFrame, column: str, limit: int = 90) -> DataFrame:
    """Rows strictly above ``limit``; unreadable counts as 0."""
    return df.where(safe_int(q(column)) > F.lit(limit))


def eligible(df: DataFrame, column: str, limit: float = 900, inclusive: bool = False) -> DataFrame:
    """Rows at or above the limit; unreadable rows drop out."""
    value = as_number(df, column)
    return df.where(value >= F.lit(limit) if inclusive else value > F.lit(limit))


# ---- cleaning -----------------------------------------------------------------------------------------------
def null_missing(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Missing-value tokens of every text column to NULL."""
    return df.select(*[null_tokens(q(c), tokens).alias(c) if t == "string" else q(c) for c, t in df.dtypes])


def percent_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Text columns whose name holds ``%`` and where at least one value does; one aggregate for all of them."""
    named = [c for c in columns if "%" in c and not is_numeric(df, c)]
    if not named:
        return []
    row = df.agg(*[F.bool_or(q(c).contains("%")).alias(f"c{i}") for i, c in enumerate(named)]).first()
    return [c for i, c in enumerate(named) if row[i]]


def clean_columns(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Drop thousands commas in the metric columns and convert those where *every* value converts.

    Columns outside ``metrics`` keep their commas (a position such as ``'MF,FW'`` is not a number).
    """
    text = [c for c in metrics if not is_numeric(df, c)]
    whole = set(discover_metrics(df, text, "strict"))
    return df.select(
        *[
            (clean_num(q(c)) if c in whole else F.replace(q(c), F.lit(","), F.lit(""))).alias(c) if c in text else q(c)
            for c in df.columns
        ]
    )


def coerce_all(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Every listed column to double, kept even when nothing in it parses."""
    percent = set(percent_columns(df, metrics))
    return df.withColumns(
        {m: as_number(df, m, lambda c: clean_num(strip_percent(c)) if m in percent else clean_num(c)) for m in metrics}
    )


def fill_defaults(df: DataFrame, numeric: Sequence[str], categories: Sequence[str], label: str = "Missing") -> DataFrame:
    return df.na.fill(0.0, list(numeric)).na.fill(label, list(categories))


# ---- column profiles and metric discovery -------------------------------------------------------------------
def column_profile(df: DataFrame, columns: Sequence[str], parse: Callable[[str], Column] = clean_num) -> DataFrame:
    """``column, n_rows, n_present, n_numeric, n_null, null_ratio, all_null, any_valid``.

    One aggregate over one scan decides every column; its single row is then turned on its side.
    """
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count(q(c)).alias(f"p{i}") for i, c in enumerate(columns)],
        *[F.count(as_number(df, c, parse)).alias(f"v{i}") for i, c in enumerate(columns)],
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col("rows").alias("n_rows"),
                F.col(f"p{i}").alias("n_present"),
                F.col(f"v{i}").alias("n_numeric"),
            )
            for i, c in enumerate(columns)
        ]
    )
    absent = F.col("n_rows") - F.col("n_present")
    return counts.select(F.inline(cells)).select(
        "column", "n_rows", "n_present", "n_numeric",
        absent.alias("n_null"),
        (absent / F.nullif(F.col("n_rows"), F.lit(0))).alias("null_ratio"),
        (F.col("n_present") == 0).alias("all_null"),
        (F.col("n_numeric") > 0).alias("any_valid"),
    )


def metric_rules(profile: DataFrame, ratio: float = 0.7) -> DataFrame:
    """The three discovery rules per column.

    ``any``: at least one value parses.  ``strict``: no present value fails to parse.  ``ratio``: more than
    ``ratio`` of all rows parse.
    """
    return profile.select(
        "column", "n_present", "n_numeric",
        (F.col("n_numeric") > 0).alias("any"),
        (F.col("n_numeric") == F.col("n_present")).alias("strict"),
        (F.coalesce(F.col("n_numeric") / F.nullif(F.col("n_rows"), F.lit(0)), F.lit(0.0)) > ratio).alias("ratio"),
    )


def discover_metrics(df: DataFrame, columns: Sequence[str], rule: str = "any", ratio: float = 0.7) -> list[str]:
    """Names of the metric columns under one rule, in input order."""
    if not columns:
        return []
    parse = num if rule == "strict_raw" else clean_num
    chosen = metric_rules(column_profile(df, columns, parse), ratio).where(q("strict" if rule == "strict_raw" else rule))
    hits = {row["column"] for row in chosen.select("column").collect()}
    return [c for c in columns if c in hits]


def mostly_null_columns(df: DataFrame, columns: Sequence[str], limit: float = 0.5) -> list[str]:
    rows = column_profile(df, columns).where(F.col("null_ratio") > limit).select("column").collect()
    return [row["column"] for row in rows]


def observed(df: DataFrame, name: str, stages: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """The same rows with counters that fill in while the next action runs; no job of their own."""
    seen = Observation(name)
    return df.observe(seen, *[F.count_if(cond).alias(stage) for stage, cond in stages.items()]), seen


def metric_cardinality(long: DataFrame, approx: bool = False) -> DataFrame:
    """``metric, n_distinct, is_constant``; values are deduplicated map-side and across tasks before counting.

    ``approx`` counts with a sketch of fixed size instead of exchanging the distinct values.
    """
    if approx:
        present = long.where(F.col("value").isNotNull())
        return present.groupBy("metric").agg(
            F.approx_count_distinct("value").alias("n_distinct"), (F.min("value") == F.max("value")).alias("is_constant")
        )
    return (
        long.where(F.col("value").isNotNull()).groupBy("metric", "value").agg(F.lit(1).alias("one"))
        .groupBy("metric")
        .agg(F.count("*").alias("n_distinct"), (F.min("value") == F.max("value")).alias("is_constant"))
    )


def category_long(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """``column, value, first_seen`` per distinct category value."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("string").alias("value")) for c in columns])
    return (
        df.select(q(order).alias("seen"), F.inline(cells))
        .groupBy("column", "value").agg(F.count("*").alias("n"), F.min("seen").alias("first_seen"))
    )


def category_sample(df: DataFrame, columns: Sequence[str], order: str, k: int = 10) -> DataFrame:
    """``column, sample``: the first ``k`` distinct values in order of appearance."""
    by_age = Window.partitionBy("column").orderBy("first_seen", "value")
    first = category_long(df, columns, order).withColumn("rank", F.row_number().over(by_age)).where(F.col("rank") <= k)
    entries = F.sort_array(F.collect_list(F.struct("rank", "value")))
    return first.groupBy("column").agg(F.transform(entries, lambda e: e["value"]).alias("sample"))


def stage_counts(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """``stage, n_rows``: rows passing each named condition, in one aggregate."""
    row = df.agg(*[F.count_if(cond).alias(f"s{i}") for i, cond in enumerate(stages.values())])
    cells = F.array(
        *[F.struct(F.lit(n).alias("stage"), F.col(f"s{i}").alias("n_rows")) for i, n in enumerate(stages)]
    )
    return row.select(F.inline(cells))
