"""Imputation, scaling and encoding.

Fitted numbers are constants of the fitted transform: one aggregate finds them for all columns, and SQL / ML pipeline
stages apply them row by row, so applying a fitted preprocessor never shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statquarry.operators.shape import q
from statquarry.session import small_join


# ---- simple imputation and scaling --------------------------------------------------------------------------
def numeric_facts(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """``{column: (mean, population deviation after mean imputation)}`` of the columns with any value.

    Imputed cells add no squared deviation, so the deviation follows from the present values and the row count.
    """
    row = df.agg(
        F.count("*").alias("n"),
        *[f(q(c)).alias(f"{name}{i}") for i, c in enumerate(columns) for name, f in
          (("m", F.avg), ("v", F.var_pop), ("c", F.count))],
    ).first()
    return {
        c: (row[f"m{i}"], (row[f"v{i}"] * row[f"c{i}"] / row["n"]) ** 0.5)
        for i, c in enumerate(columns)
        if row[f"c{i}"]
    }


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL to the column mean; columns without any value are dropped."""
    facts = numeric_facts(df, columns)
    empty = [c for c in columns if c not in facts]
    return df.drop(*empty).withColumns({c: F.coalesce(q(c), F.lit(facts[c][0])) for c in facts})


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(value - mean) / population deviation``; a constant column becomes 0."""
    facts = numeric_facts(df, columns)
    return df.withColumns({c: _scaled(q(c), *facts[c]) for c in facts})


def _scaled(value: Column, mean: float, deviation: float) -> Column:
    return (value - F.lit(mean)) / F.lit(deviation if deviation > 0 else 1.0)


def category_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per text column, the smallest on ties.

    Values are counted as rows, not inside one aggregation buffer, so a column may have any number of them.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), q(c).alias("value")) for c in columns])
    counted = df.select(F.inline(cells)).where(F.col("value").isNotNull()).groupBy("column", "value").count()
    best = counted.groupBy("column").agg(F.min(F.struct((-F.col("count")).alias("rank"), "value")).alias("best"))
    return {r["column"]: r["best"]["value"] for r in best.collect()}


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.fill(category_modes(df, columns))


# ---- one-hot encoding and whole preprocessors ---------------------------------------------------------------
def one_hot_stages(columns: Sequence[str], indexed: str = "{}__index", encoded: str = "{}__hot") -> list:
    """Every known level gets a slot in alphabetical order; an unseen level gives all zeros."""
    index = [indexed.format(c) for c in columns]
    hot = [encoded.format(c) for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True),
    ]


def feature_pipeline(
    df: DataFrame,
    numeric: Sequence[str],
    categories: Sequence[str],
    output: str = "features",
    scale: bool = True,
) -> PipelineModel:
    """Fit mean imputation + standardisation of numbers and mode imputation + one-hot of categories.

    Numeric columns without any value are left out.  Columns in neither list do not reach the vector.
    """
    facts = numeric_facts(df, numeric)
    modes = category_modes(df, categories) if categories else {}
    spoken = [c for c in categories if c in modes]
    items = ["*"]
    for i, c in enumerate(facts):
        mean, deviation = facts[c]
        spread = deviation if scale and deviation > 0 else 1.0
        centre = mean if scale else 0.0
        items.append(f"(coalesce(`{c}`, {mean!r}D) - {centre!r}D) / {spread!r}D AS `num__{i}`")
    for i, c in enumerate(spoken):
        literal = modes[c].replace("\\", "\\\\").replace("'", "\\'")
        items.append(f"coalesce(`{c}`, '{literal}') AS `cat__{i}`")
    stages = [SQLTransformer(statement=f"SELECT {', '.join(items)} FROM __THIS__")]
    inputs = [f"num__{i}" for i in range(len(facts))]
    if spoken:
        names = [f"cat__{i}" for i in range(len(spoken))]
        stages += one_hot_stages(names)
        inputs += [f"{c}__hot" for c in names]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="error"))
    model = Pipeline(stages=stages).fit(df)
    return model


def feature_names(model: PipelineModel, numeric: Sequence[str], categories: Sequence[str]) -> list[str]:
    """Names of the vector's slots in order: numbers first, then ``category=level``."""
    names = list(numeric)
    indexers = [s for s in model.stages if hasattr(s, "labelsArray")]
    for indexer in indexers:
        for category, levels in zip(categories, indexer.labelsArray):
            names += [f"{category}={level}" for level in levels]
    return names


def helper_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(("num__", "cat__"))]


# ---- preprocessing from a table of parameters ----------------------------------------------------------------
def parameters(df: DataFrame, numeric: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """What a preprocessor learns, as rows: ``slot, feature, column, level, mean, deviation, is_mode``.

    A number has one row (level NULL), a category one for each level, the slots of both following one another as in
    ``feature_pipeline``.  Numeric columns without any value have no row.  Levels are counted as rows; the counted table is
    sorted in one task to number the slots, which is as many rows as the vector has.
    """
    facts = numeric_facts(df, numeric)
    numbers = df.sparkSession.createDataFrame(
        [(i, c, c, None, mean, deviation if deviation > 0 else 1.0, False) for i, (c, (mean, deviation)) in enumerate(facts.items())],
        "slot long, feature string, column string, level string, mean double, deviation double, is_mode boolean",
    )
    cells = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(c).alias("column"), q(c).alias("level")) for i, c in enumerate(categories)])
    if not categories:
        return numbers
    counted = df.select(F.inline(cells)).where("level IS NOT NULL").groupBy("place", "column", "level").agg(F.count("*").alias("n"))
    modes = counted.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("rank"), "level")).alias("mode"))
    levels = counted.join(modes, "column").withColumn("is_mode", F.col("mode.level") == F.col("level"))
    number = F.row_number().over(Window.orderBy("place", "level")) + (len(facts) - 1)
    levels = levels.withColumn("slot", number.cast("long")).select(
        "slot", F.concat_ws("=", "column", "level").alias("feature"), "column", "level",
        F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("deviation"), "is_mode",
    )
    return numbers.unionByName(levels)


def apply_parameters(df: DataFrame, learned: DataFrame, key: str) -> DataFrame:
    """``key, slot, feature, value`` of every feature that is not zero, by joins with the table of parameters.

    Missing numbers take the mean and are scaled, missing categories take the mode; a level that the table lacks gives no
    row.  The cells of a row come out of one generator; the joins broadcast the parameters if their count allows.
    """
    kinds = learned.select("column", F.col("level").isNull().alias("is_number"), F.when(F.col("is_mode"), F.col("level")).alias("mode"))
    found = kinds.groupBy("column").agg(F.bool_and("is_number").alias("is_number"), F.max("mode").alias("mode")).collect()  # columns
    numbers = [r["column"] for r in found if r["is_number"] and r["column"] in df.columns]
    spoken = {r["column"]: r["mode"] for r in found if not r["is_number"] and r["column"] in df.columns}
    cell = lambda c, level, value: F.struct(F.lit(c).alias("column"), level.alias("level"), value.alias("number"))
    none = F.lit(None)
    cells = [cell(c, none.cast("string"), q(c).cast("double")) for c in numbers]
    cells += [cell(c, F.coalesce(q(c).cast("string"), F.lit(mode)), none.cast("double")) for c, mode in spoken.items()]
    if not cells:
        return df.select(q(key), *[F.lit(None).cast(t).alias(c) for c, t in (("slot", "long"), ("feature", "string"), ("value", "double"))]).limit(0)
    rows = df.select(q(key), F.inline(F.array(*cells)))
    joined = small_join(rows, learned.select("column", "level", "slot", "feature", "mean", "deviation"), ["column", "level"], null_safe=True)
    scaled = (F.coalesce("number", "mean") - F.col("mean")) / F.col("deviation")
    value = F.when(F.col("mean").isNotNull(), scaled).otherwise(F.lit(1.0))
    return joined.select(q(key), "slot", "feature", value.alias("value")).where("value <> 0")


def log_target(df: DataFrame, target: str, name: str) -> DataFrame:
    return df.withColumn(name, F.log1p(q(target)))

