"""Vectors that tasks add up over their rows, merged by key."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statquarry.operators.shape import q

FEW = 8  # the results of so many tasks are added up where they are wanted, without an exchange

Partial = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[Sequence[np.ndarray], np.ndarray]]]


def values_of(df: DataFrame, features: str) -> Column:
    """A vector or an array of numbers as an array of doubles."""
    return vector_to_array(q(features)) if dict(df.dtypes)[features] == "vector" else q(features).cast("array<double>")


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def summed(rows: DataFrame, partial: Partial, keys: Sequence[str]) -> dict[tuple, np.ndarray]:
    """The vector of each key, added up over all tasks.

    ``partial`` reads a task's batches and yields (key columns, matrix), one line for each key.  The driver receives one
    vector for each key, or those of ``FEW`` tasks; an aggregate merges them where there are more tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, lines in partial(batch for batch in batches if batch.num_rows):
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.asarray(c).astype(np.int32)) for c in columns), pa.array(list(lines), pa.list_(pa.float64()))],
                names=[*keys, "line"],
            )

    found = rows.mapInArrow(run, ", ".join(f"{k} int" for k in keys) + ", line array<double>")
    if rows.rdd.getNumPartitions() > FEW:
        merged = found.groupBy(*keys).agg(Summarizer.sum(array_to_vector("line")).alias("line"))
        found = merged.select(*keys, vector_to_array("line").alias("line"))
    out: dict[tuple, np.ndarray] = {}
    for r in found.collect():
        key, line = tuple(r)[:-1], np.array(r["line"])
        out[key] = out[key] + line if key in out else line
    return out
