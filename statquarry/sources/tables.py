"""CSV tables in and out, text reports, staged tables."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from statquarry.functions.parsing import DEFAULT_NA_TOKENS, NA_TOKENS, fixed
from statquarry.operators.shape import null_missing, q, trim_headers
from statquarry.session import materialise, small_join

ROW_NO = "row_no"


def _csv(spark: SparkSession, paths: Sequence[str], encoding: str, columns: Sequence[str] | None) -> DataFrame:
    reader = spark.read.option("header", True).option("encoding", encoding).option("enforceSchema", False)
    reader = reader.option("quote", '"').option("escape", '"')
    if columns is not None:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    return reader.csv(list(paths))


MAX_HEADERS = 100


def invalid_utf8_files(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(valid, invalid) file names below ``path``, for a look at a folder; ``read_table`` keeps its verdicts in a table."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.expr("is_valid_utf8(value)").alias("ok"))
    flags = lines.groupBy("file").agg(F.bool_and("ok").alias("ok")).collect()
    return sorted(r["file"] for r in flags if r["ok"]), sorted(r["file"] for r in flags if not r["ok"])


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, split, line, header, value``: the raw bytes of every line that is not empty, numbered inside its split.

    ``header`` marks the first line of a file.  Lines are numbered as a task reads them, without a sort.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("value"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, next_line = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            file = pc.dictionary_encode(batch.column("file"))
            code, split = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (file.indices, batch.column("split")))
            fresh = np.ones(batch.num_rows, bool)
            fresh[1:] = (code[1:] != code[:-1]) | (split[1:] != split[:-1])
            heads = np.flatnonzero(fresh)
            line = np.arange(batch.num_rows) - np.repeat(heads, np.diff(np.append(heads, batch.num_rows)))
            if last == (batch.column("file")[0].as_py(), int(split[0])):
                line[: heads[1] if len(heads) > 1 else None] += next_line
            last, next_line = (batch.column("file")[-1].as_py(), int(split[-1])), int(line[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("split"), pa.array(line), pa.array((line == 0) & (split == 0)), batch.column("value")],
                names=["file", "split", "line", "header", "value"],
            )

    lines = raw.mapInArrow(run, "file string, split long, line long, header boolean, value binary")
    return lines.where(F.octet_length("value") > 0)


def _read_by_verdict(spark: SparkSession, path: str, columns: Sequence[str] | None, with_row_no: bool) -> DataFrame:
    """Every file decoded as UTF-8 if all of it is valid, else as Latin-1, by a join with a table of verdicts.

    The verdicts stay a table, whatever the number of files; only the different header lines reach the driver.
    """
    lines = numbered_lines(spark, path)
    verdicts = materialise(
        lines.groupBy("file").agg(
            F.bool_and(F.is_valid_utf8(F.col("value").cast("string"))).alias("valid"), F.max(F.when(F.col("header"), F.col("value"))).alias("head"),
        )
    )
    decoded = lambda raw: F.when(F.col("valid"), raw.cast("string")).otherwise(F.decode(raw, "ISO-8859-1"))
    verdicts = verdicts.select("file", "valid", F.regexp_replace(decoded(F.col("head")), "^\ufeff", "").alias("head"))
    heads = [r["head"] for r in verdicts.select("head").distinct().orderBy("head").limit(MAX_HEADERS + 1).collect() if r["head"] is not None]
    if len(heads) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different header lines below {path}")
    joined = small_join(lines.where("NOT header"), verdicts, ["file"])
    rows = joined.select("file", "split", "line", "head", decoded(F.col("value")).alias("text"))
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    parts = []
    for head in heads:
        names = next(csv.reader([head]))
        fields = ", ".join("`" + c.replace("`", "``") + "` STRING" for c in names)
        cells = rows.where(F.col("head") == head).select("file", "split", "line", F.from_csv("text", fields, options).alias("cells"))
        kept = [F.col("cells")[c].alias(c) for c in names if columns is None or c in columns]
        place = [F.struct("file", "split", "line").alias(ROW_NO)] if with_row_no else []
        parts.append(cells.select(*kept, *place))
    if not parts:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in columns or []]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_table(
    spark: SparkSession,
    path: str,
    na_tokens: Sequence[str] = NA_TOKENS,
    with_row_no: bool = False,
    columns: Sequence[str] | None = None,
    encoding_fallback: bool = False,
    default_na: bool = True,
) -> DataFrame:
    """CSV with header, all text, header names trimmed, missing-value tokens NULL.

    No schema inference pass over the data: only the header line is looked at.  With ``encoding_fallback`` files that
    are not valid UTF-8 are read as Latin-1.  ``with_row_no`` adds an orderable ``row_no`` of (file, split, line
    number in split) that keeps input order without a sort.
    """
    if encoding_fallback:
        df = _read_by_verdict(spark, path, columns, with_row_no)
    else:
        df = _with_row_no(_csv(spark, [path], "UTF-8", columns), with_row_no)
    tokens = tuple(dict.fromkeys((*na_tokens, *(DEFAULT_NA_TOKENS if default_na else ()))))
    return null_missing(trim_headers(df), tokens)


def _with_row_no(df: DataFrame, wanted: bool) -> DataFrame:
    if not wanted:
        return df
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),
    )
    return df.select("*", place.alias(ROW_NO))


def write_table(
    df: DataFrame, path: str, decimals: int | None = None, encoding: str = "UTF-8", bom: bool = False, mode: str = "overwrite"
) -> None:
    """CSV with header; with ``decimals`` every floating column is written with that many places.

    ``bom`` begins every file with a byte order mark, as spreadsheets expect it.
    """
    if decimals is not None:
        floats = [c for c, t in df.dtypes if t in ("double", "float")]
        df = df.withColumns({c: fixed(q(c), decimals) for c in floats})
    if bom and df.columns:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    df.write.mode(mode).option("header", True).option("escape", '"').option("encoding", encoding).csv(path)


def write_report(blocks: DataFrame, path: str, order: str = "metric") -> None:
    """Text blocks, one blank line after each, ordered by metric over the part files."""
    blocks.orderBy(q(order)).select("block").write.mode("overwrite").option("lineSep", "\n").text(path)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table as parquet and go on from the written copy."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
