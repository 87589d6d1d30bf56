"""Written tables and folders in the storage that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``.  Only a local session that names none gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="statquarry-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to shared storage and read it back: computed once, lineage cut, lost executors harmless."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(documents: DataFrame, id: str, text: str) -> DataFrame:
    """Id, text and a hash of the text.  Id and hash together name a row, or rows that are equal in every respect."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return documents.select(F.col(f"`{id}`").cast("long").alias("id"), body.alias("text"), F.xxhash64(body).alias("key"))


ID, KEY = "statquarry id", "statquarry key"  # names that no table is likely to have


def with_key(documents: DataFrame, id: str, text: str) -> DataFrame:
    """All columns, and id and key as ``keyed`` gives them, under the names ``ID`` and ``KEY``."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return documents.withColumns({ID: F.col(f"`{id}`").cast("long"), KEY: F.xxhash64(body)})


def same_row(rows: DataFrame, found: DataFrame) -> Column:
    """Join condition of ``with_key`` rows with a table that has id and key."""
    return rows[ID].eqNullSafe(found["id"]) & (rows[KEY] == found["key"])


def matches(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on id and key; a null id equals a null id."""
    return left["id"].eqNullSafe(right["id"]) & (left["key"] == right["key"])
