"""Session helpers shared by the bench, the tests and the job functions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def local_session(cpus: int | str = "*", app: str = "statquarry", shuffle: int = 8) -> SparkSession:
    """Session for tests and the bench.  A cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the storage that driver and executors share (``spark.checkpoint.dir``).

    Only a local session that names no such folder gets a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="statquarry-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder named by ``spark.checkpoint.dir``.

    The folder is shared storage on a cluster, so the result outlives any executor.  Only a session that names
    no folder at all (a local test) gets a throw-away one.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="statquarry-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def _join(left: DataFrame, right: DataFrame, names: Sequence[str], how: str, null_safe: bool, spread: bool) -> DataFrame:
    other = {name: f"__{name}" for name in names}
    pairs = [(F.col(f"`{name}`"), F.col(f"`{twin}`")) for name, twin in other.items()]
    condition = F.xxhash64(*[a for a, _ in pairs]) == F.xxhash64(*[b for _, b in pairs]) if spread else F.lit(True)
    for a, b in pairs:
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return left.join(right.withColumnsRenamed(other), condition, how).drop(*other.values())


def splittable_join(
    left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Equi-join on same-named columns whose hot keys adaptive execution can split; columns of ``left`` stay.

    It splits a hot partition only where each side comes straight out of a shuffle made for this join.  A side that is
    already partitioned by the same columns (an aggregate, a window) would be used as it is, and a key with a third
    of all rows on the other side would stay in one task.  A hash of the names as one more join condition makes the
    existing partitioning unfit, so the (reduced) side is shuffled once more and the large side stays splittable.
    """
    return _join(left, right, names, how, null_safe, spread=True)


def small_join(
    rows: DataFrame, small: DataFrame, names: Sequence[str], null_safe: bool = False, max_rows: int | None = None
) -> DataFrame:
    """Inner join with a side that is usually small: computed once, counted, broadcast only when the count allows.

    The planner cannot know that an aggregate over a huge table is small, and would shuffle the huge side for it.
    Beyond ``max_rows`` (default ``BROADCAST_ROWS``) both sides are shuffled, with adaptive splitting of hot keys.
    """
    kept = materialise(small)
    if kept.count() <= (BROADCAST_ROWS if max_rows is None else max_rows):
        return _join(rows, F.broadcast(kept), names, "inner", null_safe, spread=False)
    return splittable_join(rows, kept, names, "inner", null_safe)
