"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words, every document an expected number of copies, the same for all documents of a source or
in proportion to a preference.  Its whole copies are certain; the fraction that is left is its inclusion probability.
Documents of a source are ranked by the odds of a random number, drawn from id and text, over the odds of this probability;
the sample is the beginning of that order.  Its size is fixed in words: it ends before the document that would pass the
words still missing, and the gap is closed with the next documents of the order that fit, larger classes of size first, at
last with one that passes the target if that comes nearer to it.

Texts are read once, for their sizes.  The end of a sample is found by histograms of the rank, digit by digit, and only the
rows of the bucket that holds it are sorted, so a source may hold any share of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statquarry.llm.arrays import map_slices, split_words, utf8
from statquarry.llm.storage import saved
from statquarry.session import BROADCAST_ROWS, splittable_join

SLICE_BYTES = 1 << 20
SIZED = "id long, source string, size long, preference double, draw long, row long"
DIGIT = 10  # bits
RANK_BITS = 50
RANK_DIGITS = RANK_BITS // DIGIT
DIGITS = RANK_DIGITS + 7  # then those of the row number, for rows that are equal in every respect


@dataclass(frozen=True)
class Mix:
    """Sources in the order of their names weigh ``weights``, repeating; no document is taken more than ``most`` times."""

    weights: tuple[float, ...] = (1, 2, 3)
    share: float = 1.0  # words of the mix, as a share of all words
    most: int = 3
    seed: str = "1"
    fillers: int = 4  # documents of each class of size that may close a gap
    sorted_rows: int = 10_000  # so many rows of a source are sorted at once, at most


def sizes(documents: DataFrame, mix: Mix, id: str, text: str, source: str, preference: str | None) -> DataFrame:
    """Written table of (id, source, size, preference, draw, row).  ``draw`` has 52 random bits that hang on id and text."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    name = F.concat_ws(":", F.lit(mix.seed), F.col(f"`{id}`").cast("string"), F.md5(body.cast("binary")))
    drawn = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("long")
    wish = F.lit(1.0) if preference is None else F.greatest(F.coalesce(F.col(f"`{preference}`").cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = documents.select(
        F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{source}`").cast("string").alias("source"),
        wish.alias("preference"), drawn.alias("draw"), F.monotonically_increasing_id().alias("row"), body.alias("text"),
    )

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        counts = split_words(*utf8(part.column("text"))).counts().astype(np.int64)
        kept = {c: part.column(c) for c in ("id", "source", "preference", "draw", "row")} | {"size": pa.array(counts)}
        return pa.RecordBatch.from_pydict({c: kept[c] for c in ("id", "source", "size", "preference", "draw", "row")})

    return saved(map_slices(rows, "text", run, SIZED, SLICE_BYTES), "sizes")


def numbered(names: DataFrame) -> DataFrame:
    """Rows of different ``source``, numbered from 0 by code point, null last: sorted in ranges, ranges are counted."""
    last = F.col("source").isNull()
    ranged = saved(
        names.withColumn("last", last).repartitionByRange("last", "source").withColumn("part", F.spark_partition_id()), "ranges"
    )
    counted = ranged.groupBy("part").agg(F.count("*").alias("n"))  # a row for each partition
    before = counted.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("last", "source")) - 1
    return ranged.withColumn("place", place).join(before, "part").withColumn("number", F.col("before") + F.col("place")).drop(
        "last", "part", "place", "before"
    )


def targets(sized: DataFrame, mix: Mix) -> tuple[DataFrame, bool]:
    """Written table (source, source_size, weight, target), and whether it is small enough for a broadcast.

    All words are shared by weight; no target exceeds ``most`` times its source, and what it leaves is shared by the others
    by weight, until none is above.  With ``level`` words for each unit of weight a target is the lesser of level x weight
    and its limit; every round raises the level by what the sources at their limit leave, and needs one row from Spark.
    """
    found = numbered(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in mix.weights]), (F.col("number") % len(mix.weights) + 1).cast("int"))
    found = saved(found.select("source", "source_size", weigh.alias("weight")), "sources")
    limit = F.col("source_size") * F.lit(float(mix.most))
    total, number = found.agg(F.sum("source_size"), F.count("*")).first()
    total = mix.share * (total or 0)
    level = 0.0
    while True:
        full = limit <= F.col("weight") * level
        held, open_ = found.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        if not open_:
            break
        higher = (total - (held or 0.0)) / open_
        if higher <= level:
            break
        level = higher
    return saved(found.withColumn("target", F.least(F.col("weight") * F.lit(level), limit)), "targets"), number <= BROADCAST_ROWS


def by_source(rows: DataFrame, table: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """Rows with the columns of their source, null being one; ``table`` has one row for each of ``few`` or of many sources."""
    if not few:
        return splittable_join(rows, table, ["source"], how, null_safe=True)
    other = table.withColumnRenamed("source", "its source")
    return rows.join(F.broadcast(other), F.col("source").eqNullSafe(F.col("its source")), how).drop("its source")


def levels(sized: DataFrame, wanted: DataFrame, mix: Mix, few: bool) -> DataFrame:
    """``wanted`` with ``level``: a document is to be taken level x preference times, ``most`` times at most.

    Rounds as in ``targets``, for all sources together.  A source whose documents with a preference cannot hold its target
    gets all they can.
    """
    state = wanted.withColumn("level", F.lit(0.0))
    while True:
        full = F.col("preference") * F.col("level") >= mix.most
        sums = by_source(sized, state.select("source", "level"), few).groupBy("source").agg(
            F.coalesce(F.sum(F.when(full, F.col("size"))), F.lit(0)).alias("held"),
            F.sum(F.when(~full, F.col("preference") * F.col("size"))).alias("open"),
        )
        higher = F.coalesce(F.try_divide(F.col("target") - F.col("held") * mix.most, F.col("open")), F.lit(0.0))
        risen = higher > F.col("level")
        both = by_source(state, sums, few)
        state = saved(both.select(*wanted.columns, F.greatest("level", higher).alias("level"), risen.alias("risen")), "levels")
        if not state.where("risen").head(1):
            return state.drop("risen")
        state = state.drop("risen")


def ranked(sized: DataFrame, state: DataFrame, mix: Mix, few: bool) -> DataFrame:
    """Rows with ``whole`` copies and ``rank``, their place in the Pareto order, null if nothing is left to draw."""
    expected = F.least(F.lit(float(mix.most)), F.col("level") * F.col("preference"))
    rows = by_source(sized, state, few).withColumn("whole", F.floor(expected)).withColumn("chance", expected - F.col("whole"))
    random = (F.col("draw") + F.lit(0.5)) / F.lit(float(1 << 52))
    odds = F.try_divide(random / (1 - random), F.col("chance") / (1 - F.col("chance")))
    rank = F.least(F.floor(odds / (1 + odds) * F.lit(float(1 << RANK_BITS))), F.lit((1 << RANK_BITS) - 1))
    return rows.withColumn("rank", F.when((F.col("chance") > 0) & (F.col("size") > 0), rank)).drop("chance", "level")


def digits(level: int) -> Column:
    """Rank and row number as far as the first ``level`` digits go; as structs they compare like the whole."""
    rank = F.shiftright("rank", max(0, RANK_BITS - DIGIT * level)) if level else F.lit(0)
    row = F.shiftright("row", DIGIT * (DIGITS - level)) if level > RANK_DIGITS else F.lit(0)
    return F.struct(rank.cast("long").alias("rank"), row.cast("long").alias("row"))


def ends(rows: DataFrame, missing: DataFrame, mix: Mix, few: bool) -> tuple[DataFrame, int]:
    """(source, edge, rest): the bucket in which each sample ends, and how many digits name it.

    ``rest`` words are missing when all rows before the bucket are taken.  The bucket is split by one digit more until no
    source has more than ``sorted_rows`` rows in it.  A source whose sample takes all its rows has no bucket.
    """
    state = missing.select("source", digits(0).alias("edge"), F.col("missing").alias("rest"))
    for level in range(1, DIGITS + 1):
        here = by_source(rows, state, few).where(digits(level - 1) == F.col("edge"))
        sums = here.groupBy("source", digits(level).alias("at")).agg(
            F.sum("size").alias("s"), F.count("*").alias("n"), F.first("rest").alias("rest")
        )
        # at most 2 ** DIGIT rows for each source
        upto = sums.withColumn("upto", F.sum("s").over(Window.partitionBy("source").orderBy("at")))
        found = upto.where("upto > rest").groupBy("source").agg(F.min(F.struct("at", "upto", "s", "rest", "n")).alias("b"))
        rest = F.col("b.rest") - (F.col("b.upto") - F.col("b.s"))
        state = saved(found.select("source", F.col("b.at").alias("edge"), rest.alias("rest"), F.col("b.n").alias("n")), "buckets")
        most = state.agg(F.max("n")).first()[0] or 0
        state = state.drop("n")
        if most <= mix.sorted_rows:
            break
    return state, level


def sample(rows: DataFrame, mix: Mix, few: bool) -> tuple[DataFrame, int]:
    """(source, edge, last, more) and the number of digits: taken are the rows before the bucket ``edge``, inside it those up
    to ``last`` (rank and row), and the rows whose numbers are in ``more``."""
    sums = rows.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("whole") * F.col("size")).alias("held"))
    drawn = rows.where("rank IS NOT NULL").select("source", "rank", "row", "size")
    bucket, level = ends(drawn, saved(sums.select("source", (F.col("target") - F.col("held")).alias("missing")), "missing"), mix, few)
    marked = by_source(drawn, bucket, few).withColumn("at", digits(level))
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("rank", "row"))  # sorted_rows at most
    inside = saved(marked.where("at = edge").withColumn("upto", upto).drop("at"), "inside")
    # the next rows of every class of size, from the bucket and behind it
    later = marked.where("at > edge").select("source", "rank", "row", "size").unionByName(
        inside.where("upto > rest").select("source", "rank", "row", "size")
    )
    best = Window.partitionBy("source", "class").orderBy("rank", "row")
    later = later.withColumn("class", F.length(F.bin("size"))).withColumn("k", F.row_number().over(best))
    fill = later.where(F.col("k") <= mix.fillers).groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("class")).alias("class"), "rank", "row", "size"))).alias("next")
    )
    taken = F.col("upto") <= F.col("rest")
    within = inside.groupBy("source", "edge").agg(
        (F.first("rest") - F.coalesce(F.max(F.when(taken, F.col("upto"))), F.lit(0))).alias("gap"),
        F.max(F.when(taken, F.struct("rank", "row"))).alias("last"),
    )
    both = by_source(within, fill, few, "left")
    # (gap, rows taken): a document that fits closes a part of the gap, and the nearest of the others what is left
    closed = F.expr("""
        aggregate(next, named_struct('gap', gap, 'rows', cast(array() AS array<long>)), (held, x) ->
                  named_struct('gap', if(x.size <= held.gap, held.gap - x.size, held.gap),
                               'rows', if(x.size <= held.gap, array_append(held.rows, x.row), held.rows)))""")
    nearest = F.expr("""
        array_min(transform(filter(next, x -> x.size < 2 * closed.gap AND NOT array_contains(closed.rows, x.row)),
                            (x, i) -> named_struct('off', abs(x.size - closed.gap), 'i', i, 'row', x.row))).row""")
    more = F.concat("closed.rows", F.when(nearest.isNotNull(), F.array(nearest)).otherwise(F.array().cast("array<long>")))
    return both.withColumn("closed", closed).select("source", "edge", "last", more.alias("more")), level


def mixed(
    documents: DataFrame, mix: Mix = Mix(), id: str = "doc_id", text: str = "text", source: str = "source",
    preference: str | None = None,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for each document; ``taken`` is copies x size.

    ``size`` counts the words (runs of characters other than blank and 0x09-0x0D), of a null text none.  A null source is one
    of its own, after all others.  ``preference`` names a column of numbers; null and negative count as zero, and such
    documents are not taken.  Rows that repeat are documents of their own, ranked alike; which of equal rows is taken is
    arbitrary, how many is not.  Other columns are ignored.  The same table gives the same mix.
    """
    sized = sizes(documents, mix, id, text, source, preference)
    wanted, few = targets(sized, mix)
    if preference is None:
        state = wanted.withColumn("level", F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)))
    else:
        state = levels(sized, wanted, mix, few)
    rows = ranked(sized, state, mix, few)
    chosen, level = sample(rows, mix, few)
    cuts = by_source(wanted.select("source"), chosen, few, "left")
    placed = by_source(rows, saved(cuts, "sample"), few)
    before = (digits(level) < F.col("edge")) | (F.struct("rank", "row") <= F.col("last"))
    # without a bucket the sample takes all rows that have a rank
    drawn = F.col("edge").isNull() | F.coalesce(before, F.lit(False)) | F.array_contains("more", F.col("row"))
    copies = F.col("whole") + F.when(F.col("rank").isNotNull() & F.coalesce(drawn, F.lit(False)), 1).otherwise(0)
    return placed.select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )
