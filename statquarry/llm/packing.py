"""Best-fit decreasing packing of token pieces into sequences of fixed capacity.

Lengths are whole numbers up to the capacity, so the number of pieces of each length (a table of ``capacity`` rows at most,
however large the corpus) determines the packing.  ``plan`` runs best-fit decreasing on it: a segment tree over remaining
capacities finds the tightest open sequences for a length in logarithmic time, and equal sequences and equal pieces are
handled as ranges.  The plan says, for a range of pieces of one length, which sequences and offsets they get; every piece
then looks up its range by its number among the pieces of its length.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statquarry.llm.arrays import map_slices
from statquarry.llm.storage import saved
from statquarry.llm.tokens import SLICE_BYTES, TokenIds, held, specification, texts_of

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row long, copy long"


class Capacities:
    """Segment tree over remaining capacities: whether sequences with that much room are open, and the tightest that fits."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = np.zeros(2 * self.size, bool)

    def set(self, room: int, there: bool) -> None:
        at = room + self.size
        self.open[at] = there
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def tightest(self, length: int) -> int | None:
        """Least room of an open sequence that holds ``length``."""
        at = length + self.size
        while not self.open[at]:
            while at & 1:  # a right child: all of its parent's leaves to the right lie elsewhere
                at //= 2
            if at <= 1:
                return None
            at += 1
        while at < self.size:
            at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.size


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, number, sequence, each, offset) of a best-fit decreasing packing.

    Pieces ``first`` to ``first + number - 1`` of a length fill sequences from number ``sequence`` on, ``each`` of them in
    one sequence, the first at ``offset``.
    """
    tree, rooms, used, rows = Capacities(capacity), {}, 0, []

    def leave(room: int, sequences: tuple[int, int]) -> None:
        if room:
            if not rooms.get(room):
                tree.set(room, True)
            rooms.setdefault(room, []).append(sequences)

    for length in sorted((n for n in counts if n > 0), reverse=True):
        done, number = 0, counts[length]
        while done < number:
            room = tree.tightest(length)
            if room is None:
                room, low, many = capacity, used, math.ceil((number - done) / (capacity // length))
                used += many
            else:
                low, many = rooms[room].pop()
                if not rooms[room]:
                    tree.set(room, False)
            # the tightest sequence stays the tightest until the length doesn't fit any more
            each = room // length
            full = min(many, (number - done) // each)
            if full:
                rows.append((length, done, full * each, low, each, capacity - room))
                leave(room - each * length, (low, full))
                done += full * each
            if full < many:
                rest = number - done
                if rest:
                    rows.append((length, done, rest, low + full, rest, capacity - room))
                    leave(room - rest * length, (low + full, 1))
                    done, full = number, full + 1
                if full < many:
                    leave(room, (low + full, many - full))
    return rows


def token_pieces(
    documents: DataFrame, path: str, capacity: int, end: int, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Written table of the pieces of every document's ids, closed by the id ``end``; only longer documents are cut."""
    shared = specification(documents, path)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, number = held(TokenIds, shared).ids(part.column("text").to_pylist())
        size = number + 1
        stop = np.cumsum(size)
        flat = np.full(int(stop[-1]), end, "<u4")
        body = np.ones(len(flat), bool)
        body[stop - 1] = False
        flat[body] = ids
        pieces = -(-size // capacity)
        doc = np.repeat(np.arange(len(size)), pieces)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        low = (stop - size)[doc] + piece * capacity
        length = np.minimum(capacity, stop[doc] - low)
        raw = flat.tobytes()
        sums = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(low.tolist(), length.tolist())]
        # number of a row among the equal ones of its slice
        keys = {"id": part.column("id").fill_null(0), "null": part.column("id").is_null(), "row": part.column("row")}
        copy = pd.DataFrame({k: v.to_numpy(zero_copy_only=False) for k, v in keys.items()}).groupby([*keys]).cumcount()
        return pa.RecordBatch.from_arrays(
            [part.column("id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(piece * capacity),
             pa.array(length), pa.array(sums, pa.int64()), part.column("row").take(pa.array(doc)),
             pa.array(copy.to_numpy(np.int64)[doc])],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "row", "copy"],
        )

    texts = texts_of(documents, id, text).withColumn("row", F.xxhash64("text"))
    return saved(map_slices(texts, "text", run, PIECES, SLICE_BYTES), "pieces")


def in_lots(pieces: DataFrame, many: int) -> DataFrame:
    """Deal pieces to lots by their values; equal rows by their written number as well, so that no lot gets them all."""
    return pieces.withColumn("lot", F.pmod(F.xxhash64("doc_id", "row", "piece").bitwiseXOR(F.col("copy")), F.lit(many)))


def pack(
    documents: DataFrame, path: str, capacity: int = 4096, end: int = 1, id: str = "doc_id", text: str = "text",
    lot: int = 50_000,
) -> DataFrame:
    """One row (doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece.

    A document's ids are the tokenizer's (without added special tokens), then ``end``.  A null or empty text has only
    ``end``; rows that repeat, and equal or null ids, are documents of their own; other columns are ignored.
    """
    pieces = token_pieces(documents, path, capacity, end, id, text)
    spark = pieces.sparkSession
    lengths = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()  # one row for each length at most
    rows = plan({r["length"]: r["n"] for r in lengths}, capacity)
    ranges = spark.createDataFrame(
        rows or [(0, 0, 0, 0, 0, 0)], "length long, first long, number long, sequence long, each long, begin long"
    )
    # number of every piece among those of its length: pieces of a length are dealt to lots, lots are counted
    many = math.ceil((sum(r["n"] for r in lengths) + 1) / lot)
    dealt = in_lots(pieces, many)
    sizes = dealt.groupBy("length", "lot").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "lot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "lot").orderBy("doc_id", "row", "piece")
    numbered = dealt.withColumn("place", F.row_number().over(inside) - 1)
    placed = numbered.join(bases, ["length", "lot"]).withColumn("number_", F.col("base") + F.col("place"))
    # which range holds a piece: ranges follow one another, so the last that begins at or before it
    table = F.broadcast(  # lengths and cuts bound its rows: see plan
        ranges.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first", "sequence", "each", "begin"))).alias("held"))
    )
    found = placed.join(table, "length").withColumn(
        "at", F.expr("aggregate(held, held[0], (last, x) -> IF(x.first <= number_, x, last))")
    )
    step = F.col("number_") - F.col("at.first")
    return found.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("at.sequence") + F.floor(step / F.col("at.each"))).cast("long").alias("sequence_id"),
        (F.col("at.begin") + (step % F.col("at.each")) * F.col("length")).cast("long").alias("offset"),
    )
