"""Stretches of text that occur more than once, found through anchors: the first half of both substring operators.

A *unit* is a word or a byte, a *window* a run of ``window`` units.  Every window has an anchor: the least of the hashes
of its grams (runs of ``gram`` units), the leftmost of equals.  The anchor is a function of the window's content, so equal
windows have equal anchors at equal places, and windows of different anchors are different.  Neighbouring windows mostly
share their anchor; such a run of windows is a *span*.  Spans, not windows, are what tasks exchange: one for every
``(window - gram) / 2`` units.

Gram and span hashes have 64 bits each, and equality is always asked of both together (or of a gram and a window hash),
which makes a false match about as likely as with one 128-bit hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statquarry.llm import sketch
from statquarry.llm.arrays import M1, Rolling, map_slices, mix, sliced, window_minima
from statquarry.llm.storage import saved
from statquarry.session import splittable_join

OCCURRENCES = "id long, key long, gram long, run long, start int, n int, who long"
Units = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]  # hashes of all units, and where each text begins


@dataclass(frozen=True)
class Rule:
    window: int
    gram: int
    slice_bytes: int = 1 << 20
    cells_per_anchor: int = 8
    sketch_depth: int = 2
    sketch_max_cells: int = 1 << 27


@dataclass
class Spans:
    """``doc``: number of the text; ``at``: first window as a place in the slice; ``start``: the same within its text."""

    doc: np.ndarray
    at: np.ndarray
    start: np.ndarray
    n: np.ndarray
    gram: np.ndarray
    run: np.ndarray
    hashes: Rolling


def find_spans(values: np.ndarray, first: np.ndarray, rule: Rule) -> Spans:
    hashes = Rolling(values)
    sizes = np.diff(first)
    starts = np.maximum(sizes - rule.window + 1, 0)
    grams = hashes.windows(rule.gram)
    anchor = window_minima(grams, rule.window - rule.gram + 1)
    doc = np.repeat(np.arange(len(sizes)), starts)
    at = np.arange(int(starts.sum())) - np.repeat(np.cumsum(starts) - starts, starts) + first[doc]
    anchor = anchor[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(fresh)
    n = np.diff(np.append(head, len(at)))
    at, doc = at[head], doc[head]
    # the run's hash covers the place of the anchor too: equal runs hold it at equal places anyway
    return Spans(doc, at, at - first[doc], n, grams[anchor[head]], hashes.of(at, at + n + rule.window - 1), hashes)


def names(spans: Spans, key: np.ndarray) -> np.ndarray:
    """A hash that names one occurrence: its text, its place and its content."""
    return mix(mix(key[spans.doc].view(np.uint64) ^ (spans.start.astype(np.uint64) * M1)) ^ spans.run)


def _columns(part: pa.RecordBatch, name: str) -> np.ndarray:
    return part.column(name).to_numpy(zero_copy_only=False)


def occurrences(texts: DataFrame, units: Units, rule: Rule) -> DataFrame:
    """Written table of the spans whose anchor gram repeats by the merged sketch; none that repeats is left out."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = sketch.sketch_bits(size // (rule.gram * 4), rule.cells_per_anchor, rule.sketch_max_cells)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for part in sliced(batches, "text", rule.slice_bytes):
            yield find_spans(*units(part), rule).gram

    merged = sketch.build(texts.select("text"), grams, "twice", rule.sketch_depth, bits)
    shared: Broadcast = spark.sparkContext.broadcast(merged)

    def candidates(part: pa.RecordBatch) -> pa.RecordBatch:
        spans = find_spans(*units(part), rule)
        who = names(spans, _columns(part, "key"))
        keep = np.flatnonzero(shared.value.passes(spans.gram))
        return pa.RecordBatch.from_arrays(
            [part.column("id").take(pa.array(spans.doc[keep])), part.column("key").take(pa.array(spans.doc[keep])),
             pa.array(spans.gram[keep].view(np.int64)), pa.array(spans.run[keep].view(np.int64)),
             pa.array(spans.start[keep].astype(np.int32)), pa.array(spans.n[keep].astype(np.int32)),
             pa.array(who[keep].view(np.int64))],
            names=["id", "key", "gram", "run", "start", "n", "who"],
        )

    return saved(map_slices(texts, "text", candidates, OCCURRENCES, rule.slice_bytes), "spans")


def distinct_spans(found: DataFrame) -> DataFrame:
    """Written table of different spans of every gram that occurs twice or more, counted exactly.

    ``least``: smallest id; ``c``: occurrences; ``who``: one of them; ``kinds``: different spans of the gram.
    """
    spans = found.groupBy("gram", "run").agg(
        F.min("id").alias("least"), F.count("*").alias("c"), F.min("who").alias("who"), F.first("n").alias("n")
    )
    spans = saved(spans, "distinct-spans")
    grams = spans.groupBy("gram").agg(F.count("*").alias("kinds"), F.sum("c").alias("total")).where("total > 1")
    joined = splittable_join(spans, grams.select("gram", "kinds"), ["gram"])
    return saved(joined, "repeated-spans")


def contents(
    texts: DataFrame, mixed: DataFrame, units: Units, rule: Rule,
    take: Callable[[pa.RecordBatch, Spans, np.ndarray], pa.Array], kind: str,
) -> DataFrame:
    """One row (gram, run, n, content) for each span of ``mixed``, drawn from the texts by the occurrence it names.

    The names travel as a bounded bit plane, which lets a few other spans pass; the join with ``mixed`` drops them.
    """
    number = mixed.count()
    bits = sketch.sketch_bits(number, 16, rule.sketch_max_cells)

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            yield _columns(batch, "who").view(np.uint64)

    wanted = texts.sparkSession.sparkContext.broadcast(sketch.build(mixed.select("who"), arrays, "once", 2, bits))

    def draw(part: pa.RecordBatch) -> pa.RecordBatch:
        spans = find_spans(*units(part), rule)
        who = names(spans, _columns(part, "key"))
        keep = np.flatnonzero(wanted.value.passes(who))
        return pa.RecordBatch.from_arrays(
            [pa.array(who[keep].view(np.int64)), pa.array(spans.gram[keep].view(np.int64)),
             pa.array(spans.run[keep].view(np.int64)), take(part, spans, keep)],
            names=["who", "gram", "run", "content"],
        )

    drawn = map_slices(texts, "text", draw, f"who long, gram long, run long, content {kind}", rule.slice_bytes)
    # rows that are equal in every respect name the same occurrence
    return drawn.join(mixed, ["who", "gram", "run"]).dropDuplicates(["gram", "run"])
