"""Repeated word windows of documents: a count-min prefilter, then exact groups of what may repeat."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statquarry.llm.arrays import as_binary, hash_slices, join_words, map_slices, ranges, split_words, utf8
from statquarry.llm.repeats import Rule, Spans, contents, distinct_spans, occurrences
from statquarry.llm.storage import keyed, matches, saved
from statquarry.session import splittable_join

RULE = Rule(window=50, gram=16)


def word_units(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    buf, offsets = utf8(part.column("text"))
    words = split_words(buf, offsets)
    return hash_slices(buf, words.start, words.end), words.first


def repeated_word_spans(documents: DataFrame, id: str = "doc_id", text: str = "text", rule: Rule = RULE) -> DataFrame:
    """(id, key, spans): for each document with a window that also starts in a document of smaller id, its spans.

    A span is ``start`` (first window, in words), ``n`` windows and ``mask``, null if all of them count.
    """
    texts = keyed(documents, id, text)
    found = occurrences(texts, word_units, rule)
    spans = distinct_spans(found)
    mixed = spans.where("kinds > 1")

    def windows(part: pa.RecordBatch, drawn: Spans, keep: np.ndarray) -> pa.Array:
        n = drawn.n[keep]
        at = np.repeat(drawn.at[keep] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        values = drawn.hashes.of(at, at + rule.window).view(np.int64)
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(values))

    listed = saved(
        contents(texts, mixed, word_units, rule, windows, "array<long>").select(
            "gram", "run", "least", F.posexplode("content").alias("place", "window")
        ), "windows",
    )
    first = listed.groupBy("gram", "window").agg(F.min("least").alias("first"))
    firsts = (
        splittable_join(listed, first, ["gram", "window"])
        .groupBy("gram", "run").agg(F.collect_list(F.struct("place", "first")).alias("found"))
        .select("gram", "run", F.transform(F.sort_array("found"), lambda x: x["first"]).alias("firsts"))
    )
    # what decides: the smallest id of the whole span where all its windows occur together, else of each window
    verdict = spans.where("kinds > 1 OR c > 1").join(firsts, ["gram", "run"], "left").select(
        "gram", "run", "least", "firsts"
    )
    smaller = lambda other: other.isNotNull() & (F.col("id").isNull() | (other < F.col("id")))
    hits = splittable_join(found.select("id", "key", "gram", "run", "start", "n"), verdict, ["gram", "run"]).select(
        "id", "key", "start", "n",
        F.when(F.col("firsts").isNotNull(), F.transform("firsts", smaller)).alias("mask"),
        smaller(F.col("least")).alias("whole"),
    )
    hits = hits.where(F.when(F.col("mask").isNull(), F.col("whole")).otherwise(F.array_contains("mask", True)))
    # rows that are equal in id and text have equal spans: a set holds them once, before the exchange too
    return hits.groupBy("id", "key").agg(F.collect_set(F.struct("start", "n", "mask")).alias("spans"))


def covered(spans: pa.Array, first: np.ndarray, window: int) -> np.ndarray:
    """Which units of a slice lie in a marked window, from the spans of each of its texts."""
    doc = np.repeat(np.arange(len(spans)), pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False))
    flat = spans.flatten()
    at = flat.field("start").to_numpy(zero_copy_only=False).astype(np.int64) + first[doc]
    n = flat.field("n").to_numpy(zero_copy_only=False)
    mask = flat.field("mask")
    whole = mask.is_null().to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(mask), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    each = np.repeat(at - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    each = each[mask.flatten().to_numpy(zero_copy_only=False).astype(bool)]
    begin = np.concatenate([at[whole], each])
    end = np.concatenate([at[whole] + n[whole] - 1, each]) + window
    total = int(first[-1])
    change = np.bincount(begin, minlength=total + 1) - np.bincount(end, minlength=total + 1)
    return np.cumsum(change[:total]) > 0


def remove_repeated_words(documents: DataFrame, id: str = "doc_id", text: str = "text", rule: Rule = RULE) -> DataFrame:
    """Every document without the words of windows that also start in a document of smaller id.

    Words are runs of characters other than blank and 0x09-0x0D.  Returns (doc_id, n_words, n_removed, kept, removed):
    ``kept`` joins the remaining words by one blank, ``removed`` lists word ranges (start, end).  One row out for each row
    in.  A null text has no words; a null id is larger than every id; rows that repeat an id are not smaller than one
    another; other columns are ignored.
    """
    texts = keyed(documents, id, text)
    spans = repeated_word_spans(documents, id, text, rule)
    joined = texts.join(spans, matches(texts, spans), "left").select(texts["id"], texts["text"], spans["spans"])

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        buf, offsets = utf8(part.column("text"))
        words = split_words(buf, offsets)
        marked = covered(part.column("spans"), words.first, rule.window)
        left = np.flatnonzero(~marked)
        kept = join_words(buf, words.start[left], words.end[left], np.searchsorted(left, words.first))
        gone = np.append(0, np.cumsum(marked))[words.first]
        return pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(words.counts().astype(np.int64)), pa.array(np.diff(gone).astype(np.int64)),
             as_binary(*kept, text=True), ranges(marked, words.first)[0]],
            names=["doc_id", "n_words", "n_removed", "kept", "removed"],
        )

    schema = "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start: long, end: long>>"
    return map_slices(joined, "text", cut, schema, rule.slice_bytes)
