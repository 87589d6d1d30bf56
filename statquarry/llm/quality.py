"""Quality rules: text figures, and a hashed n-gram likelihood ratio between trusted texts and the whole corpus.

Words and word pairs (A-Z in lower case) are hashed into ``buckets``.  Two multinomials are counted in full: over all
documents, and over all documents that are trusted.  A document's score is the mean, over its words and pairs, of the
logarithm of trusted probability over corpus probability; it is kept if that reaches the threshold.  The same text always
gets the same verdict: nothing is drawn at random.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statquarry.llm.arrays import M1, Rolling, hash_slices, map_slices, mix, sliced, split_words, utf8
from statquarry.llm.tokens import texts_of
from statquarry.session import small_join

BUCKETS = 1 << 16
SLICE_BYTES = 1 << 20
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))


def features(buf: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every word and every pair of neighbouring words."""
    lower = np.where((buf - np.uint8(65)) < 26, buf + np.uint8(32), buf)
    words = split_words(lower, offsets)
    hashes, doc = hash_slices(lower, words.start, words.end), words.doc()
    same = np.flatnonzero(doc[1:] == doc[:-1])
    pairs = mix(hashes[same] * M1 ^ hashes[same + 1])
    both = np.concatenate([hashes, pairs])
    return (both % np.uint64(buckets)).astype(np.int64), np.concatenate([doc, doc[same]])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts; the table has ``buckets`` rows, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in sliced(batches, "text", SLICE_BYTES):
            total += np.bincount(features(*utf8(part.column("text")), buckets)[0], minlength=buckets)
        seen = np.flatnonzero(total)
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    rows = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def log_ratio(trusted: np.ndarray, corpus: np.ndarray, pseudo: float = 20.0) -> np.ndarray:
    """Logarithm of trusted over corpus probability of each bucket.

    ``pseudo`` is added to the count of trusted texts and to the count that the corpus lets expect: a bucket that is seldom
    seen says little, one that is often seen says what was counted.  Without any trusted text all ratios are zero.
    """
    expected = corpus * (trusted.sum() / max(corpus.sum(), 1))
    return np.log((trusted + pseudo) / (expected + pseudo))


def figures(part: pa.RecordBatch, ratio: np.ndarray) -> dict[str, np.ndarray]:
    buf, offsets = utf8(part.column("text"))
    texts, total = len(offsets) - 1, int(offsets[-1])
    words = split_words(buf, offsets)
    n_words, doc = words.counts(), words.doc()
    inside = np.zeros(total + 1, np.int64)
    body = buf[:total]

    def per_text(marked: np.ndarray) -> np.ndarray:
        np.cumsum(marked, out=inside[1:])
        return np.diff(inside[offsets])

    space = (body == 32) | ((body - np.uint8(9)) < 5)
    word_chars = per_text(~space & ((body & 0xC0) != 0x80))
    n_symbols = per_text(_SYMBOL[body])
    # lines: between line ends and text ends
    ends = np.flatnonzero(body == 10)
    low = np.sort(np.concatenate([offsets[:-1], ends + 1]), kind="stable")
    line_doc = np.searchsorted(offsets, low, side="right") - 1
    # a line that begins where a text ends belongs to the text before it, and is empty
    high = np.minimum(np.append(low[1:], total), offsets[1:][np.minimum(line_doc, texts - 1)]) if texts else low
    has_next = np.append(low[1:], -1) == high
    closed = (high > low) & has_next & (buf[np.maximum(high - 1, 0)] == 10)
    high = np.where(closed, high - 1, high)
    filled = np.flatnonzero(np.searchsorted(words.start, high) > np.searchsorted(words.start, low))
    name = mix(hash_slices(buf, low[filled], high[filled]) ^ (line_doc[filled].astype(np.uint64) * M1))
    first = np.zeros(len(name), bool)
    first[np.unique(name, return_index=True)[1]] = True
    n_dup_lines = np.bincount(line_doc[filled][~first], minlength=texts)
    # words in windows of eight that occur twice in their text
    hashes = hash_slices(buf, words.start, words.end)
    windows = Rolling(hashes).windows(8)
    at = np.flatnonzero(doc[: len(windows)] == doc[7 : 7 + len(windows)]) if len(windows) else np.zeros(0, np.int64)
    name = mix(windows[at] ^ (doc[at].astype(np.uint64) * M1))
    _, which, number = np.unique(name, return_inverse=True, return_counts=True)
    at = at[number[which] > 1]
    change = np.bincount(at, minlength=len(doc) + 1) - np.bincount(at + 8, minlength=len(doc) + 1)
    covered = np.cumsum(change[: len(doc)]) > 0
    n_repeat = np.bincount(doc[covered], minlength=texts)
    bucket, of = features(buf, offsets, len(ratio))
    size = np.bincount(of, minlength=texts)
    score = np.bincount(of, weights=ratio[bucket], minlength=texts) / np.maximum(size, 1)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat, "score": score,
    }


def quality(
    documents: DataFrame, trusted: DataFrame, threshold: float = -0.05, buckets: int = BUCKETS, min_words: int = 20,
    max_repeat_percent: int = 30, id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row for each document: doc_id, the figures, ``score``, ``base_failed`` and ``kept``.

    ``trusted`` holds the ids of trusted documents (its first column; nulls and ids without a document are ignored).  A
    null text has no words, figures of zero and score zero, and fails the base rules.  A line counts as repeated if it has
    a word and equals an earlier line of its text.  Rows may repeat; other columns are ignored.
    """
    texts = texts_of(documents, id, text)
    corpus = bucket_counts(texts, buckets)
    ids = trusted.select(F.col(f"`{trusted.columns[0]}`").cast("long").alias("id")).where("id IS NOT NULL").distinct()
    chosen = bucket_counts(small_join(texts, ids, ["id"]), buckets)
    shared = documents.sparkSession.sparkContext.broadcast(log_ratio(chosen, corpus))

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        found = figures(part, shared.value)
        return pa.RecordBatch.from_arrays(
            [part.column("id"), *(pa.array(x.astype(np.float64 if n == "score" else np.int64)) for n, x in found.items())],
            names=["doc_id", *found],
        )

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return map_slices(texts, "text", run, schema, SLICE_BYTES).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold)
    )
