"""Toxicity of whole texts by subword-bag embeddings and a linear softmax, trained jointly.

A word is the bag of its byte n-grams (with its borders) and of itself; every n-gram has a vector in a hashed table.  The
vectors of a word are averaged and go through a linear softmax over (clean, toxic).  A text scores as its most toxic word,
so one insult counts as much in 20,000 words as in ten, and a misspelling that was never seen scores by the n-grams it
shares with words that were.

Training is full-batch gradient descent in numpy, first with every word under its document's label, then with the most
toxic words of each document only.  Because the softmax is linear, a scoring task needs one number per table row: the
vector's product with the difference of the two output vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statquarry.llm.arrays import M1, PAD, _LOW, hash_slices, join_words, lanes, map_slices, mix, release, sliced, split_words, utf8
from statquarry.llm.tokens import forget, texts_of

SLICE_BYTES = 1 << 20
STRIPE = 1 << 14  # so many rows of the table are filled or moved at a time
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    """``max_toxic`` and ``max_clean`` bound the labelled documents that are learned from."""

    max_toxic: int = 4000
    max_clean: int = 8000
    bits: int = 18
    size: int = 16
    shortest: int = 3
    longest: int = 6
    first_rounds: int = 30
    rounds: int = 120
    refresh: int = 20  # after so many rounds, look again which words of a document are its most toxic ones
    looked_at: int = 12  # so many of them are kept between two looks
    rate: float = 0.5
    seed: int = 7


def _lower(buf: np.ndarray) -> np.ndarray:
    return np.where((buf - np.uint8(65)) < 26, buf + np.uint8(32), buf)


def bordered(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words between single blanks: bytes, the place of the blank before each word, and the words' ranges by text."""
    words = split_words(buf, offsets)
    body, stop = join_words(_lower(buf), words.start, words.end, np.array([0, len(words.start)]))
    line = np.full(int(stop[-1]) + 2 + PAD, 32, np.uint8)
    line[1 : int(stop[-1]) + 1] = body[: int(stop[-1])]
    size = words.end - words.start + 1
    return line, np.cumsum(size) - size, words.first


def grams(line: np.ndarray, blank: np.ndarray, settings: Settings):
    """For every n-gram length: the table rows at all places, and which places are inside one word with its borders."""
    if not len(blank):
        return
    total = len(line) - PAD
    size = np.diff(np.append(blank, total - 1))
    border = np.repeat(np.append(blank[1:], total - 1), size)  # the blank after each place
    left = border - np.arange(len(border))
    eight, shift = lanes(line)[: len(border)], np.uint64(64 - settings.bits)
    for n in range(settings.shortest, settings.longest + 1):
        yield (mix((eight & _LOW[n]) + np.uint64(n * int(M1) % (1 << 64))) >> shift).astype(np.int32), left >= n - 1
    whole = np.zeros(len(border), np.int32)
    whole[blank] = (mix(hash_slices(line, blank + 1, blank + size) ^ M1) >> shift).astype(np.int32)
    first = np.zeros(len(border), bool)
    first[blank] = True
    yield whole, first


def word_scores(line: np.ndarray, blank: np.ndarray, weights: np.ndarray, settings: Settings) -> np.ndarray:
    """Mean table value of every word's bag."""
    if not len(blank):
        return np.zeros(0)
    span = len(line) - PAD - 1
    total, count = np.zeros(span, np.float32), np.zeros(span, np.float32)
    for rows, inside in grams(line, blank, settings):
        total += weights[rows] * inside
        count += inside
    return np.add.reduceat(total, blank, dtype=np.float64) / np.add.reduceat(count, blank, dtype=np.float64)


@dataclass
class Model:
    weights: np.ndarray  # one number for each table row: log odds that its vector gives
    bias: float
    settings: Settings

    def scores(self, column: pa.Array) -> np.ndarray:
        line, blank, first = bordered(*utf8(column))
        logits = word_scores(line, blank, self.weights, self.settings) + self.bias
        out = np.full(len(first) - 1, min(self.bias, -3.0))
        full = np.flatnonzero(np.diff(first))
        if len(full):
            out[full] = np.maximum.reduceat(logits, first[full])
        return 1 / (1 + np.exp(-out))


def stretches(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The given runs of bytes, one after another."""
    stop = np.cumsum(size)
    return buf[np.repeat(start - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)]


def vocabulary(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different words: their bytes, each after a blank, and where each begins; and the (text, word) pairs there are.

    Works through slices of the texts, as tasks do: memory hangs on the number of words, not on their bytes times eight.
    """
    docs, words, known, bodies, sizes, row = [], [], [], [], [], 0
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    for part in sliced([batch], "text", SLICE_BYTES):
        line, blank, first = bordered(*utf8(part.column("text")))
        size = np.diff(np.append(blank, max(len(line) - PAD - 1, 0)))
        found, at, word = np.unique(hash_slices(line, blank + 1, blank + size), return_index=True, return_inverse=True)
        doc, word = np.divmod(np.unique(np.repeat(np.arange(len(first) - 1), np.diff(first)) << 32 | word), 1 << 32)
        docs.append((doc + row).astype(np.int32))
        words.append(word.astype(np.int32))
        known.append(found)
        bodies.append(stretches(line, blank[at], size[at]))
        sizes.append(size[at])
        row += part.num_rows
    names, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *known]), return_index=True)
    words = [np.searchsorted(names, found).astype(np.int32)[word] for found, word in zip(known, words)]
    line, size = np.concatenate([np.zeros(0, np.uint8), *bodies]), np.concatenate([np.zeros(0, np.int64), *sizes])
    del bodies, sizes, known, names
    begin, size = (np.cumsum(size) - size)[at], size[at]
    parts = [stretches(line, begin[k : k + STRIPE], size[k : k + STRIPE]) for k in range(0, len(at), STRIPE)]
    line = np.concatenate([*parts, np.full(1 + PAD, 32, np.uint8)])
    empty = np.zeros(0, np.int32)
    return line, np.append(0, np.cumsum(size)), np.concatenate([empty, *docs]), np.concatenate([empty, *words])


def train(texts: pa.Array | list[str], toxic: np.ndarray, settings: Settings = Settings()) -> Model:
    """Fit vectors and softmax on whole texts.  With one class only, or no word, the score is the toxic share."""
    return learn(vocabulary(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())), toxic, settings)


def learn(found: tuple, toxic: np.ndarray, settings: Settings = Settings()) -> Model:
    """Fit vectors and softmax on what ``vocabulary`` returns of the texts."""
    toxic = np.asarray(toxic, float)
    line, begin, doc, word = found
    number = len(begin) - 1
    if not number or not 0 < toxic.sum() < len(toxic):
        share = (toxic.sum() + 0.01) / (len(toxic) + 1)
        return Model(np.zeros(1 << settings.bits, np.float32), float(np.log(share / (1 - share))), settings)
    head = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    label = toxic[doc[head]]
    slot = np.repeat(np.arange(len(head), dtype=np.int32), np.diff(np.append(head, len(doc))))
    del found, doc
    # bags of the different words, for each n-gram length and block: table rows, and how many of them each word has
    bags = []
    for low in range(0, number, 1 << 15):
        at = begin[low : low + (1 << 15) + 1]
        block = np.concatenate([line[at[0] : at[-1]], np.full(1 + PAD, 32, np.uint8)])
        bags += [
            (rows[inside], low, np.add.reduceat(inside, at[:-1] - at[0], dtype=np.int32))
            for rows, inside in grams(block, at[:-1] - at[0], settings)
        ]
    del line, begin, block
    release()
    count = np.zeros(number, np.int64)
    for _, low, sizes in bags:
        count[low : low + len(sizes)] += sizes
    draw = np.random.default_rng(settings.seed)
    table = np.empty((1 << settings.bits, settings.size), np.float32)
    for low in range(0, len(table), STRIPE):
        table[low : low + STRIPE] = draw.standard_normal(table[low : low + STRIPE].shape) / settings.size
    out = (draw.standard_normal((settings.size, 2)) / settings.size).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen = [np.full_like(x, 1e-6) for x in (table, out, bias)]
    one, zero = np.zeros(number), np.zeros(number)
    for low in range(0, len(word), 1 << 19):
        of, sign = word[low : low + (1 << 19)], label[slot[low : low + (1 << 19)]]
        one += np.bincount(of, weights=sign, minlength=number)
        zero += np.bincount(of, weights=1 - sign, minlength=number)
    one, zero = one / label.sum(), zero / (1 - label).sum()

    def word_logits(bags: list, count: np.ndarray) -> np.ndarray:
        value = table @ (out[:, 1] - out[:, 0])
        total = np.zeros(len(count))
        for rows, low, sizes in bags:
            total[low : low + len(sizes)] += np.bincount(
                np.repeat(np.arange(len(sizes)), sizes), weights=value[rows], minlength=len(sizes)
            )
        return total / count + (bias[1] - bias[0])

    def step(place, x: np.ndarray, grad: np.ndarray, past: np.ndarray) -> None:
        past[place] += grad * grad
        x[place] -= settings.rate * grad / np.sqrt(past[place])

    def descend(error: np.ndarray, bags: list, count: np.ndarray) -> None:
        """One AdaGrad step along the gradient of the loss by every word's log odds."""
        part = error / count
        by_row = np.zeros(len(table))
        for rows, low, sizes in bags:
            by_row += np.bincount(rows, weights=np.repeat(part[low : low + len(sizes)], sizes), minlength=len(table))
        by_row = by_row.astype(np.float32)
        moved = np.flatnonzero(by_row)
        by_row = by_row[moved]
        grad_out = by_row @ table[moved]
        toward = out[:, 1] - out[:, 0]
        # the table's rows move stripe by stripe, so that temporary arrays stay small beside it
        for low in range(0, len(moved), STRIPE):
            step(moved[low : low + STRIPE], table, by_row[low : low + STRIPE, None] * toward, seen[0])
        step(slice(None), out, np.column_stack([-grad_out, grad_out]), seen[1])
        step(slice(None), bias, np.array([-error.sum(), error.sum()], np.float32), seen[2])

    for _ in range(settings.first_rounds):
        odds = 1 / (1 + np.exp(-word_logits(bags, count)))
        descend(odds * (one + zero) - one, bags, count)
    for x in seen:
        x[...] = 1e-6
    for turn in range(settings.rounds):
        if turn % settings.refresh == 0:
            # the most toxic words of every document, and their bags
            some = None
            logits, most = word_logits(bags, count).astype(np.float32), settings.looked_at
            near = np.concatenate([
                low + (np.argpartition(-logits[word[low:high]], most)[:most] if high - low > most else np.arange(high - low))
                for low, high in zip(head.tolist(), [*head[1:].tolist(), len(word)])
            ])
            chosen = np.unique(word[near])
            taken, again = np.zeros(number, bool), np.full(number, -1, np.int32)
            taken[chosen], again[chosen] = True, np.arange(len(chosen))
            some = []
            for rows, low, sizes in bags:
                own = taken[low : low + len(sizes)]
                some.append((rows[np.repeat(own, sizes)], int(taken[:low].sum()), sizes[own]))
            words, at_doc, few = again[word[near]], slot[near], count[chosen]
            del logits, near, again, taken
            release()
            begin = np.flatnonzero(np.append(True, at_doc[1:] != at_doc[:-1]))
        own = word_logits(some, few)[words]
        best = np.maximum.reduceat(own, begin)[at_doc]
        # the most toxic word decides; clean documents answer for all words that come near it or above even odds
        counts = (own >= best - 1e-9) | (label[at_doc] == 0) & ((own >= best - 1.0) | (own > 0))
        error = np.where(counts, 1 / (1 + np.exp(-own)) - label[at_doc], 0.0) / len(head)
        descend(np.bincount(words, weights=error, minlength=len(few)), some, few)
    used = np.zeros(len(table), bool)
    for rows, _, _ in bags:
        used[rows] = True
    value = table @ (out[:, 1] - out[:, 0])
    value[~used] = 0  # n-grams never seen say nothing
    return Model(value.astype(np.float32), float(bias[1] - bias[0]), settings)


def labelled(documents: DataFrame, labels: DataFrame, settings: Settings, id: str, text: str, label: str) -> DataFrame:
    """(id, toxic, words): the different words of a bounded sample of labelled documents, chosen by a hash of the id alone.

    Of texts that share an id the greatest is learned from.
    """
    known = (
        labels.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{label}`").alias("toxic"))
        .where("id IS NOT NULL AND toxic IS NOT NULL AND crc32(cast(id AS string)) % 5 <> 0")
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    )
    parts = [
        known.where(F.col("toxic") == value).orderBy(F.xxhash64("id"), "id").limit(most)
        for value, most in ((1, settings.max_toxic), (0, settings.max_clean))
    ]
    chosen = F.broadcast(parts[0].union(parts[1]))  # max_toxic + max_clean rows at most
    words = F.array_join(F.array_distinct(F.split(F.translate("text", UPPER, LOWER), r"[\x20\x09-\x0D]+")), " ")
    return texts_of(documents, id, text).join(chosen, "id").groupBy("id").agg(
        F.max("toxic").cast("double").alias("toxic"), F.max(words).alias("words")
    )


def fitted(documents: DataFrame, labels: DataFrame, settings: Settings, id: str, text: str, label: str) -> Model:
    """The model of a bounded sample, trained in one task: the driver receives ``2 ** bits`` numbers and no text.

    The task reads max_toxic + max_clean rows at most; a lost executor means that another one trains the same model.
    """

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        del held
        words = table.column("words").cast(pa.large_string()).combine_chunks()
        words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
        toxic = table.column("toxic").to_numpy()
        del table
        known = [vocabulary(words)]
        del words
        forget()
        release()
        model = learn(known.pop(), toxic, settings)
        release()
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], names=["weights", "bias"]
        )

    rows = labelled(documents, labels, settings, id, text, label).repartition(1).sortWithinPartitions("id")
    found = rows.mapInArrow(fit, "weights binary, bias double").collect()
    if not found:
        return train([], np.zeros(0), settings)
    return Model(np.frombuffer(bytes(found[0]["weights"]), np.float32), found[0]["bias"], settings)


def toxicity(
    documents: DataFrame, labels: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text",
    label: str = "toxic",
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each document.

    Labels of ids whose crc32 leaves the remainder 0 by 5 are never read.  A text without words (empty, null) has a fixed
    low score.  Rows may repeat; a null id is not held out; an id labelled twice is toxic if one label says so.
    """
    model = fitted(documents, labels, settings, id, text, label)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # 2 ** bits numbers

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(shared.value.scores(part.column("text")))], names=["doc_id", "score"]
        )

    scored = map_slices(texts_of(documents, id, text), "text", run, "doc_id long, score double", SLICE_BYTES)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(
    documents: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.5, id: str = "doc_id",
    text: str = "text", label: str = "toxic",
) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns and without a shuffle."""
    model = fitted(documents, labels, settings, id, text, label)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        return part.filter(pa.array(shared.value.scores(part.column(text)) < threshold))

    return map_slices(documents, text, run, documents.schema, SLICE_BYTES)
