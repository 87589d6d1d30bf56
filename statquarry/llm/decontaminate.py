"""Benchmark items inside documents, up to a share of edited words.

A CGK embedding walks along a sequence of words and repeats or steps on by a random function of place and word; sequences
a few edits apart mostly fall back into step, so edit distance becomes Hamming distance.  Each of several walks is sampled
at a few places several times, and the words found there make a key: one of many keys of two sequences agrees with a
chance that grows with their similarity.  Windows have the size of an item; windows and items that share a key are
compared by their exact edit distance.

Which windows are embedded: an item of ``n`` words has ``k + 1`` disjoint runs of words if ``k`` edits are allowed, so one
of them is left whole in every occurrence.  A window is embedded if it lies within ``k`` words of where such a run puts
its item; windows elsewhere cannot be within the distance.  Which item a window belongs to is left to the keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statquarry.llm.arrays import M1, Rolling, hash_slices, mix, sliced, split_words, utf8
from statquarry.llm.storage import keyed, same_row, saved, with_key
from statquarry.llm.tokens import texts_of
from statquarry.session import BROADCAST_ROWS

SLICE_BYTES = 1 << 20
FOUND = "doc_id long, key long, item_id long, start_word long, n_words long, distance int, item_words int"
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = 32


@dataclass(frozen=True)
class Settings:
    """``edits``: allowed edits as a share of an item's words.  ``walks`` times ``samples`` keys of ``places`` words each.

    The tests measure the recall of these keys on planted passages with every allowed number of edits: above 0.95.
    """

    edits: float = 0.2
    walks: int = 16
    samples: int = 8
    places: int = 3
    seed: int = 11
    block_items: int = 20_000
    block_bytes: int = 1 << 24  # items of so many bytes make a block, or one longer item
    window_words: int = 1 << 20  # windows are embedded when so many words have come together
    cells: int = 1 << 21  # so many words of windows, filled up to one width, are embedded at a time
    spread: int = 64  # windows on either side of where a run puts its item; longer items leave some starts out


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in lower case, and where each text's begin.  ASCII signs part words."""
    buf, offsets = utf8(pa.array([(t or "").lower() for t in texts], pa.large_string()))
    buf = _PLAIN[buf]
    words = split_words(buf, offsets)
    return hash_slices(buf, words.start, words.end), words.first


def keys(windows: np.ndarray, size: np.ndarray, settings: Settings) -> np.ndarray:
    """LSH keys, one column each.  ``windows`` holds word hashes (rows filled up by zero) of ``size`` words."""
    steps = 2 * windows.shape[1]
    out = np.empty((len(windows), settings.walks * settings.samples), np.uint64)
    row = np.arange(len(windows))
    padded = np.column_stack([windows, np.zeros(len(windows), np.uint64)])
    for walk in range(settings.walks):
        # both sides draw the same, however wide their tables are
        salt = mix(np.arange(1, steps + 1, dtype=np.uint64) * M1 + np.uint64(settings.seed * 1000 + walk << 32))
        at = np.random.default_rng([settings.seed, walk]).random((settings.samples, settings.places))
        seen = np.empty((steps, len(windows)), np.uint64)
        place = np.zeros(len(windows), np.int64)
        for step in range(steps):
            word = padded[row, place]
            seen[step] = word
            place = np.minimum(place + (mix(word ^ salt[step]) & np.uint64(1)).astype(np.int64), size)
        for sample in range(settings.samples):
            key = size.astype(np.uint64) + np.uint64(1 + walk * settings.samples + sample << 32)
            for fraction in at[sample]:
                # the walk needs about two steps for a word
                key = mix(key * M1 ^ seen[(fraction * 2 * size).astype(np.int64), row])
            out[:, walk * settings.samples + sample] = key
    return out


def by_size(size: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    """Row numbers in groups of sizes that differ by less than a factor of two and fill so many cells, or of one row."""
    order = np.argsort(size, kind="stable")
    low = 0
    while low < len(order):
        width = 1 << int(size[order[low]]).bit_length()
        same = int(np.searchsorted(size[order], width, "left"))
        high = min(same, low + max(1, cells // width))
        yield order[low:high]
        low = high


def table_of(runs: list[np.ndarray]) -> np.ndarray:
    """Runs of words as rows, filled up by zero."""
    out = np.zeros((len(runs), max(map(len, runs), default=0)), np.uint64)
    for k, run in enumerate(runs):
        out[k, : len(run)] = run
    return out


def _ends(pattern: np.ndarray, text: np.ndarray, free: bool) -> np.ndarray:
    """Edit distance of the pattern to the best run that ends at each place (``free``), or to each prefix of the text."""
    count = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64) if free else count.copy()
    for k, word in enumerate(pattern):
        next_ = np.empty_like(row)
        next_[0] = k + 1
        next_[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(next_ - count) + count
    return row


def best_run(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the run of ``text`` nearest to ``pattern``."""
    ends = _ends(pattern, text, True)
    end = int(np.argmin(ends))
    back = _ends(pattern[::-1], text[:end][::-1], False)
    return int(ends[end]), end - int(np.argmin(back)), end


class Items:
    """A block of benchmark items with their runs and keys."""

    def __init__(self, ids: list[int], texts: list[str], settings: Settings):
        hashes, first = words_of(texts)
        self.settings = settings
        self.ids, self.words = [], []
        for k, item in enumerate(ids):
            if first[k + 1] > first[k]:
                self.ids.append(item)
                self.words.append(hashes[first[k] : first[k + 1]])
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.allowed = np.floor(self.size * settings.edits + 1e-9).astype(np.int64)
        run = self.size // (self.allowed + 1)
        # for every length of runs: sorted hashes of the runs, and the item and place of each
        self.runs = {}
        for q in np.unique(run).tolist():
            rows = []
            for k in np.flatnonzero(run == q).tolist():
                grams = Rolling(self.words[k]).windows(q)[: (self.allowed[k] + 1) * q : q]
                rows += [(int(g), k, t * q) for t, g in enumerate(grams[: self.allowed[k] + 1])]
            rows.sort()
            gram = np.array([r[0] for r in rows], np.uint64)
            near = np.zeros(1 << 16, bool)
            near[gram >> np.uint64(48)] = True
            self.runs[q] = (near, gram, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
        found = np.zeros((len(self.words), settings.walks * settings.samples), np.uint64)
        for some in by_size(self.size, settings.cells):
            found[some] = keys(table_of([self.words[k] for k in some.tolist()]), self.size[some], settings)
        order = np.argsort(found.ravel(), kind="stable")
        self.keys, self.key_item = found.ravel()[order], order // found.shape[1]

    def windows(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Rows (text, start, size) of the windows to embed."""
        out = []
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for q, (near, gram, item, place) in self.runs.items():
            grams = Rolling(hashes).windows(q)
            at = np.flatnonzero(near[grams >> np.uint64(48)])
            low, high = np.searchsorted(gram, grams[at], "left"), np.searchsorted(gram, grams[at], "right")
            at, low, high = at[high > low], low[high > low], high[high > low]
            inside = text[at] == text[at + q - 1]
            at, low, number = at[inside], low[inside], (high - low)[inside]
            entry = np.repeat(low - (np.cumsum(number) - number), number) + np.arange(int(number.sum()))
            at = np.repeat(at, number)
            # a start that is left out is a few words from one that isn't: little beside the edits that an item so long may have
            step = np.maximum(-(-self.allowed[item[entry]] // self.settings.spread), 1)
            spread = 2 * (self.allowed[item[entry]] // step) + 1
            shift = np.arange(int(spread.sum())) - np.repeat(np.cumsum(spread) - spread, spread)
            at, entry, step = np.repeat(at, spread), np.repeat(entry, spread), np.repeat(step, spread)
            start = (at - place[entry]) // step * step + step * (shift - self.allowed[item[entry]] // step)
            keep = (start >= first[text[at]]) & (start < first[text[at] + 1])
            out.append(np.column_stack([text[at], start, self.size[item[entry]]])[keep])
        return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 3), np.int64)

    def candidates(self, windows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of window and item that share a key."""
        found = keys(windows, size, self.settings)
        low = np.searchsorted(self.keys, found.ravel(), "left")
        number = np.searchsorted(self.keys, found.ravel(), "right") - low
        hit = np.flatnonzero(number)
        entry = np.repeat(low[hit], number[hit]) + np.arange(int(number[hit].sum())) - np.repeat(
            np.cumsum(number[hit]) - number[hit], number[hit]
        )
        window = np.repeat(hit // found.shape[1], number[hit])
        pairs = np.unique(np.column_stack([window, self.key_item[entry]]), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def matches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, words = [], 0
        for part in sliced(batches, "text", SLICE_BYTES):
            hashes, first = words_of(part.column("text").to_pylist())
            found = self.windows(hashes, first)
            if len(found):
                # only texts with windows are kept waiting
                texts, text = np.unique(found[:, 0], return_inverse=True)
                for number, k in enumerate(texts.tolist()):
                    own = found[text == number]
                    row = part.column("id")[k].as_py(), part.column("key")[k].as_py()
                    waiting.append((row, hashes[first[k] : first[k + 1]], own[:, 1] - first[k], own[:, 2]))
                    words += int(own[:, 2].sum()) + int(first[k + 1] - first[k])
            if words > self.settings.window_words:
                yield self._verified(waiting)
                waiting, words = [], 0
        if waiting:
            yield self._verified(waiting)

    def _verified(self, waiting: list) -> pa.RecordBatch:
        rows = []
        size = np.concatenate([w[3] for w in waiting])
        text = np.repeat(np.arange(len(waiting)), [len(w[3]) for w in waiting])
        start = np.concatenate([w[2] for w in waiting])
        for some in by_size(size, self.settings.cells):
            runs = [waiting[t][1][s : s + n] for t, s, n in zip(text[some].tolist(), start[some].tolist(), size[some].tolist())]
            window, item = self.candidates(np.pad(table_of(runs), ((0, 0), (0, int(size[some].max()) - max(map(len, runs))))), size[some])
            rows.append(np.column_stack([text[some][window], item, start[some][window]]))
        pairs = np.concatenate(rows)
        pairs = pairs[np.lexsort((pairs[:, 2], pairs[:, 1], pairs[:, 0]))]
        out = []
        for t, item in np.unique(pairs[:, :2], axis=0).tolist():
            starts = pairs[(pairs[:, 0] == t) & (pairs[:, 1] == item), 2]
            n, allowed, words = int(self.size[item]), int(self.allowed[item]), waiting[t][1]
            best = None
            # windows that touch make one stretch of text
            for group in np.split(starts, np.flatnonzero(np.diff(starts) > n) + 1):
                low, high = max(0, int(group[0]) - allowed), int(group[-1]) + n + allowed
                distance, a, b = best_run(self.words[item], words[low:high])
                if distance <= allowed and (best is None or distance < best[0]):
                    best = (distance, low + a, low + b)
            if best:
                out.append((*waiting[t][0], self.ids[item], best[1], best[2] - best[1], best[0], n))
        columns = list(zip(*out)) if out else [[]] * 7
        kinds = [pa.int64()] * 5 + [pa.int32()] * 2
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["doc_id", "key", "item_id", "start_word", "n_words", "distance", "item_words"],
        )


def contaminated(
    documents: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row for each document and benchmark item of which it holds a passage: (doc_id, key, item_id, start_word, n_words,
    distance, item_words), the nearest passage if there are several; ``key`` is a hash of the document's text.

    Words are compared in lower case, ASCII signs part them.  A passage counts if at most ``edits`` of the item's words
    (rounded down) must be inserted, deleted or replaced.  Null texts are empty; items without words (or a null id) match
    nothing; equal rows and items give equal rows.  Items are taken in blocks of about ``block_items`` and ``block_bytes``,
    each sent to all tasks, so a larger benchmark costs more passes, not more memory.  Items of any length are embedded in
    groups of like size; of items of over 5 x ``spread`` words (at 20 % of edits) not every start is tried.
    """
    texts = keyed(documents, id, text)
    items = texts_of(benchmark, item, item_text).where("id IS NOT NULL")
    number, size = items.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-number // settings.block_items), -(-(size or 0) // settings.block_bytes))
    out = None
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).orderBy("id", "text").collect()
        held = documents.sparkSession.sparkContext.broadcast(Items([r[0] for r in rows], [r[1] for r in rows], settings))
        found = texts.mapInArrow(lambda batches, held=held: held.value.matches(batches), FOUND)
        out = found if out is None else out.union(found)
    return out


def without_contaminated(
    documents: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The documents that hold no passage of a benchmark item, with all their columns."""
    found = contaminated(documents, benchmark, settings, id, text, item, item_text)
    found = saved(found.select(F.col("doc_id").alias("id"), "key").distinct(), "contaminated")
    held = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
    rows = with_key(documents, id, text)
    return rows.join(held, same_row(rows, held), "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])
