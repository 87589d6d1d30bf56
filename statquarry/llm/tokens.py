"""Tokens of whole texts: counts by transducers, ids for packing."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from statquarry.llm.arrays import map_slices
from statquarry.llm.transducer import MAX_KNOWN, Memo, Pieces, Specification, TokenCounts, different

SLICE_BYTES = 1 << 20
ENCODED = 1 << 11  # pieces that the library encodes at a time: each encoding is an object of a kilobyte
_HELD: dict[str, tuple[int, object]] = {}


def held(kind: type, shared: Broadcast):
    """One object of a kind for each Python worker: what it has compiled serves the next task."""
    number, made = _HELD.get(kind.__name__, (None, None))
    if number != shared.value.content:
        made = kind(shared.value)
        _HELD[kind.__name__] = (shared.value.content, made)
    return made


def forget() -> None:
    """Drop what this worker holds for later tasks; they make it again."""
    _HELD.clear()


def specification(documents: DataFrame, path: str) -> Broadcast:
    """The compiled tables of a tokenizer file (a few MB, whatever the corpus), for all tasks."""
    return documents.sparkSession.sparkContext.broadcast(Specification(Path(path).read_text(encoding="utf-8")))


def texts_of(documents: DataFrame, id: str, text: str) -> DataFrame:
    return documents.select(
        F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")
    )


def count_tokens(documents: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for each document, by the transducers compiled from the tokenizer file at ``path``.

    Special strings of the file inside a text count as one token each, as the tokenizer handles them by default.  A null
    text is empty and has no tokens; ids may be null or repeat; other columns are ignored.
    """
    shared = specification(documents, path)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        counts = held(TokenCounts, shared).counts(part.column("text").to_pylist())
        return pa.RecordBatch.from_arrays(
            [part.column("id"), part.column("n_bytes"), pa.array(counts)], names=["doc_id", "n_bytes", "n_tokens"]
        )

    texts = texts_of(documents, id, text).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return map_slices(texts, "text", run, "doc_id long, n_bytes long, n_tokens long", SLICE_BYTES)


class TokenIds:
    """Ids of whole texts.  The library encodes each different piece once, and any text with a special string whole."""

    def __init__(self, specification: Specification):
        self.pieces = Pieces(specification)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads would hold memory of their own
        self.library = Tokenizer.from_str(specification.content)
        self.clear()

    def clear(self) -> None:
        self.memo, self.store, self.used = Memo(), np.zeros(1 << 16, np.uint32), 0

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of every text."""
        whole = [k for k, text in enumerate(texts) if "<|" in text and self.pieces.special.search(text)]
        plain = list(texts)
        for k in whole:
            plain[k] = ""
        buf, start, end, doc = self.pieces.of(plain)
        names, place, which = different(buf, start, end)
        if len(self.memo) > MAX_KNOWN:
            self.clear()
        refs, known = self.memo.find(names)
        fresh = np.flatnonzero(~known)
        if len(fresh):
            body = buf.tobytes()
            at = place[fresh]
            sizes, flats = [], []
            for low in range(0, len(at), ENCODED):
                some = at[low : low + ENCODED]
                words = [body[a:b].decode("utf-8", "surrogatepass") for a, b in zip(start[some].tolist(), end[some].tolist())]
                found = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
                sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
                flats.append(np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes[-1].sum())))
            size, flat = np.concatenate(sizes), np.concatenate(flats)
            while self.used + len(flat) > len(self.store):
                self.store = np.concatenate([self.store, np.zeros_like(self.store)])
            self.store[self.used : self.used + len(flat)] = flat
            refs[fresh] = (self.used + np.cumsum(size) - size) << 24 | size
            self.used += len(flat)
            self.memo.add(names[fresh], refs[fresh])
        ref = refs[which]
        size, begin = ref & 0xFFFFFF, ref >> 24
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        out = self.store[np.repeat(begin - (stop - size), size) + np.arange(total)]
        number = np.bincount(doc, weights=size, minlength=len(texts)).astype(np.int64)
        if not whole:
            return out, number
        cuts = np.append(0, np.cumsum(number))
        lists = [out[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        for k in whole:
            lists[k] = np.array(self.library.encode(texts[k], add_special_tokens=False).ids, np.uint32)
            number[k] = len(lists[k])
        return np.concatenate(lists), number
