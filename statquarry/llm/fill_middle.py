"""Fill-in-the-middle transformation of texts through piece tables.

A text is never edited.  It is described by a table of pieces, each a stretch (buffer, start, length) of one of two
buffers that don't change: the texts and the sentinels.  Cutting splits descriptors, an arrangement permutes them, the
inverse permutation restores the text, and hashes read the stretches in the order of the descriptors without joining them.
The tables of all texts of a slice are numpy columns; nothing is shuffled, and memory hangs on the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from statquarry.llm.arrays import as_binary, map_slices, utf8
from statquarry.llm.tokens import texts_of

SLICE_BYTES = 1 << 20
SENTINELS = ("<P>", "<S>", "<M>")  # before the prefix, the suffix and the middle
TEXT, MARKS = 0, 1  # the two buffers
# places of the pieces [P, S, M, prefix, middle, suffix] in an output of each form; without sentinels the text stays as it is
ORDERS = {"plain": [0, 1, 2, 3, 4, 5], "psm": [0, 3, 1, 5, 2, 4], "spm": [1, 5, 0, 3, 2, 4]}
FORMS = list(ORDERS)
ARRANGED = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string, "
    "pieces array<struct<buffer: int, start: long, length: long>>"
)


@dataclass(frozen=True)
class Rates:
    """``seed`` goes before the id into the hash that draws; so many texts in a hundred are arranged, and so many of these
    with the suffix first."""

    seed: str = "1"
    percent: int = 90
    suffix_first: int = 20


@dataclass
class PieceTables:
    """A piece table for each text, one in a row; pieces of length zero are allowed."""

    buffer: np.ndarray
    start: np.ndarray
    length: np.ndarray

    @staticmethod
    def whole(offsets: np.ndarray) -> PieceTables:
        """Tables of one piece, the whole text."""
        start = offsets[:-1, None].astype(np.int64)
        return PieceTables(np.full(start.shape, TEXT, np.int8), start, offsets[1:, None] - start)

    @staticmethod
    def marks(sentinels: tuple[str, ...], present: np.ndarray) -> PieceTables:
        """Tables of all sentinels; they are empty where ``present`` is false."""
        size = np.array([len(s.encode()) for s in sentinels], np.int64)
        start = np.tile(np.cumsum(size) - size, (len(present), 1))
        return PieceTables(np.full(start.shape, MARKS, np.int8), start, present[:, None] * size)

    def cut(self, at: np.ndarray) -> PieceTables:
        """Split the piece that holds the distance ``at`` from a table's beginning in two."""
        ends = np.cumsum(self.length, axis=1)
        split = np.minimum((ends < at[:, None]).sum(axis=1), self.length.shape[1] - 1)[:, None]
        left = at[:, None] - np.take_along_axis(ends - self.length, split, 1)
        column = np.arange(self.length.shape[1] + 1)[None, :]
        old = np.where(column <= split, column, column - 1)
        buffer, start, length = (np.take_along_axis(x, old, 1) for x in (self.buffer, self.start, self.length))
        length = np.where(column == split, left, np.where(column == split + 1, length - left, length))
        return PieceTables(buffer, np.where(column == split + 1, start + left, start), length)

    def beside(self, other: PieceTables) -> PieceTables:
        """The pieces of these tables, then those of the others."""
        both = ((self.buffer, other.buffer), (self.start, other.start), (self.length, other.length))
        return PieceTables(*(np.concatenate(x, axis=1) for x in both))

    def permuted(self, order: np.ndarray) -> PieceTables:
        """Piece ``order[r, k]`` of row r comes at place k."""
        return PieceTables(*(np.take_along_axis(x, order, 1) for x in (self.buffer, self.start, self.length)))

    def last(self, number: int) -> PieceTables:
        return PieceTables(self.buffer[:, -number:], self.start[:, -number:], self.length[:, -number:])

    def stream(self, buffers: tuple) -> Iterator[list[memoryview]]:
        """The stretches of every table, in order, as views of the buffers."""
        views = [memoryview(b) for b in buffers]
        rows = zip(self.buffer.tolist(), self.start.tolist(), (self.start + self.length).tolist())
        for buffer, start, end in rows:
            yield [views[b][a:z] for b, a, z in zip(buffer, start, end) if z > a]

    def digests(self, buffers: tuple) -> list[str]:
        """SHA-256 of every table's text, fed stretch by stretch."""
        out = []
        for stretches in self.stream(buffers):
            running = hashlib.sha256()
            for stretch in stretches:
                running.update(stretch)
            out.append(running.hexdigest())
        return out

    def written(self, buffers: tuple) -> pa.Array:
        """Every table's text, as a column."""
        body = b"".join(stretch for stretches in self.stream(buffers) for stretch in stretches)
        return as_binary(np.frombuffer(body, np.uint8), np.append(0, np.cumsum(self.length.sum(axis=1))), text=True)

    def listed(self, offsets: np.ndarray) -> pa.Array:
        """The descriptors as a column; starts in the text buffer count from the text's own beginning."""
        start = np.where(self.buffer == TEXT, self.start - offsets[:-1, None], self.start)
        columns = [pa.array(self.buffer.ravel().astype(np.int32)), pa.array(start.ravel()), pa.array(self.length.ravel())]
        ends = np.arange(len(start) + 1, dtype=np.int32) * start.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, ["buffer", "start", "length"]))


def unit_starts(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units (runs of A-Z and a-z, or one other character) begin, and whether a character begins at each byte."""
    body = buf[: int(offsets[-1])]
    letter = (np.bitwise_or(body, np.uint8(32)) - np.uint8(97)) < 26
    character = (body & 0xC0) != 0x80
    after = np.zeros(len(body), bool)  # a letter that continues a run
    after[1:] = letter[1:] & letter[:-1]
    after[offsets[:-1][offsets[:-1] < len(body)]] = False
    return np.flatnonzero(character & ~after), character


def draws(ids: pa.Array, seed: str) -> np.ndarray:
    """Four unsigned 32-bit numbers for each id, from the SHA-256 of seed, colon and id."""
    raw = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids.to_pylist()]
    return np.frombuffer(b"".join(raw), ">u4").reshape(-1, 4).astype(np.int64)


def holds_any(texts: pa.Array, buf: np.ndarray, offsets: np.ndarray, marks: list[bytes]) -> np.ndarray:
    """Which texts contain one of the sentinels."""
    body, found = buf[: int(offsets[-1])].tobytes(), np.zeros(len(offsets) - 1, bool)
    for mark in marks:
        at = body.find(mark)
        while at >= 0:
            text = int(np.searchsorted(offsets, at, side="right")) - 1
            if at + len(mark) <= offsets[text + 1]:  # not across two texts
                found[text] = True
                at = body.find(mark, int(offsets[text + 1]))
            else:
                at = body.find(mark, at + 1)
    return found


def fill_in_middle(
    documents: DataFrame, id: str = "doc_id", text: str = "text", rates: Rates = Rates(),
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, output_sha256, pieces) for each document.

    A text of ``n`` units (see ``unit_starts``) is cut after two drawn numbers of units into prefix, middle and suffix.
    ``form`` is ``psm`` (prefix, suffix, middle, each behind its sentinel), ``spm`` (suffix first) or ``plain`` (the text as
    it is): always for an empty or null text and one that contains a sentinel, else as drawn from the id.  Lengths of parts
    are in characters and null for plain texts.  A null id draws like an id without digits; rows that repeat are treated
    alike; other columns are ignored.
    """
    marks = [s.encode() for s in sentinels]
    fixed = np.frombuffer(b"".join(marks), np.uint8)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        buf, offsets = utf8(part.column("text"))
        starts, character = unit_starts(buf, offsets)
        first = np.searchsorted(starts, offsets)
        n = np.diff(first)
        drawn = draws(part.column("id"), rates.seed)
        plain = (n == 0) | holds_any(part.column("text"), buf, offsets, marks) | (drawn[:, 2] % 100 >= rates.percent)
        form = np.where(plain, 0, np.where(drawn[:, 3] % 100 < rates.suffix_first, FORMS.index("spm"), FORMS.index("psm")))
        places = np.append(starts, offsets[-1])
        cuts = []
        for unit in (np.minimum(drawn[:, 0] % (n + 1), drawn[:, 1] % (n + 1)), np.maximum(drawn[:, 0] % (n + 1), drawn[:, 1] % (n + 1))):
            place = np.where(unit < n, places[np.minimum(first[:-1] + unit, len(starts))], offsets[1:])
            cuts.append(np.where(plain, 0, place - offsets[:-1]))
        low, high = cuts
        tables = PieceTables.whole(offsets).cut(low).cut(high)
        tables = PieceTables.marks(sentinels, ~plain).beside(tables).permuted(np.array(list(ORDERS.values()))[form])
        buffers = (buf, fixed)
        chars = np.append(0, np.cumsum(character))
        prefix, middle = chars[offsets[:-1] + low] - chars[offsets[:-1]], chars[offsets[:-1] + high] - chars[offsets[:-1] + low]
        return pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(n.astype(np.int64)), pa.array(np.array(FORMS, object)[form], pa.string()),
             pa.array(prefix.astype(np.int64), mask=plain), pa.array(middle.astype(np.int64), mask=plain),
             tables.written(buffers), pa.array(tables.digests(buffers), pa.string()), tables.listed(offsets)],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "pieces"],
        )

    return map_slices(texts_of(documents, id, text), "text", run, ARRANGED, SLICE_BYTES)


def restore(
    arranged: DataFrame, sentinels: tuple[str, str, str] = SENTINELS, output: str = "output", form: str = "form",
) -> DataFrame:
    """All columns, and ``restored`` and ``restored_sha256``: the text of each output, rebuilt from output and form alone.

    The output's table is cut around its sentinels, which the text does not contain, and its pieces are put back by the
    inverse of the form's permutation.  A null output gives an empty text, an unknown form an error.
    """
    marks = [s.encode() for s in sentinels]
    schema = StructType([
        *arranged.schema.fields, StructField("restored", StringType()), StructField("restored_sha256", StringType())
    ])

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        buf, offsets = utf8(part.column(output))
        body = memoryview(buf)
        forms = np.array([FORMS.index(x) for x in part.column(form).to_pylist()], np.int64)
        cuts = np.zeros((len(forms), 5), np.int64)
        for row in np.flatnonzero(forms).tolist():
            order = ORDERS[FORMS[forms[row]]]
            whole, at, places = bytes(body[offsets[row] : offsets[row + 1]]), 0, []
            for piece in order[::2]:  # a sentinel stands at every other place
                at = whole.index(marks[piece], at)
                places += [at, at + len(marks[piece])]
            cuts[row] = places[1:]
        tables = PieceTables.whole(offsets)
        for k in range(5):
            tables = tables.cut(cuts[:, k])
        # plain: all cuts at 0, so the whole text is the last piece and the others are empty
        inverse = np.argsort(np.array(list(ORDERS.values())), axis=1)
        tables = tables.permuted(inverse[forms]).last(3)
        return pa.RecordBatch.from_arrays(
            [*part.columns, tables.written((buf,)), pa.array(tables.digests((buf,)), pa.string())], names=schema.names
        )

    return map_slices(arranged, output, run, schema, SLICE_BYTES)
