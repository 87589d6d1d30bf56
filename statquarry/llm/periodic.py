"""Periodic runs of words: stretches that repeat a short stretch again and again.

A run is a stretch of words with smallest period q, long enough and of enough periods, that no neighbouring word extends
keeping the period.  Words are appended to a suffix automaton.  In the tree of its suffix links a node stands for the words
sequences that end at the same places, and the path from a prefix's node to the root for all that end at the prefix's end.
Every node has a colour, the last place where its sequences ended.  Appending a word gives its whole path the new place;
the path is accessed as in a link-cut tree, whose preferred paths have one colour each, so a word meets a logarithmic number
of segments on average.  A segment of colour ``e`` and greatest length ``l``, met at place ``i``, says that the last
``l`` words occurred last at the distance ``d = i - e``.  Where ``d <= l`` they overlap or touch: a square of the smallest
period ``d``, which reaches ``l + d`` words back from ``i`` and no further.  Squares of one beginning and period are one run,
which ends where the last of them ends.

Words that cannot lie in a run are not appended: a gram of three words inside a run occurs there nearly as often as the
period does, so a stretch of grams that are rarer in their text holds none.  This leaves no run out and finds none itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Hashable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from statquarry.llm.arrays import (
    M1, Rolling, as_binary, hash_slices, join_words, map_slices, mix, split_words, utf8,
)
from statquarry.llm.tokens import texts_of

SLICE_BYTES = 1 << 20
GRAM = 3
FOUND = "doc_id long, n_words long, n_dropped long, kept string, runs array<struct<start: long, length: long, period: long>>"


@dataclass(frozen=True)
class Rule:
    """A run has ``least`` words or more, and ``times`` its period or more (2 at least)."""

    least: int = 6
    times: int = 4

    def gram_count(self) -> int:
        """How often each gram of a run occurs in it at least: periods of two and more, and the period of one."""
        return min(self.times - 1, max(self.least, self.times) - GRAM + 1)


def suffix_automaton(units: Sequence[Hashable]) -> tuple[list[int], list[int], list[int]]:
    """Suffix link and greatest length of every state, and the state of every prefix."""
    follow: list[dict] = [{}]
    link, length, prefixes, last = [-1], [0], [], 0
    for unit in units:
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and unit not in follow[p]:
            follow[p][unit] = new
            p = link[p]
        if p >= 0:
            q = follow[p][unit]
            if length[q] != length[p] + 1:
                clone = len(follow)
                follow.append(follow[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = clone
                while p >= 0 and follow[p].get(unit) == q:
                    follow[p][unit] = clone
                    p = link[p]
                q = clone
            link[new] = q
        prefixes.append(new)
        last = new
    return link, length, prefixes


class LastPlaces:
    """The suffix-link tree as preferred paths of one colour each.

    Every preferred path is a splay tree ordered by depth; its root's parent is the tree node above the path, and its root
    holds the colour of all of it.
    """

    def __init__(self, link: list[int]):
        self.up = link
        self.left = [-1] * len(link)
        self.right = [-1] * len(link)
        self.colour = [-1] * len(link)

    def splay(self, x: int) -> None:
        up, left, right, colour = self.up, self.left, self.right, self.colour
        while True:
            p = up[x]
            if p < 0:
                return
            if left[p] == x:
                below = False
            elif right[p] == x:
                below = True
            else:
                return
            g = up[p]
            inner = g >= 0 and (left[g] == p or right[g] == p)
            if inner:
                # one side twice: turn the parent first; either way the root's colour reaches x with the last turn
                y, z = (p, g) if (left[g] == p) != below else (x, p)
                self.turn(y, z)
                self.turn(x, up[x])
            else:
                self.turn(x, p)
            if not inner:
                return

    def turn(self, x: int, p: int) -> None:
        up, left, right = self.up, self.left, self.right
        g = up[p]
        if left[p] == x:
            moved = left[p] = right[x]
            right[x] = p
        else:
            moved = right[p] = left[x]
            left[x] = p
        if moved >= 0:
            up[moved] = p
        up[p] = x
        up[x] = g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        self.colour[x] = self.colour[p]

    def access(self, node: int, place: int) -> list[tuple[int, int]]:
        """Colour the path from ``node`` to the root with ``place``.  Returns (deepest node, old colour) of its segments."""
        up, right, colour = self.up, self.right, self.colour
        met, below, x = [], -1, node
        while x >= 0:
            self.splay(x)
            old, cut = colour[x], right[x]
            if cut >= 0:
                colour[cut] = old
            right[x] = below
            if old >= 0:
                met.append((x, old))
            below, x = x, up[x]
        self.splay(node)
        colour[node] = place
        return met


def runs_of(units: Sequence[Hashable], rule: Rule = Rule()) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence, by start, then period."""
    link, length, prefixes = suffix_automaton(units)
    places, times, least = LastPlaces(link), rule.times, rule.least
    ends: dict[tuple[int, int], int] = {}
    for place, state in enumerate(prefixes):
        for node, before in places.access(state, place):
            period = place - before
            size = length[node] + period
            if size >= times * period and size >= least:
                ends[place - size + 1, period] = place
    return sorted((start, end - start + 1, period) for (start, period), end in ends.items())


def stretches(hashes: np.ndarray, first: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of words, inside one text each, that hold all runs."""
    count, least = rule.gram_count(), max(rule.least, rule.times)
    if count < 2:
        kept = np.diff(first) >= least
        return first[:-1][kept], first[1:][kept]
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    grams = Rolling(hashes).windows(GRAM)
    inside = np.flatnonzero(doc[: len(grams)] == doc[GRAM - 1 : GRAM - 1 + len(grams)])
    _, which, number = np.unique(mix(grams[inside] ^ (doc[inside].astype(np.uint64) * M1)), return_inverse=True, return_counts=True)
    often = np.zeros(len(grams) + 2, bool)
    often[inside[number[which] >= count] + 1] = True
    # texts end before a gram that would reach into the next one, so stretches stay inside a text
    edge = np.flatnonzero(often[1:] != often[:-1])
    low, high = edge[::2], edge[1::2] + GRAM - 1
    kept = high - low >= least
    return low[kept], high[kept]


def periodic_runs(documents: DataFrame, id: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n_words, n_dropped, kept, runs) for each document.

    Words are runs of characters other than blank and 0x09-0x0D, and compared by their bytes.  ``runs`` lists (start,
    length, period) in words, by start, then period.  A word is dropped if a run contains it after the run's first
    ``period`` words; ``kept`` joins the others by one blank.  A null text has no words; ids may be null or repeat; other
    columns are ignored.
    """

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        buf, offsets = utf8(part.column("text"))
        words = split_words(buf, offsets)
        low, high = stretches(hash_slices(buf, words.start, words.end), words.first, rule)
        body, total = buf.tobytes(), len(words.start)
        rows, change = [], np.zeros(total + 1, np.int64)
        for a, b in zip(low.tolist(), high.tolist()):
            known: dict[bytes, int] = {}
            places = zip(words.start[a:b].tolist(), words.end[a:b].tolist())
            units = [known.setdefault(body[i:j], len(known)) for i, j in places]
            rows += [(a + start, length, period) for start, length, period in runs_of(units, rule)]
        start, length, period = np.array(rows, np.int64).reshape(-1, 3).T
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        gone = np.cumsum(change[:total]) > 0
        left = np.flatnonzero(~gone)
        kept = join_words(buf, words.start[left], words.end[left], np.searchsorted(left, words.first))
        doc = np.searchsorted(words.first, start, side="right") - 1
        ends = np.searchsorted(doc, np.arange(len(offsets)))
        columns = [pa.array(start - words.first[doc]), pa.array(length), pa.array(period)]
        return pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(words.counts().astype(np.int64)),
             pa.array(np.diff(np.append(0, np.cumsum(gone))[words.first]).astype(np.int64)), as_binary(*kept, text=True),
             pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.StructArray.from_arrays(columns, ["start", "length", "period"]))],
            names=["doc_id", "n_words", "n_dropped", "kept", "runs"],
        )

    return map_slices(texts_of(documents, id, text), "text", run, FOUND, SLICE_BYTES)


def with_planted_runs(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text): every tenth text or so goes on, from a word on, repeating the words that stand there.

    With ``h`` the unsigned crc32 of the decimal id and ``g = h div 10``, a text of n > 0 words with ``h mod 10 = 0`` gets as
    word i >= a, ``a = g mod n``, its word ``a + (i - a) mod p``, ``p = 1 + (n - a) div (3 + g mod 8)``, and one blank between
    words.  Other texts, and those of null ids, stay as they are (a null text empty).
    """

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        h = np.array([1 if i is None else zlib.crc32(b"%d" % i) for i in part.column("id").to_pylist()], np.int64)
        chosen = np.flatnonzero(h % 10 == 0)
        buf, offsets = utf8(part.column("text").take(pa.array(chosen)))
        words = split_words(buf, offsets)
        n, g = words.counts(), h[chosen] // 10
        a = g % np.maximum(n, 1)
        p = 1 + (n - a) // (3 + g % 8)
        first, doc = words.first[:-1], words.doc()
        at = np.arange(len(doc)) - first[doc]
        from_ = np.where(at < a[doc], at, a[doc] + (at - a[doc]) % p[doc]) + first[doc]
        made = as_binary(*join_words(buf, words.start[from_], words.end[from_], words.first), text=True)
        # rows of the slice from the texts as they are, or from the made ones behind them
        place = np.arange(part.num_rows)
        filled = n > 0
        place[chosen[filled]] = part.num_rows + np.flatnonzero(filled)
        both = pa.concat_arrays([part.column("text").cast(pa.string()), made])
        return pa.RecordBatch.from_arrays([part.column("id"), both.take(pa.array(place))], names=["id", "text"])

    return map_slices(texts_of(documents, id, text), "text", run, "id long, text string", SLICE_BYTES)
