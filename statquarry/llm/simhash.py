"""Near copies by SimHash: fingerprints, a positional byte index with count filtering, and components.

Fingerprints of ``BYTES`` bytes that differ in ``bits`` bits at most agree in ``BYTES - bits`` byte positions at least.
The index lists fingerprints under what they hold at some positions.  Lists of single bytes would hold a 256th of all
fingerprints each, so a list stands for ``r`` positions out of ``r + bits`` fixed ones: a pair within the distance shares
``r`` of them, whichever they are.  In a list, the positional bytes that a pair shares are tallied; pairs below the
guaranteed minimum go, the rest are verified by their distance.  Long lists (many near copies) are listed again under two
more bytes, and then under a piece of the remaining bits, which again every pair within the distance shares.  A list of
the last level holds fewer than ``2 ** 18`` different fingerprints, whatever the corpus.

Of every list only a spanning forest of its links leaves the task: enough for components, and never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statquarry.llm.arrays import join_words, map_slices, split_words, utf8
from statquarry.llm.components import connected
from statquarry.llm.storage import ID, KEY, keyed, same_row, saved, with_key
from statquarry.session import splittable_join

BYTES, BITS = 8, 3
LONG_LIST = 2048
SEED = 42


def _lower(buf: np.ndarray) -> np.ndarray:
    return np.where((buf - np.uint8(65)) < 26, buf + np.uint8(32), buf)


def simhashes(buf: np.ndarray, offsets: np.ndarray, shingle: int) -> np.ndarray:
    """Fingerprint of every text: a bit is set if more than half of the hashes of its word shingles have it set."""
    words = split_words(buf, offsets)
    buf, offsets = join_words(_lower(buf), words.start, words.end, words.first)
    words = split_words(buf, offsets)
    count = words.counts()
    number = np.where(count > 0, np.maximum(count - shingle + 1, 1), 0)
    stop = np.cumsum(number)
    doc = np.repeat(np.arange(len(number)), number)
    head = np.arange(int(number.sum())) - (stop - number)[doc] + words.first[doc]
    tail = np.minimum(head + shingle, words.first[doc + 1]) - 1
    body, digest = buf.tobytes(), xxhash.xxh64_intdigest
    edges = zip(words.start[head].tolist(), words.end[tail].tolist())
    hashes = np.fromiter((digest(body[a:b], SEED) for a, b in edges), "<u8", len(head))
    out = np.zeros(len(number), np.uint64)
    full = np.flatnonzero(number)
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, (stop - number)[full], axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > number[full, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(documents: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(id, key, print): the 64-bit SimHash of every text as a long; zero if it has no word."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        found = simhashes(*utf8(part.column("text")), shingle)
        return pa.RecordBatch.from_arrays(
            [part.column("id"), part.column("key"), pa.array(found.view(np.int64))], names=["id", "key", "print"]
        )

    return map_slices(keyed(documents, id, text), "text", run, "id long, key long, print long", 1 << 20)


def _at(position: int, size: int = 8) -> Column:
    return F.shiftrightunsigned("print", position).bitwiseAND((1 << size) - 1)


def _keys(choices: list[tuple[list[int], int]], size: int) -> Column:
    """One list key for each choice: its number, followed by ``size`` bits from each of its bit positions."""
    keys = []
    for positions, number in choices:
        key = F.lit(number).cast("long")
        for position in positions:
            key = F.shiftleft(key, size).bitwiseOR(_at(position, size))
        keys.append(key)
    return F.array(*keys)


def _first_keys(bits: int) -> Column:
    return _keys([([8 * p for p in c], n) for n, c in enumerate(combinations(range(3 + bits), 3))], 8)


def _second_lists(lists: DataFrame, bits: int) -> DataFrame:
    """Members of long lists under two more of the other positions, of which ``bits`` may differ."""
    choices = []
    for number, c in enumerate(combinations(range(3 + bits), 3)):
        rest = [p for p in range(BYTES) if p not in c][: 2 + bits]
        choices.append([(number * 100 + m, (*c, *two)) for m, two in enumerate(combinations(rest, 2))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = batch.column("print").to_numpy().view(np.uint64)
            number = batch.column("list").to_numpy() >> 24
            for n in np.unique(number).tolist():
                members = value[number == n]
                for name, positions in choices[n]:
                    key = np.full(len(members), name, np.uint64)
                    for p in positions:
                        key = (key << np.uint64(8)) | ((members >> np.uint64(8 * p)) & np.uint64(255))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(members.view(np.int64)), pa.array(key.view(np.int64))], names=["print", "list"]
                    )

    return lists.select("print", "list").mapInArrow(run, "print long, list long")


def _links(rows: pa.Table, bits: int) -> pa.Table:
    """Spanning forest of the links inside every list of a group."""
    key, value = rows.column("list").to_numpy(), rows.column("print").to_numpy().view(np.uint64)
    order = np.lexsort((value, key))
    key, value = key[order], value[order]
    parent = np.arange(len(value))

    def roots(nodes: np.ndarray) -> np.ndarray:
        up = parent[nodes]
        while True:
            further = parent[up]
            if np.array_equal(further, up):
                return up
            up = further

    def root(node: int) -> int:
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    first = np.arange(len(value))
    step, found = 1, []
    while len(first):
        first = first[first + step < len(value)]
        first = first[key[first] == key[first + step]]
        differ = value[first] ^ value[first + step]
        # tally of shared positional bytes, then the distance
        near = np.flatnonzero((differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1) >= BYTES - bits)
        near = first[near[np.bitwise_count(differ[near]) <= bits]]
        if len(near):
            near = near[roots(near) != roots(near + step)]
            for a in near.tolist():
                low, high = sorted((root(a), root(a + step)))
                if low != high:
                    parent[high] = low
                    found.append((a, a + step))
        step += 1
    links = value.view(np.int64)[np.array(found, np.int64).reshape(-1, 2)]
    return pa.table({"a": pa.array(links[:, 0]), "b": pa.array(links[:, 1])})


def _searched(lists: DataFrame, rows: int, bits: int) -> DataFrame:
    lots = math.ceil((rows + 1) / 100_000)
    return lists.withColumn("lot", F.pmod(F.xxhash64("list"), F.lit(lots))).groupBy("lot").applyInArrow(
        lambda group: _links(group.select(["list", "print"]), bits), "a long, b long"
    )


def links(prints: DataFrame, bits: int = BITS, long_list: int = LONG_LIST) -> DataFrame:
    """Links (a, b) that connect all fingerprints of ``prints`` (column ``print``, different values) within ``bits``."""
    if not 0 <= bits <= BITS:
        raise ValueError(f"the index has lists for 0 to {BITS} bits")

    def filled(postings: DataFrame) -> DataFrame:
        """Rows of lists with two members or more, with the number of members."""
        sizes = postings.groupBy("list").agg(F.count("*").alias("members")).where("members > 1")
        return saved(splittable_join(postings, sizes, ["list"]), "lists")

    def number(level: DataFrame, condition: str) -> int:
        return level.where(condition).count()

    short, long = f"members <= {long_list}", f"members > {long_list}"
    one = filled(prints.select("print", F.explode(_first_keys(bits)).alias("list")))
    out = _searched(one.where(short), number(one, short), bits)
    if number(one, long):
        two = filled(_second_lists(one.where(long), bits))
        out = out.union(_searched(two.where(short), number(two, short), bits))
        if number(two, long):
            # pairs in a list agree in 40 bits at least; of the pieces of all 64 bits by 4, those that may differ are few
            pieces = F.array(*[
                F.xxhash64("list", F.lit(n), *[_at(p + n, 1) for p in range(0, 64, bits + 1)]) for n in range(bits + 1)
            ])
            three = filled(two.where(long).select("print", F.explode(pieces).alias("list")))
            out = out.union(_searched(three, number(three, "true"), bits))
    return out


def near_copies(
    documents: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = BITS
) -> DataFrame:
    """One row (doc_id, key, print, root, component_id) for each document; ``root`` names the component.

    Words are runs of characters other than blank and 0x09-0x0D, with A-Z in lower case; ``component_id`` is the smallest
    id among all documents reachable by links of ``bits`` differing bits at most, itself included.  A text with fewer words
    than a shingle has one hash of all of them, a text without words (empty, null) the fingerprint zero, which links like
    any other.  A null id is never the smallest, unless there is no other.  Rows that repeat stay rows.
    """
    found = saved(fingerprints(documents, id, text, shingle), "prints")
    nodes = saved(found.groupBy("print").agg(F.min("id").alias("low")), "nodes")
    tree = connected(links(nodes.select("print"), bits))
    rooted = nodes.join(tree, nodes["print"] == tree["a"], "left").select(
        "print", "low", F.coalesce("b", "print").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = splittable_join(rooted, lowest, ["root"]).select("print", "root", "component_id")
    joined = splittable_join(found, named, ["print"])
    return joined.select(F.col("id").alias("doc_id"), "key", "print", "root", "component_id")


def one_of_each(
    documents: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = BITS
) -> DataFrame:
    """One document of each component, with all its columns: that of the smallest id, then of the smallest text hash.

    Of rows that are equal in id and text one stays.  A null id counts as larger than any other.
    """
    of_none = F.col("doc_id").isNull()
    stay = near_copies(documents, id, text, shingle, bits).groupBy("root").agg(
        F.min(F.struct(of_none.alias("none"), F.col("doc_id").alias("id"), "key")).alias("stay")
    ).select("stay.id", "stay.key")
    rows = with_key(documents, id, text)
    kept = rows.join(stay, same_row(rows, stay), "left_semi")
    return kept.dropDuplicates([ID, KEY]).select(*[F.col(f"`{c}`") for c in documents.columns])
