"""Repeated byte strings, same document or not, by sharded suffix arrays.

Anchors (``repeats``) leave the spans whose gram occurs twice or more.  Equal spans are collapsed to one with a count: all
its windows repeat if the count is above one.  Where a gram has different spans, their windows must be compared: the spans
are dealt to shards by gram, and each shard sorts its suffixes by Larsson-Sadakane refinement, finds common prefixes of
neighbours by Kasai's rule and marks the windows that share ``window`` bytes with a neighbour.  Equal windows have equal
grams, so a gram's spans meet in one shard - unless there are too many for one.  Those are spread over several shards, and
each shard offers the names of its different windows of such grams as sorted lists, which are cut into ranges and searched
in the merged list by binary search.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statquarry.llm.arrays import M1, PAD, Rolling, as_binary, lanes, map_slices, mix, ranges, release, released, utf8
from statquarry.llm.repeats import Rule, Spans, contents, distinct_spans, occurrences
from statquarry.llm.storage import keyed, matches, same_row, saved, with_key
from statquarry.llm.substring_dedup import covered
from statquarry.session import splittable_join

RULE = Rule(window=400, gram=64, slice_bytes=1 << 19)
SHARD_BYTES = 1 << 20
SPANS = "statquarry spans"
_HIGH = np.array([(1 << 64) - (1 << (64 - 8 * k)) for k in range(9)], np.uint64)  # the first k of eight bytes
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * M1)


def byte_units(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    buf, offsets = utf8(part.column("text"))
    return _BYTE[buf[: int(offsets[-1])]], offsets


def suffix_array(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes of several byte strings, and the place of each suffix in it.

    ``buf`` is padded.  Every string ends in a symbol of its own, smaller than any byte, so that no common prefix crosses
    an end and no two suffixes are equal.  Groups of suffixes equal as far as ``depth`` are sorted by the groups of what
    follows, which triples the depth (doubles it where three group numbers don't fit into one key); groups of one suffix
    are not looked at again.
    """
    n, strings = int(offsets[-1]), len(offsets) - 1
    # places and depths fit into 32 bits: a shard holds a few MB
    string = np.repeat(np.arange(strings, dtype=np.int32), np.diff(offsets))
    left = offsets[1:].astype(np.int32)[string] - np.arange(n, dtype=np.int32)
    # seven bytes and, in the last place, how many of them there are; 255 stands for all
    short = np.minimum(left, 7)
    head = lanes(buf)[:n].byteswap()
    head &= _HIGH[short]
    head |= np.where(left < 7, left, 255).astype(np.uint64)
    order = np.argsort(head).astype(np.int32)
    ordered = head[order]
    del head, short
    ending = np.flatnonzero((ordered & np.uint64(255)) < 7)  # suffixes that differ by their ends, in the strings' order
    order[ending] = order[ending][np.lexsort((order[ending], ordered[ending]))]
    fresh = np.ones(n, bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    fresh[ending] = True
    del ordered, ending
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n, dtype=np.int32), 0))
    depth, triple = 7, n + strings < 1 << 21

    def follower(at: np.ndarray, steps: int) -> np.ndarray:
        """Group of what follows after ``steps`` bytes; an end counts as the string's own symbol."""
        rest = left[at] - steps
        inside = rest > 0
        out = np.zeros(len(at), np.int64)
        out[inside] = rank[at[inside] + steps] + strings
        over = rest == 0
        out[over] = string[at[over]]
        return out

    single = fresh & np.append(fresh[1:], True)
    active = np.flatnonzero(~single)
    while len(active):
        at = order[active]
        lead = rank[at].astype(np.int64)
        key = (lead << 42) | (follower(at, depth) << 21) | follower(at, 2 * depth) if triple else (
            (lead << 32) | follower(at, depth)
        )
        sort = np.argsort(key)
        at, key = at[sort], key[sort]
        order[active] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = key[1:] != key[:-1]
        rank[at] = np.maximum.accumulate(np.where(fresh, active, 0))
        active = active[~(fresh & np.append(fresh[1:], True))]
        depth *= 3 if triple else 2
    return order, rank


def common_prefixes(
    buf: np.ndarray, offsets: np.ndarray, order: np.ndarray, rank: np.ndarray, limit: int, heads: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Chosen suffixes in order, and the common prefix of each with the chosen one before it, as far as ``limit``.

    Chosen are the first ``heads`` suffixes of every string (all by default).  Kasai's rule: a suffix shares one byte less,
    at least, than the suffix that begins one byte earlier, if the other's next suffix is a chosen one too.  All strings
    are walked side by side.
    """
    eight, n, sizes = lanes(buf), int(offsets[-1]), np.diff(offsets)
    heads = sizes if heads is None else heads
    string = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    end = offsets[1:].astype(np.int32)[string]
    chosen = np.arange(n, dtype=np.int32) - offsets[:-1].astype(np.int32)[string] < heads.astype(np.int32)[string]
    found = order[chosen[order]]
    slot_of = np.zeros(n + 1, np.int32)
    slot_of[found] = np.arange(len(found))
    goes_on = np.append(chosen[1:] & (string[1:] == string[:-1]), False) if n else chosen
    out = np.zeros(len(found), np.int64)
    walk = np.argsort(-heads, kind="stable")
    count = np.searchsorted(-heads[walk], -np.arange(1, int(heads.max(initial=0)) + 1), side="right")
    shared = np.zeros(len(sizes), np.int64)
    for step, width in enumerate(count.tolist()):
        here = offsets[:-1][walk[:width]] + step
        slot = slot_of[here]
        other = found[slot - 1]
        most = np.minimum(np.minimum(end[here] - here, end[other] - other), limit)
        most[slot == 0] = 0
        same = np.minimum(shared[:width], most)
        going = np.flatnonzero(same < most)
        while len(going):
            differ = eight[here[going] + same[going]] ^ eight[other[going] + same[going]]
            bytes_ = np.where(differ == 0, 8, np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3)
            same[going] = np.minimum(same[going] + bytes_, most[going])
            going = going[(bytes_ == 8) & (same[going] < most[going])]
        shared[:width] = np.where(goes_on[other], np.maximum(same - 1, 0), 0)
        out[slot] = same
    return found, out


def _shard(rows: pa.Table, window: int, lots: int) -> pa.Table:
    """Marks of the windows that repeat in one shard.

    The different windows of spread grams are offered to the other shards: their names are sorted and cut into ``lots``
    ranges by binary search.  The shard's first row carries these lists.
    """
    rows = rows.combine_chunks()
    content = rows.column("content").combine_chunks()
    buf, offsets = utf8(content.chunk(0) if isinstance(content, pa.ChunkedArray) else content)
    n = rows.column("n").to_numpy().astype(np.int64)
    spread = rows.column("parts").to_numpy() > 1
    order, rank = suffix_array(buf, offsets)
    chosen, prefix = common_prefixes(buf, offsets, order, rank, window, n)
    size = len(order)
    del order, rank
    release()
    own = np.repeat(offsets[:-1] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))  # places of the windows
    with_last = prefix >= window
    marked, lead = np.zeros(size, bool), np.zeros(size, bool)
    marked[chosen] = with_last | np.append(with_last[1:], False)
    lead[chosen] = ~with_last
    bounds = pa.array(np.append(0, np.cumsum(n)).astype(np.int32))
    hashes = Rolling(_BYTE[buf[: int(offsets[-1])]]).of(own, own + window).view(np.int64)
    marks = pa.ListArray.from_arrays(bounds, pa.array(marked[own]))
    offer = np.flatnonzero(lead[own] & np.repeat(spread, n))
    span = np.repeat(np.arange(len(n)), n)[offer]
    gram, run = (rows.column(name).to_numpy()[span] for name in ("gram", "run"))
    name = mix(hashes[offer].view(np.uint64) ^ (gram.view(np.uint64) * M1))
    order = np.argsort(name)
    cuts = np.searchsorted(name[order] >> np.uint64(32), (np.arange(lots + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(lots))
    table = np.column_stack([name.view(np.int64), gram, run, offer - (np.cumsum(n) - n)[span]])[order]
    lists = [{"lot": k, "body": table[a:b].tobytes()} for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
    kind = pa.list_(pa.struct([("lot", pa.int32()), ("body", pa.binary())]))
    offers = pa.array([lists] + [[]] * (len(n) - 1), kind)
    return pa.table({"gram": rows.column("gram"), "run": rows.column("run"), "mask": marks, "offers": offers})


def _meet(rows: pa.Table) -> pa.Table:
    """One range of the offered windows: every shard's sorted list is searched in the merged one.

    Returns the places of the windows that several shards hold, by span.
    """
    lists = [np.frombuffer(body.as_py(), np.int64).reshape(-1, 4) for body in rows.column("body")]
    names = [table[:, 0].copy().view(np.uint64) for table in lists]
    merged = np.sort(np.concatenate(names), kind="stable")
    shared = [np.searchsorted(merged, x, side="right") - np.searchsorted(merged, x, side="left") > 1 for x in names]
    hits = np.concatenate([table[found, 1:] for table, found in zip(lists, shared)])
    hits = hits[np.lexsort((hits[:, 1], hits[:, 0]))]
    fresh = np.ones(len(hits), bool)
    fresh[1:] = (hits[1:, :2] != hits[:-1, :2]).any(axis=1)
    head = np.flatnonzero(fresh)
    places = pa.ListArray.from_arrays(pa.array(np.append(head, len(hits)).astype(np.int32)), pa.array(hits[:, 2]))
    return pa.table({"gram": pa.array(hits[head, 0]), "run": pa.array(hits[head, 1]), "places": places})


def repeated_byte_spans(
    documents: DataFrame, id: str = "doc_id", text: str = "text", rule: Rule = RULE, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """(id, key, spans): for each document with a window that occurs elsewhere, its spans with start, n and mask."""
    texts = keyed(documents, id, text)
    found = occurrences(texts, byte_units, rule)
    spans = distinct_spans(found)
    mixed = spans.where("kinds > 1")

    def cut(part: pa.RecordBatch, drawn: Spans, keep: np.ndarray) -> pa.Array:
        buf, _ = utf8(part.column("text"))
        at, size = drawn.at[keep], drawn.n[keep] + rule.window - 1
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        return as_binary(buf[np.repeat(at - (stop - size), size) + np.arange(total)], np.append(0, stop))

    each = rule.window + (rule.window - rule.gram) // 2
    drawn = saved(
        contents(texts, mixed, byte_units, rule, cut, "binary").select(
            "gram", "run", "n", "content",
            F.ceil(F.col("kinds") * F.lit(2.0 * each / shard_bytes)).cast("int").alias("parts"),
        ), "contents",
    )
    total, spread = drawn.agg(
        F.sum(F.octet_length("content")), F.sum(F.when(F.col("parts") > 1, F.col("n")))
    ).first()
    shards, lots, window = math.ceil(((total or 0) + 1) / shard_bytes), math.ceil(((spread or 0) + 1) / 500_000), rule.window
    marks = saved(
        drawn.withColumn("shard", F.pmod(F.xxhash64("gram", F.pmod("run", F.greatest("parts", F.lit(1)))), F.lit(shards)))
        .groupBy("shard").applyInArrow(
            released(lambda rows: _shard(rows, window, lots)),
            "gram long, run long, mask array<boolean>, offers array<struct<lot: int, body: binary>>",
        ), "marks",
    )
    across = (
        marks.select(F.explode("offers").alias("offer")).select("offer.*").groupBy("lot")
        .applyInArrow(released(lambda rows: _meet(rows)), "gram long, run long, places array<long>")
        .groupBy("gram", "run").agg(F.flatten(F.collect_list("places")).alias("places"))
    )
    masks = marks.join(across, ["gram", "run"], "left").select(
        "gram", "run",
        F.when(F.col("places").isNull(), F.col("mask"))
        .otherwise(F.transform("mask", lambda x, i: x | F.array_contains("places", i.cast("long")))).alias("mask"),
    )
    verdict = spans.where("kinds > 1 OR c > 1").join(masks, ["gram", "run"], "left").select(
        "gram", "run", F.when(F.col("c") == 1, F.col("mask")).alias("mask"), (F.col("c") > 1).alias("whole")
    ).where("whole OR array_contains(mask, true)")
    hits = splittable_join(found.select("id", "key", "gram", "run", "start", "n"), verdict, ["gram", "run"])
    # rows that are equal in id and text have equal spans: a set holds them once, before the exchange too
    return hits.groupBy("id", "key").agg(F.collect_set(F.struct("start", "n", "mask")).alias("spans"))


def remove_repeated_bytes(
    documents: DataFrame, id: str = "doc_id", text: str = "text", rule: Rule = RULE, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Every document without the bytes of strings of ``rule.window`` bytes that also start anywhere else.

    Returns (doc_id, n_bytes, n_removed, kept, removed): ``kept`` holds the remaining bytes (binary: a cut can part a
    character), ``removed`` the maximal removed runs (start, end) in bytes.  One row out for each row in; rows that repeat
    an id, or a whole row, are different documents.  A null text is empty; other columns are ignored.
    """
    texts = keyed(documents, id, text)
    spans = repeated_byte_spans(documents, id, text, rule, shard_bytes)
    joined = texts.join(spans, matches(texts, spans), "left").select(texts["id"], texts["text"], spans["spans"])

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        buf, offsets = utf8(part.column("text"))
        marked = covered(part.column("spans"), offsets, rule.window)
        gone = np.append(0, np.cumsum(marked))[offsets]
        kept = np.concatenate([buf[: int(offsets[-1])][~marked], np.zeros(PAD, np.uint8)])
        return pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(np.diff(offsets)), pa.array(np.diff(gone)), as_binary(kept, offsets - gone),
             ranges(marked, offsets)[0]],
            names=["doc_id", "n_bytes", "n_removed", "kept", "removed"],
        )

    schema = "doc_id long, n_bytes long, n_removed long, kept binary, removed array<struct<start: long, end: long>>"
    return map_slices(joined, "text", cut, schema, rule.slice_bytes)


def without_repeats(
    documents: DataFrame, id: str = "doc_id", text: str = "text", rule: Rule = RULE, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """All documents with all their columns, the repeated strings cut out of their texts.

    Where a cut parts a character, its remaining bytes go too.  A text without repeats stays as it is, a null too.
    """
    rows, spans = with_key(documents, id, text), repeated_byte_spans(documents, id, text, rule, shard_bytes)
    joined = rows.join(spans, same_row(rows, spans), "left").select(*[rows[f"`{c}`"] for c in documents.columns], spans["spans"])
    joined = joined.toDF(*documents.columns, SPANS)

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        found = part.column(SPANS)
        touched = found.is_valid().to_numpy(zero_copy_only=False)
        old = part.column(text)
        if touched.any():
            buf, offsets = utf8(old)
            marked = covered(found, offsets, rule.window)
            new = old.to_pylist()
            for k in np.flatnonzero(touched).tolist():
                a, b = int(offsets[k]), int(offsets[k + 1])
                new[k] = buf[a:b][~marked[a:b]].tobytes().decode("utf-8", "ignore")
            part = part.set_column(part.schema.get_field_index(text), text, pa.array(new, old.type))
        return part.select(columns)

    columns = documents.columns
    return map_slices(joined, text, cut, documents.schema, rule.slice_bytes)
