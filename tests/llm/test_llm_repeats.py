"""Repeated words and bytes against brute force, and the suffix arrays against sorting."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from awkward import corpus, documents, empty, prose, words
from hypothesis import given
from hypothesis import strategies as st

from statquarry.llm import sketch
from statquarry.llm.arrays import utf8
from statquarry.llm.repeats import Rule
from statquarry.llm.substring_dedup import remove_repeated_words, repeated_word_spans
from statquarry.llm.suffix_dedup import common_prefixes, remove_repeated_bytes, repeated_byte_spans, suffix_array, without_repeats


def plain_words(rows, size):
    least = defaultdict(lambda: float("inf"))
    known = lambda i: float("inf") if i is None else i
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - size + 1):
            least[tuple(w[k : k + size])] = min(least[tuple(w[k : k + size])], known(i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - size + 1):
            if least[tuple(w[k : k + size])] < known(i):
                gone.update(range(k, k + size))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return Counter(out)


def plain_bytes(rows, size):
    count = Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, t in texts:
        count.update(t[k : k + size] for k in range(len(t) - size + 1))
    out = []
    for i, t in texts:
        marked = np.zeros(len(t) + 1, int)
        for k in range(len(t) - size + 1):
            if count[t[k : k + size]] > 1:
                marked[k] += 1
                marked[k + size] -= 1
        marked = np.cumsum(marked)[: len(t)] > 0
        spans = int(np.sum(np.diff(np.concatenate([[0], marked.astype(int)])) == 1))
        out.append((i, len(t), int(marked.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~marked])))
    return Counter(out)


def word_result(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect())


def byte_result(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept)) for r in df.collect())


def tangled(seed, n):
    """Texts cut from a few long ones, so that passages overlap in many ways."""
    draw = random.Random(seed)
    sources = [prose(seed * 100 + k, 400).split(" ") for k in range(3)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(draw.randint(1, 4)):
            w = draw.choice(sources)
            a = draw.randrange(len(w))
            parts += w[a : a + draw.randint(1, 150)]
            if draw.random() < 0.5:
                parts.append(f"u{i}")
        rows.append((i, " ".join(parts)))
    return rows


def test_repeated_words(spark):
    rows = corpus() + [(i + 100, t) for i, t in tangled(1, 40)]
    assert word_result(remove_repeated_words(documents(spark, rows))) == plain_words(rows, 50)


def test_repeated_bytes_with_grams_spread_over_shards(spark):
    rows = corpus() + [(i + 100, t) for i, t in tangled(2, 40)]
    for shard in (1 << 20, 3000):
        assert byte_result(remove_repeated_bytes(documents(spark, rows), shard_bytes=shard)) == plain_bytes(rows, 400)


def test_a_small_sketch_loses_nothing(spark):
    rows = tangled(3, 30)
    rule = Rule(window=20, gram=5, sketch_max_cells=1 << 12, slice_bytes=3000)
    assert word_result(remove_repeated_words(documents(spark, rows), rule=rule)) == plain_words(rows, 20)
    assert byte_result(remove_repeated_bytes(documents(spark, rows), rule=rule)) == plain_bytes(rows, 20)


def test_equal_rows_share_one_list_of_spans(spark):
    text = prose(3, 80)
    table = documents(spark, [(1, text)] + [(5, text)] * 30 + [(None, text)] * 30)
    for spans in (repeated_word_spans(table, rule=Rule(5, 2)), repeated_byte_spans(table, rule=Rule(40, 16))):
        found = [r.spans for r in spans.collect()]
        assert len(found) >= 2 and all(len(held) == len({(s.start, s.n) for s in held}) for held in found)


def test_empty_tables(spark):
    assert remove_repeated_words(empty(spark)).collect() == []
    assert remove_repeated_bytes(empty(spark)).collect() == []


def test_cut_documents_keep_their_columns(spark):
    rows = corpus()
    before = documents(spark, rows)
    after = without_repeats(before)
    assert after.schema == before.schema
    plain = Counter((k[0], k[4].decode("utf-8", "ignore")) for k in plain_bytes(rows, 400).elements())
    assert Counter((r.doc_id, r.text or "") for r in after.collect()) == plain
    assert after.where("text IS NULL").count() == 2
    assert without_repeats(empty(spark)).count() == 0


@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=6), st.integers(0, 40))
def test_suffix_array_and_common_prefixes(strings, head):
    buf, offsets = utf8(pa.array(strings, pa.binary()))
    order, rank = suffix_array(buf, offsets)
    of = np.repeat(np.arange(len(strings)), np.diff(offsets))
    suffix = lambda p: bytes(buf[p : offsets[of[p] + 1]])
    # the end of string k sorts before all bytes, and before the ends of later strings
    want = sorted(range(int(offsets[-1])), key=lambda p: [*(b + len(strings) for b in suffix(p)), of[p]])
    assert order.tolist() == want and rank[order].tolist() == list(range(len(order)))
    for heads in (None, np.minimum(np.diff(offsets), head)):
        chosen, shared = common_prefixes(buf, offsets, order, rank, 17, heads)
        first = np.diff(offsets) if heads is None else heads
        assert chosen.tolist() == [p for p in want if p - offsets[of[p]] < first[of[p]]]
        for k in range(1, len(chosen)):
            a, b = suffix(chosen[k - 1]), suffix(chosen[k])
            plain = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[k] == min(plain, 17)


def test_sketch_never_counts_too_low(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 3000, 9000)
    df = spark.createDataFrame([(int(v),) for v in values], "v long").repartition(5)
    arrays = lambda batches: (b.column("v").to_numpy().view(np.uint64) for b in batches)
    counts = Counter(values.tolist())
    twice = sketch.build(df, arrays, "twice", 2, 16)
    once = sketch.build(df, arrays, "once", 2, 16)
    asked = np.arange(6000, dtype=np.uint64)
    assert all(p for v, p in zip(asked.tolist(), twice.passes(asked)) if counts[v] > 1)
    assert all(p for v, p in zip(asked.tolist(), once.passes(asked)) if counts[v])
    assert twice.passes(asked)[3000:].mean() < 0.05


def test_passages_of_many_words_go_from_400_bytes_on(spark):
    """A passage of over 50 words goes as a whole if it has 400 bytes, and stays as a whole if it has one less."""
    rows, wanted = [], {}
    for k, size in enumerate((260, 399, 400, 401, 650)):
        passage = prose(40 + k, 400, 60).encode("ascii", "ignore").decode()[: size - 1] + "z"
        assert len(passage) == size and len(passage.split()) > 50
        for side in (0, 1):
            head, tail = prose(60 + 2 * k + side, 40), prose(80 + 2 * k + side, 40)
            rows.append((2 * k + side, f"{head}<{side}{passage}{side}>{tail}"))
            wanted[2 * k + side] = size if size >= 400 else 0
    got = remove_repeated_bytes(documents(spark, rows)).collect()
    assert {r.doc_id: r.n_removed for r in got} == wanted
