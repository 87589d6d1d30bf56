import random
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
from awkward import corpus, documents, empty
from tokenizers import Tokenizer

from statquarry.llm import transducer
from statquarry.llm.packing import Capacities, in_lots, pack, plan, token_pieces
from statquarry.llm.tokens import count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "it's we're I'll 'sa 're've 'l 'll' ''s --'s 'r", "'", "'r", "'v", "'re", "'l'l", "a'", "1'23's 4'5", "don't'",
    "<|endoftext|>", "x<|startoftext|>y's<|endoftext|> z", "<|endof", "ΑΣ ΟΔΥΣΣΕΥΣ σ", "İstanbul ǅ ŉ", "é ẛ̣ ﬁ Å",
    "a b c\u0085d​e", "日本語 テスト １２３ ٣٤", "👍👍🏽 🇩🇪", "x" * 5000, "'" * 50 + "s", "\x00a\x1fb", " 'RE 'Ll 'T'D",
    "ab'r" + "e" * 3, "Ɤ ꟋꟜ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_counts_are_the_librarys(spark, library):
    draw = random.Random(5)
    signs = "aabcdersttlmv''''  13.-,éßΣ😀\n<|>"
    rows = corpus() + [(100 + k, t) for k, t in enumerate(HARD)]
    rows += [(1000 + k, "".join(draw.choice(signs) for _ in range(draw.randint(0, 1500)))) for k in range(100)]
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert Counter(tuple(r) for r in count_tokens(documents(spark, rows), PATH).collect()) == want
    assert count_tokens(empty(spark), PATH).collect() == []


def test_counter_starts_anew_when_its_tables_are_full(monkeypatch, library):
    monkeypatch.setattr(transducer, "MAX_STATES", 50)
    monkeypatch.setattr(transducer, "MAX_KNOWN", 20)
    with open(PATH, encoding="utf-8") as file:
        counts = transducer.TokenCounts(transducer.Specification(file.read()))
    texts = [t for _, t in corpus() if t and len(t) < 4000]
    for _ in range(2):
        for text in texts:
            assert counts.counts([text]).tolist() == [len(library.encode(text, add_special_tokens=False).ids)]


def test_plan_is_best_fit_decreasing():
    draw = random.Random(1)
    for _ in range(200):
        capacity = draw.choice([7, 16, 50, 64])
        lengths = [draw.randint(1, capacity) for _ in range(draw.randint(0, 150))]
        rooms = []
        for length in sorted(lengths, reverse=True):
            fit = [k for k, room in enumerate(rooms) if room >= length]
            if fit:
                rooms[min(fit, key=lambda k: rooms[k])] -= length
            else:
                rooms.append(capacity - length)
        sequences, seen = {}, Counter()
        for length, first, number, sequence, each, offset in plan(dict(Counter(lengths)), capacity):
            assert first == seen[length]
            seen[length] += number
            for k in range(number):
                sequences.setdefault(sequence + k // each, []).append((offset + k % each * length, length))
        assert seen == Counter(lengths) and len(sequences) == len(rooms)
        for held in sequences.values():
            held.sort()
            assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))]
            assert sum(n for _, n in held) <= capacity


def test_tightest_room():
    tree = Capacities(100)
    for room in (5, 40, 90):
        tree.set(room, True)
    assert [tree.tightest(n) for n in (1, 5, 6, 40, 41, 90, 91)] == [5, 5, 40, 40, 90, 90, None]
    tree.set(40, False)
    assert tree.tightest(6) == 90


def test_equal_rows_are_dealt_to_many_lots(spark):
    pieces = token_pieces(documents(spark, [(5, "the same text")] * 300 + [(None, "same")] * 300), PATH, 64, 1)
    sizes = [r["count"] for r in in_lots(pieces, 60).groupBy("lot").count().collect()]
    assert sum(sizes) == 600 and max(sizes) < 100


def test_pieces_fill_sequences_without_gaps(spark, library):
    rows = corpus() + [(100 + k, t) for k, t in enumerate(HARD)]
    capacity = 64
    want = Counter()
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for low in range(0, len(ids), capacity):
            part = ids[low : low + capacity]
            want[i, low // capacity, low, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    got = pack(documents(spark, rows), PATH, capacity=capacity, lot=10).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))]
        assert sum(n for _, n in held) <= capacity
    total = sum(k[3] * n for k, n in want.items())
    assert len(sequences) <= -(-total // capacity) * 11 // 9 + 1
    assert pack(empty(spark), PATH).collect() == []
