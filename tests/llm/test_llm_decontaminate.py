import random

import numpy as np
import pyarrow as pa
from awkward import corpus, documents, empty, prose

from statquarry.llm.decontaminate import Items, Settings, best_run, by_size, contaminated, without_contaminated, words_of


def edited(words, edits, draw, vocabulary):
    words = list(words)
    for _ in range(edits):
        kind, at = draw.random(), draw.randrange(len(words))
        if kind < 0.33:
            words.insert(at, draw.choice(vocabulary))
        elif kind < 0.66 and len(words) > 1:
            words.pop(at)
        else:
            words[at] = draw.choice(vocabulary)
    return words


def test_recall_and_exact_distances():
    draw = random.Random(2)
    vocabulary = sorted(set(prose(1, 3000, 700).split(" ")))
    items = [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(8, 60))) for _ in range(40)]
    texts = []
    for item in items:
        w = item.split(" ")
        for edits in range(len(w) // 5 + 2):
            around = [draw.choice(vocabulary) for _ in range(draw.randint(0, 60))]
            at = draw.randint(0, len(around))
            texts.append(" ".join(around[:at] + edited(w, edits, draw, vocabulary) + around[at:]))
    block = Items(list(range(len(items))), items, Settings())
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([0] * len(texts)), pa.array(texts)], names=["id", "key", "text"])
    got = {(r["doc_id"], r["item_id"]): r["distance"] for b in block.matches([batch]) for r in b.to_pylist()}
    hashes, first = words_of(texts)
    want = {}
    for t in range(len(texts)):
        for k, words in enumerate(block.words):
            distance = best_run(words, hashes[first[t] : first[t + 1]])[0]
            if distance <= block.allowed[k]:
                want[t, k] = distance
    assert len(want) > 100 and set(got) <= set(want)
    assert sum(key in got for key in want) >= 0.9 * len(want)
    assert all(got[key] == want[key] for key in got)


def plain_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for k, a in enumerate(pattern):
        new = [k + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_best_run_is_the_edit_distance_to_some_run():
    draw = random.Random(4)
    for _ in range(200):
        pattern, text = ([draw.randrange(3) for _ in range(draw.randint(1, n))] for n in (8, 20))
        distance, a, b = best_run(np.array(pattern), np.array(text))
        assert distance == plain_distance(pattern, text)
        whole = [list(range(len(text[a:b]) + 1))]
        for k, x in enumerate(pattern):
            whole.append([k + 1])
            for j, y in enumerate(text[a:b]):
                whole[-1].append(min(whole[-2][j] + (x != y), whole[-2][j + 1] + 1, whole[-1][-1] + 1))
        assert whole[-1][-1] == distance


def tables(spark):
    leak, other = prose(70, 30), prose(71, 20)
    rows = corpus() + [
        (300, prose(72, 50) + " " + leak + " " + prose(73, 50)), (301, "START " + leak.upper() + "! end"), (302, other),
        (302, other), (303, " ".join(leak.split(" ")[:10])), (None, prose(74, 10) + "\n" + other),
    ]
    items = [(1, leak, "x"), (2, other, "x"), (2, other, "x"), (3, None, "x"), (4, "", "x"), (None, leak, "x"), (5, "...", "x")]
    return rows, spark.createDataFrame(items, "item_id long, text string, id string")


def test_passages_are_found_and_clean_documents_left(spark):
    rows, items = tables(spark)
    found = contaminated(documents(spark, rows), items).distinct().collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in found} == {(300, 1, 0), (301, 1, 0), (302, 2, 0), (None, 2, 0)}
    start = next(r for r in found if r.doc_id == 300)
    assert start.n_words == start.item_words == len(words_of([tables(spark)[1].first().text])[0])
    before = documents(spark, rows)
    after = without_contaminated(before, items)
    assert after.schema == before.schema and after.count() == len(rows) - 5


def test_blocks_of_items_and_empty_tables(spark):
    rows, items = tables(spark)
    blocks = contaminated(documents(spark, rows), items, Settings(block_items=2)).distinct()
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == {(300, 1), (301, 1), (302, 2), (None, 2)}
    assert contaminated(empty(spark), items).collect() == []
    assert contaminated(documents(spark, rows), items.limit(0)).collect() == []
    assert without_contaminated(documents(spark, rows), items.limit(0)).count() == len(rows)


def test_size_classes_give_the_keys_of_one_table():
    draw = random.Random(8)
    vocabulary = sorted(set(prose(3, 2000, 500).split(" ")))
    items = [" ".join(draw.choice(vocabulary) for _ in range(n)) for n in (1, 2, 3, 5, 8, 31, 32, 33, 60, 200)]
    one, many = (Items(list(range(len(items))), items, Settings(cells=c)) for c in (1 << 30, 1))
    assert np.array_equal(one.keys, many.keys) and np.array_equal(one.key_item, many.key_item)
    groups = list(by_size(np.array([5, 900, 4, 7, 6, 1000, 64]), 1 << 11))
    assert sorted(k for g in groups for k in g.tolist()) == list(range(7)) and [g.tolist() for g in groups][:1] == [[2, 0, 4, 3]]


def test_a_very_long_item_and_recall_through_a_table(spark):
    """Passages with all allowed numbers of edits as a table, beside an item of 6,000 words that one document quotes."""
    draw = random.Random(12)
    vocabulary = sorted(set(prose(5, 3000, 800).split(" ")))
    items = [[draw.choice(vocabulary) for _ in range(draw.randint(8, 80))] for _ in range(60)]
    long = [draw.choice(vocabulary) for _ in range(6_000)]
    rows, planted = [], set()
    for k, item in enumerate(items):
        for edits in range(0, len(item) // 5 + 1, 2):
            around = [draw.choice(vocabulary) for _ in range(40)]
            planted.add((len(rows), k))
            rows.append((len(rows), " ".join(around[:20] + edited(item, edits, draw, vocabulary) + around[20:])))
    rows += [(9000, " ".join(edited(long, 60, draw, vocabulary))), (9001, " ".join(long[:2_700])), (9002, prose(77, 9_000))]
    benchmark = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)] + [(500, " ".join(long))], "item_id long, text string")
    found = contaminated(documents(spark, rows), benchmark, Settings(block_bytes=50_000)).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(planted & got) >= 0.9 * len(planted) and (9000, 500) in got and (9001, 500) not in got
    assert all(r.distance <= r.item_words // 5 for r in found)
