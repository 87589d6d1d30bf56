import re
from collections import Counter

import numpy as np
import xxhash
from awkward import corpus, documents, empty, prose, words

from statquarry.llm import simhash
from statquarry.llm.components import connected


def plain_print(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, bits=3):
    """Representative of each value's component."""
    values = list(values)
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    array = np.array(values, np.uint64)
    for k in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(array[k] ^ array[k + 1 :]) <= bits) + k + 1:
            parent[root(int(j))] = root(k)
    return {v: values[root(k)] for k, v in enumerate(values)}


def plain(rows):
    prints = [plain_print(t) for _, t in rows]
    root = plain_components(set(prints))
    lowest = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            lowest[root[p]] = min(lowest.get(root[p], i), i)
    return [(i, p, lowest.get(root[p])) for (i, _), p in zip(rows, prints)]


def test_prints_and_components(spark):
    rows = corpus() + [(50 + k, prose(60, 400) + f" tail{k}") for k in range(20)]
    got = Counter((r.doc_id, r.print & (2**64 - 1), r.component_id) for r in simhash.near_copies(documents(spark, rows)).collect())
    assert got == Counter(plain(rows))


def test_one_document_of_each_group_stays(spark):
    rows = corpus()
    before = documents(spark, rows)
    after = simhash.one_of_each(before)
    assert after.schema == before.schema
    root = plain_components({plain_print(t) for _, t in rows})
    groups = {}
    for i, t in rows:
        groups.setdefault(root[plain_print(t)], []).append((i is None, i or 0))
    kept = [(root[plain_print(r.text)], (r.doc_id is None, r.doc_id or 0)) for r in after.collect()]
    assert len(kept) == len(groups) and all(i == min(groups[g]) for g, i in kept)


def test_empty_table(spark):
    assert simhash.near_copies(empty(spark)).collect() == []
    assert simhash.one_of_each(empty(spark)).collect() == []


def test_links_connect_dense_groups_at_every_level(spark):
    rng = np.random.default_rng(3)
    values = set()
    for centre in rng.integers(0, 2**63, 4, dtype=np.uint64).tolist():
        for _ in range(250):
            v = centre
            for b in rng.integers(0, 64, int(rng.integers(1, 9))).tolist():
                v ^= 1 << b
            values.add(v)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(signed(v),) for v in values], "print long")
    want = plain_components(values)
    for long_list in (2048, 20, 3):
        links = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in simhash.links(df, 3, long_list).collect()]
        assert all((a ^ b).bit_count() <= 3 for a, b in links)
        found = {r.a: r.b for r in connected(simhash.links(df, 3, long_list)).collect()}
        got = {v: found.get(signed(v), signed(v)) for v in values}
        assert len({(want[v], got[v]) for v in values}) == len(set(want.values())) == len(set(got.values()))


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(200, 200), (300, 301), (301, 300)]
    got = {r.a: r.b for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, **{k: 100 for k in range(101, 160)}, 301: 300}


def test_a_null_id_is_not_the_largest_number(spark):
    from statquarry.llm.simhash import one_of_each

    rows = [(None, prose(1, 50)), ((1 << 63) - 1, prose(2, 50)), (None, prose(3, 50)), ((1 << 63) - 1, prose(3, 50))]
    kept = {(r.doc_id, r.text) for r in one_of_each(documents(spark, rows)).collect()}
    assert kept == {(None, prose(1, 50)), ((1 << 63) - 1, prose(2, 50)), ((1 << 63) - 1, prose(3, 50))}
