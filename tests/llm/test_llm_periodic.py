import hashlib
import random
import zlib
from collections import Counter

import pytest
from awkward import corpus, documents, empty, prose, words

from statquarry.llm import catalog
from statquarry.llm.periodic import Rule, periodic_runs, runs_of, with_planted_runs


def plain(units, rule=Rule()):
    """Every stretch of every period, without those that have a smaller one."""
    n, found = len(units), set()
    for q in range(1, n // rule.times + 1):
        same = [units[i] == units[i + q] for i in range(n - q)] + [False]
        low = None
        for i, equal in enumerate(same):
            if equal and low is None:
                low = i
            elif not equal and low is not None:
                length = i + q - low
                part = units[low : low + length]
                if length >= max(rule.least, rule.times * q) and all(part[r:] != part[:-r] for r in range(1, q)):
                    found.add((low, length, q))
                low = None
    return sorted(found)


def planted(id, text):
    w = words(text)
    h = 1 if id is None else zlib.crc32(str(id).encode())
    if h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def kept(units, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(u for i, u in enumerate(units) if i not in gone)


RULES = [Rule(), Rule(2, 2), Rule(1, 3), Rule(12, 2), Rule(6, 6)]


@pytest.mark.parametrize("rule", RULES)
def test_sequences_against_all_periods(rule):
    draw = random.Random(rule.least)
    for _ in range(500):
        n, letters = draw.randrange(60), draw.choice([1, 2, 3, 5])
        units = [draw.randrange(letters) for _ in range(n)]
        if n and draw.random() < 0.6:
            a, p = draw.randrange(n), 1 + draw.randrange(6)
            units = [units[i] if i < a else units[min(a + (i - a) % p, n - 1)] for i in range(n)]
        assert runs_of(units, rule) == plain(units, rule)


def repeating():
    texts = ["a b " * 30, "x " * 5, "x " * 6, "a b c " * 3 + "a b c", "a a a a a a b a a a a a a b " * 5, "n o " * 3 + "n o",
             prose(1, 40, 3), prose(2, 500, 2), prose(3, 60) + " so it goes" * 9 + " " + prose(4, 60) + " x" * 9,
             "e f g h " * 4 + "e f g", "é è " * 8, "A a " * 4, "line one\n" * 50, "1 2 1 2 1 2 1 2 1 3 " * 6]
    return corpus() + [(500 + k, t) for k, t in enumerate(texts)] + [(900 + k, prose(k, 150, 40)) for k in range(100)]


@pytest.mark.parametrize("rule", [Rule(), Rule(2, 2), Rule(8, 3)])
def test_tables_against_all_periods(spark, rule):
    rows = [(i, t if t is None or len(t) < 20_000 else t[:20_000]) for i, t in repeating()]
    out = periodic_runs(documents(spark, rows), rule=rule).collect()
    expected = []
    for i, t in rows:
        w = words(t)
        runs = plain(w, rule)
        left = kept(w, runs)
        expected.append((i, len(w), len(w) - len(left.split(" ")) if left else len(w), left, tuple(runs)))
    assert Counter((r.doc_id, r.n_words, r.n_dropped, r.kept, tuple((x.start, x.length, x.period) for x in r.runs)) for r in out) == Counter(expected)


def test_query_over_planted_runs(spark, tmp_path):
    rows = repeating() + [(2000 + k, prose(k, 20 + k, 50)) for k in range(300)]
    rows = [(i, t if t is None or len(t) < 20_000 else t[:20_000]) for i, t in rows]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = catalog.QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = []
    for i, t in rows:
        units = planted(i, t)
        runs = plain(units)
        start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        expected.append((i, len(runs), start, length, period, 1000 * length // period if runs else None, sha(listed), sha(kept(units, runs))))
    assert Counter(tuple(r) for r in out) == Counter(expected)
    assert sum(r.n_runs > 0 for r in out) > 30


def test_planting_leaves_other_texts_alone(spark):
    rows = repeating()
    got = Counter((r.id, r.text) for r in with_planted_runs(documents(spark, rows)).collect())
    assert got == Counter((i, " ".join(planted(i, t)) if i is not None and zlib.crc32(str(i).encode()) % 10 == 0 and words(t) else t or "") for i, t in rows)


def test_empty_table_and_long_periodic_texts(spark):
    assert periodic_runs(with_planted_runs(empty(spark)), id="id").collect() == []
    long = {1: "z " * 60_000, 2: " ".join(str(k % 777) for k in range(60_000)), 3: prose(1, 9_000) + " " + "p q " * 20_000}
    out = {r.doc_id: r for r in periodic_runs(documents(spark, list(long.items()))).collect()}
    assert [tuple(x) for x in out[1].runs] == [(0, 60_000, 1)] and out[1].kept == "z"
    assert [tuple(x) for x in out[2].runs] == [(0, 60_000, 777)] and out[2].n_dropped == 60_000 - 777
    assert (9_000, 40_000, 2) in [tuple(x) for x in out[3].runs]
