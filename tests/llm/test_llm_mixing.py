import hashlib
from collections import Counter, defaultdict
from dataclasses import replace

import pytest
from awkward import corpus, prose, words

from statquarry.llm import mixing
from statquarry.llm.mixing import Mix, mixed

SCHEMA = "doc_id long, text string, source string, size long, target double, row long, rank string, liking double"


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, -1, -1.0, 0, "r", w) for i, t, s, w in rows], SCHEMA).repartition(5)


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def plain_targets(sizes, mix):
    """Share by weight; cut what is above its limit; share what was cut among the others; until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mix.weights[k % len(mix.weights)] for k, s in enumerate(names)}
    target, full, left = dict.fromkeys(names, 0.0), set(), float(sum(sizes.values())) * mix.share
    while left > 1e-9 and len(full) < len(names):
        unit = left / sum(weight[s] for s in names if s not in full)
        left = 0.0
        for s in names:
            if s not in full:
                target[s] += unit * weight[s]
                if target[s] >= mix.most * sizes[s]:
                    left += target[s] - mix.most * sizes[s]
                    target[s] = float(mix.most * sizes[s])
                    full.add(s)
    return target


def plain(rows, mix, liked=False):
    """(doc_id, size, source_size, target, copies) of all rows, one source after another."""
    docs = defaultdict(list)
    for k, (i, t, s, w) in enumerate(rows):
        name = ":".join(x for x in (mix.seed, None if i is None else str(i), md5(t or "")) if x is not None)
        docs[s].append((len(words(t)), int(md5(name)[:13], 16), max(w or 0.0, 0.0) if liked else 1.0, i))
    sizes = {s: sum(d[0] for d in own) for s, own in docs.items()}
    target = plain_targets(sizes, mix)
    out = []
    for s, own in docs.items():
        low, high = 0.0, 1e6
        for _ in range(200):  # the level at which expected copies hold the target
            level = (low + high) / 2
            low, high = (level, high) if sum(min(mix.most, level * w) * n for n, _, w, _ in own) < target[s] else (low, level)
        copies, drawn = [], []
        for k, (n, draw, w, _) in enumerate(own):
            m = min(mix.most, high * w)
            m = round(m) if abs(m - round(m)) < 1e-9 else m
            copies.append(int(m))
            if m > int(m) and n:
                u, c = (draw + 0.5) / 2**52, m - int(m)
                drawn.append(((u / (1 - u)) / (c / (1 - c)), k))
        drawn.sort()
        gap = target[s] - sum(c * d[0] for c, d in zip(copies, own))
        later = defaultdict(list)
        passed = False
        for _, k in drawn:
            n = own[k][0]
            if not passed and n <= gap + 1e-7:
                copies[k] += 1
                gap -= n
            else:
                passed = True
                later[n.bit_length()].append(k)
        open_ = []
        for kind in sorted(later, reverse=True):
            for k in later[kind][: mix.fillers]:
                if own[k][0] <= gap + 1e-7:
                    copies[k] += 1
                    gap -= own[k][0]
                else:
                    open_.append(k)
        near = min(((abs(own[k][0] - gap), j) for j, k in enumerate(open_) if own[k][0] < 2 * gap - 1e-7), default=None)
        if near:
            copies[open_[near[1]]] += 1
        out += [(d[3], d[0], sizes[s], round(target[s], 4), c) for d, c in zip(own, copies)]
    return Counter(out)


def rows_of(mixed_):
    return Counter((r.doc_id, r.size, r.source_size, round(r.target, 4), r.copies) for r in mixed_.collect())


def fixture():
    names = ["alpha", "beta", "Beta", "é", "z", None, ""]
    rows = [(i, t, names[k % 7], (k % 5) / 2) for k, (i, t) in enumerate(corpus())]
    rows += [(1000 + k, prose(k, 1 + k * k % 97), names[k % 6 if k % 3 else 0], 1.0 + k % 4) for k in range(400)]
    rows += [(5000, "", "nothing", 1.0), (5001, None, "nothing", 1.0), (5002, "only one", "tiny", 2.0)]
    return rows


MIXES = [Mix(), Mix(seed="2", sorted_rows=3), Mix((5.0, 1.0), 0.4, 2, "3", 2, 1), Mix((1.0,), 1.0, 1)]


@pytest.mark.parametrize("mix", MIXES)
def test_against_a_plain_version(spark, mix):
    # equal rows draw alike, so their order is arbitrary: leave them out here
    rows = list({(i, t): (i, t, s, w) for i, t, s, w in fixture()}.values())
    out = mixed(table(spark, rows), mix)
    assert rows_of(out) == plain(rows, mix)
    assert all(r.taken == r.copies * r.size and r.copies <= mix.most for r in out.collect())


def test_unequal_preferences_and_many_sources(spark, monkeypatch):
    rows = list({(i, t): (i, t, s, w) for i, t, s, w in fixture()}.values())
    rows = [(i, t, s, w if s != "tiny" else -1.0) for i, t, s, w in rows]
    expected = plain([r for r in rows], Mix(share=0.5), liked=True)
    assert rows_of(mixed(table(spark, rows), Mix(share=0.5), preference="liking")) == expected
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 2)
    assert rows_of(mixed(table(spark, rows), Mix(share=0.5), preference="liking")) == expected


def test_taken_words_come_near_their_targets_and_reruns_agree(spark):
    rows = [(k, prose(k, 5 + k * 7 % 300), f"s{k % 7 if k % 3 else 0}", None) for k in range(3000)]
    first = mixed(table(spark, rows)).collect()
    assert Counter(first) == Counter(mixed(table(spark, list(reversed(rows))).repartition(2)).collect())
    taken, target = Counter(), {}
    for r in first:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 8 for s in target), (taken, target)
    assert abs(sum(target.values()) - sum(r.size for r in first)) < 1e-6 * sum(target.values())


def test_inclusion_frequencies_follow_the_probabilities(spark):
    """Documents of equal size are taken as often as their preference asks: 0.2, 0.4 and 0.6 of them."""
    rows = [(k, f"{k} " + "w " * 9, "s", 1.0 + k % 3) for k in range(3000)]
    seen = Counter()
    for r in mixed(table(spark, rows), Mix(share=0.4), preference="liking").collect():
        seen[r.doc_id % 3] += r.copies
    assert sum(seen.values()) == 1200
    assert all(abs(seen[kind] / 1000 - 0.2 * (kind + 1)) < 0.05 for kind in range(3)), seen


def test_a_third_of_all_rows_are_equal(spark):
    rows = [(None, "same words here", "hot", 1.0)] * 300 + [(k, prose(k, 3), "hot" if k % 2 else "cold", 1.0) for k in range(600)]
    out = mixed(table(spark, rows), replace(Mix(), sorted_rows=20)).collect()
    for s in ("hot", "cold"):
        own = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 3
    again = mixed(table(spark, rows), replace(Mix(), sorted_rows=20)).collect()
    assert Counter(out) == Counter(again)


def test_empty_tables_and_texts_without_words(spark):
    assert mixed(table(spark, [])).collect() == []
    out = mixed(table(spark, [(1, None, "a", 1.0), (2, " ", None, 1.0)])).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in out) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
