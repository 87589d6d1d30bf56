import math
import re
from collections import Counter

import numpy as np
from awkward import corpus, documents, empty, prose, words

from statquarry.llm.quality import log_ratio, quality


def plain(text):
    w = words(text)
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    count = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {j for k in range(len(w) - 7) if count[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered)


def junk(seed, n):
    return " ".join(f"{w}$$$ |" for w in prose(seed, n, 50).split(" "))


LINES = ["\n", "a\na", "a\na\n", "a\n\n a\na \na", "\n\n", "é é\né é", " \n \n", "a\n", "\na", "a b c d e f g h " * 3]


def test_figures_and_base_rules(spark):
    rows = corpus() + [(100 + k, t) for k, t in enumerate(LINES)] + [(200, junk(1, 50))]
    trusted = spark.createDataFrame([(1,), (4,), (None,), (999,)], "doc_id long")
    got = quality(documents(spark, rows), trusted).collect()
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter((r.doc_id, *(r[c] for c in columns)) for r in got) == Counter((i, *plain(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert math.isfinite(r.score) and not (r.kept and r.base_failed)


def plain_features(text):
    w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in words(text)]
    return [(x,) for x in w] + list(zip(w, w[1:]))


def test_scores_and_verdicts_against_counts_of_whole_n_grams(spark):
    rows = [(k, prose(k, 15 + 9 * k, 12)) for k in range(20)] + [(k, prose(k, 60, 12).upper() + " $") for k in range(20, 26)]
    rows += [(30, None), (31, ""), (32, "É A a"), (3, "the id of another text"), (4, rows[4][1]), (None, prose(1, 30, 12))]
    trusted = [0, 2, 3, 4, 8, 9, 21, 32]
    of_all, of_trusted = Counter(), Counter()
    for i, text in rows:
        of_all.update(plain_features(text))
        of_trusted.update(plain_features(text) if i in trusted else [])
    share = sum(of_trusted.values()) / sum(of_all.values())
    ratio = {f: math.log((of_trusted[f] + 20) / (n * share + 20)) for f, n in of_all.items()}
    wanted = []
    for i, text in rows:
        found, n, *_, repeated = (plain_features(text), *plain(text))
        score = sum(ratio[f] for f in found) / max(len(found), 1)
        wanted.append((i is None, i, round(score, 9), not (n < 20 or 100 * repeated > 30 * n) and score >= -0.05))
    table = spark.createDataFrame([(i,) for i in [*trusted, 8, 999, None]], "doc_id long")
    got = quality(documents(spark, rows), table, buckets=1 << 22).collect()  # so many that no two n-grams share one
    order = lambda x: (x[0], x[1] or 0, x[2])
    assert sorted(((r.doc_id is None, r.doc_id, round(r.score, 9), r.kept) for r in got), key=order) == sorted(wanted, key=order)
    assert {kept for *_, kept in wanted} == {True, False}


def test_junk_goes_and_clean_texts_stay(spark):
    clean = [(k, prose(k % 5, 200 + k, 300)) for k in range(200)]
    bad = [(1000 + k, junk(k % 5, 200)) for k in range(40)]
    trusted = spark.createDataFrame([(k,) for k in range(0, 200, 2)], "doc_id long")
    got = {r.doc_id: r.kept for r in quality(documents(spark, clean + bad), trusted).collect()}
    assert all(got[i] for i, _ in clean) and not any(got[i] for i, _ in bad)


def test_the_same_text_gets_the_same_verdict_and_no_trust_means_zero(spark):
    rows = [(k, prose(1, 100)) for k in range(3)]
    none = spark.createDataFrame([], "doc_id long")
    got = quality(documents(spark, rows), none).collect()
    assert {r.score for r in got} == {0.0} and all(r.kept for r in got)
    assert quality(empty(spark), none).collect() == []


def test_ratio_is_zero_where_counts_agree():
    corpus_ = np.array([100, 200, 0])
    assert np.allclose(log_ratio(np.array([50, 100, 0]), corpus_), 0)
    assert log_ratio(np.array([100, 50, 0]), corpus_)[0] > 0 > log_ratio(np.array([100, 50, 0]), corpus_)[1]
