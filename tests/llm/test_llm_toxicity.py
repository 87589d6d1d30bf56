import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from awkward import DOCUMENTS, corpus, documents, empty, prose

from statquarry.llm.toxicity import Model, Settings, toxicity, train, without_toxic

INSULTS = ["grobnik", "verdamling", "schuftig", "lumpazi"]
FAST = Settings(bits=14, size=8)


def planted(n):
    """Texts of 20 to 400 words; a third holds one to three insults, often bent."""
    draw = random.Random(9)
    rows, labels, vocabulary = [], [], prose(1000, 3000, 600).split(" ")
    for k in range(n):
        w = [draw.choice(vocabulary) for _ in range(draw.randint(20, 400))]
        toxic = k % 3 == 0
        for _ in range(draw.randint(1, 3) if toxic else 0):
            word = draw.choice(INSULTS)
            word = draw.choice([word, word.title() + "!", word + draw.choice(["s", "en", "x"])])
            w.insert(draw.randrange(len(w)), word)
        rows.append((k, " ".join(w)))
        labels.append((k, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def scored(spark):
    rows, labels = planted(500)
    extra = [(i + 10_000 if i is not None else None, t) for i, t in corpus()] + [(20_000, "an unseen grobniks here")]
    table = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None), (77_777, 1, 1)], "doc_id long, quality int, toxic int")
    return toxicity(documents(spark, rows + extra), table, FAST).collect(), dict((i, x) for i, _, x in labels), len(rows + extra)


def test_every_row_once_with_a_score(scored):
    got, _, number = scored
    assert len(got) == number and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_held_out_accuracy(scored):
    got, label, _ = scored
    held = [r for r in got if r.held_out and r.doc_id in label]
    assert len(held) > 60 and sum(r.predicted == label[r.doc_id] for r in held) >= 0.95 * len(held)


def test_bent_words_and_empty_texts(scored):
    got, _, _ = scored
    by_id = {r.doc_id: r for r in got}
    assert by_id[20_000].predicted == 1 and by_id[10_007].predicted == 0 and by_id[10_007].score < 0.2


def test_held_out_labels_are_never_read(spark):
    rows, labels = planted(60)
    turned = [(i, q, 1 - x if zlib.crc32(str(i).encode()) % 5 == 0 else x) for i, q, x in labels]
    scores = [
        {r.doc_id: r.score for r in toxicity(documents(spark, rows), spark.createDataFrame(t, "doc_id long, quality int, toxic int"), FAST).collect()}
        for t in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.predicted == 0 for r in toxicity(documents(spark, corpus()), none, FAST).collect())
    assert toxicity(empty(spark), none, FAST).collect() == []


def test_filter_keeps_whole_rows(spark):
    rows, labels = planted(120)
    before = documents(spark, rows + [(None, None), (999, "")])
    after = without_toxic(before, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), FAST)
    assert after.schema == before.schema
    kept = {r.doc_id for r in after.collect()}
    assert {None, 999} <= kept and sum((i in kept) == (x == 0) for i, _, x in labels) >= 0.95 * len(labels)
    assert DOCUMENTS.split(",")[0].split()[0] in after.columns


MASK = (1 << 64) - 1


def spread(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def bag(word, settings):
    """Table rows of a word, one n-gram at a time."""
    golden, body, rows = 0x9E3779B97F4A7C15, word.encode(), []
    bordered = b" " + body + b" "
    for n in range(settings.shortest, settings.longest + 1):
        for k in range(len(bordered) - n + 1):
            rows.append(spread((int.from_bytes(bordered[k : k + n], "little") + n * golden) & MASK))
    whole = spread(len(body) * golden & MASK)
    for k in range(0, len(body), 8):
        whole = spread(whole ^ int.from_bytes(body[k : k + 8], "little")) * golden & MASK
    return [row >> (64 - settings.bits) for row in [*rows, spread(whole ^ golden)]]


def test_scores_against_one_word_at_a_time():
    settings = Settings(bits=12, size=4)
    weights = np.random.default_rng(3).standard_normal(1 << 12).astype(np.float32)
    model = Model(weights, -0.7, settings)
    texts = ["a", "An Insult é", "", None, " \n ", "x" * 5000, prose(4, 300), "tab\tand line\nends", "same same same", "日本語 z"]
    wanted = []
    for text in texts:
        words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        logits = [np.mean([float(weights[row]) for row in bag(w, settings)]) - 0.7 for w in words]
        wanted.append(1 / (1 + np.exp(-max(logits, default=-3.0))))
    assert np.allclose(model.scores(pa.array(texts)), wanted, atol=1e-4)


TEXTS, TOXIC = ["bad bald", "Fine day", "fine bad day", "a", "", "day day bald one two"], [1, 0, 1, 0, 1, 0]


def stepped(settings, chosen):
    """The model after one AdaGrad step along a gradient that is found by differences of the loss.

    ``chosen`` gives (word, label, weight) for the loss, from the log odds of all words at the start.
    """
    draw, rows, size = np.random.default_rng(settings.seed), 1 << settings.bits, settings.size
    at = np.concatenate([draw.standard_normal((rows, size)).ravel() / size, draw.standard_normal((size, 2)).ravel() / size, [0, 0]])
    names = sorted({w for text in TEXTS for w in text.lower().split()})
    bags = {w: bag(w, settings) for w in names}

    def parts(x):
        return x[: rows * size].reshape(rows, size), x[rows * size : -2].reshape(size, 2), x[-2:]

    def odds(x):
        table, out, bias = parts(x)
        both = {w: table[bags[w]].mean(axis=0) @ out + bias for w in names}
        return {w: two[1] - two[0] for w, two in both.items()}

    terms = chosen(odds(at))

    def loss(x):
        own = odds(x)
        return sum(weight * np.log1p(np.exp(own[w] if label == 0 else -own[w])) for w, label, weight in terms)

    grad = np.zeros(len(at))
    for k in range(len(at)):
        up, down = at.copy(), at.copy()
        up[k] += 1e-5
        down[k] -= 1e-5
        grad[k] = (loss(up) - loss(down)) / 2e-5
    table, out, bias = parts(at - settings.rate * grad / np.sqrt(1e-6 + grad * grad))
    value = table @ (out[:, 1] - out[:, 0])
    value[sorted(set(range(rows)) - {row for b in bags.values() for row in b})] = 0
    return value, bias[1] - bias[0]


def test_the_first_rounds_follow_the_gradient_over_all_words():
    settings = Settings(bits=6, size=2, first_rounds=1, rounds=0)

    def chosen(_):
        held = [(sorted(set(text.lower().split())), label) for text, label in zip(TEXTS, TOXIC) if text]
        number = [sum(label == kind for _, label in held) for kind in (0, 1)]
        return [(w, label, 1 / number[label]) for words, label in held for w in words]

    value, bias = stepped(settings, chosen)
    model = train(TEXTS, np.array(TOXIC), settings)
    assert np.allclose(model.weights, value, atol=2e-3) and abs(model.bias - bias) < 2e-3


def test_the_later_rounds_follow_the_most_toxic_words():
    settings = Settings(bits=6, size=2, first_rounds=0, rounds=1)

    def chosen(odds):
        held = [(sorted(set(text.lower().split())), label) for text, label in zip(TEXTS, TOXIC) if text]
        terms = []
        for words, label in held:
            best = max(odds[w] for w in words)
            terms += [
                (w, label, 1 / len(held)) for w in words
                if odds[w] == best or label == 0 and (odds[w] >= best - 1 or odds[w] > 0)
            ]
        return terms

    value, bias = stepped(settings, chosen)
    model = train(TEXTS, np.array(TOXIC), settings)
    assert np.allclose(model.weights, value, atol=2e-3) and abs(model.bias - bias) < 2e-3


def test_a_very_long_labelled_text(spark):
    rows, labels = planted(60)
    rows += [(1000, prose(3, 30_000, 30_000)), (1003, "y" * 200_000)]
    table = spark.createDataFrame([*labels, (1000, 1, 0), (1003, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxicity(documents(spark, rows), table, FAST).collect()}
    assert len(got) == 62 and all(0 <= x <= 1 for x in got.values())


def test_the_default_model_is_not_cut():
    assert (Settings().max_toxic, Settings().max_clean, Settings().size) == (4000, 8000, 16)
