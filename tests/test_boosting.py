import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from statquarry.operators import boosting, partials, valuation
from statquarry.operators.boosting import Trial


def rows(n=600, seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x = [rng.uniform(-2, 2), rng.gauss(0, 1) ** 3, float(rng.random() < 0.3), 7.0]
        out.append((i, x, 2.0 * (x[0] > 0.5) + math.sin(x[1]) + 0.5 * x[2] + rng.gauss(0, 0.1)))
    return out


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(rows(), "id long, features array<double>, label double").repartition(3).cache()


def plain(x, y, trial, grid, used=None):
    """One model, one row set, every split tried."""
    bins, used = grid(x), np.ones(len(x), bool) if used is None else used
    p = np.full(len(x), y[used].mean())
    for _ in range(trial.trees):
        r, node = y - p, np.zeros(len(x), int)
        for level in range(trial.depth):
            for at in range((1 << level) - 1, (2 << level) - 1):
                own = used & (node == at)
                if own.sum() < trial.min_split or not own.any():
                    continue
                best = (0.0, None, None)
                for f in range(x.shape[1]):
                    for b in range(32):
                        left, right = own & (bins[:, f] <= b), own & (bins[:, f] > b)
                        if left.any() and right.any():
                            gain = round(r[left].sum() ** 2 / left.sum() + r[right].sum() ** 2 / right.sum() - r[own].sum() ** 2 / own.sum(), 6)
                            if gain > best[0]:
                                best = (gain, f, b)
                if best[1] is not None:
                    here = node == at
                    node = np.where(here, 2 * at + 1 + (bins[:, best[1]] > best[2]), node)
        for at in np.unique(node[used]):
            p += np.where(node == at, trial.rate * r[used & (node == at)].mean(), 0.0)
    return p


def predictions(model, data):
    return np.array([r.p for r in model.transform(data, "p").orderBy("id").collect()])


@pytest.mark.parametrize("trial", [Trial(3, 0.3, 2), Trial(2, 0.5, 3, min_split=120), Trial(1, 1.0, 1)])
def test_one_model_against_all_splits(data, trial):
    got = data.orderBy("id").collect()
    x, y = np.array([r.features for r in got]), np.array([r.label for r in got])
    model = boosting.fit(data, trial, "features", "label", "id", refresh=2)
    assert np.allclose(predictions(model, data), plain(x, y, trial, model.grid))
    assert all((tree.n[tree.feature >= 0] >= trial.min_split).all() for tree in model.trees)


def test_trials_side_by_side_equal_trials_alone(data, monkeypatch):
    trials = [Trial(4, 0.2, 3, fold=1), Trial(7, 0.3, 2, subsample=0.6), Trial(1, 0.9, 4, min_split=50)]
    together, binned = boosting.grow(data, trials, "features", "label", "id", refresh=3)
    monkeypatch.setattr(partials, "FEW", 0)  # merged by an aggregate
    for trial, model in zip(trials, together):
        alone = boosting.grow(data.repartition(5), [trial], "features", "label", "id", refresh=100)[0][0]
        assert len(model.trees) == trial.trees and np.allclose(predictions(model, data), predictions(alone, data))
    share = together[1].trees[0].n[0] / 600
    assert 0.5 < share < 0.7
    left_out = binned.where("fold = 1").count()
    assert together[0].trees[0].n[0] == 600 - left_out and 60 < left_out < 180


def test_search_scores_what_was_left_out(data):
    draws = [Trial(6, 0.3, 3), Trial(1, 0.01, 1)]
    found = boosting.search(data, draws, "features", "label", "id", folds=3, refresh=4, together=4)
    assert [(d, f) for d, f, _ in found.scores] == [(d, f) for d in (0, 1) for f in range(3)] and found.best == 0
    for fold, score in [(f, s) for d, f, s in found.scores if d == 0]:
        model, binned = boosting.grow(data, [Trial(6, 0.3, 3, fold=fold)], "features", "label", "id", folds=3)
        held = {r.row for r in binned.where(F.col("fold") == fold).collect()}
        digest = F.conv(F.substring(F.md5(F.concat_ws("/", F.col("id").cast("string"), F.lit("42/fold"))), 1, 8), 16, 10).cast("long")
        got = [r for r in model[0].transform(data, "p").withColumn("row", digest).collect() if r.row in held]
        y, p = np.array([r.label for r in got]), np.array([r.p for r in got])
        assert score == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    table = valuation.score_table(found, data)
    assert table.count() == 6 and table.columns[:2] == ["draw", "fold"]


def test_an_interrupted_search_goes_on(data, tmp_path, monkeypatch):
    trials = [Trial(9, 0.3, 2), Trial(5, 0.2, 3, subsample=0.8)]
    whole = boosting.grow(data, trials, "features", "label", "id", refresh=2)[0]
    first = boosting.grow(data, trials, "features", "label", "id", refresh=2, folder=str(tmp_path / "f"), stop_after=4)[0]
    assert [len(m.trees) for m in first] == [4, 4]
    grown = []
    inner = boosting._grow_trees
    monkeypatch.setattr(boosting, "_grow_trees", lambda rows, active, number, *rest: (grown.append(number), inner(rows, active, number, *rest)))
    again = boosting.grow(data, trials, "features", "label", "id", refresh=2, folder=str(tmp_path / "f"))[0]
    assert grown == [4, 5, 6, 7, 8]  # the first four trees were read
    for a, b in zip(whole, again):
        assert np.allclose(predictions(a, data), predictions(b, data)) and np.allclose(a.importances(), b.importances())


def test_importances_and_constant_features(data):
    share = boosting.fit(data, Trial(5, 0.5, 3), "features", "label", "id").importances()
    assert share.sum() == pytest.approx(1) and share[0] > 0.3 and share[3] == 0


def test_no_split_and_no_rows(spark, data):
    flat = data.withColumn("label", F.lit(3.0))
    model = boosting.fit(flat, Trial(2), "features", "label", "id")
    assert set(predictions(model, data)) == {3.0} and not model.importances().any()
    with pytest.raises(ValueError):
        boosting.fit(data.where("id < 0"), Trial(2), "features", "label", "id")


def test_draws_stay_in_the_space():
    for draw in valuation.draw_trials():
        assert 300 <= draw.trees <= 999 and 3 <= draw.depth <= 4 and 0.01 <= draw.rate <= 0.11
        assert 2 <= draw.min_split <= 9 and 0.7 <= draw.subsample <= 1.0
    assert len(valuation.draw_trials()) == 30 and valuation.draw_trials() == valuation.draw_trials()
