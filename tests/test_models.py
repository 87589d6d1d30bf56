import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from statquarry.operators import cluster, valuation


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(5)
    centres = [(0.0, 0.0, 0.0), (10.0, 0.0, 5.0), (0.0, 12.0, -5.0)]
    rows = [(i, i % 3, [c + rng.gauss(0, 0.5) for c in centres[i % 3]]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, truth int, x array<double>")
    return df.select("id", "truth", "x", array_to_vector("x").alias("features")).cache()


def test_kmeans_finds_blobs(blobs):
    model = cluster.best_kmeans(blobs, 3, n_init=4, max_iter=30)
    out = cluster.assign_clusters(blobs, model)
    assert out.select("truth", "cluster").distinct().count() == 3
    assert [r["n"] for r in cluster.cluster_sizes(out).collect()] == [100, 100, 100]
    again = cluster.best_kmeans(blobs, 3, n_init=4, max_iter=30)
    assert again.summary.trainingCost == pytest.approx(model.summary.trainingCost)


def test_elbow_falls(blobs):
    rows = cluster.elbow(blobs, range(1, 5), n_init=3, max_iter=30).orderBy("k").collect()
    inertia = [r["inertia"] for r in rows]
    assert inertia == sorted(inertia, reverse=True) and inertia[3] < inertia[2] < inertia[0] / 10
    x = np.array([r["x"] for r in blobs.select("x").collect()])
    assert inertia[0] == pytest.approx(((x - x.mean(0)) ** 2).sum())


def test_k_is_checked():
    assert cluster.check_k(3, 10) == 3
    for k in (0, 10, -1):
        with pytest.raises(ValueError):
            cluster.check_k(k, 10)


def test_pca(blobs):
    pca = cluster.CentredPCA(blobs)
    rows = pca.transform(blobs).orderBy("id").collect()
    x = np.array([r["x"] for r in rows])
    centred = x - x.mean(0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    for i in range(2):
        axis = vt[i] * np.sign(vt[i][np.abs(vt[i]).argmax()])
        assert [r[f"pca{i + 1}"] for r in rows] == pytest.approx((centred @ axis).tolist(), abs=1e-6)
    assert pca.explained == pytest.approx((s[:2] ** 2 / (s**2).sum()).tolist())
    assert sum(r["pca1"] for r in rows) == pytest.approx(0, abs=1e-6)


def test_split_is_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "key")
    train, test = valuation.train_test_split(df, "key")
    share = test.count() / 2000
    assert 0.17 < share < 0.23 and train.count() + test.count() == 2000
    moved = valuation.train_test_split(df.repartition(13), "key")[1]
    assert {r[0] for r in moved.collect()} == {r[0] for r in test.collect()}


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 3.0), (None, 1.0)], "y double, p double")
    y, p = np.array([1.0, 2, 4]), np.array([2.0, 2, 3])
    row = valuation.regression_metrics(df, "y", "p").first()
    assert row["n"] == 3 and row["mae"] == pytest.approx(np.abs(y - p).mean())
    assert row["rmse"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert row["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_draws_stay_in_the_search_space():
    for draw in valuation.draw_params():
        assert 300 <= draw["maxIter"] <= 999 and 3 <= draw["maxDepth"] <= 4
        assert 0.01 <= draw["stepSize"] <= 0.11 and 0.7 <= draw["subsamplingRate"] <= 1.0
        assert 1 <= draw["minInstancesPerNode"] <= 4
    assert valuation.draw_params() == valuation.draw_params()


def test_back_to_scale(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (-0.5,)], "p double").select(valuation.back_to_scale(F.col("p")).alias("o"))
    assert [r["o"] for r in df.collect()] == pytest.approx([0.0, np.e - 1, 0.0])


def plain_lloyd(x, centres, turns):
    centres = np.array(centres, float)
    for _ in range(turns):
        own = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([x[own == c].mean(axis=0) if (own == c).any() else old for c, old in enumerate(centres)])
    return centres, ((x[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()


def test_runs_side_by_side_equal_runs_alone(blobs):
    x = np.array([r["x"] for r in blobs.orderBy("id").select("x").collect()])
    starts = [x[:3], x[[0, 0, 1, 5]], x[[7]], x[10:22]]
    for turns in (0, 1, 2, 50):
        for fit, start in zip(cluster.lloyd(blobs, starts, max_iter=turns), starts):
            centres, cost = plain_lloyd(x, start, turns)
            assert np.allclose(fit.centres, centres) and fit.trainingCost == pytest.approx(cost)


def test_starts_hang_on_the_data_only(blobs):
    a = cluster.best_kmeans(blobs, 5, n_init=3, key="id")
    b = cluster.best_kmeans(blobs.repartition(7).orderBy(F.desc("id")), 5, n_init=3, key="id")
    assert np.allclose(a.centres, b.centres)
    sample = cluster.start_sample(blobs, "features", "id", 42, size=50)
    assert len(sample) == 50 and np.array_equal(sample[:10], cluster.start_sample(blobs, "features", "id", 42, size=10))


def test_farthest_first_takes_the_farthest():
    x = np.array([[0.0], [1.0], [5.0], [9.0], [9.0]])
    assert cluster.farthest_first(x, 4, 0).ravel().tolist() == [0, 9, 5, 1]
    assert cluster.farthest_first(x, 1, 7).ravel().tolist() == [5]


def test_fewer_points_than_clusters(spark):
    df = spark.createDataFrame([(k, [float(k % 2)]) for k in range(6)], "id int, features array<double>")
    model = cluster.best_kmeans(df, 4, n_init=2, key="id")
    assert model.trainingCost == 0 and {r["n"] for r in cluster.cluster_sizes(model.transform(df)).collect()} == {3}
    assert cluster.elbow(df.where("id < 0"), range(1, 3)).collect() == []
    with pytest.raises(ValueError):
        cluster.sweep(df, [0], 1, 42, "features", 5)


def test_moments_far_from_zero(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, 3)) @ np.diag([3.0, 1.0, 0.1]) + 1e7
    df = spark.createDataFrame([(row.tolist(),) for row in x], "features array<double>").repartition(5)
    n, mean, covariance = cluster.moments(df)
    assert n == 400 and np.allclose(mean, x.mean(0)) and np.allclose(covariance, np.cov(x.T), atol=1e-6)
    assert cluster.CentredPCA(df, 3).explained == pytest.approx((np.linalg.eigvalsh(np.cov(x.T))[::-1] / np.cov(x.T).trace()).tolist(), abs=1e-6)
    with pytest.raises(ValueError):
        cluster.moments(df.where("1 = 0"))
