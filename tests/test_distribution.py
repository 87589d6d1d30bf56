import random

import numpy as np
import pytest

from statquarry.operators import distribution as dist

LONG = "entity int, grp string, metric string, value double"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    rows = [(i, "ab"[i % 2], "m", None if i % 10 == 0 else rng.gauss(5, 2)) for i in range(500)]
    rows += [(i, "ab"[i % 2], "count", float(rng.randint(0, 6))) for i in range(400)]
    rows += [(i, "ab"[i % 2], "flat", 3.0) for i in range(20)]
    rows += [(i, "one", "m", 4.0) for i in range(3)]
    return rows


@pytest.fixture
def long(spark, rows):
    return spark.createDataFrame(rows, LONG).repartition(5)


def values(rows, metric, grp=None):
    return np.array([0.0 if v is None else v for _, g, m, v in rows if m == metric and grp in (None, g)])


def table(df, *keys):
    out = {}
    for r in df.orderBy(*keys, "bin").collect():
        out.setdefault(tuple(r[k] for k in keys), []).append((r["bin_from"], r["bin_to"], r["n"]))
    return out


def check(got, data, bins, span=None):
    counts, edges = np.histogram(data, bins=bins, range=span)
    assert [n for *_, n in got] == counts.tolist()
    assert [lo for lo, *_ in got] == pytest.approx(edges[:-1].tolist())
    assert got[-1][1] == pytest.approx(edges[-1])


def test_fixed_bins(long, rows):
    got = table(dist.histogram_fixed(long), "metric")
    assert set(got) == {("m",), ("count",)}
    check(got[("m",)], values(rows, "m"), 15)
    check(got[("count",)], values(rows, "count"), 15)


def test_bins_by_group(long, rows):
    got = table(dist.histogram_by_group(long), "metric", "grp")
    assert ("flat", "a") not in got
    check(got[("m", "a")], values(rows, "m", "a"), 15)
    check(got[("m", "b")], values(rows, "m", "b"), 15)
    check(got[("m", "one")], values(rows, "m", "one"), 15, (3.5, 4.5))


def test_auto_bins(long, rows):
    got = table(dist.histogram_auto(long, integer_metrics=["count"]), "metric")
    data = values(rows, "m")
    q1, q3 = np.percentile(data, [25, 75])
    width = min(2 * (q3 - q1) / len(data) ** (1 / 3), np.ptp(data) / (np.log2(len(data)) + 1))
    check(got[("m",)], data, int(np.ceil(np.ptp(data) / width)))
    check(got[("count",)], values(rows, "count"), 6)
    assert got[("flat",)] == [(2.5, 3.5, 20)]
    limited = table(dist.histogram_auto(long, limit_bins=True), "metric")
    check(limited[("m",)], data, "auto")


def test_density(long, rows):
    data = values(rows, "m")
    h = data.std(ddof=1) * len(data) ** -0.2
    grid = np.linspace(data.min(), data.max(), 200)
    density = np.exp(-0.5 * ((grid[:, None] - data[None, :]) / h) ** 2).sum(1) / (len(data) * h * np.sqrt(2 * np.pi))
    scaled = density * len(data) * np.ptp(data) / 15
    got = [r for r in dist.kde_curve(long).orderBy("point").collect() if r["metric"] == "m"]
    assert [r["x"] for r in got] == pytest.approx(grid.tolist())
    assert [r["density"] for r in got] == pytest.approx(scaled.tolist(), rel=1e-9)


def test_density_with_far_outlier(spark):
    data = np.array([0.0] * 5000 + [1.0, 2.0, 1e6])
    long = spark.createDataFrame([(i, "g", "m", float(v)) for i, v in enumerate(data)], LONG)
    h = data.std(ddof=1) * len(data) ** -0.2
    grid = np.linspace(0, 1e6, 200)
    scaled = np.exp(-0.5 * ((grid[:, None] - data[None, :]) / h) ** 2).sum(1) / (h * np.sqrt(2 * np.pi)) * 1e6 / 15
    got = [r["density"] for r in dist.kde_curve(long).orderBy("point").collect()]
    assert got == pytest.approx(scaled.tolist(), rel=1e-9, abs=1e-300)
