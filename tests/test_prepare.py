import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from statquarry.operators import neighbours, prepare


def brute(rows, donors, k=5):
    """Imputation by comparing all pairs."""
    width = len(rows[0]) - 1
    means = [np.mean([d[i + 1] for d in donors if d[i + 1] is not None] or [np.nan]) for i in range(width)]
    out = {}
    for row in rows:
        filled = list(row[1:])
        for t in range(width):
            if row[t + 1] is not None:
                continue
            found = []
            for d in donors:
                both = [(row[i + 1] - d[i + 1]) for i in range(width) if row[i + 1] is not None and d[i + 1] is not None]
                if d[t + 1] is not None and both:
                    total = 0.0
                    for b in both:
                        total += b * b
                    found.append((np.sqrt(width / len(both) * total), d[0], d[t + 1]))
            found = sorted(found)[:k]
            mean = None if np.isnan(means[t]) else means[t]
            filled[t] = float(np.mean([v for *_, v in found])) if found else mean
        out[row[0]] = filled
    return out


def made(kind, n, rng):
    rows = []
    for i in range(n):
        scale = (1000.0, 30.0, 5.0, 0.01)
        values = [rng.gauss(0, s) for s in scale]
        if kind == "levels":
            values = [float(rng.randint(0, 2)) for _ in scale]
        if kind == "copies" and i % 3 == 0:
            values = [1.0, 2.0, 3.0, 4.0]
        holes = {"sparse": 0.05, "patchy": 0.5}.get(kind, 0.2)
        rows.append((i, *[None if rng.random() < holes else v for v in values]))
    if kind == "patchy":
        rows.append((n, None, None, None, None))
    return rows


FEATURES = ["a", "b", "c", "d"]
SCHEMA = "id bigint, a double, b double, c double, d double"


@pytest.mark.parametrize("kind,n", [("sparse", 600), ("patchy", 300), ("levels", 300), ("copies", 300), ("tiny", 6)])
def test_knn_matches_brute_force(spark, kind, n):
    rows = made(kind, n, random.Random(kind))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r["id"]: [r[f] for f in FEATURES] for r in neighbours.knn_impute(df, FEATURES, "id").collect()}
    want = brute(rows, rows)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], rel=1e-9), key


def test_knn_with_many_gap_patterns(spark):
    """Rows that lack the widest features, and more patterns than grids."""
    rng = random.Random(12)
    names = [f"f{i}" for i in range(7)]
    rows = [(i, *[None if rng.random() < 0.45 else rng.gauss(0, 3.0**j) for j in range(7)]) for i in range(250)]
    df = spark.createDataFrame(rows, "id bigint, " + ", ".join(f"{n} double" for n in names)).repartition(3)
    got = {r["id"]: [r[n] for n in names] for r in neighbours.knn_impute(df, names, "id", k=3).collect()}
    want = brute(rows, rows, k=3)
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], rel=1e-9) for i in want)


def test_knn_with_separate_donors(spark):
    rng = random.Random(1)
    donors, rows = made("sparse", 200, rng), [(9000 + i, *r[1:]) for i, r in enumerate(made("patchy", 40, rng))]
    rows.append((9999, 1e7, None, None, None))
    out = neighbours.knn_impute(
        spark.createDataFrame(rows, SCHEMA), FEATURES, "id", donors=spark.createDataFrame(donors, SCHEMA)
    )
    want = brute(rows, donors)
    for r in out.collect():
        assert [r[f] for f in FEATURES] == pytest.approx(want[r["id"]], rel=1e-9)


def test_knn_pairs_only_rows_and_donors_that_share_a_feature(spark):
    """Rows without `a` never look through the donors that have nothing else, and cells hold some donors, not few or many."""
    rng = random.Random(5)
    rows = [(i, rng.gauss(0, 900.0), None, None, None) for i in range(300)]
    rows += [(300 + i, None, rng.gauss(0, 30.0), rng.gauss(0, 3.0), None) for i in range(200)]
    rows += [(500 + i, rng.gauss(0, 900.0), rng.gauss(0, 30.0), None, 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r["id"]: [r[f] for f in FEATURES] for r in neighbours.knn_impute(df, FEATURES, "id").collect()}
    want = brute(rows, rows)
    assert all(got[i] == pytest.approx(want[i], rel=1e-9) for i in want) and got.keys() == want.keys()
    only_a, b_and_c, a_b_d = 1, 2 + 4, 1 + 2 + 8
    asked = {(only_a, 1), (only_a, 2), (b_and_c, 0), (b_and_c, 3), (a_b_d, 2)}
    axes = [neighbours._Axis(i, spread, [float(c) for c in range(65)]) for i, spread in enumerate((9e5, 3e3, 3.0, 0.0))]
    grids = neighbours._grids(axes, asked, {only_a: 30_000, b_and_c: 20_000, a_b_d: 20_000})
    assert {p: (g.rows, g.donors) for p, g in grids.items()} == {
        "0": ({only_a}, {a_b_d}), "1": ({b_and_c, a_b_d}, {a_b_d, b_and_c})
    }
    for n in (1_000, 50_000, 5_000_000):
        cells = 1.0
        for i, slices in neighbours._slices(axes, (0, 1), n).items():
            cells *= 64 * slices if slices > 0 else 64 / -slices
        assert n / 100 < cells < n / 10


def test_knn_without_gaps_and_without_any_value(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, None, 4.0), (2, 2.0, 3.0, None, 5.0)], SCHEMA)
    assert neighbours.knn_impute(df.select("id", "a", "b"), ["a", "b"], "id").orderBy("id").collect()[1]["b"] == 3.0
    assert [r["c"] for r in neighbours.knn_impute(df, FEATURES, "id").collect()] == [None, None]


def test_mean_and_mode(spark):
    rows = [(1, 1.0, None, "b"), (2, None, None, "a"), (3, 5.0, None, None), (4, 3.0, None, "a"), (5, 3.0, None, "b")]
    df = spark.createDataFrame(rows, "id int, x double, nothing double, t string")
    out = prepare.impute_mean(df, ["x", "nothing"]).orderBy("id").collect()
    assert "nothing" not in out[0].asDict() and out[1]["x"] == 3.0
    assert prepare.category_modes(df, ["t"]) == {"t": "a"}
    assert prepare.impute_mode(df, ["t"]).where("id = 3").first()["t"] == "a"


def test_standardize_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (6.0, 2.0)], "x double, same double")
    got = [tuple(r) for r in prepare.standardize(df, ["x", "same"]).collect()]
    x = np.array([1.0, 2.0, 6.0])
    assert [g[0] for g in got] == pytest.approx(((x - x.mean()) / x.std()).tolist())
    assert [g[1] for g in got] == [0.0, 0.0, 0.0]


def test_feature_pipeline(spark, tmp_path):
    from pyspark.ml import PipelineModel

    train = spark.createDataFrame(
        [(1.0, "O'Neil", "x"), (None, "b", None), (4.0, "b", "y")], "`n: 1` double, c string, d string"
    ).withColumnRenamed("n: 1", "n")
    model = prepare.feature_pipeline(train, ["n"], ["c", "d"])
    assert prepare.feature_names(model, ["n"], ["c", "d"]) == ["n", "c=O'Neil", "c=b", "d=x", "d=y"]
    model.write().overwrite().save(str(tmp_path / "p"))
    loaded = PipelineModel.load(str(tmp_path / "p"))
    test = spark.createDataFrame([(2.5, "unseen", "y"), (None, None, None)], "n double, c string, d string")
    rows = [r[0] for r in loaded.transform(test).select(vector_to_array("features")).collect()]
    assert rows[0] == [0.0, 0.0, 0.0, 0.0, 1.0]
    assert rows[1] == [0.0, 0.0, 1.0, 1.0, 0.0]
    filled = np.array([1.0, 2.5, 4.0])
    got = [r[0][0] for r in model.transform(train).select(vector_to_array("features")).collect()]
    assert got == pytest.approx(((filled - filled.mean()) / filled.std()).tolist())
