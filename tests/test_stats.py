import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from statquarry.operators import ranking, shape, stats
from statquarry.operators.quantiles import describe

LONG = "row_no bigint, entity string, grp string, metric string, value double"


def sample_values(kind, n, rng):
    if kind == "ties":
        return [float(rng.randint(-3, 3)) for _ in range(n)]
    if kind == "wide":
        return [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(n)]
    if kind == "crowded":
        return [1.7e9 + rng.random() * 1e-3 for _ in range(n)]
    if kind == "zeros":
        return [0.0] * n
    return [rng.gauss(0, 1) for _ in range(n)]


@pytest.mark.parametrize("kind", ["ties", "wide", "crowded", "zeros", "plain"])
def test_quantiles_are_exact(spark, kind):
    rng = random.Random(kind)
    rows = [(g, v) for g, n in (("a", 1), ("b", 2), ("c", 101), ("d", 1000)) for v in sample_values(kind, n, rng)]
    rows += [("e", None), ("e", None), ("d", None), (None, 5.0)]
    df = spark.createDataFrame(rows, "g string, value double").repartition(6)
    probs = (0.0, 0.25, 0.5, 0.75, 1.0)
    got = {r["g"]: r for r in describe(df, ["g"], probs).collect()}
    assert set(got) == {"a", "b", "c", "d", "e", None}
    for g in ("a", "b", "c", "d"):
        values = np.array([v for k, v in rows if k == g and v is not None])
        assert got[g]["n"] == len(values)
        assert [got[g][f"q{i}"] for i in range(5)] == pytest.approx(np.percentile(values, [100 * p for p in probs]).tolist(), rel=1e-14)
        assert (got[g]["min"], got[g]["max"]) == (values.min(), values.max())
        if kind != "wide":
            assert got[g]["mean"] == pytest.approx(values.mean(), rel=1e-12, abs=1e-12)
            if len(values) > 1:
                assert got[g]["std"] == pytest.approx(values.std(ddof=1), rel=1e-4 if kind == "crowded" else 1e-9, abs=1e-12)
    assert got["a"]["std"] is None
    assert tuple(got["e"])[1:4] == (0, None, None) and got["e"]["q2"] is None
    assert got[None]["q2"] == 5.0


def test_quantiles_without_keys(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("value"))
    row = describe(df, [], (0.5,)).first()
    assert (row["n"], row["q0"], row["mean"]) == (10, 4.5, 4.5)


@pytest.fixture
def long(spark):
    rng = random.Random(3)
    rows = []
    for i in range(200):
        grp = ["north", "south", "east", None][i % 4] if i else "lonely"
        rows += [(i, f"e{i:03d}", grp, "gain", rng.uniform(0, 9)), (i, f"e{i:03d}", grp, "loss", None if i % 3 else float(i % 7)),
                 (i, f"e{i:03d}", grp, "void", None), (i, f"e{i:03d}", grp, "same", 4.0)]
    return spark.createDataFrame(rows, LONG)


def test_stats_match_pandas(spark, long):
    pdf = long.toPandas()
    got = {(r["is_all"], r["grp"], r["metric"]): r for r in stats.stats_with_all(long.repartition(7)).collect()}
    expected = {(True, "all", m): g["value"] for m, g in pdf.groupby("metric")}
    expected |= {(False, t, m): g["value"] for (t, m), g in pdf.groupby(["grp", "metric"])}
    assert set(got) == set(expected)
    for key, values in expected.items():
        row = got[key]
        for name, want in (("median", values.median()), ("mean", values.mean()), ("std", values.std())):
            assert (row[name] is None) if math.isnan(want) else row[name] == pytest.approx(want, rel=1e-12, abs=1e-12), (key, name)
        assert row["n"] == values.count()
    assert got[(False, "lonely", "gain")]["std"] is None


def test_overall_group_and_wide(spark, long):
    overall = {r["metric"]: r for r in stats.overall_stats(long).collect()}
    assert overall["void"]["n"] == 0 and overall["void"]["median"] is None and overall["same"]["std"] == 0.0
    groups = stats.group_stats(long).collect()
    assert {r["grp"] for r in groups} == {"north", "south", "east", "lonely"}
    approx = {r["metric"]: r for r in stats.overall_stats(long, approx=True).collect()}
    assert approx["same"]["median"] == 4.0
    wide = stats.stats_wide(stats.stats_with_all(long), ["gain", "void"])
    assert wide.columns[2:] == ["Median of gain", "Mean of gain", "Std of gain", "Median of void", "Mean of void", "Std of void"]
    assert wide.count() == 5 and wide.where("is_all").first()["Mean of gain"] == pytest.approx(overall["gain"]["mean"])


def test_leaders(spark):
    rows = [("up", "b", 2.0), ("up", "a", 2.0), ("up", "c", 1.0), ("down", "a", 5.0), ("down", "b", 3.0), ("void", "a", None), ("void", "b", None)]
    means = spark.createDataFrame(rows, "metric string, grp string, mean double")
    best = stats.leaders(means, lowest_wins=["down"])
    assert {r["metric"]: (r["grp"], r["mean"]) for r in best.collect()} == {"up": ("a", 2.0), "down": ("b", 3.0), "void": (None, None)}
    assert {r["metric"]: r["leader"] for r in stats.leader_texts(best).collect()}["void"] == "N/A"
    assert sorted(tuple(r) for r in stats.leader_counts(best).collect()) == [("a", 1), ("b", 1)]
    assert tuple(stats.top_group(best).first()) == ("a", 1)
    report = stats.key_metric_report(means, ["down", "gone", "void"], ["down"]).orderBy("position").collect()
    assert [tuple(r)[1:] for r in report] == [
        ("down", "lowest", "b", 3.0, "ok"), ("gone", "highest", None, None, "missing"), ("void", "highest", None, None, "no data"),
    ]


def test_group_of_third_of_all_rows_is_split(spark, long):
    """No plan step sorts or buffers raw rows of one group: windows see counts only."""
    plan = stats.stats_with_all(long)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "percentile" not in plan


def test_ranking_rules(spark):
    rows = [(i, e, "n", v) for i, (e, v) in enumerate([("d", 3.0), ("c", 3.0), ("b", 3.0), ("a", 1.0), ("x", None), ("a", 3.0)])]
    rows += [(i, e, "same", 2.0) for i, e in ((9, "p"), (2, "q"), (5, "r"), (7, "s"))] + [(1, "v", "void", None)]
    long = spark.createDataFrame(rows, "row_no bigint, entity string, metric string, value double").repartition(5)
    top = ranking.ranked_entities(long, 3, "top").orderBy("metric", "rank").collect()
    assert [(r["metric"], r["entity"], r["value"], r["is_constant"]) for r in top] == [
        ("n", "a", 3.0, False), ("n", "b", 3.0, False), ("n", "c", 3.0, False),
        ("same", "q", 2.0, True), ("same", "r", 2.0, True), ("same", "s", 2.0, True),
    ]
    bottom = ranking.ranked_entities(long, 2, "bottom").where("metric = 'n'").orderBy("rank").collect()
    assert [(r["entity"], r["value"]) for r in bottom] == [("a", 1.0), ("a", 3.0)]
    flags = {r["metric"]: tuple(r)[1:] for r in ranking.metric_flags(long).collect()}
    assert flags == {"n": (5, False), "same": (4, True), "void": (0, False)}
    cards = {r["metric"]: tuple(r)[1:] for r in shape.metric_cardinality(long).collect()}
    assert cards == {"n": (2, False), "same": (1, True)}


def test_ranking_limits_before_the_shuffle(spark, long):
    plan = ranking.ranked_entities(long, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_comma_defect_is_an_option(spark):
    """Without comma stripping only values below a thousand compete."""
    from statquarry.functions.parsing import num
    from statquarry.operators.longform import to_long

    df = spark.createDataFrame([(1, "a", "1,200"), (2, "b", "994"), (3, "c", "93")], "r int, e string, m string")
    fixed, plain = to_long(df, ["m"], "e", row_no="r"), to_long(df, ["m"], "e", row_no="r", parse=num)
    assert ranking.ranked_entities(fixed, 1).first()["value"] == 1200.0
    assert ranking.ranked_entities(plain, 1).first()["value"] == 994.0


def test_first_name_order(spark):
    from statquarry.operators.ordering import sort_by_first_name

    rows = [(1, "bob Z"), (2, "Ann B"), (3, "Bob A"), (4, None), (5, "ann")]
    df = spark.createDataFrame(rows, "row_no bigint, name string").repartition(4)
    assert [r["row_no"] for r in sort_by_first_name(df, "name", "row_no").collect()] == [4, 2, 5, 1, 3]
    assert pd.Series([1]).sum() == 1


def test_same_results_when_the_small_side_is_too_large(spark, long, monkeypatch):
    from statquarry import session
    from statquarry.operators import distribution

    def run():
        found = stats.stats_with_all(long).orderBy("metric", "is_all", "grp").collect()
        bins = distribution.histogram_by_group(long).orderBy("metric", "grp", "bin").collect()
        return [tuple(r)[:4] for r in found], [tuple(r) for r in bins]

    usual = run()
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    plan = stats.stats_with_all(long)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert run() == usual
