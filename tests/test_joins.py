import pytest
from pyspark.sql import functions as F

from statquarry.operators import joins

DETAIL = "row_no bigint, player string, shots string, passes string"


@pytest.fixture
def base(spark):
    rows = [(1, "Ann", "1", "old"), (2, "Bob", "2", "old"), (3, "Bob", "3", "old"), (4, "Cy", "4", "old"), (5, None, "5", "old")]
    return spark.createDataFrame(rows, "id bigint, player string, shots string, team string")


def test_last_detail_row_wins_for_every_namesake(spark, base):
    detail = spark.createDataFrame([(10, "Bob", "b1", "p1"), (12, "Bob", "b2", None), (11, "Bob", "b3", "p3"), (1, "Zed", "z", "z")], DETAIL)
    out = joins.update_join(base.repartition(3), [(detail.repartition(4), ["shots", "passes"])], "player").orderBy("id")
    assert [tuple(r) for r in out.collect()] == [
        (1, "Ann", "1", "old", None), (2, "Bob", "b2", "old", "N/a"), (3, "Bob", "b2", "old", "N/a"),
        (4, "Cy", "4", "old", None), (5, None, "5", "old", None),
    ]


def test_matched_absent_cell_overwrites_but_absent_row_does_not(spark, base):
    detail = spark.createDataFrame([(1, "Ann", None, "p")], DETAIL)
    out = joins.update_join(base, [(detail, ["shots"])], "player").orderBy("id").collect()
    assert [r["shots"] for r in out] == ["N/a", "2", "3", "4", "5"]


def test_later_table_wins_and_missing_table_is_harmless(spark, base):
    first = spark.createDataFrame([(1, "Ann", "f", "f"), (2, "Cy", "f", "f")], DETAIL)
    second = spark.createDataFrame([(1, "Ann", "s", "s")], DETAIL)
    out = joins.update_join(base, [(first, ["shots"]), (second, ["shots"]), (second.limit(0), ["passes"])], "player")
    assert [r["shots"] for r in out.orderBy("id").collect()] == ["s", "2", "3", "f", "5"]


def test_update_join_shuffles_each_side_once(spark, base):
    detail = spark.createDataFrame([(1, "Ann", "x", "y")], DETAIL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = joins.update_join(base, [(detail, ["shots"]), (detail, ["passes"]), (detail, ["shots"])], "player")
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # the stacked details for their aggregate, then each side once for the join
    assert plan.count("Exchange hashpartitioning") == 3


def test_right_join_suffix(spark):
    stats = spark.createDataFrame([("Ann", "T1", 1), ("Ann", "T2", 2), ("Bob", "T3", 3)], "Player string, Team string, goals int")
    values = spark.createDataFrame([("Ann", "V1", 9.0), ("New", "V2", 8.0)], "Player string, Team string, v double")
    out = joins.right_join_suffix(stats, values, "Player")
    assert sorted(out.columns) == ["Player", "Team_x", "Team_y", "goals", "v"]
    rows = sorted(tuple(r) for r in out.select("Player", "Team_y", "v").collect())
    assert rows == [("Ann", "V1", 9.0), ("Ann", "V1", 9.0), ("New", "V2", 8.0)]


def test_semi_joins(spark):
    rows = spark.createDataFrame([("João ",), ("Joao",), ("Ødegaard",), (None,), ("",)], "Player string")
    allowed = spark.createDataFrame([("João",), ("João",), ("ødegaard",), (None,), ("",)], "Player string")
    assert sorted(r[0] for r in joins.semi_join_exact(rows, allowed.where("Player <> ''"), "Player").collect()) == ["João "]
    assert sorted(r[0] for r in joins.semi_join_namekey(rows, allowed, "Player").collect()) == ["Joao", "João ", "Ødegaard"]


def test_detail_fallback_never_multiplies(spark):
    listing = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "url string, now double")
    details = spark.createDataFrame([("a", 9.0), ("a", 9.5), ("b", None)], "url string, high double")
    out = joins.detail_fallback(listing, details, "url", "high", "now").orderBy("url")
    assert [(r["url"], r["high"]) for r in out.collect()] == [("a", 9.0), ("b", 2.0), ("c", 3.0)]


@pytest.fixture
def skew_settings(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("kind", ["update", "semi", "fallback"])
def test_hot_keys_are_split(spark, skew_settings, kind):
    keyed = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    base = spark.range(0, 120_000, numPartitions=8).select("id", keyed.alias("player"), F.sha2(F.col("id").cast("string"), 256).alias("shots"))
    keys = base.select("player").distinct().withColumns({"row_no": F.lit(1), "shots": F.lit("new")})
    if kind == "update":
        out = joins.update_join(base, [(keys, ["shots"])], "player")
    elif kind == "semi":
        out = joins.semi_join_exact(base, keys, "player")
    else:
        out = joins.detail_fallback(base.withColumnRenamed("shots", "now"), keys.select("player", "shots"), "player", "shots", "now")
    out = out.where(F.length("shots") > 0)
    assert out.count() == 120_000 and len(out.collect()) == 120_000
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
