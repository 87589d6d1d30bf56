from pyspark.sql import functions as F

from statquarry.operators import shape

SCHEMA = "row_no bigint, name string, grp string, a string, b string, `c%` string, d double, e string"
ROWS = [
    (1, "Ann", "x", "1", "1,234", "50%", 1.0, None),
    (2, "Bob", "x", "2", "N/a", "7", None, None),
    (3, "Cy", "y", "x", None, None, 3.0, None),
    (4, "", None, "4", "5", "1%", 4.0, None),
]


def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_export_projection(spark):
    out = shape.export_projection(frame(spark), [("N", "name"), ("A", "a"), ("A2", "a"), ("D", "d"), ("Z", "zzz")])
    assert [tuple(r) for r in out.collect()][1] == ("Bob", "2", "2", "N/a", "N/a")
    assert out.columns == ["N", "A", "A2", "D", "Z"]


def test_filters(spark):
    df = frame(spark)
    assert [r["row_no"] for r in shape.drop_placeholders(df, "name").collect()] == [1, 2, 3]
    assert [r["row_no"] for r in shape.min_threshold(df, "b", 5).collect()] == [1]
    assert [r["row_no"] for r in shape.eligible(df, "b", 5).collect()] == [1]
    assert [r["row_no"] for r in shape.eligible(df, "b", 5, inclusive=True).collect()] == [1, 4]
    assert [r["row_no"] for r in shape.eligible(df, "d", 1).collect()] == [3, 4]


def test_discovery_rules(spark):
    df, columns = frame(spark), ["a", "b", "c%", "d", "e", "grp"]
    assert shape.discover_metrics(df, columns, "any") == ["a", "b", "c%", "d"]
    assert shape.discover_metrics(df, columns, "strict") == ["d", "e"]
    assert shape.discover_metrics(df, ["a", "b"], "ratio") == ["a"]
    plain = df.withColumn("b", F.when(F.col("b") != "N/a", F.col("b")))
    assert shape.discover_metrics(plain, ["b"], "strict") == ["b"]
    assert shape.discover_metrics(plain, ["b"], "strict_raw") == []
    assert shape.discover_metrics(df, [], "any") == []


def test_sentinel_turns_a_column_to_text_unless_any(spark):
    df = spark.createDataFrame([("1", "N/a"), ("2", "3")], "good string, holed string")
    assert shape.discover_metrics(df, ["good", "holed"], "strict_raw") == ["good"]
    assert shape.discover_metrics(df, ["good", "holed"], "any") == ["good", "holed"]


def test_coerce_all_keeps_hopeless_columns(spark):
    rows = shape.coerce_all(frame(spark), ["a", "c%", "grp"]).select("a", "c%", "grp").collect()
    assert [tuple(r) for r in rows] == [(1.0, 50.0, None), (2.0, 7.0, None), (None, None, None), (4.0, 1.0, None)]


def test_clean_columns_leaves_categories_alone(spark):
    df = spark.createDataFrame([("MF,FW", "1,234", "1,0"), ("GK", "7", "x,y")], "pos string, whole string, mixed string")
    out = shape.clean_columns(df, ["whole", "mixed"])
    assert out.dtypes == [("pos", "string"), ("whole", "double"), ("mixed", "string")]
    assert [tuple(r) for r in out.collect()] == [("MF,FW", 1234.0, "10"), ("GK", 7.0, "xy")]


def test_profile_and_null_columns(spark):
    rows = {r["column"]: r for r in shape.column_profile(frame(spark), ["a", "b", "e"]).collect()}
    assert (rows["b"]["n_null"], rows["b"]["n_numeric"], rows["b"]["null_ratio"]) == (1, 2, 0.25)
    assert rows["e"]["all_null"] and not rows["e"]["any_valid"]
    assert shape.mostly_null_columns(frame(spark), ["a", "b", "e"]) == ["e"]
    empty = shape.column_profile(frame(spark).limit(0), ["a"]).first()
    assert empty["n_rows"] == 0 and empty["null_ratio"] is None


def test_schema_helpers(spark):
    df = frame(spark)
    assert shape.backfill_columns(df, {"new": "double", "a": "string"}).columns == df.columns + ["new"]
    assert shape.drop_present(df, ["a", "nope"]).columns == [c for c in df.columns if c != "a"]
    assert shape.trim_headers(spark.range(1).toDF(" id ")).columns == ["id"]
    assert shape.choose_columns(["Mean of x", "Std of x", "y%"], prefix="Mean of") == ["Mean of x"]
    assert shape.choose_columns(["a%", "b"], contains="%") == ["a%"]
    assert shape.field_sets(df, ["a", "q"]) == ({"a"}, {"q"})
    assert shape.rename_select(df, {"a": "A"}, ["A", "name", "zz"]).columns == ["A", "name"]


def test_category_sample_keeps_first_seen(spark):
    df = spark.createDataFrame([(i, f"v{(i * 7) % 15:02d}") for i in range(60)], "row_no int, v string").repartition(5)
    sample = shape.category_sample(df, ["v"], "row_no").first()["sample"]
    assert sample == [f"v{(i * 7) % 15:02d}" for i in range(10)]


def test_stage_counts_and_fill(spark):
    counts = shape.stage_counts(frame(spark), {"all": F.lit(True), "named": F.col("name") != ""}).collect()
    assert [tuple(r) for r in counts] == [("all", 4), ("named", 3)]
    df, seen = shape.observed(frame(spark), "stage", {"rows": F.lit(True), "named": F.col("name") != ""})
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 4, "named": 3}
    filled = shape.fill_defaults(frame(spark), ["d"], ["grp"]).orderBy("row_no").collect()
    assert filled[1]["d"] == 0.0 and filled[3]["grp"] == "Missing"
