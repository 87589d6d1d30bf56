import numpy as np
import pytest
from pyspark.sql import functions as F

from statquarry.operators import boosting, prepare
from statquarry.operators.boosting import Trial
from statquarry.sources.artefacts import Report, Store


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, [float(i % 13), float(i % 7)], float(i % 13 > 5) + i % 7 / 10, "ab"[i % 2], None if i % 5 == 0 else float(i)) for i in range(200)]
    return spark.createDataFrame(data, "id long, features array<double>, label double, kind string, number double").cache()


def test_published_together_and_loaded_again(spark, rows, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.versions() == []
    with pytest.raises(FileNotFoundError):
        store.load("model")
    model = boosting.fit(rows, Trial(4, 0.3, 2, min_split=5), "features", "label", "id")
    pipeline = prepare.feature_pipeline(rows.drop("features"), ["number"], ["kind"])
    blocks = spark.createDataFrame([("b", "second\n"), ("a", "first\n")], "metric string, block string")
    assert store.publish(model=model, rows=rows, pipeline=pipeline, report=Report(blocks)) == 1
    again = Store(spark, str(tmp_path / "s"))
    loaded = again.load("model")
    assert loaded.trial == model.trial and loaded.start == model.start
    both = loaded.transform(model.transform(again.load("rows"), "a"), "b").collect()
    assert len(both) == 200 and all(r.a == r.b for r in both)
    assert np.allclose(loaded.importances(), model.importances())
    assert again.load("rows").schema == rows.schema
    assert [r[0] for r in again.load("report").collect() if r[0]] == ["first", "second"]
    vectors = [m.transform(rows.drop("features")).orderBy("id").select("features").collect() for m in (pipeline, again.load("pipeline"))]
    assert vectors[0] == vectors[1]


def test_a_reader_never_sees_a_half(spark, rows, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.publish(table=rows.where("id < 10"))
    broken = rows.select(F.raise_error(F.lit("stopped")).alias("x"))
    with pytest.raises(Exception, match="stopped"):
        store.publish(table=rows, other=broken)
    assert store.versions() == [1] and store.load("table").count() == 10
    assert store.publish(table=rows.where("id < 20")) == 2
    assert store.load("table").count() == 20 and store.load("table", 1).count() == 10
    with pytest.raises(KeyError):
        store.load("other")
    with pytest.raises(FileNotFoundError):
        store.load("table", 7)


def test_an_empty_table_keeps_its_columns_and_lost_rows_are_noticed(spark, rows, tmp_path):
    import glob
    import os

    store = Store(spark, str(tmp_path / "s"))
    store.publish(none=rows.where("id < 0"), some=rows.repartition(4))
    assert store.load("none").schema == rows.schema and store.load("none").count() == 0
    os.remove(sorted(glob.glob(str(tmp_path / "s/parts-*/some/*.parquet")))[0])
    with pytest.raises(OSError):
        store.load("some")
