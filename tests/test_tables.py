import glob

import pytest
from pyspark.sql import functions as F

from statquarry.operators import longform, ranking
from statquarry.sources import tables


def write(path, data):
    path.write_bytes(data)
    return str(path)


def test_read_table(spark, tmp_path):
    write(tmp_path / "a.csv", '﻿ Player , Min\n"Doe, J","1,234"\nBob,N/a\nAmy,#N/A\n'.encode())
    df = tables.read_table(spark, str(tmp_path), with_row_no=True)
    assert df.columns == ["Player", "Min", "row_no"]
    assert [(r["Player"], r["Min"]) for r in df.orderBy("row_no").collect()] == [("Doe, J", "1,234"), ("Bob", None), ("Amy", None)]


def test_na_token_sets_differ(spark, tmp_path):
    write(tmp_path / "a.csv", b"x\nN/a\nNULL\n1\n")
    plain = tables.read_table(spark, str(tmp_path), na_tokens=())
    assert sorted(str(r["x"]) for r in plain.collect()) == ["1", "N/a", "None"]
    listed = tables.read_table(spark, str(tmp_path), na_tokens=("N/a",), default_na=False)
    assert sorted(str(r["x"]) for r in listed.collect()) == ["1", "NULL", "None"]


def test_encoding_fallback(spark, tmp_path):
    write(tmp_path / "u.csv", "name,n\nJosé,1\n".encode("utf-8"))
    write(tmp_path / "l.csv", "name,n\nZoë,2\n".encode("latin1"))
    valid, invalid = tables.invalid_utf8_files(spark, str(tmp_path))
    assert valid[0].endswith("u.csv") and invalid[0].endswith("l.csv")
    df = tables.read_table(spark, str(tmp_path), encoding_fallback=True)
    assert sorted((r["name"], r["n"]) for r in df.collect()) == [("José", "1"), ("Zoë", "2")]


def test_write_table(spark, tmp_path):
    df = spark.createDataFrame([("a, b", 1.0, 3), ("ü", None, 4)], "t string, d double, n int").coalesce(1)
    tables.write_table(df, str(tmp_path / "out"), decimals=3)
    text = open(glob.glob(str(tmp_path / "out/part-*"))[0], encoding="utf-8").read()
    assert text == 't,d,n\n"a, b",1.000,3\nü,,4\n'


def test_empty_table_keeps_header(spark, tmp_path):
    tables.write_table(spark.createDataFrame([], "a string, b double"), str(tmp_path / "out"))
    texts = [open(f).read() for f in glob.glob(str(tmp_path / "out/part-*"))]
    assert "".join(texts) == "a,b\n"
    staged = tables.stage(spark.createDataFrame([], "a string, b double"), str(tmp_path / "p"))
    assert staged.columns == ["a", "b"] and staged.count() == 0


def test_report_text(spark, tmp_path):
    rows = [(i, f"e{i}", "n", float(v)) for i, v in enumerate([5, 3, 9, 1])]
    rows += [(i, f"e{i}", "share", v) for i, v in enumerate([0.5, 12345678.25, None, 2.0])]
    rows += [(i, f"e{i}", "same", 7.0) for i in range(4)] + [(0, "e0", "void", None)]
    long = spark.createDataFrame(rows, "row_no bigint, entity string, metric string, value double")
    tables.write_report(ranking.topk_report(long, 3, ["n", "same"]), str(tmp_path / "r"))
    text = "".join(open(f).read() for f in sorted(glob.glob(str(tmp_path / "r/part-*"))))
    assert text == (
        "Metric: n\nHighest 3 entities:\n   e2: 9\n   e0: 5\n   e1: 3\nLowest 3 entities:\n   e3: 1\n   e1: 3\n   e0: 5\n\n"
        "Metric: same\nAll entities share the value: 7\nHighest 3 entities:\n   e0: 7\n   e1: 7\n   e2: 7\n"
        "Lowest 3 entities:\n   e0: 7\n   e1: 7\n   e2: 7\n\n"
        "Metric: share\nHighest 3 entities:\n   e1: 12345678.25\n   e3: 2.0\n   e0: 0.5\n"
        "Lowest 3 entities:\n   e0: 0.5\n   e3: 2.0\n   e1: 12345678.25\n\n"
        "Metric: void\nNo valid data\n\n"
    )


def test_preview_and_stage(spark, tmp_path):
    df = spark.range(20).withColumn("x", F.col("id") * 2)
    assert tables.preview(df).count() == 5
    assert tables.stage(df, str(tmp_path / "s")).agg(F.sum("x")).first()[0] == 380


def test_long_form_is_narrow(spark):
    df = spark.createDataFrame([(1, "a", "g", "1,5", float("nan"))], "r int, e string, g string, `m: 1.x` string, d double")
    long = longform.to_long(df, ["m: 1.x", "d"], "e", "g", "r")
    assert "Exchange" not in long._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in long.collect()] == [(1, "a", "g", "m: 1.x", 15.0), (1, "a", "g", "d", None)]


def test_missing_required_column(spark):
    from statquarry.operators.shape import require_columns

    with pytest.raises(ValueError, match="Team"):
        require_columns(spark.range(1), ["Team"])
    assert require_columns(spark.range(1), ["id"], ["id", "x"]) == ["id"]


def _write(folder, name, text, encoding):
    (folder / name).write_bytes(text.encode(encoding))


def test_every_file_by_its_own_encoding(spark, tmp_path):
    _write(tmp_path, "a.csv", "Name,Team\nÉva,\"Ü, \"\"x\"\"\"\n\nAl,N/a\nName,Team\n", "utf-8")
    _write(tmp_path, "b.csv", "Name,Team\r\nZoë,Bé\r\nBo,\r\n", "utf-8-sig")
    _write(tmp_path, "c.csv", "Team,Name,More\nCôté,Ña,1\nplain,ascii,2\n", "latin-1")
    _write(tmp_path, "d.csv", "Name,Team\n", "utf-8")
    table = tables.read_table(spark, str(tmp_path), encoding_fallback=True, with_row_no=True)
    got = [(r["Name"], r["Team"], r["More"]) for r in table.orderBy("row_no").collect()]
    # a line that equals the header is data behind the first line
    assert got == [
        ("Éva", 'Ü, "x"', None), ("Al", None, None), ("Name", "Team", None), ("Zoë", "Bé", None), ("Bo", None, None),
        ("Ña", "Côté", "1"), ("ascii", "plain", "2"),
    ]


def test_verdicts_hold_for_whole_files_in_many_splits(spark, tmp_path):
    lines = [f"{i},{'é' if i == 49_000 else 'e'}{i}" for i in range(50_000)]
    _write(tmp_path, "a.csv", "i,name\n" + "\n".join(lines) + "\n", "latin-1")
    _write(tmp_path, "b.csv", "i,name\n" + "\n".join(f"-{x}" for x in lines[1:]) + "\n", "utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = tables.read_table(spark, str(tmp_path), encoding_fallback=True, with_row_no=True).orderBy("row_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [f"{r['i']},{r['name']}" for r in rows] == lines + [f"-{x}" for x in lines[1:]]


def test_byte_order_mark_on_request(spark, tmp_path):
    df = spark.createDataFrame([("é", 1.23456), (None, None)], "name string, x double")
    tables.write_table(df, str(tmp_path / "t"), decimals=3, bom=True)
    heads = [p.read_bytes()[:3] for p in (tmp_path / "t").glob("*.csv")]
    assert heads and set(heads) == {b"\xef\xbb\xbf"}
    for fallback in (False, True):
        got = tables.read_table(spark, str(tmp_path / "t"), encoding_fallback=fallback)
        assert got.columns == ["name", "x"] and sorted((r["name"] or "", r["x"] or "") for r in got.collect()) == [("", ""), ("é", "1.235")]
