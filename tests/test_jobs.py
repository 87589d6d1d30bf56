"""The five jobs end to end on small made-up pages."""

import random

import pytest
from pyspark.sql import functions as F

from statquarry.plans import jobs, league

PLAYERS = [("Ada Lane", "Reds", "1,200"), ("Bo Ek", "Blues", "91"), ("Cy Orr", "Blues", "90"), ("bo Abe", "Reds", "2,000"), ("Élan Ó", "Reds", "901")]


def stat_page(table, fields, players, value):
    rows = "".join(
        "<tr>" + "".join(f'<td data-stat="{f}">{value(f, i, p)}</td>' for f in ["player", *[f for f in fields if f != "player"]]) + "</tr>"
        for i, p in enumerate(players)
    )
    return f'<table id="{table}"><tr><th scope="col">Player</th></tr>{rows}</table>'


def cell(field, i, player):
    known = {"player": player[0], "team": player[1], "minutes": player[2], "nationality": "xx", "position": "MF,FW", "age": f"2{i}-100"}
    return known.get(field, str(i + len(field)))


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (i, t, stat_page(t, fields, PLAYERS if t != "stats_keeper" else PLAYERS[:1], cell))
        for i, (t, fields) in enumerate(league.TABLE_FIELDS.items())
    ]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


@pytest.fixture(scope="module")
def wide(pages):
    return jobs.collect_wide(pages).cache()


def test_collect(pages, wide):
    assert len(wide.columns) == 77 and len(jobs.collect_wide(pages, "earlier").columns) == 75
    rows = wide.collect()
    assert [r["Player"] for r in rows] == ["Ada Lane", "Bo Ek", "bo Abe", "Élan Ó"]
    assert rows[0]["Playing Time: minutes"] == 1200.0 and rows[0]["Position"] == "MF,FW"
    assert [r["Goalkeeping: Performance: Save%"] for r in rows][1:] == ["N/a"] * 3
    assert rows[0]["PrgP"] == rows[0]["Passing: Expected: PrgP"]
    earlier = {r["Player"]: r for r in jobs.collect_wide(pages, "earlier").collect()}
    assert earlier["Ada Lane"]["Playing Time: minutes"] == "1,200"


def test_profile(wide):
    numbered = wide.withColumn("row_no", F.monotonically_increasing_id())
    found = jobs.profile(numbered, "row_no")
    assert len(found.metrics) == 72
    assert found.ranked.where("metric = 'Playing Time: minutes' and side = 'top'").orderBy("rank").first()["entity"] == "bo Abe"
    stats = found.wide.where("grp = 'Reds'").first()
    assert stats["Median of Playing Time: minutes"] == 1200.0
    assert found.wide.where("is_all").first()["Mean of Playing Time: minutes"] == pytest.approx((1200 + 91 + 2000 + 901) / 4)
    assert found.key_report.count() == 8 and found.report.count() == 72
    charts = jobs.chart_tables(found.long.where("metric = 'Playing Time: minutes'"))
    assert charts["overall"].agg(F.sum("n")).first()[0] == 4 and charts["density"].count() == 200


def listing(players):
    rows = "".join(
        f'<tr><td class="td-player"><div class="text"><a href="/p/{i}">{n}</a></div><span class="sub-text d-none d-md-block">F (C)</span></td>'
        f'<td class="m-hide age">{a}</td><td class="td-team"><span class="td-team__teamname">{t}</span></td>'
        f'<td><div class="table-skill__skill">90.5</div><div class="table-skill__pot">91/100</div></td>'
        f'<td class="text-center"><span class="player-tag">{v}</span></td></tr>'
        for i, n, a, t, v in players
    )
    return f'<table><tbody id="player-table-body">{rows}</tbody></table>'


def test_transfer_values(spark, wide):
    listings = spark.createDataFrame(
        [(1, listing([(1, "Elan O", "24-1", "Reds", "€1.5M"), (2, "", "30", "X", "€1M"), (3, "Bo Ek", "25", "Blues", "€900K")])),
         (2, listing([(4, "bo Abe", "26", "Reds", "N/a"), (5, "Ada Lane", "27", "Reds", "€2,000K")]))],
        "page_id bigint, html string",
    )
    block = '<div class="d-col"><span class="txt">Highest ETV</span><span class="player-tag">€{}M</span></div>'
    details = spark.createDataFrame([(1, "/p/1", block.format(9)), (2, "/p/5", "<p>none</p>")], "page_id bigint, url string, html string")
    listed = jobs.listed_values(listings)
    assert [(r["ScrapeOrder"], r["Player"], r["ETV_Parsed"]) for r in listed.orderBy("ScrapeOrder").collect()] == [
        (1, "Elan O", 1.5), (2, "Bo Ek", 0.9), (3, "bo Abe", None), (4, "Ada Lane", None),
    ]
    early = jobs.estimation_table(listed, wide)
    assert early.columns == league.EARLIER_VALUE_COLUMNS
    assert [r["Player"] for r in early.collect()] == ["bo Abe", "Ada Lane"]
    assert early.first()["Skill"] == 90.5 and early.first()["Potential"] == 91.0
    nobody = jobs.estimation_table(listed, wide, min_minutes=1e9)
    assert nobody.count() == 0 and nobody.columns == league.EARLIER_VALUE_COLUMNS

    valued = jobs.valued_players(listings, details)
    rows = {r["Player"]: r for r in valued.collect()}
    assert rows["Elan O"]["Highest_ETV_EUR_Millions"] == 9.0 and rows["Elan O"]["Age"] == "24"
    assert rows["Ada Lane"]["TransferValue_EUR_Millions"] == rows["Ada Lane"]["Highest_ETV_EUR_Millions"] == 2.0
    kept = {r["Player"] for r in jobs.valued_eligible(valued, wide).collect()}
    assert kept == {"Elan O", "bo Abe", "Ada Lane"}
    table = jobs.training_table(wide, valued)
    assert {r["Player"] for r in table.collect()} == {"Elan O", "Bo Ek", "Ada Lane"}
    assert {"Team_x", "Team_y"} <= set(table.columns)


def test_clustering(spark):
    rng = random.Random(2)
    rows = [(f"p{i}", ["A", "B"][i % 2], f"20-{i % 5}", rng.gauss(20 * (i % 3), 1), "N/a" if i == 0 else str(rng.gauss(20 * (i % 3), 1)))
            for i in range(90)]
    df = spark.createDataFrame(rows, "Player string, Team string, Age string, m1 double, m2 string")
    found = jobs.cluster_entities(df, 3, k_range=(2, 3, 4), n_init=3, max_iter=20)
    assert found.elbow.count() == 3 and found.assigned.count() == 90
    assert found.points.columns == ["pca1", "pca2", "cluster", "Player"] and 0 < sum(found.explained) <= 1
    loose = jobs.cluster_entities(df, 3, rule="any", k_range=(), n_init=5, max_iter=20)
    truth = (F.substring("Player", 2, 9).cast("int") % 3).alias("truth")
    assert loose.elbow is None and loose.assigned.where("Player <> 'p0'").select(truth, "cluster").distinct().count() == 3
    slots = [len(c.preprocessor.stages[-1].getInputCols()) for c in (found, loose)]
    assert slots == [3, 4]  # the column with a sentinel text counts as a number only under the loose rule
    with pytest.raises(ValueError):
        jobs.cluster_entities(df, 90, k_range=(), n_init=1)


def test_valuation(spark, tmp_path):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        x1, x2 = rng.uniform(0, 3), rng.uniform(0, 3)
        y = float(F and __import__("math").expm1(0.8 * x1 + 0.4 * x2 + rng.gauss(0, 0.05)))
        rows.append((
            i, f"p{i}", None if rng.random() < 0.05 else x1, x2, None if rng.random() < 0.6 else 1.0,
            "N/a" if rng.random() < 0.2 else f"{x1 * 1000:,.1f}", "text" if rng.random() < 0.4 else "5",
            rng.choice("ABC") if i != 3 else "rare", y * 1.1, y,
        ))
    schema = ("id bigint, Player string, x1 double, x2 double, mostly_null double, texty string, mixed string, Position string, "
              "Highest_ETV_EUR_Millions double, TransferValue_EUR_Millions double")
    data = spark.createDataFrame(rows, schema)
    found = jobs.value_entities(data, "id", draws=2, folds=2, trees=(8, 12), parallelism=2)
    assert set(found.numeric) == {"x1", "x2", "texty"} and set(found.categories) == {"mixed", "Position"}
    metrics = found.metrics.first()
    assert metrics["r2"] > 0.3 and metrics["n"] == found.residuals.count()
    top = {r["feature"] for r in found.importance.limit(3).collect()}
    assert "x1" in top or "texty" in top
    found.save(str(tmp_path / "m"))
    preprocessor, model = jobs.Valuation.load(str(tmp_path / "m"))
    fresh = found.scored.drop("features", "predicted", "predicted_log")
    fresh = fresh.drop(*[c for c in fresh.columns if "__" in c and c != "target__log"])
    again = model.transform(preprocessor.transform(fresh))
    old = {r["id"]: r["predicted_log"] for r in found.scored.collect()}
    assert {r["id"]: r["predicted_log"] for r in again.collect()} == pytest.approx(old)


def test_command_line(spark, pages, tmp_path):
    from statquarry.__main__ import main
    from statquarry.sources.tables import read_table

    pages.write.parquet(str(tmp_path / "pages"))
    main(["collect", "--pages", str(tmp_path / "pages"), "--out", str(tmp_path / "a")], spark)
    main(["profile", "--wide", str(tmp_path / "a/results"), "--out", str(tmp_path / "b")], spark)
    table = read_table(spark, str(tmp_path / "b/results2"))
    rows = {r["Team"]: r for r in table.collect()}
    assert set(rows) == {"all", "Reds", "Blues"}
    assert rows["Reds"]["Median of Playing Time: minutes"] == "1200.000" and rows["Blues"]["Std of PrgC"] is None
    report = "\n".join(r[0] for r in spark.read.text(str(tmp_path / "b/top_3")).collect())
    assert "   bo Abe: 2000" in report
    assert spark.read.parquet(str(tmp_path / "b/charts/overall")).where("metric = 'Performance: assists'").count() == 15


def test_command_line_valuation_keeps_namesakes(spark, tmp_path):
    from statquarry.__main__ import main
    from statquarry.sources.tables import read_table, write_table

    rng = random.Random(4)
    players = [(f"p{i // 2}", "T", "MF", str(rng.randint(900, 3000)), str(i)) for i in range(60)]
    wide = spark.createDataFrame(players, "Player string, Team string, Position string, minutes string, goals string")
    values = spark.createDataFrame([(f"p{i}", "U", float(i + 1)) for i in range(30)], "Player string, Team string, TransferValue_EUR_Millions double")
    write_table(wide, str(tmp_path / "w"))
    write_table(values, str(tmp_path / "v"))
    main(["valuation", "--wide", str(tmp_path / "w"), "--values", str(tmp_path / "v"), "--draws", "1", "--trees", "3", "5",
          "--out", str(tmp_path / "o")], spark)
    scored = read_table(spark, str(tmp_path / "o/residuals"))
    assert scored.count() == int(read_table(spark, str(tmp_path / "o/metrics")).first()["n"])
