import pytest
from pyspark.sql import functions as F

from statquarry.functions import markup
from statquarry.sources import pages as ps

STATS = """<html><!-- <table id="stats"><tr><td>ghost</td></tr></table> --><body><table class="x" id="stats"><thead>
<tr><th scope="col">Player</th><th scope="col">Min</th></tr></thead><tbody>
<tr><th scope="row">1</th><td data-stat="player"><a href="/p/1">Jos&eacute; &amp; Co</a></td><td data-stat="minutes"> 1,234 </td>
<td data-stat="goals"></td></tr>
<tr class="thead"><th scope="col">Player</th><td data-stat="player">Player</td></tr>
<tr><td data-stat="player">Bob</td><td data-stat='minutes'>91</td></tr>
<tr><td data-stat="player">Bob</td><td data-stat="minutes">90</td><td data-stat="goals">3</td></tr>
</tbody></table><script>var s = "<table id='other'><tr></tr><tr></tr></table>";</script></body></html>"""
HEADER_ONLY = '<table id="stats"><tr><th scope="col">Player</th></tr></table>'

LISTING = """<table><tbody id="player-table-body">
<tr><td class="td-player big"><div class="text"><a href="/p/haaland">Erling <b>Haaland</b></a></div><span class="sub-text d-none d-md-block"> F (C) </span></td>
<td class="nationality"><span class="ficon" title="C&ocirc;te d&#39;Ivoire"></span></td><td class="m-hide age">24-100</td></tr>
<tr><td class="td-player-x"><div class="text"><a href="/p/none">Nobody</a></div></td><td class="age m-hide">30</td></tr>
<tr><td class="td-player"><div class="text"><a href="/p/2">Łukasz</a></div></td></tr></tbody></table>"""


@pytest.fixture
def pages(spark):
    rows = [(1, "u1", STATS), (2, "u2", HEADER_ONLY), (3, "u3", "<p>no table</p>"), (4, "u4", STATS.replace("Bob", "Zoë"))]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_valid_pages(pages):
    assert sorted(r["page_id"] for r in ps.valid_pages(pages, "table", "stats").collect()) == [1, 4]
    assert ps.valid_pages(pages, "table", "other").count() == 0


def test_table_rows(pages):
    rows = ps.table_rows(ps.table_blocks(pages.repartition(3), ["stats"]), "stats", ["player", "minutes", "goals", "absent"]).orderBy("row_no").collect()
    assert [tuple(r)[2:] for r in rows if r["page_id"] == 1] == [
        ("José & Co", "1,234", "", "N/a"), ("Bob", "91", "N/a", "N/a"), ("Bob", "90", "3", "N/a"),
    ]
    assert [r["page_id"] for r in rows] == [1, 1, 1, 4, 4, 4]


def test_first_table_of_an_id_counts(spark):
    table = '<table id="{}"><tr><th scope="col">P</th></tr>{}</table>'
    row = '<tr><td data-stat="player">{}</td></tr>'
    html = table.format("a", row.format("first")) + table.format("b", "") + table.format("a", row.format("second"))
    df = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    blocks = ps.table_blocks(df, ["a", "b"])
    assert [r["table_id"] for r in blocks.collect()] == ["a"]
    assert [r["player"] for r in ps.table_rows(blocks, "a", ["player"]).collect()] == ["first"]


def test_listing_rows(spark):
    df = spark.createDataFrame([(7, LISTING)], "page_id bigint, html string")
    texts = {
        "player": [("td", "td-player"), ("div", "text"), ("a", None)],
        "position": [("td", "td-player"), ("span", "sub-text d-none d-md-block")],
        "age": [("td", "m-hide age")],
    }
    attributes = {"nation": ([("td", "nationality"), ("span", "ficon")], "title"),
                  "url": ([("td", "td-player"), ("div", "text"), ("a", None)], "href")}
    rows = ps.listing_rows(df, "player-table-body", texts, attributes).orderBy("row_in_page").collect()
    got = [tuple(r)[2:] for r in ps.listing_rows(df, "player-table-body", {"player": texts["player"], "age": texts["age"]},
                                                attributes).orderBy("row_in_page").collect()]
    assert got == [
        ("ErlingHaaland", "24-100", "Côte d'Ivoire", "/p/haaland"), ("N/a", "30", "N/a", "N/a"), ("Łukasz", "N/a", "N/a", "/p/2"),
    ]
    assert len(rows) == 3


def test_scrape_order_is_gap_free(spark):
    rows = [(p, i, "" if (p + i) % 4 == 0 else f"n{p}-{i}") for p in (50, 3, 900, 7) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "page_id bigint, row_in_page bigint, name string").repartition(7)
    got = ps.in_scrape_order(df, "name").orderBy("scrape_order").collect()
    kept = sorted((p, i) for p, i, n in rows if n)
    assert [(r["page_id"], r["row_in_page"]) for r in got] == kept
    assert [r["scrape_order"] for r in got] == list(range(1, len(kept) + 1))


def test_labelled_value(spark):
    block = '<div class="d-col"><span class="txt">{}</span>{}</div>'
    tag = '<span class="player-tag x">{}</span>'
    rows = [
        (1, "a", block.format("Age", "") + block.format("Highest ETV:", tag.format(" €9M "))),
        (2, "b", block.format("Highest ETV", "") + block.format("Highest ETV", tag.format("€1M"))),
        (3, "c", "<div>nothing</div>"),
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = ps.labelled_value(df, "Highest ETV", ("div", "d-col"), ("span", "txt"), ("span", "player-tag"))
    assert {r["page_id"]: r["value"] for r in got.collect()} == {1: "€9M", 2: "€1M", 3: None}


def test_entities(column):
    texts = ["a &amp;lt; b", "&lt;&#60;&#x3C;&quot;&apos;", "R&D & co", "&unknown; &nbsp;", "&#128512;", None]
    assert column(texts, lambda c: markup.decode_entities(F.col(c))) == [
        "a &lt; b", "<<<\"'", "R&D & co", "&unknown; \xa0", "😀", None,
    ]
