"""Every operator as a named query over the given tables, with the SQL that checks it.

A query takes ``(spark, folder)``; its SQL runs on the same parquet tables.  Iterative models have no SQL and are
checked by invariants in the tests.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statquarry.functions import parsing
from statquarry.operators import boosting, cluster, distribution, joins, ordering, prepare, ranking, shape, stats, valuation
from statquarry.operators import neighbours as knn
from statquarry.plans import model_sql, views
from statquarry.plans.views import TEXT_COLUMNS, profile, profile_long, table, with_views
from statquarry.session import materialise, shared_path
from statquarry.sources import pages as page_source
from statquarry.sources import tables as sinks
from statquarry.sources.artefacts import Store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def rounded(df: DataFrame, *columns: str, places: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def on_grid(df: DataFrame, *columns: str) -> DataFrame:
    """Averages to the nearest 1/16384, the precision at which two engines are compared.

    The average of a few two-decimal numbers often lies exactly half-way between two four-decimal ones, where the last
    bit of a sum decides; it does not lie half-way on a binary grid.
    """
    return df.withColumns({c: F.round(F.col(c) * 16384.0) / 16384.0 for c in columns})


def _grid_sql(expression: str, name: str) -> str:
    return f"round({expression} * 16384.0) / 16384.0 AS {name}"


# ---- pages ------------------------------------------------------------------------------------------------------
_PLAIN = "replace(replace(regexp_replace({x}, '(?s)<[^>]*>', '', 'g'), '&quot;', '\"'), '&amp;', '&')"


def _plain(markup: str) -> str:
    """SQL text of simple markup: tags out, the two entities of the data decoded, outer space trimmed."""
    return r"regexp_replace(" + _PLAIN.format(x=markup) + r", '^\s+|\s+$', '', 'g')"


@query(
    "page_scan_valid",
    """SELECT page_id, CAST(len(regexp_extract_all(regexp_extract(html, '(?s)<ul>.*?</ul>'), '<li\\b')) AS INTEGER) AS n_rows
       FROM pages WHERE len(regexp_extract_all(regexp_extract(html, '(?s)<ul>.*?</ul>'), '<li\\b')) > 1""",
)
def page_scan_valid(spark: SparkSession, folder: str) -> DataFrame:
    return page_source.valid_pages(table(spark, folder, "pages"), "ul", row_tag="li").select("page_id", "n_rows")


_LINKS = """links AS (
    SELECT page_id, CAST(row_in_page AS BIGINT) AS row_in_page, regexp_extract(item, '(?s)>([^<]*)</a>', 1) AS text,
           regexp_extract(item, 'href="([^"]*)"', 1) AS href
    FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<li>.*?</li>')) AS item,
                 generate_subscripts(regexp_extract_all(html, '(?s)<li>.*?</li>'), 1) AS row_in_page FROM pages))"""


@query("html_rows", f"WITH {_LINKS} SELECT page_id, row_in_page, trim(text) AS text, href FROM links")
def html_rows(spark: SparkSession, folder: str) -> DataFrame:
    return page_source.link_rows(table(spark, folder, "pages"))


@query(
    "html_attrs",
    f"""SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
               regexp_extract(html, '<meta charset="([^"]*)"', 1) AS charset,
               {_plain("regexp_extract(html, '(?s)<h1>.*?</h1>')")} AS heading,
               {_plain("regexp_extract(html, '(?s)<div class=.ad.>.*?</div>')")} AS notice,
               'N/a' AS table_text, 'N/a' AS heading_title
        FROM pages""",
)
def html_attrs(spark: SparkSession, folder: str) -> DataFrame:
    return page_source.page_fields(
        table(spark, folder, "pages"),
        {
            "lang": ("html", None, "lang"),
            "charset": ("meta", None, "charset"),
            "heading": ("h1", None, None),
            "notice": ("div", "ad", None),
            "table_text": ("table", None, None),
            "heading_title": ("h1", None, "title"),
        },
    )


@query(
    "scrape_order",
    f"""WITH {_LINKS} SELECT page_id, row_in_page, text, row_number() OVER (ORDER BY page_id, row_in_page) AS scrape_order
        FROM links WHERE trim(text) NOT IN ('', 'N/a', 'the', 'de')""",
)
def scrape_order(spark: SparkSession, folder: str) -> DataFrame:
    links = page_source.link_rows(table(spark, folder, "pages"))
    return page_source.in_scrape_order(links, "text", ("", "N/a", "the", "de")).select(
        "page_id", "row_in_page", "text", "scrape_order"
    )


_LABELLED = f"""labelled AS (
    SELECT page_id, url, list_filter(list_transform(regexp_extract_all(html, '(?s)<p>.*?</p>'),
           lambda p: {_plain("p")}), lambda t: contains(t, 'ment'))[1] AS value FROM pages)"""


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return page_source.labelled_value(table(spark, folder, "pages"), "ment", ("p", None), None, None)


@query("labelled_value", f"WITH {_LABELLED} SELECT page_id, url, value FROM labelled")
def labelled_value(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(spark, folder)


@query(
    "detail_fallback",
    f"""WITH {_LABELLED} SELECT p.page_id, {_plain("regexp_extract(html, '(?s)<h1>.*?</h1>')")} AS heading,
               coalesce(value, {_plain("regexp_extract(html, '(?s)<h1>.*?</h1>')")}) AS value
        FROM pages p LEFT JOIN labelled l ON p.page_id = l.page_id""",
)
def detail_fallback(spark: SparkSession, folder: str) -> DataFrame:
    listing = page_source.page_fields(table(spark, folder, "pages"), {"heading": ("h1", None, None)})
    details = _labelled(spark, folder).select("page_id", "value")
    return joins.detail_fallback(listing, details, "page_id", "value", "heading")


# ---- text to numbers ----------------------------------------------------------------------------------------------
@query(
    "na_tokens",
    with_views("texts") + """SELECT o_orderkey,
        CASE WHEN trim(price_text) NOT IN ('N/a','n/a','NA','na','NaN','nan','') THEN price_text END AS price_text,
        CASE WHEN trim(share_text) NOT IN ('N/a','n/a','NA','na','NaN','nan','') THEN share_text END AS share_text,
        CASE WHEN trim(count_text) NOT IN ('N/a','n/a','NA','na','NaN','nan','') THEN count_text END AS count_text,
        nullif(price_text, 'N/a') AS without_sentinel
        FROM texts""",
)
def na_tokens(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.texts(spark, folder).select("o_orderkey", "price_text", "share_text", "count_text")
    bare = rows.withColumn("without_sentinel", parsing.unsentinel("price_text"))
    return bare.select("o_orderkey", *[parsing.null_tokens(c).alias(c) for c in rows.columns[1:]], "without_sentinel")


@query(
    "safe_int",
    with_views("texts") + r"""SELECT o_orderkey,
        coalesce(CASE WHEN regexp_matches(replace(count_text, ',', ''), '^[+-]?\d+$')
                      THEN try_cast(replace(count_text, ',', '') AS BIGINT) END, 0) AS n,
        coalesce(CASE WHEN regexp_matches(replace(price_text, ',', ''), '^[+-]?\d+$')
                      THEN try_cast(replace(price_text, ',', '') AS BIGINT) END, -1) AS n_price
        FROM texts""",
)
def safe_int(spark: SparkSession, folder: str) -> DataFrame:
    return views.texts(spark, folder).select(
        "o_orderkey", parsing.safe_int("count_text").alias("n"), parsing.safe_int("price_text", -1).alias("n_price")
    )


@query(
    "to_numeric",
    with_views("texts")
    + f"SELECT o_orderkey, {views.sql_num('price_text')} AS price, {views.sql_num('share_text')} AS share, "
    f"{views.sql_num('count_text')} AS n FROM texts",
)
def to_numeric(spark: SparkSession, folder: str) -> DataFrame:
    return views.texts(spark, folder).select(
        "o_orderkey",
        parsing.num("price_text").alias("price"),
        parsing.num("share_text").alias("share"),
        parsing.num("count_text").alias("n"),
    )


@query(
    "strip_commas",
    with_views("texts") + "SELECT o_orderkey, replace(price_text, ',', '') AS bare, "
    + views.sql_num("replace(price_text, ',', '')") + " AS price FROM texts",
)
def strip_commas(spark: SparkSession, folder: str) -> DataFrame:
    return views.texts(spark, folder).select(
        "o_orderkey", parsing.strip_commas("price_text").alias("bare"), parsing.clean_num("price_text").alias("price")
    )


@query(
    "strip_percent",
    with_views("texts") + "SELECT o_orderkey, replace(share_text, '%', '') AS bare, "
    + views.sql_num("replace(replace(share_text, '%', ''), ',', '')") + " AS share FROM texts",
)
def strip_percent(spark: SparkSession, folder: str) -> DataFrame:
    return views.texts(spark, folder).select(
        "o_orderkey",
        parsing.strip_percent("share_text").alias("bare"),
        parsing.clean_num(parsing.strip_percent("share_text")).alias("share"),
    )


@query(
    "clean_columns",
    with_views("profile") + """SELECT c_custkey, c_mktsegment, replace(order_text, ',', '') AS order_text,
        CAST(replace(format('{:,.2f}', max_order), ',', '') AS DOUBLE) AS max_text FROM profile""",
)
def clean_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = profile(spark, folder).select(
        "c_custkey", "c_mktsegment", "order_text", F.format_number("max_order", 2).alias("max_text")
    )
    return shape.clean_columns(rows, ["order_text", "max_text"])


@query("first_token", "SELECT p_partkey, split_part(p_name, ' ', 1) AS first FROM part")
def first_token(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select("p_partkey", parsing.first_token("p_name").alias("first"))


@query(
    "name_key",
    r"SELECT doc_id, regexp_replace(strip_accents(lower(text)), '^\s+|\s+$', '', 'g') AS name_key FROM documents",
)
def name_key(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", parsing.name_key("text").alias("name_key"))


_MONEY = """, bare AS (SELECT p_partkey, regexp_replace(lower(trim(money_text)), '[€£$ ]', '', 'g') AS t FROM prices),
    scaled AS (SELECT p_partkey, t, CASE WHEN contains(t, 'm') THEN 1e6 WHEN contains(t, 'k') THEN 1e3 ELSE 1.0 END AS f
               FROM bare)"""


@query(
    "money_parse_raw",
    with_views("prices") + _MONEY
    + f" SELECT p_partkey, {views.sql_num('''replace(replace(t, 'm', ''), 'k', '')''')} * f / 1e6 AS millions FROM scaled",
)
def money_parse_raw(spark: SparkSession, folder: str) -> DataFrame:
    return views.prices(spark, folder).select("p_partkey", parsing.money_raw("money_text").alias("millions"))


@query(
    "money_parse",
    with_views("prices") + _MONEY
    + f""", value AS (SELECT p_partkey, {views.sql_num("replace(replace(replace(t, ',', ''), 'm', ''), 'k', '')")} * f / 1e6
               AS v FROM scaled)
       SELECT p_partkey, CASE WHEN v IS NULL THEN NULL ELSE CAST(printf('%.2f', v) AS DOUBLE) END AS millions FROM value""",
)
def money_parse(spark: SparkSession, folder: str) -> DataFrame:
    return views.prices(spark, folder).select("p_partkey", parsing.money("money_text").alias("millions"))


@query(
    "score_parse",
    with_views("prices") + f"SELECT p_partkey, coalesce({views.sql_num('score_text')}, "
    + views.sql_num("split_part(score_text, '/', 1)") + ") AS score FROM prices",
)
def score_parse(spark: SparkSession, folder: str) -> DataFrame:
    return views.prices(spark, folder).select("p_partkey", parsing.score("score_text").alias("score"))


@query(
    "age_years",
    with_views("texts") + f"SELECT o_orderkey, {views.sql_num('''split_part(age_text, '-', 1)''')} AS age FROM texts",
)
def age_years(spark: SparkSession, folder: str) -> DataFrame:
    return views.texts(spark, folder).select("o_orderkey", parsing.age_years("age_text").alias("age"))


@query(
    "metric_slug",
    with_views("prices") + r"""SELECT p_partkey,
        left(regexp_replace(regexp_replace(replace(replace(regexp_replace(label, '[:/\\ ]', '_', 'g'), '%', 'Percent'),
             '.', '_dot_'), '_+', '_', 'g'), '^_|_$', '', 'g'), 100) AS slug,
        regexp_replace(replace(label, ' ', '_'), '[\\/*?:"<>|]', '', 'g') AS plain_slug FROM prices""",
)
def metric_slug(spark: SparkSession, folder: str) -> DataFrame:
    return views.prices(spark, folder).select(
        "p_partkey",
        parsing.metric_slug("label").alias("slug"),
        parsing.metric_slug_plain("label").alias("plain_slug"),
    )


@query(
    "fill_defaults",
    with_views("gaps") + """SELECT c_custkey, coalesce(segment, 'Missing') AS segment, coalesce(acctbal, 0) AS acctbal,
        coalesce(max_order, 0) AS max_order FROM gaps""",
)
def fill_defaults(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.gaps(spark, folder).select("c_custkey", "segment", "acctbal", "max_order")
    return shape.fill_defaults(rows, ["acctbal", "max_order"], ["segment"])


@query(
    "nan_to_num",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0.0 WHEN '2-HIGH' THEN 1.7976931348623157e308
              WHEN '3-MEDIUM' THEN -1.7976931348623157e308 ELSE o_totalprice END AS repaired FROM orders""",
)
def nan_to_num(spark: SparkSession, folder: str) -> DataFrame:
    level = F.col("o_orderpriority")
    broken = (
        F.when(level == "1-URGENT", F.lit(float("nan")))
        .when(level == "2-HIGH", F.lit(float("inf")))
        .when(level == "3-MEDIUM", F.lit(float("-inf")))
        .otherwise(F.col("o_totalprice"))
    )
    return table(spark, folder, "orders").select("o_orderkey", parsing.nan_to_num(broken).alias("repaired"))


@query(
    "log_target",
    "SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS log_value, round(o_totalprice, 4) AS back FROM orders",
)
def log_target(spark: SparkSession, folder: str) -> DataFrame:
    rows = prepare.log_target(table(spark, folder, "orders"), "o_totalprice", "log_value")
    return rows.select(
        "o_orderkey",
        F.round("log_value", 6).alias("log_value"),
        F.round(valuation.back_to_scale(F.col("log_value")), 4).alias("back"),
    )


@query("clamp_zero", "SELECT c_custkey, greatest(c_acctbal, 0.0) AS clamped FROM customer")
def clamp_zero(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select("c_custkey", parsing.clamp_zero("c_acctbal").alias("clamped"))


# ---- projection, filters, discovery ---------------------------------------------------------------------------------
@query(
    "export_projection",
    with_views("gaps") + """SELECT c_name AS Player, coalesce(segment, 'N/a') AS Team, coalesce(CAST(CAST(n_orders AS BIGINT) AS VARCHAR), 'N/a')
        AS "Performance: count", coalesce(CAST(CAST(n_orders AS BIGINT) AS VARCHAR), 'N/a') AS "Passing: count", 'N/a' AS "Never fetched"
        FROM gaps""",
)
def export_projection(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.gaps(spark, folder).withColumn("n_orders", F.col("n_orders").cast("bigint"))
    fields = [
        ("Player", "c_name"), ("Team", "segment"), ("Performance: count", "n_orders"), ("Passing: count", "n_orders"),
        ("Never fetched", "absent_field"),
    ]
    return shape.export_projection(rows, fields)


@query(
    "drop_placeholders",
    with_views("texts") + "SELECT o_orderkey, count_text FROM texts WHERE count_text NOT IN ('', 'Player', 'N/a')",
)
def drop_placeholders(spark: SparkSession, folder: str) -> DataFrame:
    return shape.drop_placeholders(views.texts(spark, folder), "count_text").select("o_orderkey", "count_text")


@query(
    "min_threshold",
    with_views("texts") + r"""SELECT o_orderkey, count_text FROM texts
        WHERE regexp_matches(replace(count_text, ',', ''), '^\d+$')
          AND try_cast(replace(count_text, ',', '') AS BIGINT) > 90007""",
)
def min_threshold(spark: SparkSession, folder: str) -> DataFrame:
    rows = shape.min_threshold(views.texts(spark, folder), "count_text", 90_007)
    return rows.select("o_orderkey", "count_text")


def _eligible_sql(sign: str) -> str:
    value = views.sql_num("replace(order_text, ',', '')")
    return with_views("profile") + f"""SELECT c_custkey, c_name FROM profile
        WHERE {value} {sign} (SELECT max(order_value) / 2 FROM profile WHERE c_mktsegment <> 'MACHINERY')"""


def _eligible(spark: SparkSession, folder: str, inclusive: bool) -> DataFrame:
    rows = profile(spark, folder)
    half = rows.where("c_mktsegment <> 'MACHINERY'").agg((F.max("order_value") / 2).alias("half")).first()["half"]
    return shape.eligible(rows, "order_text", half, inclusive).select("c_custkey", "c_name")


@query("eligible_ge", _eligible_sql(">="))
def eligible_ge(spark: SparkSession, folder: str) -> DataFrame:
    return _eligible(spark, folder, inclusive=True)


@query("eligible_gt", _eligible_sql(">"))
def eligible_gt(spark: SparkSession, folder: str) -> DataFrame:
    return _eligible(spark, folder, inclusive=False)


@query(
    "dropna_subset",
    with_views("gaps") + "SELECT c_custkey, segment, acctbal FROM gaps WHERE segment IS NOT NULL AND acctbal IS NOT NULL",
)
def dropna_subset(spark: SparkSession, folder: str) -> DataFrame:
    return views.gaps(spark, folder).select("c_custkey", "segment", "acctbal").na.drop(subset=["segment", "acctbal"])


@query(
    "rename_select",
    with_views("profile") + 'SELECT c_name AS "Player", n_name AS "Team_TransferSite", c_acctbal AS "Value" FROM profile',
)
def rename_select(spark: SparkSession, folder: str) -> DataFrame:
    renames = {"c_name": "Player", "n_name": "Team_TransferSite", "c_acctbal": "Value"}
    return shape.rename_select(profile(spark, folder), renames, ["Player", "Team_TransferSite", "Value", "Absent"])


@query("empty_with_schema", with_views("profile") + "SELECT c_name, n_name, n_orders FROM profile WHERE n_orders < 0")
def empty_with_schema(spark: SparkSession, folder: str) -> DataFrame:
    return profile(spark, folder).where("n_orders < 0").select("c_name", "n_name", "n_orders")


@query(
    "union_aligned",
    """SELECT s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier UNION ALL
       SELECT c_name, c_acctbal, c_mktsegment FROM customer""",
)
def union_aligned(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    customers = table(spark, folder, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    return shape.union_aligned(suppliers, customers)


def _profile_sql(select: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS n_present, "
        f"count({views.sql_num(f'''replace({c}, ',', '')''')}) AS n_numeric FROM clean"
        for c in TEXT_COLUMNS
    )
    tokens = ", ".join(
        f"CASE WHEN trim({c}) NOT IN ('N/a','n/a','NA','na','NaN','nan','') THEN {c} END AS {c}" for c in TEXT_COLUMNS
    )
    return with_views("texts") + f", clean AS (SELECT {tokens} FROM texts), counts AS ({parts}) {select}"


def _clean_texts(spark: SparkSession, folder: str) -> DataFrame:
    return shape.null_missing(views.texts(spark, folder))


def _rules(spark: SparkSession, folder: str, rule: str) -> DataFrame:
    found = shape.metric_rules(shape.column_profile(_clean_texts(spark, folder), TEXT_COLUMNS))
    return found.where(F.col(rule)).select("column", "n_present", "n_numeric")


@query("metric_discovery_any", _profile_sql('SELECT "column", n_present, n_numeric FROM counts WHERE n_numeric > 0'))
def metric_discovery_any(spark: SparkSession, folder: str) -> DataFrame:
    return _rules(spark, folder, "any")


@query(
    "metric_discovery_strict",
    _profile_sql('SELECT "column", n_present, n_numeric FROM counts WHERE n_numeric = n_present'),
)
def metric_discovery_strict(spark: SparkSession, folder: str) -> DataFrame:
    return _rules(spark, folder, "strict")


@query(
    "metric_discovery_ratio",
    _profile_sql('SELECT "column", n_present, n_numeric FROM counts WHERE n_numeric / n_rows > 0.7'),
)
def metric_discovery_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return _rules(spark, folder, "ratio")


@query(
    "metric_coerce_all",
    with_views("texts") + f"""SELECT o_orderkey, {views.sql_num("replace(price_text, ',', '')")} AS price_text,
        {views.sql_num("replace(replace(share_text, '%', ''), ',', '')")} AS "share%", CAST(NULL AS DOUBLE) AS o_orderpriority
        FROM texts""",
)
def metric_coerce_all(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.texts(spark, folder).withColumnRenamed("share_text", "share%")
    rows = rows.select("o_orderkey", "price_text", "share%", "o_orderpriority")
    return shape.coerce_all(rows, ["price_text", "share%", "o_orderpriority"])


_GAP_COLUMNS = ["segment", "acctbal", "max_order", "n_orders", "nothing"]
_GAP_COUNTS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS n_present FROM gaps" for c in _GAP_COLUMNS
)


@query(
    "null_profile",
    with_views("gaps") + f"""SELECT "column", n_rows, n_rows - n_present AS n_null,
        round((n_rows - n_present) / n_rows, 6) AS null_ratio, n_present = 0 AS all_null FROM ({_GAP_COUNTS})""",
)
def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    found = shape.column_profile(views.gaps(spark, folder), _GAP_COLUMNS)
    return rounded(found.select("column", "n_rows", "n_null", "null_ratio", "all_null"), "null_ratio", places=6)


@query(
    "null_ratio_columns",
    with_views("gaps") + f"""SELECT "column", round((n_rows - n_present) / n_rows, 6) AS null_ratio FROM ({_GAP_COUNTS})
        WHERE (n_rows - n_present) / n_rows > 0.3""",
)
def null_ratio_columns(spark: SparkSession, folder: str) -> DataFrame:
    found = shape.column_profile(views.gaps(spark, folder), _GAP_COLUMNS).where(F.col("null_ratio") > 0.3)
    return rounded(found.select("column", "null_ratio"), "null_ratio", places=6)


@query(
    "metric_cardinality",
    with_views("lines_long") + """SELECT metric, count(DISTINCT value) AS n_distinct, min(value) = max(value) AS is_constant
        FROM lines_long GROUP BY metric""",
)
def metric_cardinality(spark: SparkSession, folder: str) -> DataFrame:
    return shape.metric_cardinality(views.lines_long(spark, folder))


@query(
    "category_sample",
    """WITH seen AS (SELECT 'p_name' AS "column", p_name AS value, min(p_partkey) AS first FROM part GROUP BY p_name
                     UNION ALL SELECT 'p_brand', p_brand, min(p_partkey) FROM part GROUP BY p_brand),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY first, value) AS r FROM seen)
       SELECT "column", string_agg(value, '|' ORDER BY r) AS sample FROM ranked WHERE r <= 10 GROUP BY "column" """,
)
def category_sample(spark: SparkSession, folder: str) -> DataFrame:
    found = shape.category_sample(table(spark, folder, "part"), ["p_name", "p_brand"], "p_partkey")
    return found.select("column", F.array_join("sample", "|").alias("sample"))


@query(
    "stage_counts",
    with_views("texts") + r"""SELECT 'seen' AS stage, count(*) AS n_rows FROM texts
        UNION ALL SELECT 'priced', count(*) FROM texts WHERE price_text <> 'N/a'
        UNION ALL SELECT 'counted', count(*) FROM texts WHERE regexp_matches(replace(count_text, ',', ''), '^\d+$')""",
)
def stage_counts(spark: SparkSession, folder: str) -> DataFrame:
    return shape.stage_counts(
        views.texts(spark, folder),
        {
            "seen": F.lit(True),
            "priced": F.col("price_text") != "N/a",
            "counted": parsing.safe_int("count_text") > 0,
        },
    )


# ---- joins --------------------------------------------------------------------------------------------------------
def _order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as detail rows of an order; the order key repeats, ``row_no`` is a total order within it."""
    lines = table(spark, folder, "lineitem")
    return lines.select(
        "l_orderkey",
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("row_no"),
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("state"),
        F.col("l_extendedprice").alias("price"),
    ).withColumnRenamed("l_orderkey", "o_orderkey")


_LAST_LINE = """last_line AS (SELECT * FROM (SELECT l_orderkey, l_returnflag, l_extendedprice, row_number() OVER
    (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS r
    FROM lineitem) WHERE r = 1)"""


@query(
    "update_join",
    f"""WITH {_LAST_LINE},
        big AS (SELECT * FROM (SELECT l_orderkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS r
            FROM lineitem WHERE l_quantity > 25) WHERE r = 1)
        SELECT o_orderkey, CASE WHEN l.l_orderkey IS NULL THEN o_orderstatus WHEN l_returnflag = 'A' THEN 'N/a'
                    ELSE l_returnflag END AS state,
               CASE WHEN l.l_orderkey IS NULL THEN o_totalprice ELSE l_extendedprice END AS price,
               CASE WHEN b.l_orderkey IS NOT NULL THEN b.l_quantity END AS quantity
        FROM orders LEFT JOIN last_line l ON o_orderkey = l.l_orderkey LEFT JOIN big b ON o_orderkey = b.l_orderkey""",
)
def update_join(spark: SparkSession, folder: str) -> DataFrame:
    base = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("state"), F.col("o_totalprice").alias("price")
    )
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("row_no")
    big = table(spark, folder, "lineitem").where("l_quantity > 25").select(
        F.col("l_orderkey").alias("o_orderkey"), order, F.col("l_quantity").alias("quantity")
    )
    return joins.update_join(
        base, [(_order_lines(spark, folder), ["state", "price"]), (big, ["quantity"])], "o_orderkey"
    )


@query(
    "update_join_last_wins",
    """WITH cheap AS (SELECT * FROM (SELECT o_custkey, o_orderpriority, o_orderstatus, row_number() OVER
            (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders WHERE o_totalprice < 200000) WHERE r = 1),
        late AS (SELECT * FROM (SELECT o_custkey, o_orderstatus, row_number() OVER
            (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders WHERE o_totalprice > 300000) WHERE r = 1)
       SELECT c_custkey, coalesce(cheap.o_orderpriority, 'none') AS priority,
              coalesce(late.o_orderstatus, cheap.o_orderstatus, 'none') AS status
       FROM customer LEFT JOIN cheap ON c_custkey = cheap.o_custkey LEFT JOIN late ON c_custkey = late.o_custkey""",
)
def update_join_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    base = table(spark, folder, "customer").select("c_custkey", F.lit("none").alias("priority"), F.lit("none").alias("status"))
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("row_no"), "o_totalprice",
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"),
    )
    cheap, late = orders.where("o_totalprice < 200000"), orders.where("o_totalprice > 300000")
    return joins.update_join(base, [(cheap, ["priority", "status"]), (late, ["status"])], "c_custkey")


@query(
    "right_join_suffix",
    """SELECT c.c_nationkey AS "key", c.c_name AS name_y, c.c_acctbal AS balance_y, n.n_name AS name_x, n.n_regionkey AS region
       FROM (SELECT * FROM nation WHERE n_regionkey <> 2) n RIGHT JOIN customer c ON n.n_nationkey = c.c_nationkey""",
)
def right_join_suffix(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").where("n_regionkey <> 2").select(
        F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    joined = joins.right_join_suffix(nations.withColumn("balance", F.lit(None).cast("double")), customers, "key")
    return joined.drop("balance_x")


_RICH = """rich AS (SELECT DISTINCT trim(c_name) AS c_name FROM customer WHERE c_acctbal > 5000)"""


@query(
    "semi_join_exact",
    with_views("profile") + f", {_RICH} SELECT c_custkey, c_name, n_orders FROM profile WHERE trim(c_name) IN (SELECT c_name FROM rich)",
)
def semi_join_exact(spark: SparkSession, folder: str) -> DataFrame:
    padded = table(spark, folder, "customer").where("c_acctbal > 5000").select(F.concat(F.lit(" "), "c_name").alias("c_name"))
    return joins.semi_join_exact(profile(spark, folder), padded, "c_name").select("c_custkey", "c_name", "n_orders")


_WORDS = r"""words AS (SELECT doc_id, lang, split_part(text, ' ', 1) AS word FROM documents),
    allowed AS (SELECT DISTINCT regexp_replace(strip_accents(lower(word)), '^\s+|\s+$', '', 'g') AS k FROM words WHERE lang = 'fr')"""


@query(
    "semi_join_namekey",
    f"""WITH {_WORDS} SELECT doc_id, word FROM words WHERE lang <> 'fr'
        AND regexp_replace(strip_accents(lower(word)), '^\\s+|\\s+$', '', 'g') IN (SELECT k FROM allowed WHERE k <> '')""",
)
def semi_join_namekey(spark: SparkSession, folder: str) -> DataFrame:
    words = table(spark, folder, "documents").select("doc_id", "lang", parsing.first_token("text").alias("word"))
    matched = joins.semi_join_namekey(words.where("lang <> 'fr'"), words.where("lang = 'fr'"), "word")
    return matched.select("doc_id", "word")


@query("distinct_keys", "SELECT DISTINCT trim(p_name) AS p_name FROM part")
def distinct_keys(spark: SparkSession, folder: str) -> DataFrame:
    return joins.distinct_keys(table(spark, folder, "part"), "p_name")


# ---- statistics and leader boards -----------------------------------------------------------------------------------
_STATS = ", ".join(
    [_grid_sql("median(value)", "median"), _grid_sql("avg(value)", "mean"), _grid_sql("stddev_samp(value)", "std")]
) + ", count(value) AS n"


@query("overall_stats", with_views("lines_long") + f"SELECT metric, {_STATS} FROM lines_long GROUP BY metric")
def overall_stats(spark: SparkSession, folder: str) -> DataFrame:
    return on_grid(stats.overall_stats(views.lines_long(spark, folder)), "median", "mean", "std")


@query("group_stats", with_views("lines_long") + f"SELECT metric, grp, {_STATS} FROM lines_long GROUP BY metric, grp")
def group_stats(spark: SparkSession, folder: str) -> DataFrame:
    return on_grid(stats.group_stats(views.lines_long(spark, folder)), "median", "mean", "std")


_WITH_ALL = f"""SELECT true AS is_all, 'all' AS grp, metric, {_STATS} FROM profile_long GROUP BY metric
    UNION ALL SELECT false, grp, metric, {_STATS} FROM profile_long WHERE grp IS NOT NULL GROUP BY metric, grp"""


@query("stats_with_all", with_views("profile_long") + _WITH_ALL)
def stats_with_all(spark: SparkSession, folder: str) -> DataFrame:
    return on_grid(stats.stats_with_all(profile_long(spark, folder)), "median", "mean", "std")


@query(
    "stats_wide",
    with_views("profile_long") + f", s AS ({_WITH_ALL}) SELECT is_all, grp, "
    + ", ".join(
        f"max(CASE WHEN metric = '{m}' THEN {s} END) AS \"{s.capitalize()} of {m}\""
        for m in views.PROFILE_METRICS for s in ("median", "mean", "std")
    )
    + " FROM s GROUP BY is_all, grp",
)
def stats_wide(spark: SparkSession, folder: str) -> DataFrame:
    return stats.stats_wide(stats_with_all(spark, folder), views.PROFILE_METRICS)


def _leaders_sql(order: str) -> str:
    return with_views("profile_long") + f""", means AS (SELECT metric, grp, avg(value) AS mean FROM profile_long
        WHERE grp IS NOT NULL GROUP BY metric, grp),
        best AS (SELECT metric, grp, mean FROM (SELECT *, row_number() OVER (PARTITION BY metric
                 ORDER BY mean {order} NULLS LAST, grp) AS r FROM means) WHERE r = 1)"""


def _leaders(spark: SparkSession, folder: str) -> DataFrame:
    return stats.leaders(stats.group_means(profile_long(spark, folder)))


@query("group_leaders", _leaders_sql("DESC") + f" SELECT metric, grp, {_grid_sql('mean', 'mean')} FROM best")
def group_leaders(spark: SparkSession, folder: str) -> DataFrame:
    return on_grid(_leaders(spark, folder), "mean")


@query("group_leaders_low", _leaders_sql("ASC") + f" SELECT metric, grp, {_grid_sql('mean', 'mean')} FROM best")
def group_leaders_low(spark: SparkSession, folder: str) -> DataFrame:
    means = stats.group_means(profile_long(spark, folder))
    return on_grid(stats.leaders(means, lowest_wins=views.PROFILE_METRICS), "mean")


@query(
    "leader_text",
    _leaders_sql("DESC") + """ SELECT metric, printf('%s (%.2f)', grp, mean) AS leader,
        split_part(printf('%s (%.2f)', grp, mean), ' (', 1) AS leader_group, printf('%.2f', mean) AS mean_text FROM best""",
)
def leader_text(spark: SparkSession, folder: str) -> DataFrame:
    best = _leaders(spark, folder)
    texts = stats.leader_texts(best).withColumn("leader_group", parsing.leader_group("leader"))
    return texts.join(best.select("metric", parsing.fixed("mean").alias("mean_text")), "metric")


@query(
    "leader_counts",
    _leaders_sql("DESC") + " SELECT grp, count(*) AS times_leading FROM best WHERE grp IS NOT NULL GROUP BY grp",
)
def leader_counts(spark: SparkSession, folder: str) -> DataFrame:
    return stats.leader_counts(_leaders(spark, folder))


@query(
    "top_group",
    _leaders_sql("DESC") + """ SELECT grp, count(*) AS times_leading FROM best WHERE grp IS NOT NULL GROUP BY grp
        ORDER BY times_leading DESC, grp LIMIT 1""",
)
def top_group(spark: SparkSession, folder: str) -> DataFrame:
    return stats.top_group(_leaders(spark, folder))


@query(
    "key_metric_report",
    with_views("profile_long") + """, means AS (SELECT metric, grp, avg(value) AS mean FROM profile_long GROUP BY metric, grp),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY
                   CASE WHEN metric = 'c_acctbal' THEN -mean ELSE mean END DESC NULLS LAST, grp) AS r FROM means),
        wanted AS (SELECT * FROM (VALUES (1, 'order_value', 'highest'), (2, 'c_acctbal', 'lowest'),
                   (3, 'not_there', 'highest')) AS t(position, metric, side))
        SELECT position, w.metric, side, grp, round(mean * 16384.0) / 16384.0 AS mean,
               CASE WHEN r IS NULL THEN 'missing' ELSE 'ok' END AS status
        FROM wanted w LEFT JOIN (SELECT * FROM ranked WHERE r = 1) b ON w.metric = b.metric""",
)
def key_metric_report(spark: SparkSession, folder: str) -> DataFrame:
    means = stats.group_means(profile_long(spark, folder))
    report = stats.key_metric_report(means, ["order_value", "c_acctbal", "not_there"], ["c_acctbal"])
    return on_grid(report, "mean")


# ---- rankings -------------------------------------------------------------------------------------------------------
def _ranked_sql(order: str, side: str) -> str:
    return f"""SELECT metric, '{side}' AS side, CAST(r AS INTEGER) AS rank, entity, value, false AS is_constant FROM (
        SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value {order}, entity, row_no) AS r
        FROM profile_long WHERE value IS NOT NULL) WHERE r <= 3"""


@query("topk_per_metric", with_views("profile_long") + _ranked_sql("DESC", "top"))
def topk_per_metric(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.ranked_entities(profile_long(spark, folder), 3, "top")


@query("bottomk_per_metric", with_views("profile_long") + _ranked_sql("ASC", "bottom"))
def bottomk_per_metric(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.ranked_entities(profile_long(spark, folder), 3, "bottom")


@query(
    "topk_constant_metric",
    with_views("profile_long") + """SELECT 'same' AS metric, s.side, CAST(r AS INTEGER) AS rank, c_name AS entity, 7.0 AS value,
        true AS is_constant FROM (SELECT c_name, row_number() OVER (ORDER BY c_custkey) AS r FROM customer
        WHERE c_nationkey IN (SELECT n_nationkey FROM nation)) CROSS JOIN (VALUES ('top'), ('bottom')) AS s(side) WHERE r <= 3""",
)
def topk_constant_metric(spark: SparkSession, folder: str) -> DataFrame:
    same = profile_long(spark, folder).where("metric = 'n_orders'").withColumns(
        {"metric": F.lit("same"), "value": F.lit(7.0)}
    )
    return ranking.top_and_bottom(same, 3)


@query(
    "topk_report_text",
    with_views("profile_long") + f""", ranked AS ({_ranked_sql("DESC", "top")} UNION ALL {_ranked_sql("ASC", "bottom")}),
        lines AS (SELECT metric, side, rank, '   ' || entity || ': ' || CASE WHEN metric = 'n_orders'
                  THEN CAST(CAST(value AS BIGINT) AS VARCHAR) ELSE CAST(value AS VARCHAR) END AS line FROM ranked)
        SELECT metric, 'Metric: ' || metric || chr(10) || 'Highest 3 entities:' || chr(10)
            || string_agg(line, chr(10) ORDER BY rank) FILTER (side = 'top') || chr(10)
            || 'Lowest 3 entities:' || chr(10)
            || string_agg(line, chr(10) ORDER BY rank) FILTER (side = 'bottom') || chr(10) AS block
        FROM lines GROUP BY metric""",
)
def topk_report_text(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.topk_report(profile_long(spark, folder), 3, ["n_orders"])


@query(
    "sort_first_name",
    "SELECT p_partkey, p_name, lower(split_part(p_name, ' ', 1)) AS first_name FROM part ORDER BY first_name, p_partkey",
)
def sort_first_name(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select(
        "p_partkey", "p_name", F.lower(parsing.first_token("p_name")).alias("first_name")
    )
    return ordering.sort_by_first_name(rows, "p_name", "p_partkey")


# ---- distributions ----------------------------------------------------------------------------------------------------
def _chart_long(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return orders.select(
        F.col("o_orderkey").alias("entity"), F.col("o_orderpriority").alias("grp"), F.lit("price").alias("metric"),
        price.alias("value"),
    ).unionByName(
        table(spark, folder, "lineitem").select(
            F.col("l_orderkey").alias("entity"), F.col("l_returnflag").alias("grp"), F.lit("quantity").alias("metric"),
            F.col("l_quantity").alias("value"),
        )
    )


_CHART = """WITH chart AS (
    SELECT o_orderpriority AS grp, 'price' AS metric, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice ELSE 0.0 END AS value
    FROM orders UNION ALL SELECT l_returnflag, 'quantity', l_quantity FROM lineitem)"""


def _bins_sql(keys: str, bounds: str) -> str:
    match = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    chosen = ", ".join(f"b.{k}" for k in keys.split(", "))
    return f"""{_CHART}, bounds AS ({bounds}),
        counts AS (SELECT {chosen}, least(floor((value - lo) / ((hi - lo) / bins)) + 1, bins) AS bin, count(*) AS n
                   FROM chart a JOIN bounds b ON {match} GROUP BY ALL),
        spine AS (SELECT *, unnest(range(1, bins + 1)) AS bin FROM bounds)
        SELECT {chosen}, CAST(b.bin AS INTEGER) AS bin, round(lo + (b.bin - 1) * ((hi - lo) / bins), 4) AS bin_from,
               round(lo + b.bin * ((hi - lo) / bins), 4) AS bin_to, coalesce(n, 0) AS n
        FROM spine b LEFT JOIN counts a ON {match} AND a.bin = b.bin"""


@query(
    "histogram_fixed",
    _bins_sql("metric", "SELECT metric, min(value) AS lo, max(value) AS hi, 15 AS bins FROM chart GROUP BY metric"),
)
def histogram_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(distribution.histogram_fixed(_chart_long(spark, folder)), "bin_from", "bin_to")


@query(
    "histogram_by_group",
    _bins_sql("metric, grp", "SELECT metric, grp, min(value) AS lo, max(value) AS hi, 15 AS bins FROM chart GROUP BY metric, grp"),
)
def histogram_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(distribution.histogram_by_group(_chart_long(spark, folder)), "bin_from", "bin_to")


@query(
    "histogram_auto",
    _bins_sql(
        "metric",
        """SELECT metric, lo, hi, CAST(greatest(ceil((hi - lo) / CASE WHEN metric = 'quantity' THEN greatest(w, 1.0) ELSE w END), 1)
           AS INTEGER) AS bins FROM (
           SELECT metric, min(value) AS lo, max(value) AS hi, CASE WHEN quantile_cont(value, 0.75) > quantile_cont(value, 0.25)
             THEN least(2.0 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / pow(count(*), 1.0 / 3),
                        (max(value) - min(value)) / (log2(count(*)) + 1))
             ELSE (max(value) - min(value)) / (log2(count(*)) + 1) END AS w FROM chart GROUP BY metric)""",
    ),
)
def histogram_auto(spark: SparkSession, folder: str) -> DataFrame:
    found = distribution.histogram_auto(_chart_long(spark, folder), integer_metrics=["quantity"])
    return rounded(found, "bin_from", "bin_to")


@query(
    "kde_curve",
    f"""{_CHART}, facts AS (SELECT metric, min(value) AS lo, max(value) AS hi,
            stddev_samp(value) * pow(count(*), -0.2) AS h FROM chart GROUP BY metric),
        spine AS (SELECT *, lo + i * ((hi - lo) / 199) AS x FROM facts, (SELECT unnest(range(0, 200)) AS i)),
        counted AS (SELECT metric, value, count(*) AS c FROM chart GROUP BY metric, value)
        SELECT s.metric, CAST(i AS INTEGER) AS point, round(x, 4) AS x,
               round(sum(c * exp(-0.5 * pow((x - value) / h, 2))) / (h * sqrt(2 * pi())) * ((hi - lo) / 15), 4) AS density
        FROM spine s JOIN counted c ON s.metric = c.metric GROUP BY s.metric, i, x, h, lo, hi""",
)
def kde_curve(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(distribution.kde_curve(_chart_long(spark, folder)), "x", "density")


# ---- preparation --------------------------------------------------------------------------------------------------------
@query(
    "impute_mean",
    with_views("gaps") + """SELECT c_custkey, round(coalesce(acctbal, avg(acctbal) OVER ()) * 16384.0) / 16384.0 AS acctbal,
        round(coalesce(max_order, avg(max_order) OVER ()) * 16384.0) / 16384.0 AS max_order FROM gaps""",
)
def impute_mean(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.gaps(spark, folder).select("c_custkey", "acctbal", "max_order", "nothing")
    return on_grid(prepare.impute_mean(rows, ["acctbal", "max_order", "nothing"]), "acctbal", "max_order")


@query(
    "impute_mode",
    with_views("gaps") + """SELECT c_custkey, coalesce(segment, (SELECT segment FROM gaps WHERE segment IS NOT NULL
        GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)) AS segment, n_name FROM gaps""",
)
def impute_mode(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.gaps(spark, folder).select("c_custkey", "segment", "n_name")
    return prepare.impute_mode(rows, ["segment", "n_name"])


_KNN_FEATURES = ["acctbal", "max_order", "n_orders", "order_value"]


def _knn_sql() -> str:
    diffs = {f: f"(r.{f} - d.{f}) * (r.{f} - d.{f})" for f in _KNN_FEATURES}
    shared = " + ".join(f"CAST({e} IS NOT NULL AS INTEGER)" for e in diffs.values())
    total = " + ".join(f"coalesce({e}, 0.0)" for e in diffs.values())
    parts = ", ".join(
        f"""near_{t} AS (SELECT rid, avg(v) AS v FROM (SELECT r.c_custkey AS rid, d.{t} AS v, row_number() OVER (
            PARTITION BY r.c_custkey ORDER BY sqrt(4.0 / ({shared}) * ({total})), d.c_custkey) AS rank
            FROM gaps r JOIN gaps d ON r.{t} IS NULL AND d.{t} IS NOT NULL AND ({shared}) > 0) WHERE rank <= 5 GROUP BY rid)"""
        for t in _KNN_FEATURES
    )
    filled = ", ".join(f"round(coalesce(g.{t}, near_{t}.v, avg(g.{t}) OVER ()), 4) AS {t}" for t in _KNN_FEATURES)
    joined = " ".join(f"LEFT JOIN near_{t} ON near_{t}.rid = g.c_custkey" for t in _KNN_FEATURES)
    return with_views("gaps") + f", {parts} SELECT c_custkey, {filled} FROM gaps g {joined}"


@query("knn_impute", _knn_sql())
def knn_impute(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.gaps(spark, folder).select("c_custkey", *_KNN_FEATURES)
    return rounded(knn.knn_impute(rows, _KNN_FEATURES, "c_custkey"), *_KNN_FEATURES)


@query(
    "standardize",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 4) AS l_quantity,
              round((l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER (), 4) AS l_extendedprice,
              0.0 AS same
       FROM lineitem""",
)
def standardize(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", F.lit(3.0).alias("same")
    )
    scaled = prepare.standardize(rows, ["l_quantity", "l_extendedprice", "same"])
    return rounded(scaled, "l_quantity", "l_extendedprice", "same")


@query(
    "one_hot",
    "SELECT o_orderkey, " + ", ".join(
        f"CAST(o_orderpriority = '{p}' AS INTEGER) AS level_{i}"
        for i, p in enumerate(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])
    ) + " FROM orders",
)
def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    model = prepare.feature_pipeline(rows, [], ["o_orderpriority"])
    names = prepare.feature_names(model, [], ["o_orderpriority"])
    parts = vector_to_array("features")
    return model.transform(rows).select(
        "o_orderkey", *[F.get(parts, F.lit(i)).cast("int").alias(f"level_{i}") for i in range(len(names))]
    )


# ---- clustering -------------------------------------------------------------------------------------------------------------
def _points(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return vectors.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


@query(
    "kmeans_elbow",
    "WITH RECURSIVE" + model_sql.kmeans(range(3, 16), 1, 30)
    + " SELECT CAST(k AS INTEGER) AS k, round(min(cost), 4) AS inertia FROM costs GROUP BY k",
)
def kmeans_elbow(spark: SparkSession, folder: str) -> DataFrame:
    """The later edition's sweep: 3 to 15 clusters, one start."""
    return rounded(cluster.elbow(_points(spark, folder), range(3, 16), max_iter=30, key="vec_id"), "inertia")


@query(
    "kmeans_elbow_restarts",
    "WITH RECURSIVE" + model_sql.kmeans(range(1, 11), 10, 10)
    + " SELECT CAST(k AS INTEGER) AS k, round(min(cost), 4) AS inertia FROM costs GROUP BY k",
)
def kmeans_elbow_restarts(spark: SparkSession, folder: str) -> DataFrame:
    """The earlier edition's sweep: 1 to 10 clusters, ten starts each, ten turns."""
    return rounded(cluster.elbow(_points(spark, folder), range(1, 11), n_init=10, max_iter=10, key="vec_id"), "inertia")


_BEST = "(SELECT arg_min(r, (cost, r)) FROM costs)"


@query(
    "kmeans_assign",
    "WITH RECURSIVE" + model_sql.kmeans(range(10, 11), 10, 30)
    + f" SELECT id AS vec_id, CAST(c AS INTEGER) AS cluster FROM placed WHERE r = {_BEST}",
)
def kmeans_assign(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    model = cluster.best_kmeans(points, 10, n_init=10, max_iter=30, key="vec_id")
    return cluster.assign_clusters(points, model).select("vec_id", "cluster")


@query(
    "pca_points",
    "WITH RECURSIVE" + model_sql.COMPONENTS + " SELECT id AS vec_id, round(pca1, 6) AS pca1, round(pca2, 6) AS pca2 FROM projected",
)
def pca_points(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    return rounded(cluster.CentredPCA(points).transform(points).select("vec_id", "pca1", "pca2"), "pca1", "pca2", places=6)


_SHARE = "round(size / (SELECT sum(v) FROM cov WHERE i = j), 6) AS share"


@query(
    "pca_variance",
    "WITH RECURSIVE" + model_sql.COMPONENTS
    + f" SELECT 1 AS component, {_SHARE} FROM one_size UNION ALL SELECT 2, {_SHARE} FROM two_size",
)
def pca_variance(spark: SparkSession, folder: str) -> DataFrame:
    shares = cluster.CentredPCA(_points(spark, folder)).explained
    rows = [(i + 1, s) for i, s in enumerate(shares)]
    return rounded(spark.createDataFrame(rows, "component int, share double"), "share", places=6)


@query(
    "cluster_points",
    "WITH RECURSIVE" + model_sql.kmeans(range(10, 11), 10, 30) + "," + model_sql.COMPONENTS
    + f""" SELECT id AS vec_id, round(pca1, 6) AS pca1, round(pca2, 6) AS pca2, CAST(c AS INTEGER) AS cluster,
                  count(*) OVER (PARTITION BY c) AS cluster_size
           FROM placed JOIN projected USING (id) WHERE r = {_BEST}""",
)
def cluster_points(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    assigned = cluster.assign_clusters(points, cluster.best_kmeans(points, 10, n_init=10, max_iter=30, key="vec_id"))
    placed = cluster.CentredPCA(points).transform(assigned)
    sizes = cluster.cluster_sizes(assigned).withColumnRenamed("n", "cluster_size")
    return rounded(
        placed.join(sizes, "cluster").select("vec_id", "pca1", "pca2", "cluster", "cluster_size"), "pca1", "pca2", places=6
    )


@query(
    "total_inertia",
    """WITH parts AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
       SELECT round(sum(s), 4) AS inertia FROM (SELECT var_pop(CAST(v AS DOUBLE)) * count(*) AS s FROM parts GROUP BY i)""",
)
def total_inertia(spark: SparkSession, folder: str) -> DataFrame:
    inertia = cluster.total_inertia(_points(spark, folder))
    return rounded(spark.createDataFrame([(inertia,)], "inertia double"), "inertia")


@query(
    "train_test_split",
    """SELECT c_custkey, CAST('0x' || left(md5(c_custkey || '/42'), 8) AS BIGINT) % 100 < 20 AS is_test FROM customer""",
)
def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select("c_custkey", valuation.in_test(F.col("c_custkey")).alias("is_test"))


_GBT_NUMBERS = ["acctbal", "max_order", "n_orders"]
_GBT_CATEGORIES = ["segment", "n_name"]
_ONE_TRIAL = boosting.Trial(trees=10, rate=0.1, depth=3)
_DRAWS = valuation.draw_trials(3, trees=(3, 6))
_IN_TEST = "CAST('0x' || left(md5(id || '/42'), 8) AS BIGINT) % 100 < 20"


def _gbt_sql(trials: list[boosting.Trial]) -> str:
    """The value model over the view with gaps, in SQL: features, then the trees of all trials."""
    return with_views("gaps") + f""",
    data AS MATERIALIZED (SELECT c_custkey AS id, c_name, order_value, {', '.join(_GBT_NUMBERS)},
                 {', '.join(f"coalesce({c}, 'Missing') AS {c}" for c in _GBT_CATEGORIES)} FROM gaps WHERE order_value IS NOT NULL),
    train AS MATERIALIZED (SELECT id, ln(1 + order_value) AS y FROM data WHERE NOT {_IN_TEST}),
    """ + model_sql.feature_rows(_GBT_NUMBERS, _GBT_CATEGORIES) + "," + model_sql.boosting([vars(t) for t in trials])


_SCORED = """ SELECT {columns} FROM (SELECT *, greatest(exp(p) - 1, 0) AS predicted FROM predicted JOIN data USING (id)) WHERE """ + _IN_TEST


def _value_rows(spark: SparkSession, folder: str):
    """Training rows with features and label, test rows with features, and the features' names."""
    rows = views.gaps(spark, folder).where(F.col("order_value").isNotNull())
    rows = shape.fill_defaults(prepare.log_target(rows, "order_value", "label"), [], _GBT_CATEGORIES)
    train, test = valuation.train_test_split(rows, "c_custkey")
    prepared = prepare.feature_pipeline(train, _GBT_NUMBERS, _GBT_CATEGORIES, scale=False)
    names = prepare.feature_names(prepared, _GBT_NUMBERS, _GBT_CATEGORIES)
    return prepared.transform(train).select("c_custkey", "features", "label"), prepared.transform(test), names


def _value_model(spark: SparkSession, folder: str):
    train, test, names = _value_rows(spark, folder)
    return boosting.fit(train, _ONE_TRIAL, "features", "label", "c_custkey"), test, names


@query("gbt_predict", _gbt_sql([_ONE_TRIAL]) + _SCORED.format(columns="id AS c_custkey, order_value, round(predicted, 4) AS predicted"))
def gbt_predict(spark: SparkSession, folder: str) -> DataFrame:
    model, test, _ = _value_model(spark, folder)
    scored = valuation.predict(model, test)
    return rounded(scored.select("c_custkey", "order_value", "predicted"), "predicted")


@query(
    "residuals",
    _gbt_sql([_ONE_TRIAL]) + _SCORED.format(
        columns="c_name AS entity, order_value AS actual, round(predicted, 4) AS predicted, round(order_value - predicted, 4) AS residual"
    ),
)
def residuals(spark: SparkSession, folder: str) -> DataFrame:
    model, test, _ = _value_model(spark, folder)
    scored = valuation.predict(model, test)
    return rounded(valuation.residuals(scored, "c_name", "order_value"), "predicted", "residual")


@query(
    "feature_importance",
    _gbt_sql([_ONE_TRIAL]) + """
    SELECT feature, round(coalesce(share, 0), 6) AS importance FROM names LEFT JOIN (
        SELECT f, sum(gain / root) / sum(sum(gain / root)) OVER () AS share
        FROM splits JOIN (SELECT tree, n AS root FROM splits WHERE node = 0) USING (tree) GROUP BY f) USING (f)
    ORDER BY coalesce(share, 0) DESC, feature LIMIT 20""",
)
def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    model, _, names = _value_model(spark, folder)
    return rounded(valuation.gain_table(model, names, table(spark, folder, "customer")), "importance", places=6)


@query(
    "gbt_first_tree",
    _gbt_sql([boosting.Trial(trees=1, depth=4, min_split=40)])
    + " SELECT CAST(node AS INTEGER) AS node, feature, CAST(bin AS INTEGER) AS split, n, round(gain, 4) AS gain FROM splits JOIN names USING (f)",
)
def gbt_first_tree(spark: SparkSession, folder: str) -> DataFrame:
    train, _, names = _value_rows(spark, folder)
    model = boosting.fit(train, boosting.Trial(trees=1, depth=4, min_split=40), "features", "label", "c_custkey")
    splits = [(node, names[f], split, int(n), gain) for _, _, node, f, split, n, gain, _ in boosting.tree_rows([model]) if f >= 0]
    return rounded(spark.createDataFrame(splits, "node int, feature string, split int, n long, gain double"), "gain")


@query(
    "search_scores",
    _gbt_sql([replace(draw, fold=f) for draw in _DRAWS for f in range(5)]) + f"""
    SELECT CAST(trial // 5 AS INTEGER) AS draw, CAST(fold AS INTEGER) AS fold, trees, round(rate, 6) AS rate, depth, min_split,
           round(subsample, 6) AS subsample, round(r2, 6) AS r2
    FROM params JOIN (SELECT trial, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2
                      FROM predicted JOIN r USING (id) JOIN params USING (trial) WHERE y IS NOT NULL AND r.fold = params.fold
                      GROUP BY trial) USING (trial)""",
)
def search_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Three draws of three to six trees (the search itself draws 30 of 300 to 999), five folds, all grown side by side."""
    train, _, _ = _value_rows(spark, folder)
    found = boosting.search(train, _DRAWS, "features", "label", "c_custkey")
    return rounded(valuation.score_table(found, train), "r2", "rate", "subsample", places=6)


@query("model_round_trip", _gbt_sql([_ONE_TRIAL]) + _SCORED.format(columns="id AS c_custkey, round(predicted, 4) AS predicted"))
def model_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Model and test rows published together, loaded from the manifest, and scored."""
    model, test, _ = _value_model(spark, folder)
    store = Store(spark, shared_path(spark, "store"))
    store.publish(model=model, rows=test.select("c_custkey", vector_to_array("features").alias("features")))
    return rounded(valuation.predict(store.load("model"), store.load("rows")).select("c_custkey", "predicted"), "predicted")


@query(
    "regression_metrics",
    """WITH s AS (SELECT l_extendedprice AS a, l_quantity * 2100.0 AS p FROM lineitem)
       SELECT count(*) AS n, round(1 - sum((a - p) * (a - p)) / (var_pop(a) * count(*)), 6) AS r2,
              round(sqrt(avg((a - p) * (a - p))), 4) AS rmse, round(avg(abs(a - p)), 4) AS mae FROM s""",
)
def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    scored = table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("actual"), (F.col("l_quantity") * 2100.0).alias("predicted")
    )
    found = rounded(valuation.regression_metrics(scored, "actual", "predicted"), "rmse", "mae")
    return rounded(found, "r2", places=6)


# ---- tables in and out, schema rules ----------------------------------------------------------------------------------------
@query(
    "column_pipeline",
    with_views("gaps") + """,
    numbers AS (SELECT c_custkey, 'acctbal' AS feature, acctbal AS v FROM gaps UNION ALL
                SELECT c_custkey, 'max_order', max_order FROM gaps UNION ALL SELECT c_custkey, 'n_orders', n_orders FROM gaps),
    filled AS (SELECT c_custkey, feature, v, avg(v) OVER (PARTITION BY feature) AS m FROM numbers),
    scaled AS (SELECT c_custkey, feature, (coalesce(v, m) - m) / stddev_pop(coalesce(v, m)) OVER (PARTITION BY feature) AS value FROM filled),
    common AS (SELECT segment AS mode FROM gaps WHERE segment IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)
    SELECT c_custkey, feature, round(value, 4) AS value FROM scaled WHERE value <> 0
    UNION ALL SELECT c_custkey, 'segment=' || coalesce(segment, (SELECT mode FROM common)), 1.0 FROM gaps
    UNION ALL SELECT c_custkey, 'n_name=' || n_name, 1.0 FROM gaps""",
)
def column_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers filled and scaled, categories filled and encoded, from one table of parameters; other columns dropped."""
    rows = views.gaps(spark, folder)
    learned = materialise(prepare.parameters(rows, ["acctbal", "max_order", "n_orders", "nothing"], _GBT_CATEGORIES))
    return rounded(prepare.apply_parameters(rows, learned, "c_custkey").drop("slot"), "value")


@query(
    "encoding_fallback",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, 'Ünï, "' || translate(c_name, 'u', 'ü') || '"' AS name, c_mktsegment
       FROM customer""",
)
def encoding_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Files of one folder in UTF-8, UTF-8 with a byte order mark and Latin-1, read as one table."""
    name = F.concat(F.lit('Ünï, "'), F.translate("c_name", "u", "ü"), F.lit('"')).alias("name")
    rows = table(spark, folder, "customer").select("c_custkey", name, "c_mktsegment")
    place = shared_path(spark, "encodings")
    for kind, (encoding, bom) in enumerate([("UTF-8", False), ("UTF-8", True), ("ISO-8859-1", False)]):
        sinks.write_table(rows.where(F.col("c_custkey") % 3 == kind), place, encoding=encoding, bom=bom, mode="append")
    return sinks.read_table(spark, place, encoding_fallback=True)


@query(
    "csv_sink",
    with_views("gaps") + """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, printf('%.3f', acctbal) AS acctbal,
                                   printf('%.3f', max_order) AS max_order, segment FROM gaps""",
)
def csv_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Written with three decimals and a byte order mark, read back as text."""
    place = shared_path(spark, "csv")
    sinks.write_table(views.gaps(spark, folder).select("c_custkey", "c_name", "acctbal", "max_order", "segment"), place, decimals=3, bom=True)
    return sinks.read_table(spark, place)


@query(
    "staged_table",
    with_views("profile") + "SELECT n_name, count(*) AS n, round(sum(order_value), 2) AS total FROM profile WHERE n_orders >= 5 GROUP BY n_name",
)
def staged_table(spark: SparkSession, folder: str) -> DataFrame:
    """The unfiltered table is written and read again, then filtered and counted."""
    staged = sinks.stage(profile(spark, folder), shared_path(spark, "stage"))
    kept = shape.eligible(staged, "n_orders", 5, inclusive=True)
    return rounded(kept.groupBy("n_name").agg(F.count("*").alias("n"), F.sum("order_value").alias("total")), "total", places=2)


@query("preview_rows", with_views("profile") + "SELECT c_name, n_name, order_value FROM profile ORDER BY order_value DESC NULLS LAST, c_name LIMIT 5")
def preview_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = profile(spark, folder).select("c_name", "n_name", "order_value")
    return sinks.preview(rows.orderBy(F.desc_nulls_last("order_value"), "c_name"))


@query("required_columns", "SELECT o_orderkey, o_totalprice, o_custkey FROM orders")
def required_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Required columns are there; of the wanted ones those that exist."""
    orders = table(spark, folder, "orders")
    found = shape.require_columns(orders, ["o_orderkey"], ["o_totalprice", "o_discount", "o_custkey"])
    return orders.select("o_orderkey", *found)


def _stat_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One page for each nation with two tables of its customers, each with a row of column headers now and then."""
    customers = table(spark, folder, "customer")
    cell = lambda stat, value: F.concat(F.lit(f'<td data-stat="{stat}"> '), value.cast("string"), F.lit("</td>"))
    header = F.when(F.col("c_custkey") % 7 == 0, F.lit('<tr><th scope="col">Player</th></tr>')).otherwise(F.lit(""))
    line = lambda *cells: F.sort_array(F.collect_list(F.struct("c_custkey", F.concat(header, F.lit("<tr>"), *cells, F.lit("</tr>")).alias("tr"))))
    both = customers.groupBy("c_nationkey").agg(
        line(cell("player", F.col("c_name")), cell("minutes", F.col("c_acctbal")), cell("unused", F.col("c_custkey"))).alias("base"),
        line(cell("player", F.col("c_name")), cell("segment", F.col("c_mktsegment")), cell("spare", F.col("c_custkey"))).alias("more"),
    )
    body = lambda name: F.concat(F.lit(f'<table id="{name}">'), F.array_join(F.col(f"{name}.tr"), ""), F.lit("</table>"))
    return both.select(F.col("c_nationkey").cast("long").alias("page_id"), F.concat(body("base"), F.lit("<p>"), body("more")).alias("html"))


@query(
    "source_pruning",
    """SELECT CAST(c_nationkey AS BIGINT) AS page_id, c_name AS player, CAST(c_acctbal AS VARCHAR) AS minutes, c_mktsegment AS segment
       FROM customer WHERE c_nationkey IN (SELECT c_nationkey FROM customer GROUP BY c_nationkey
                                           HAVING count(*) + count(*) FILTER (c_custkey % 7 = 0) > 1)""",
)
def source_pruning(spark: SparkSession, folder: str) -> DataFrame:
    """Only the required fields of each page table; rows of column headers are skipped."""
    fields, required = {"base": ["player", "minutes", "unused"], "more": ["segment", "spare"]}, {"player", "minutes", "segment"}
    blocks = materialise(page_source.table_blocks(_stat_pages(spark, folder), list(fields)))
    base = page_source.table_rows(blocks, "base", [f for f in fields["base"] if f in required])
    kept = [f for f in fields["more"] if f in required]
    details = [(page_source.table_rows(blocks, "more", ["player", *kept]), kept)]
    return joins.update_join(base, details, "player").select("page_id", "player", "minutes", "segment")


@query("drop_present", "SELECT p_partkey, p_name, p_type FROM part")
def drop_present(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_type", "p_size")
    return shape.drop_present(part, ["p_size", "p_comment", "p_nothing"])


@query("backfill_columns", "SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE) AS skill, CAST(NULL AS VARCHAR) AS team FROM supplier")
def backfill_columns(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    return shape.backfill_columns(supplier, {"s_name": "string", "skill": "double", "team": "string"})


@query("trim_headers", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def trim_headers(spark: SparkSession, folder: str) -> DataFrame:
    return shape.trim_headers(table(spark, folder, "nation").select(F.col("n_nationkey").alias(" n_nationkey"), F.col("n_name").alias("n_name\t"), "n_regionkey"))


@query(
    "field_sets",
    """SELECT 'c_acctbal' AS field, true AS present, count(c_acctbal) AS n FROM customer
       UNION ALL SELECT 'c_name', true, count(c_name) FROM customer UNION ALL SELECT 'c_age', false, 0""",
)
def field_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Wanted fields, whether the table has them, and how many values they hold."""
    customers = table(spark, folder, "customer")
    present, missing = shape.field_sets(customers, ["c_name", "c_acctbal", "c_age"])
    counts = [F.struct(F.lit(f).alias("field"), F.lit(True).alias("present"), F.count(f).alias("n")) for f in sorted(present)]
    counts += [F.struct(F.lit(f).alias("field"), F.lit(False).alias("present"), F.lit(0).cast("long").alias("n")) for f in sorted(missing)]
    return customers.agg(F.array(*counts).alias("rows")).select(F.inline("rows"))
