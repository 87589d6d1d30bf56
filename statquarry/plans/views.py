"""Views over the given tables that play the parts of the reference's inputs.

``profile``: one row per customer (entity name, group nation, category segment, metrics from the orders).  ``texts``: the
orders with numbers written as text.  ``prices``: the parts with prices written as money texts.  Missing values are
planted by conditions on the data.  ``VIEW_SQL`` holds the same definitions for the SQL check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statquarry.operators.longform import to_long

PROFILE_METRICS = ["n_orders", "order_value", "max_order", "c_acctbal"]
LINE_METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TEXT_COLUMNS = ["price_text", "share_text", "count_text", "age_text", "o_orderpriority"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def profile(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"),
        F.round(F.sum("o_totalprice"), 2).alias("order_value"),
        F.max("o_totalprice").alias("max_order"),
    )
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    joined = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    order_text = F.when(F.col("c_mktsegment") == "MACHINERY", "N/a").otherwise(F.format_number("order_value", 2))
    return joined.select(
        "c_custkey", "c_name", "n_name", "c_mktsegment", "c_acctbal", "n_orders", "order_value", "max_order",
        order_text.alias("order_text"),
    )


def profile_long(spark: SparkSession, folder: str) -> DataFrame:
    """Long form; the order value is parsed back out of its text, so one segment has no value there."""
    view = profile(spark, folder).drop("order_value").withColumnRenamed("order_text", "order_value")
    return to_long(view, PROFILE_METRICS, "c_name", "n_name", "c_custkey")


def lines_long(spark: SparkSession, folder: str) -> DataFrame:
    return to_long(table(spark, folder, "lineitem"), LINE_METRICS, "l_orderkey", "l_returnflag")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    urgent, low = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "5-LOW"
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "N/a").otherwise(F.format_number(price, 2)).alias("price_text"),
        F.when(urgent, "").when(low, "nan").otherwise(F.concat(F.format_number(price, 2), F.lit("%"))).alias("share_text"),
        F.when(urgent, F.concat(F.col("o_custkey").cast("string"), F.lit(".5")))
        .when(low, "N/a")
        .otherwise(F.format_number(F.col("o_custkey") * 1000 + 7, 0))
        .alias("count_text"),
        F.concat(F.year("o_orderdate") - 1970, F.lit("-"), F.lpad(F.dayofyear("o_orderdate").cast("string"), 3, "0"))
        .alias("age_text"),
        "o_orderpriority",
    )


def prices(spark: SparkSession, folder: str) -> DataFrame:
    price, kind = F.col("p_retailprice"), F.col("p_type")
    plain = price.cast("decimal(12,2)").cast("string")
    money_text = (
        F.when(kind == "ECONOMY", F.concat(F.lit("€"), plain, F.lit("M")))
        .when(kind == "PROMO", F.concat(F.lit("£"), F.format_number(price * 5, 0), F.lit("K")))
        .when(kind == "LARGE", F.concat(F.lit("$ "), plain, F.lit("m")))
        .when(kind == "SMALL", F.lit("N/a"))
        .when(kind == "MEDIUM", F.concat(plain, F.lit("k")))
        .otherwise(F.concat(plain, F.lit("00")))
    )
    score_text = F.when(kind == "SMALL", F.lit("N/a")).when(
        kind == "PROMO", F.concat(F.col("p_size").cast("string"), F.lit(".5"))
    ).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".5/100")))
    label = F.concat("p_brand", F.lit(": "), "p_name", F.lit(" / "), F.col("p_size").cast("string"), F.lit(".5%"))
    return table(spark, folder, "part").select(
        "p_partkey", "p_name", "p_type", money_text.alias("money_text"), score_text.alias("score_text"), label.alias("label")
    )


def gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Profile with missing numbers and categories."""
    segment = F.col("c_mktsegment")
    return profile(spark, folder).select(
        "c_custkey", "c_name", "n_name",
        F.when(segment != "HOUSEHOLD", segment).alias("segment"),
        F.when(segment != "BUILDING", F.col("c_acctbal")).alias("acctbal"),
        F.when(~segment.isin("MACHINERY", "BUILDING"), F.col("max_order")).alias("max_order"),
        F.col("n_orders").cast("double").alias("n_orders"),
        "order_value",
        F.when(F.lit(False), F.col("c_acctbal")).alias("nothing"),
    )


def sql_long(view: str, entity: str, group: str, row_no: str, metrics: dict[str, str]) -> str:
    """UNION ALL form of the long table for the SQL check."""
    return " UNION ALL ".join(
        f"SELECT {row_no} AS row_no, {entity} AS entity, {group} AS grp, '{m}' AS metric, {e} AS value FROM {view}"
        for m, e in metrics.items()
    )


NUMBER_SQL = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"


def sql_num(text: str) -> str:
    return f"CASE WHEN regexp_matches(trim({text}), {NUMBER_SQL}) THEN try_cast(trim({text}) AS DOUBLE) END"


VIEW_SQL: dict[str, str] = {
    "profile": """
        SELECT c_custkey, c_name, n_name, c_mktsegment, c_acctbal, n_orders, order_value, max_order,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'N/a' ELSE format('{:,.2f}', order_value) END AS order_text
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS order_value,
                          max(o_totalprice) AS max_order FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""",
    "profile_long": sql_long(
        "profile", "c_name", "n_name", "c_custkey",
        {
            "n_orders": "CAST(n_orders AS DOUBLE)", "order_value": sql_num("replace(order_text, ',', '')"),
            "max_order": "max_order", "c_acctbal": "c_acctbal",
        },
    ),
    "lines_long": sql_long("lineitem", "l_orderkey", "l_returnflag", "l_orderkey", {m: m for m in LINE_METRICS}),
    "texts": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus = 'P' THEN 'N/a' ELSE format('{:,.2f}', o_totalprice) END AS price_text,
               CASE WHEN o_orderpriority = '1-URGENT' THEN '' WHEN o_orderpriority = '5-LOW' THEN 'nan'
                    ELSE format('{:,.2f}', o_totalprice) || '%' END AS share_text,
               CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey || '.5' WHEN o_orderpriority = '5-LOW' THEN 'N/a'
                    ELSE format('{:,}', o_custkey * 1000 + 7) END AS count_text,
               (year(o_orderdate) - 1970) || '-' || lpad(CAST(dayofyear(o_orderdate) AS VARCHAR), 3, '0') AS age_text,
               o_orderpriority
        FROM orders""",
    "prices": """
        SELECT p_partkey, p_name, p_type,
               CASE p_type WHEN 'ECONOMY' THEN '€' || printf('%.2f', p_retailprice) || 'M'
                    WHEN 'PROMO' THEN '£' || format('{:,.0f}', p_retailprice * 5) || 'K'
                    WHEN 'LARGE' THEN '$ ' || printf('%.2f', p_retailprice) || 'm'
                    WHEN 'SMALL' THEN 'N/a' WHEN 'MEDIUM' THEN printf('%.2f', p_retailprice) || 'k'
                    ELSE printf('%.2f', p_retailprice) || '00' END AS money_text,
               CASE p_type WHEN 'SMALL' THEN 'N/a' WHEN 'PROMO' THEN p_size || '.5' ELSE p_size || '.5/100' END
                    AS score_text,
               p_brand || ': ' || p_name || ' / ' || p_size || '.5%' AS label
        FROM part""",
    "gaps": """
        SELECT c_custkey, c_name, n_name, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS segment,
               CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS acctbal,
               CASE WHEN c_mktsegment NOT IN ('MACHINERY', 'BUILDING') THEN max_order END AS max_order,
               CAST(n_orders AS DOUBLE) AS n_orders, order_value, CAST(NULL AS DOUBLE) AS nothing
        FROM profile""",
}
_NEEDS = {"profile_long": ["profile"], "gaps": ["profile"]}


def with_views(*names: str) -> str:
    """WITH clause defining the named views and what they build on."""
    ordered: list[str] = []
    for name in names:
        for part in [*_NEEDS.get(name, []), name]:
            if part not in ordered:
                ordered.append(part)
    return "WITH " + ", ".join(f"{name} AS ({VIEW_SQL[name]})" for name in ordered) + " "
