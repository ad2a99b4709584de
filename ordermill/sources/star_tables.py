"""The three feeds, with dirt in them, from star-schema tables.

The tables are clean, so bad cells and second copies are put in by arithmetic on
the keys. ``seq`` carries the file order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEQ = "seq"

# The columns the feeds are made from.
TABLE_COLUMNS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def customer_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with missing names, cities and ids, bad dates and copies."""
    rows = _table(spark, folder, "customer").join(
        _table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey"), "left"
    )
    first = """struct(
        if(c_custkey != 7, 'C' || c_custkey, NULL) AS customer_id,
        if(c_custkey % 41 != 0, c_name, NULL) AS customer_name,
        if(c_custkey % 43 != 0, n_name, NULL) AS city,
        if(c_custkey % 47 = 0, '2023-13-01', '2022-03-04') AS signup_date,
        c_custkey * 2 AS seq)"""
    second = """struct(
        'C' || c_custkey AS customer_id,
        'Copy ' || c_name AS customer_name,
        'Elsewhere' AS city,
        '2022-03-05' AS signup_date,
        c_custkey * 2 + 1 AS seq)"""
    return rows.selectExpr(
        f"inline(if(c_custkey % 10 = 0, array({first}, {second}), array({first})))"
    )


def product_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Products with missing names and categories, bad prices and copies."""
    first = """struct(
        'P' || p_partkey AS product_id,
        if(p_partkey % 53 != 0, p_name, NULL) AS product_name,
        if(p_partkey % 59 != 0, p_type, NULL) AS category,
        CASE WHEN p_partkey % 37 = 0 THEN 'n/a'
             WHEN p_partkey % 61 = 0 THEN 'abc'
             ELSE string(p_retailprice) END AS price,
        p_partkey * 2 AS seq)"""
    second = """struct(
        'P' || p_partkey AS product_id,
        'Copy ' || p_name AS product_name,
        p_type AS category,
        '1.0' AS price,
        p_partkey * 2 + 1 AS seq)"""
    return _table(spark, folder, "part").selectExpr(
        f"inline(if(p_partkey % 10 = 0, array({first}, {second}), array({first})))"
    )


def order_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with orphan and missing keys, bad numbers and dates, copies.

    Both tables grow alike, so the join is told to shuffle even while one of
    them is small. That also spreads a table that sits in one row group.
    """
    order = _table(spark, folder, "orders").hint("merge")
    rows = _table(spark, folder, "lineitem").join(order, F.expr("l_orderkey = o_orderkey"))
    return rows.selectExpr(
        "'O' || l_orderkey || '-' || l_linenumber AS order_id",
        """CASE WHEN o_custkey = 7 THEN NULL
                WHEN o_custkey % 67 = 0 THEN 'X' || o_custkey
                ELSE 'C' || o_custkey END AS customer_id""",
        "if(l_partkey % 71 = 0, 'X', 'P') || l_partkey AS product_id",
        """CASE WHEN l_partkey % 29 = 0 THEN 'bad'
                WHEN l_partkey % 73 = 0 THEN 'nan'
                WHEN l_suppkey % 23 = 0 THEN '-3'
                WHEN l_suppkey % 31 = 0 THEN '0'
                ELSE string(l_quantity) END AS quantity""",
        """CASE WHEN l_orderkey % 53 = 0 THEN '2023-13-01'
                WHEN l_orderkey % 59 = 0 THEN NULL
                ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS order_date""",
        "struct(l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS seq",
    )


def feeds(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The customer, product and order feeds of one folder."""
    return (
        customer_feed(spark, folder),
        product_feed(spark, folder),
        order_feed(spark, folder),
    )
