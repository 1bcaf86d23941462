"""Input feeds derived from the given tables.

``FEEDS`` are written in SQL that Spark and DuckDB both run; ``{orders}`` and the like stand for the
tables. They put in what real feeds have: several messages per key, missing and malformed values.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.joins import lookup_join
from tidemill.sources.files import read_parquet, spread

AS_OF = "2001-09-01 00:00:00"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

FEEDS = {
    # Sign-ups, trade accounts without orders, and the contact data that came with each order.
    "raw_customers": """
        SELECT c_custkey AS customer_id, CAST(0 AS BIGINT) AS _seq, lower(c_mktsegment) AS first_name,
               c_name AS last_name,
               CASE WHEN c_acctbal >= 0 THEN lower(c_mktsegment) || '@example.com' END AS email,
               '+1 (' || CAST(c_nationkey AS STRING) || ') ' || CAST(c_custkey AS STRING) AS phone
        FROM {customer}
        UNION ALL
        SELECT 1000000000000 + s_suppkey, CAST(0 AS BIGINT), 'o' || chr(39) || lower(s_name),
               CASE WHEN s_acctbal >= 0 THEN '3rd mary-ann' END, NULL, NULL
        FROM {supplier}
        UNION ALL
        SELECT o_custkey, 1 + o_orderkey, 'o' || chr(39) || lower(o_orderpriority),
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
                    ELSE 'VAN DER ' || lower(o_orderstatus) END,
               CASE WHEN o_orderstatus <> 'O' THEN lower(o_orderpriority) || '@example.org' END,
               CASE WHEN o_orderstatus = 'F' THEN 'no phone'
                    WHEN o_orderstatus = 'O' THEN '(555) ' || CAST(o_orderkey AS STRING) || ' x.' END
        FROM {orders}
    """,
    # One message per order line.
    "raw_orders": """
        SELECT l_orderkey AS order_id,
               CASE WHEN o_orderpriority = '1-URGENT' AND l_returnflag = 'A' THEN NULL ELSE o_custkey END AS customer_id,
               CASE WHEN o_orderstatus = 'P' AND l_returnflag = 'N' THEN 'not known'
                    ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date,
               CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_shipdate AS DATE) AS STRING) || ' 18:30:00'
                    WHEN l_returnflag = 'R' THEN 'soon' END AS ship_date,
               CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(l_shipdate AS DATE) AS STRING) || 'T07:00:00' END
                 AS delivery_date,
               l_extendedprice AS item_price, CAST(l_quantity AS INT) AS quantity, l_suppkey AS store_id,
               l_linenumber AS _line, l_partkey AS _part, l_shipdate AS _shipped
        FROM {order_lines}
    """,
    # The catalogue, then a price message per sale.
    "raw_products": """
        SELECT p_partkey AS product_id, '  ' || p_name || chr(9) AS product_name, p_type AS category,
               CAST(p_retailprice AS STRING) AS price, CAST(p_size AS STRING) || '.5' AS cost,
               p_brand AS msrp, CAST(NULL AS TIMESTAMP) AS _shipped, CAST(NULL AS BIGINT) AS _order,
               CAST(NULL AS INT) AS _line, CAST(NULL AS BIGINT) AS _store
        FROM {part}
        UNION ALL
        SELECT l_partkey,
               CASE WHEN l_returnflag = 'R' THEN NULL
                    ELSE chr(9) || ' Item ' || CAST(l_linenumber AS STRING) || ' ' || chr(10) END,
               l_linestatus || l_returnflag,
               CASE WHEN l_discount = 0.1 THEN 'n/a' WHEN l_discount = 0.05 THEN '0' WHEN l_discount = 0.02 THEN '12d'
                    WHEN l_tax = 0.08 THEN '-1' ELSE CAST(l_extendedprice AS STRING) END,
               CASE WHEN l_tax = 0.0 THEN 'free' ELSE CAST(l_linenumber AS STRING) || '.25' END,
               CAST(CAST(l_quantity AS INT) AS STRING),
               l_shipdate, l_orderkey, l_linenumber, l_suppkey
        FROM {lineitem}
    """,
    # Opening records, then an address message per delivery.
    "raw_stores": """
        SELECT s_suppkey AS store_id, s_name AS store_name, '  1 Main St ' AS address,
               '  ' || lower(n_name) || ' ' AS city, ' ' || lower(n_name) AS state, 'ZIP-00501-x' AS zip_code,
               lower(r_name) || '  ' AS country, '(555) 010-' || CAST(s_suppkey AS STRING) AS phone,
               '1995-01-01' AS opening_date, CAST(NULL AS STRING) AS closing_date,
               CAST(NULL AS TIMESTAMP) AS _shipped, CAST(NULL AS BIGINT) AS _order, CAST(NULL AS INT) AS _line,
               CAST(NULL AS BIGINT) AS _part
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
        UNION ALL
        SELECT l_suppkey, 'Store ' || CAST(l_suppkey AS STRING), ' ' || CAST(l_linenumber AS STRING) || ' High St' || chr(9),
               ' new ' || lower(l_linestatus), lower(l_returnflag) || 'x ',
               CASE WHEN l_returnflag <> 'A' THEN 'ZIP-' || CAST(l_partkey AS STRING) END, ' us',
               CASE WHEN l_linestatus = 'O' THEN 'ext. ' || CAST(l_partkey AS STRING) END,
               'unknown', CASE WHEN l_returnflag = 'R' THEN CAST(CAST(l_shipdate AS DATE) AS STRING) END,
               l_shipdate, l_orderkey, l_linenumber, l_partkey
        FROM {lineitem}
    """,
    "raw_inventory": """
        SELECT l_partkey AS product_id, l_suppkey AS store_id, CAST(l_quantity AS INT) - 3 AS quantity
        FROM {lineitem}
    """,
    # Accounts of three tables with a text label each.
    "all_accounts": """
        SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM {customer}
        UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM {supplier}
        UNION ALL SELECT CAST(NULL AS BIGINT), r_name, NULL FROM {region}
    """,
}

ORDERS_ORDER = ("_line", "_part", "_shipped", "store_id", "item_price", "quantity")
PRODUCTS_ORDER = ("_shipped", "_order", "_line", "_store")
STORES_ORDER = ("_shipped", "_order", "_line", "_part")


# Tables that are spread over the cores when they are one file.
SPREAD = ("lineitem", "orders", "events", "customer")


@lru_cache(maxsize=64)
def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, opened once per session."""
    return read_parquet(spark, f"{folder}/{name}.parquet")


@lru_cache(maxsize=64)
def _spread_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    given = table(spark, folder, name)
    return spread(given) if name in SPREAD else given


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their order. Lines are the big side, and one order may have very many."""
    orders = table(spark, folder, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    lines = _spread_table(spark, folder, "lineitem")
    return lookup_join(lines, orders, "l_orderkey").filter(F.col("o_custkey").isNotNull())


ORDER_LINES = "(SELECT * FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"


def put_tables(sql: str, naming, lines: str = ORDER_LINES) -> str:
    for name in TABLES:
        sql = sql.replace("{" + name + "}", naming(name))
    return sql.replace("{order_lines}", lines)


def query(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """SQL text over the given tables."""

    def view(name: str) -> str:
        if "{" + name + "}" in sql:
            _spread_table(spark, folder, name).createOrReplaceTempView(f"given_{name}")
        return f"given_{name}"

    if "{order_lines}" in sql:
        order_lines(spark, folder).createOrReplaceTempView("given_order_lines")
    return spark.sql(put_tables(sql, view, "given_order_lines"))


def feed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return query(spark, folder, FEEDS[name])


def oracle(sql: str, **views: str) -> str:
    """DuckDB text: the named views, feeds among them by name only, then the query."""
    parts = [f"{name} AS ({put_tables(text, str)})" for name, text in views.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + put_tables(sql, str)
