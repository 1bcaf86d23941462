"""Retail queries: cleaning, enrichment, marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.feeds import AS_OF, FEEDS, ORDERS_ORDER, PRODUCTS_ORDER, STORES_ORDER, feed, oracle, table
from tidemill.operators.rows import keep_last, kept_and_dropped
from tidemill.plans import retail, sample
from tidemill.sinks.layers import store


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return retail.clean_customers(feed(spark, folder, "raw_customers"), as_of=AS_OF)


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return retail.clean_orders(feed(spark, folder, "raw_orders"), order=ORDERS_ORDER, as_of=AS_OF)


def products(spark: SparkSession, folder: str) -> DataFrame:
    return retail.clean_products(feed(spark, folder, "raw_products"), order=PRODUCTS_ORDER, as_of=AS_OF)


def stores(spark: SparkSession, folder: str) -> DataFrame:
    return retail.clean_stores(feed(spark, folder, "raw_stores"), order=STORES_ORDER, as_of=AS_OF)


def inventory(spark: SparkSession, folder: str, cleaned_products: DataFrame | None = None) -> DataFrame:
    """Enriched inventory over stored product and store tables."""
    return retail.enrich_inventory(
        feed(spark, folder, "raw_inventory"),
        cleaned_products or store(products(spark, folder), "products"),
        store(stores(spark, folder), "stores"),
        as_of=AS_OF,
    )


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round float sums, whose last digits depend on the order of addition."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def customer_orders_mart(spark: SparkSession, folder: str) -> DataFrame:
    mart = retail.customer_orders_mart(orders(spark, folder), customers(spark, folder), AS_OF, unique_orders=True)
    return rounded(mart, total_spend=2, average_order_value=6)


def product_inventory_mart(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = store(products(spark, folder), "products")
    mart = retail.product_inventory_mart(cleaned, inventory(spark, folder, cleaned))
    return rounded(mart, inventory_value=2, retail_value=2, potential_profit=2)


def sales_by_store_mart(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = store(stores(spark, folder), "stores")
    mart = retail.sales_by_store_mart(orders(spark, folder), None, cleaned, unique_orders=True)
    return rounded(mart, total_sales=2, avg_order_value=6)


def dedup_keep_last(spark: SparkSession, folder: str) -> DataFrame:
    return keep_last(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"])


def clean_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return kept_and_dropped(feed(spark, folder, "raw_orders"), orders(spark, folder))


def _staged(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.col("props").alias("name"),
        "value",
        F.col("event_type").alias("category"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
    )
    return sample.staging(raw)


def warehouse_sample(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(sample.warehouse(_staged(spark, folder)), avg_value=4)


QUERIES = {
    "clean_customers": customers,
    "clean_orders": orders,
    "clean_products": products,
    "clean_stores": stores,
    "enrich_inventory": inventory,
    "customer_orders_mart": customer_orders_mart,
    "product_inventory_mart": product_inventory_mart,
    "sales_by_store_mart": sales_by_store_mart,
    "dedup_keep_last": dedup_keep_last,
    "clean_row_counts": clean_row_counts,
    "staging_sample": _staged,
    "warehouse_sample": warehouse_sample,
}


def _title(column: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({column}, '([a-zA-Z]+|[^a-zA-Z]+)'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


NOW = f"TIMESTAMP '{AS_OF}'"

CLEAN = {
    "clean_customers": f"""
        SELECT *, first_name || ' ' || last_name AS full_name, length(email) > 0 AS has_email,
               length(phone) > 0 AS has_phone, {NOW} AS last_updated
        FROM (SELECT customer_id, {_title("first_name")} AS first_name, {_title("last_name")} AS last_name,
                     coalesce(email, '') AS email, regexp_replace(coalesce(phone, ''), '[^0-9]', '', 'g') AS phone
              FROM (SELECT * FROM raw_customers
                    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _seq DESC) = 1)
              WHERE customer_id IS NOT NULL AND first_name IS NOT NULL AND last_name IS NOT NULL)
    """,
    "clean_orders": f"""
        SELECT *, item_price * quantity AS order_total,
               CASE WHEN ship_date >= order_date THEN date_sub('day', order_date, ship_date) END AS processing_days,
               CASE WHEN delivery_date IS NOT NULL THEN 'Delivered' WHEN ship_date IS NOT NULL THEN 'Shipped'
                    ELSE 'Unknown' END AS order_status, {NOW} AS last_updated
        FROM (SELECT order_id, customer_id, try_cast(order_date AS TIMESTAMP) AS order_date,
                     try_cast(ship_date AS TIMESTAMP) AS ship_date,
                     try_cast(delivery_date AS TIMESTAMP) AS delivery_date, item_price, quantity, store_id
              FROM raw_orders
              QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY
                  {", ".join(f"{c} DESC" for c in ORDERS_ORDER)}) = 1)
        WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_date IS NOT NULL
    """,
    "clean_products": f"""
        SELECT *, price - cost AS margin,
               CASE WHEN price = 0 THEN 0.0::DOUBLE ELSE (price - cost) / price * 100 END AS margin_percent,
               {NOW} AS last_updated
        FROM (SELECT product_id,
                     coalesce(trim(product_name, ' ' || chr(9) || chr(10)), 'Unknown Product') AS product_name, category,
                     CASE WHEN try_cast(price AS DOUBLE) >= 0 THEN try_cast(price AS DOUBLE) END AS price,
                     CASE WHEN try_cast(cost AS DOUBLE) >= 0 THEN try_cast(cost AS DOUBLE) END AS cost,
                     CASE WHEN try_cast(msrp AS DOUBLE) >= 0 THEN try_cast(msrp AS DOUBLE) END AS msrp
              FROM raw_products
              QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY
                  {", ".join(f"{c} DESC NULLS LAST" for c in PRODUCTS_ORDER)}) = 1)
        WHERE product_id IS NOT NULL
    """,
    "clean_stores": f"""
        SELECT store_id, store_name, trim(address, ' ' || chr(9)) AS address, trim(city) AS city,
               upper(trim(state)) AS state, regexp_replace(coalesce(zip_code, ''), '[^0-9]', '', 'g') AS zip_code,
               upper(trim(country)) AS country, regexp_replace(coalesce(phone, ''), '[^0-9]', '', 'g') AS phone,
               try_cast(opening_date AS TIMESTAMP) AS opening_date,
               try_cast(closing_date AS TIMESTAMP) AS closing_date,
               try_cast(closing_date AS TIMESTAMP) IS NULL AS is_active, {NOW} AS last_updated
        FROM (SELECT * FROM raw_stores
              QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY
                  {", ".join(f"{c} DESC NULLS LAST" for c in STORES_ORDER)}) = 1)
        WHERE store_id IS NOT NULL
    """,
    "enrich_inventory": f"""
        SELECT i.*, product_name, category, price, cost, store_name, city, state, is_active,
               quantity * cost AS inventory_value, quantity * price AS retail_value,
               CASE WHEN quantity < 10 THEN 'Low Stock' ELSE 'In Stock' END AS inventory_status, {NOW} AS last_updated
        FROM raw_inventory i LEFT JOIN clean_products p ON i.product_id = p.product_id
             LEFT JOIN clean_stores s ON i.store_id = s.store_id
    """,
}


def _views(*names: str) -> dict[str, str]:
    """The named views with the feeds they read."""
    feeds = {
        "clean_customers": ["raw_customers"],
        "clean_orders": ["raw_orders"],
        "clean_products": ["raw_products"],
        "clean_stores": ["raw_stores"],
        "enrich_inventory": ["raw_inventory"],
    }
    views: dict[str, str] = {}
    for name in names:
        for raw in feeds[name]:
            views[raw] = FEEDS[raw]
        views[name] = CLEAN[name]
    return views


def _clean_oracle(name: str) -> str:
    return oracle(f"SELECT * FROM {name}", **_views(name))


ORACLES = {
    **{name: _clean_oracle(name) for name in ("clean_customers", "clean_orders", "clean_products", "clean_stores")},
    "enrich_inventory": oracle(
        "SELECT * FROM enrich_inventory", **_views("clean_products", "clean_stores", "enrich_inventory")
    ),
    "customer_orders_mart": oracle(
        f"""
        SELECT c.*, coalesce(order_count, 0) AS order_count, first_order_date, last_order_date,
               round(coalesce(total_spend, 0), 2) AS total_spend, days_since_last_order,
               CASE WHEN order_count = 1 THEN 'New'
                    WHEN order_count >= 2 AND days_since_last_order <= 90 THEN 'Loyal'
                    WHEN order_count >= 2 AND days_since_last_order <= 180 THEN 'At Risk'
                    WHEN order_count >= 2 THEN 'Churned' ELSE 'Unknown' END AS customer_segment,
               round(coalesce(total_spend / order_count, 0), 6) AS average_order_value
        FROM clean_customers c LEFT JOIN (
             SELECT customer_id, count(DISTINCT order_id) AS order_count, min(order_date) AS first_order_date,
                    max(order_date) AS last_order_date, sum(order_total) AS total_spend,
                    CAST(date_diff('day', max(order_date), {NOW}) AS INT) AS days_since_last_order
             FROM clean_orders GROUP BY customer_id) o ON c.customer_id = o.customer_id
        """,
        **_views("clean_customers", "clean_orders"),
    ),
    "product_inventory_mart": oracle(
        """
        SELECT p.*, CAST(coalesce(total_quantity, 0) AS BIGINT) AS total_quantity,
               coalesce(store_count, 0) AS store_count, round(coalesce(inventory_value, 0), 2) AS inventory_value,
               round(coalesce(retail_value, 0), 2) AS retail_value,
               round(coalesce(retail_value, 0) - coalesce(inventory_value, 0), 2) AS potential_profit,
               CASE WHEN coalesce(total_quantity, 0) < 10 THEN 'Low Stock' ELSE 'In Stock' END AS inventory_status
        FROM clean_products p LEFT JOIN (
             SELECT product_id, sum(quantity) AS total_quantity, count(DISTINCT store_id) AS store_count,
                    sum(inventory_value) AS inventory_value, sum(retail_value) AS retail_value
             FROM enrich_inventory GROUP BY product_id) i ON p.product_id = i.product_id
        """,
        **_views("clean_products", "clean_stores", "enrich_inventory"),
    ),
    "sales_by_store_mart": oracle(
        """
        SELECT m.*, s.* EXCLUDE (store_id)
        FROM (SELECT store_id, CAST(year(order_date) AS INT) AS year, CAST(month(order_date) AS INT) AS month,
                     count(DISTINCT order_id) AS order_count, count(DISTINCT customer_id) AS customer_count,
                     round(sum(order_total), 2) AS total_sales, round(avg(order_total), 6) AS avg_order_value
              FROM clean_orders GROUP BY ALL) m
             LEFT JOIN clean_stores s ON m.store_id = s.store_id
        """,
        **_views("clean_orders", "clean_stores"),
    ),
    "dedup_keep_last": """
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
    "clean_row_counts": oracle(
        """
        SELECT before, kept, before - kept AS dropped
        FROM (SELECT (SELECT count(*) FROM raw_orders) AS before, (SELECT count(*) FROM clean_orders) AS kept)
        """,
        **_views("clean_orders"),
    ),
    "staging_sample": """
        SELECT event_id AS id, props AS name, value, upper(event_type) AS category, date_trunc('day', ts)::TIMESTAMP AS date,
               CAST(value AS VARCHAR) || '-' || upper(event_type) AS value_category
        FROM events
    """,
    "warehouse_sample": """
        SELECT upper(event_type) AS category, count(event_id) AS count, round(avg(value), 4) AS avg_value,
               min(value) AS min_value, max(value) AS max_value,
               min(date_trunc('day', ts))::TIMESTAMP AS earliest_date,
               max(date_trunc('day', ts))::TIMESTAMP AS latest_date
        FROM events GROUP BY 1
    """,
}
