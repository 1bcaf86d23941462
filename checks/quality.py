"""Data quality, test log, registry and monitoring queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.feeds import AS_OF, FEEDS, feed, oracle, query, table
from tidemill.operators import quality
from tidemill.plans import testlog
from tidemill.sinks import registry


def not_null(spark: SparkSession, folder: str) -> DataFrame:
    return quality.not_null(feed(spark, folder, "raw_orders"), "customer_id")


def unique(spark: SparkSession, folder: str) -> DataFrame:
    return quality.unique(feed(spark, folder, "raw_orders"), "customer_id")


def accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    prices = feed(spark, folder, "raw_products").select("product_id", "product_name", "category", "price")
    return quality.accepted_values(prices, "category", ["OA", "OR", "ECONOMY", "PROMO"])


def orphans(spark: SparkSession, folder: str) -> DataFrame:
    placed = feed(spark, folder, "raw_orders").select("order_id", "customer_id", "store_id")
    return quality.cross_table(placed, "customer_id", table(spark, folder, "supplier"), "s_suppkey")


def null_percent(spark: SparkSession, folder: str) -> DataFrame:
    percent = quality.null_percentages(feed(spark, folder, "raw_customers").drop("_seq"))
    return percent.withColumns({c: F.round(c, 6) for c in percent.columns if c != "_rows"}).withColumnRenamed("_rows", "n")


def validated(spark: SparkSession, folder: str) -> DataFrame:
    return quality.validate(table(spark, folder, "orders"), 1, ["o_orderkey", "o_custkey"], 10.0)


def profile(spark: SparkSession, folder: str) -> DataFrame:
    accounts = feed(spark, folder, "all_accounts").withColumn("opened", F.lit("2001-09-01").cast("timestamp_ntz"))
    tidy = quality.profile(accounts, "accounts")
    return tidy.withColumns({"mean": F.round("mean", 4), "null_percent": F.round("null_percent", 6)})


def suite(spark: SparkSession, folder: str) -> DataFrame:
    checks = [
        quality.Check("unique", "order_id"),
        quality.Check("not_null", "order_id"),
        quality.Check("not_null", "customer_id"),
        quality.Check("accepted_values", "ship_date", ["soon"]),
        quality.Check("cross_table", "store_id", reference=table(spark, folder, "supplier"), reference_column="s_suppkey"),
    ]
    return quality.run_suite(feed(spark, folder, "raw_orders"), checks)


def records_split(spark: SparkSession, folder: str, part: int) -> DataFrame:
    raw = feed(spark, folder, "raw_products").select("product_id", "product_name", "category", "price")
    return quality.split_valid(raw, "product_id bigint, product_name string, price double", ["product_id", "product_name"])[part]


REPORTS = """
    SELECT to_json(named_struct(
        'metadata', named_struct('invocation_id', concat('run-', l_orderkey),
                                 'generated_at', date_format(l_shipdate, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        'results', array(
            named_struct('unique_id', concat('test.shop.', lower(l_linestatus), '.unique_', l_partkey, '.', l_suppkey),
                         'status', CASE l_returnflag WHEN 'A' THEN 'pass' WHEN 'R' THEN 'fail' ELSE 'error' END,
                         'column_name', CASE WHEN l_linestatus = 'O' THEN 'id' END,
                         'adapter_response', CASE WHEN l_returnflag <> 'N' THEN named_struct('test_type', 'generic') END,
                         'timing', CASE WHEN l_returnflag = 'A' THEN array(named_struct('elapsed', l_tax)) END,
                         'message', CASE WHEN l_returnflag = 'R' THEN concat('Got ', l_linenumber, ' results') END,
                         'failures', l_linenumber),
            named_struct('unique_id', concat('model.m', l_partkey),
                         'status', CASE WHEN l_returnflag = 'N' THEN 'error' ELSE 'success' END,
                         'column_name', NULL, 'adapter_response', NULL, 'timing', NULL, 'message', 'model',
                         'failures', NULL)))) AS raw
    FROM {lineitem}
"""


def results_flatten(spark: SparkSession, folder: str) -> DataFrame:
    return testlog.flatten_text(query(spark, folder, REPORTS))


def failed_count(spark: SparkSession, folder: str) -> DataFrame:
    return testlog.failure_count(results_flatten(spark, folder))


def latest_results(spark: SparkSession, folder: str) -> DataFrame:
    results = results_flatten(spark, folder).withColumn("result_id", F.concat_ws("/", "result_id", "invocation_id", "rows_affected"))
    return testlog.latest(results, "fail", 25).select("result_id", "status", "run_timestamp")


HISTORY = """
    SELECT 'test.' || CAST(c_custkey AS STRING) AS result_id, 'run-1' AS invocation_id, c_name AS test_name,
           CASE WHEN c_acctbal < 0 THEN 'fail' ELSE 'pass' END AS status, c_acctbal AS execution_time,
           CASE WHEN c_acctbal < 0 THEN 'negative' END AS failure_details, c_nationkey AS rows_affected,
           TIMESTAMP '2001-01-01 00:00:00' AS run_timestamp
    FROM {customer}
"""
NEWER = """
    SELECT 'test.' || CAST(p_partkey AS STRING) AS result_id, 'run-2' AS invocation_id, p_name AS test_name,
           CASE WHEN p_retailprice > 950 THEN 'fail' ELSE 'pass' END AS status, p_retailprice AS execution_time,
           CASE WHEN p_retailprice > 950 THEN 'too much' END AS failure_details, p_size AS rows_affected,
           TIMESTAMP '2001-02-01 00:00:00' AS run_timestamp
    FROM {part}
"""


def _results(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    return query(spark, folder, sql).withColumn("run_timestamp", F.col("run_timestamp").cast("timestamp_ntz"))


def partial_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return testlog.merge_results(_results(spark, folder, HISTORY), _results(spark, folder, NEWER))


def registry_row(spark: SparkSession, folder: str) -> DataFrame:
    row = registry.registry_row(
        table(spark, folder, "lineitem"), "lineitem", "lake/lineitem", metadata={"layer": "raw"}, as_of=AS_OF
    )
    fields = F.from_json("schema_json", "fields array<struct<name:string, type:string>>")["fields"]
    return row.select(
        "name", "created_at", "source_type", "location", "row_count", "metadata_json",
        F.array_join(fields["name"], ",").alias("columns"),
    )


def partition_stats(spark: SparkSession, folder: str) -> DataFrame:
    return registry.partition_stats(table(spark, folder, "orders"), "orders", "o_orderstatus", "o_orderkey", "lake/orders")


QUERIES = {
    "dq_not_null": not_null,
    "dq_unique": unique,
    "dq_accepted_values": accepted_values,
    "dq_orphans": orphans,
    "dq_null_percent": null_percent,
    "dq_validated": validated,
    "dq_profile": profile,
    "dq_suite": suite,
    "dq_valid_records": lambda spark, folder: records_split(spark, folder, 0),
    "dq_rejected_records": lambda spark, folder: records_split(spark, folder, 1),
    "dbt_results_flatten": results_flatten,
    "failed_test_count": failed_count,
    "latest_results_topk": latest_results,
    "results_partial_upsert": partial_upsert,
    "registry_row": registry_row,
    "partition_stats": partition_stats,
}

FLAT = """
    SELECT 'test.shop.' || lower(l_linestatus) || '.unique_' || l_partkey || '.' || l_suppkey AS result_id,
           'run-' || l_orderkey AS invocation_id,
           'test.shop.' || lower(l_linestatus) || '.unique_' || l_partkey || '.' || l_suppkey AS test_unique_id,
           'unique_' || l_partkey AS test_name, CASE WHEN l_returnflag <> 'N' THEN 'generic' END AS test_type,
           lower(l_linestatus) AS model_name, CASE WHEN l_linestatus = 'O' THEN 'id' END AS column_name,
           CASE l_returnflag WHEN 'A' THEN 'pass' WHEN 'R' THEN 'fail' ELSE 'error' END AS status,
           CASE WHEN l_returnflag = 'A' THEN l_tax END AS execution_time,
           CASE WHEN l_returnflag = 'R' THEN 'Got ' || l_linenumber || ' results' END AS failure_details,
           l_linenumber AS rows_affected, l_shipdate AS run_timestamp
    FROM lineitem
    UNION ALL
    SELECT 'model.m' || l_partkey, 'run-' || l_orderkey, 'model.m' || l_partkey, 'model', NULL, NULL, NULL, 'error',
           NULL, 'model', NULL, l_shipdate
    FROM lineitem WHERE l_returnflag = 'N'
"""

ORACLES = {
    "dq_not_null": oracle("SELECT * FROM raw_orders WHERE customer_id IS NULL", raw_orders=FEEDS["raw_orders"]),
    "dq_unique": oracle(
        "SELECT customer_id, count(*) AS count FROM raw_orders GROUP BY 1 HAVING count(*) > 1",
        raw_orders=FEEDS["raw_orders"],
    ),
    "dq_accepted_values": oracle(
        """SELECT product_id, product_name, category, price FROM raw_products
           WHERE category NOT IN ('OA', 'OR', 'ECONOMY', 'PROMO')""",
        raw_products=FEEDS["raw_products"],
    ),
    "dq_orphans": oracle(
        """SELECT order_id, customer_id, store_id FROM raw_orders LEFT JOIN supplier ON customer_id = s_suppkey
           WHERE s_suppkey IS NULL""",
        raw_orders=FEEDS["raw_orders"],
    ),
    "dq_null_percent": oracle(
        "SELECT count(*) AS n, "
        + ", ".join(
            f"round(avg(CASE WHEN {c} IS NULL THEN 100.0::DOUBLE ELSE 0 END), 6) AS {c}"
            for c in ("customer_id", "first_name", "last_name", "email", "phone")
        )
        + " FROM raw_customers",
        raw_customers=FEEDS["raw_customers"],
    ),
    "dq_validated": "SELECT * FROM orders",
    "dq_profile": oracle(
        """
        SELECT 'accounts' AS step, 'id' AS column, 'numeric' AS kind, count(*) AS row_count, 4 AS column_count,
               min(id)::VARCHAR AS min, max(id)::VARCHAR AS max, round(avg(id), 4) AS mean,
               NULL::BIGINT AS distinct_count, count(*) - count(id) AS null_count,
               round((count(*) - count(id)) * 100.0::DOUBLE / count(*), 6) AS null_percent
        FROM all_accounts
        UNION ALL SELECT 'accounts', 'name', 'other', count(*), 4, NULL, NULL, NULL, count(DISTINCT name),
               count(*) - count(name), round((count(*) - count(name)) * 100.0::DOUBLE / count(*), 6) FROM all_accounts
        UNION ALL SELECT 'accounts', 'balance', 'numeric', count(*), 4, min(balance)::VARCHAR, max(balance)::VARCHAR,
               round(avg(balance), 4), NULL, count(*) - count(balance),
               round((count(*) - count(balance)) * 100.0::DOUBLE / count(*), 6) FROM all_accounts
        UNION ALL SELECT 'accounts', 'opened', 'datetime', count(*), 4, '2001-09-01 00:00:00', '2001-09-01 00:00:00',
               NULL, NULL, 0, 0.0 FROM all_accounts
        """,
        all_accounts=FEEDS["all_accounts"],
    ),
    "dq_suite": oracle(
        """
        SELECT check_name AS "check", column_name AS "column", failures,
               CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status
        FROM (SELECT 'unique_order_id' AS check_name, 'order_id' AS column_name,
                     (SELECT count(*) FROM (SELECT order_id FROM raw_orders GROUP BY 1 HAVING count(*) > 1)) AS failures
              UNION ALL SELECT 'not_null_order_id', 'order_id', count(*) FROM raw_orders WHERE order_id IS NULL
              UNION ALL SELECT 'not_null_customer_id', 'customer_id', count(*) FROM raw_orders WHERE customer_id IS NULL
              UNION ALL SELECT 'accepted_values_ship_date', 'ship_date', count(*) FROM raw_orders WHERE ship_date <> 'soon'
              UNION ALL SELECT 'cross_table_store_id', 'store_id', count(*) FROM raw_orders
                        WHERE store_id NOT IN (SELECT s_suppkey FROM supplier))
        """,
        raw_orders=FEEDS["raw_orders"],
    ),
    "dq_valid_records": oracle(
        """SELECT product_id, product_name, try_cast(price AS DOUBLE) AS price FROM raw_products
           WHERE product_id IS NOT NULL AND product_name IS NOT NULL AND try_cast(price AS DOUBLE) IS NOT NULL""",
        raw_products=FEEDS["raw_products"],
    ),
    "dq_rejected_records": oracle(
        """SELECT product_id, product_name, category, price FROM raw_products
           WHERE product_id IS NULL OR product_name IS NULL OR try_cast(price AS DOUBLE) IS NULL""",
        raw_products=FEEDS["raw_products"],
    ),
    "dbt_results_flatten": FLAT,
    "failed_test_count": f"SELECT count(*) AS failed FROM ({FLAT}) WHERE status IN ('fail', 'error')",
    "latest_results_topk": f"""
        SELECT result_id || '/' || invocation_id || '/' || rows_affected AS result_id, status, run_timestamp
        FROM ({FLAT}) WHERE status = 'fail' ORDER BY run_timestamp DESC, 1 LIMIT 25
    """,
    "results_partial_upsert": oracle(
        """
        SELECT coalesce(o.result_id, n.result_id) AS result_id, coalesce(o.invocation_id, n.invocation_id) AS invocation_id,
               coalesce(o.test_name, n.test_name) AS test_name,
               CASE WHEN n.result_id IS NULL THEN o.status ELSE n.status END AS status,
               CASE WHEN n.result_id IS NULL THEN o.execution_time ELSE n.execution_time END AS execution_time,
               CASE WHEN n.result_id IS NULL THEN o.failure_details ELSE n.failure_details END AS failure_details,
               CASE WHEN n.result_id IS NULL THEN o.rows_affected ELSE n.rows_affected END AS rows_affected,
               CASE WHEN n.result_id IS NULL THEN o.run_timestamp ELSE n.run_timestamp END AS run_timestamp
        FROM history o FULL JOIN newer n ON o.result_id = n.result_id
        """,
        history=HISTORY,
        newer=NEWER,
    ),
    "registry_row": f"""
        SELECT 'lineitem' AS name, TIMESTAMP '{AS_OF}' AS created_at, 'parquet' AS source_type,
               'lake/lineitem' AS location, count(*) AS row_count, '{{"layer": "raw"}}' AS metadata_json,
               'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,'
               || 'l_returnflag,l_linestatus,l_shipdate' AS columns
        FROM lineitem
    """,
    "partition_stats": """
        SELECT 'orders' AS dataset, o_orderstatus AS partition_key, min(o_orderkey)::VARCHAR AS min_value,
               max(o_orderkey)::VARCHAR AS max_value, count(*) AS row_count,
               'lake/orders/o_orderstatus=' || o_orderstatus AS storage_location, 'parquet' AS storage_type
        FROM orders GROUP BY o_orderstatus
    """,
}
