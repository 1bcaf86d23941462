"""Growth, bucketed and pruned tables, the reject route, model sets, stored marks and mergeable counts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import movement, retail
from checks.feeds import oracle, query, table
from tidemill.operators import records, sketches
from tidemill.operators.upsert import upsert
from tidemill.plans import retail as plans
from tidemill.sinks import models
from tidemill.sinks.buckets import read_buckets
from tidemill.sinks.tables import save_bucketed
from tidemill.sinks.versioned import upsert_table
from tidemill.sources import incremental, ranges
from tidemill.streaming import landing


def sales_growth(spark: SparkSession, folder: str) -> DataFrame:
    """Growth of sales with each customer as a store of its own: many months without sales, and stores with one."""
    orders = retail.orders(spark, folder).withColumn("store_id", F.col("customer_id"))
    mart = plans.sales_by_store_mart(orders, None, retail.stores(spark, folder).select("store_id").filter("false"), unique_orders=True)
    mart = mart.withColumn("total_sales", F.when(F.col("month") != 2, F.round("total_sales", 2)))
    grown = plans.sales_growth(mart.select("store_id", "year", "month", "total_sales"))
    return retail.rounded(grown, month_growth=6, year_growth=6)


def stream_bucket_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Last event per user in hash buckets: each batch of the stream rewrites only the buckets of its users."""
    name, root, checkpoint = f"last_event_{uuid.uuid4().hex}", movement.fresh(spark, "buckets"), movement.fresh(spark, "progress")

    def shape(batch: DataFrame) -> DataFrame:
        ordered = batch.withColumns({"_at": F.col("ts"), "_id": F.col("event_id")})
        return ordered.withColumn("ts", F.col("ts").cast("timestamp_ntz"))

    def load(stream: DataFrame) -> None:
        landing.upsert_new_files(stream, name, root, checkpoint, ["user_id"], ["_at", "_id"], shape, buckets=16)

    movement._two_drops(spark, folder, load)
    return read_buckets(spark, name)


def bucketed_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The upsert by id over a table in buckets of the id, which is read without a shuffle."""
    name = f"{movement.scratch_schema(spark)}.items"
    save_bucketed(query(spark, folder, movement.ITEMS), name, ["id"], 8)
    return upsert(spark.table(name), query(spark, folder, movement.BATCH), ["id"], movement.BATCH_ORDER)


RECORDS = """
    SELECT event_id, CASE event_id % 9
        WHEN 0 THEN concat('{"timestamp":', moment, ',"glucose":', user_id, ',"device":"dev-', user_id, '","type":"sgv","noise":2}')
        WHEN 1 THEN concat('{"timestamp":', moment, ',"device":"dev-', user_id, '","type":"sgv"}')
        WHEN 2 THEN concat('{"timestamp":', moment, ',"glucose":"12d","device":"dev-', user_id, '","type":"sgv"}')
        WHEN 3 THEN concat('{"timestamp":', moment, ',"glucose":"7.5","device":"dev-', user_id, '","type":"mbg","extra":[1,{"a":2}]}')
        WHEN 4 THEN concat('{"timestamp":', moment, ',"glucose":', user_id, ',"device":"dev-', user_id, '","type":"sgv","noise":1.5}')
        WHEN 5 THEN concat('{"timestamp":true,"glucose":', user_id, ',"device":', user_id, ',"type":"sgv"}')
        WHEN 6 THEN concat('{"timestamp":', moment, ',"glucose')
        WHEN 7 THEN concat('{"timestamp":null,"glucose":', user_id, ',"device":"dev-', user_id, '","type":"sgv"}')
        ELSE concat('{"timestamp":', moment, ',"glucose":-1e2,"device":"dev-', user_id, '","type":"sgv","noise":null}') END AS raw
    FROM (SELECT event_id, user_id, (event_id + 1) * 60000 AS moment FROM {events}) AS e
"""
READING = {"timestamp": "timestamp_ntz", "glucose": "double", "device": "string", "type": "string", "noise": "bigint"}


def _routed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    judged = records.judge_records(query(spark, folder, RECORDS), "raw", READING, ["timestamp", "glucose", "device", "type"], keep=["event_id"])
    return records.route_records(judged, "raw", movement.fresh(spark, "records"))


def json_records_good(spark: SparkSession, folder: str) -> DataFrame:
    return _routed(spark, folder)[0]


def json_records_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected records with their text and reasons, and the counts that the write observed."""
    _, rejected, counts = _routed(spark, folder)
    told = rejected.select("event_id", "raw", F.concat_ws("; ", "reasons").alias("reasons"))
    return told.withColumns({f"n_{k}": F.lit(n).cast("long") for k, n in counts.items()})


def range_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of a quarter, from those of 16 files whose recorded range meets it."""
    path, orders = movement.fresh(spark, "ranged"), table(spark, folder, "orders")
    orders.repartitionByRange(16, "o_orderdate").write.parquet(path)
    index = ranges.file_ranges(spark.read.parquet(path), "o_orderdate")
    upsert_table(index, name := f"ranges_{uuid.uuid4().hex}", movement.fresh(spark, "ranges"), ["file"])
    schema = ", ".join(f"{c} {kind}" for c, kind in orders.dtypes)
    return ranges.range_scan(spark, spark.table(name), "o_orderdate", schema, "1995-01-01", "1995-03-31")


MODELS = {
    "top": "SELECT segment, n, (SELECT max(n) FROM {s}.by_segment) AS most FROM {s}.by_segment WHERE segment IN (SELECT segment FROM {s}.wanted)",
    "wanted": "WITH top AS (SELECT DISTINCT segment FROM {s}.base) SELECT segment FROM top WHERE segment <> 'BUILDING'",
    "by_segment": "SELECT segment, count(*) AS n FROM {s}.base GROUP BY segment",
    "base": "SELECT c_mktsegment AS segment FROM {s}.customers",
}


def model_graph(spark: SparkSession, folder: str) -> DataFrame:
    """Four models given with the last first, one of them a table."""
    schema = movement.scratch_schema(spark)
    table(spark, folder, "customer").write.saveAsTable(f"{schema}.customers")
    texts = {f"{schema}.{k}": sql.format(s=schema) for k, sql in MODELS.items()}
    models.build_models(spark, texts, tables={f"{schema}.by_segment"})
    return spark.table(f"{schema}.top")


def stored_mark(spark: SparkSession, folder: str) -> DataFrame:
    """Orders loaded in two runs; a run between them fails, so its rows come with the next."""
    name, root, state = f"orders_{uuid.uuid4().hex}", movement.fresh(spark, "orders"), movement.fresh(spark, "marks")
    marks, orders = f"marks_{uuid.uuid4().hex}", table(spark, folder, "orders")

    def load(rows: DataFrame) -> None:
        upsert_table(rows, name, root, ["o_orderkey"])

    def fail(rows: DataFrame) -> None:
        raise OSError("the target is away")

    incremental.load_new_rows(orders.filter("o_orderkey < 1000"), "orders", load, marks, state, "o_orderkey")
    try:
        incremental.load_new_rows(orders, "orders", fail, marks, state, "o_orderkey")
    except OSError:
        incremental.load_new_rows(orders, "orders", load, marks, state, "o_orderkey")
    last = incremental.stored_mark(spark, marks, "orders")
    return spark.table(name).select("o_orderkey", "o_totalprice", F.lit(last).cast("long").alias("mark"))


def monthly_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Customers per order status from sketches by month, beside the exact count: within four standard errors."""
    orders = table(spark, folder, "orders").withColumn("month", F.date_trunc("month", "o_orderdate"))
    monthly = sketches.sketch_distinct(orders, ["o_orderstatus", "month"], "o_custkey")
    estimate = sketches.merge_distinct(monthly, ["o_orderstatus"])
    exact = orders.groupBy("o_orderstatus").agg(F.countDistinct("o_custkey").alias("customers"))
    off = F.abs(F.col("distinct_estimate") - F.col("customers"))
    return exact.join(estimate, "o_orderstatus").select("o_orderstatus", "customers", (off <= 4 * sketches.relative_error() * F.col("customers")).alias("close"))


QUERIES = {f.__name__: f for f in (
    sales_growth, stream_bucket_upsert, bucketed_upsert, json_records_good, json_records_rejected, range_scan, model_graph,
    stored_mark, monthly_distinct,
)}

ORACLES = {
    "sales_growth": oracle(
        """
        SELECT n.*, p.total_sales AS previous_month_sales, y.total_sales AS previous_year_sales,
               round((n.total_sales - p.total_sales) / nullif(p.total_sales, 0), 6) AS month_growth,
               round((n.total_sales - y.total_sales) / nullif(y.total_sales, 0), 6) AS year_growth
        FROM mart n LEFT JOIN mart p ON p.store_id = n.store_id AND p.year * 12 + p.month = n.year * 12 + n.month - 1
             LEFT JOIN mart y ON y.store_id = n.store_id AND y.year = n.year - 1 AND y.month = n.month
        """,
        **retail._views("clean_orders"),
        mart="""
        SELECT store_id, year, month, CASE WHEN month <> 2 THEN total_sales END AS total_sales
        FROM (SELECT customer_id AS store_id, CAST(year(order_date) AS INT) AS year, CAST(month(order_date) AS INT) AS month, round(sum(order_total), 2) AS total_sales
              FROM clean_orders WHERE customer_id IS NOT NULL AND order_date IS NOT NULL GROUP BY ALL)
        """,
    ),
    "stream_bucket_upsert": movement.ORACLES["stream_incremental_upsert"],
    "bucketed_upsert": movement.ORACLES["upsert_by_id"],
    "json_records_good": """
        SELECT event_id, epoch_ms((event_id + 1) * 60000) AS timestamp,
               CASE event_id % 9 WHEN 0 THEN CAST(user_id AS DOUBLE) WHEN 3 THEN 7.5 ELSE -100.0 END AS glucose, 'dev-' || user_id AS device,
               CASE event_id % 9 WHEN 3 THEN 'mbg' ELSE 'sgv' END AS type, CASE event_id % 9 WHEN 0 THEN 2::BIGINT END AS noise
        FROM events WHERE event_id % 9 IN (0, 3, 8)
    """,
    "json_records_rejected": oracle(
        """
        SELECT event_id, raw, CASE event_id % 9 WHEN 1 THEN 'glucose is missing' WHEN 2 THEN 'glucose is no double' WHEN 4 THEN 'noise is no bigint'
                    WHEN 5 THEN 'timestamp is no timestamp_ntz; device is no string' WHEN 6 THEN 'no JSON object' ELSE 'timestamp is missing' END AS reasons,
               (SELECT count(*) FROM events WHERE event_id % 9 IN (0, 3, 8)) AS n_good, (SELECT count(*) FROM events WHERE event_id % 9 NOT IN (0, 3, 8)) AS n_rejected
        FROM records WHERE event_id % 9 NOT IN (0, 3, 8)
        """,
        records=RECORDS,
    ),
    "range_scan": "SELECT * FROM orders WHERE o_orderdate BETWEEN '1995-01-01' AND '1995-03-31'",
    "model_graph": """
        WITH by_segment AS (SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1)
        SELECT segment, n, (SELECT max(n) FROM by_segment) AS most FROM by_segment WHERE segment <> 'BUILDING'
    """,
    "stored_mark": "SELECT o_orderkey, o_totalprice, max(o_orderkey) OVER () AS mark FROM orders",
    "monthly_distinct": "SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, true AS close FROM orders GROUP BY 1",
}
