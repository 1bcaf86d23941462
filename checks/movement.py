"""Sources, sinks, SQL, incremental loads, flows and streams.

Where a query needs files, Spark writes them from the given tables into a new folder below the
shared work folder, and reads them back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.feeds import FEEDS, feed, oracle, query, table
from tidemill.operators import rows
from tidemill.operators.upsert import upsert
from tidemill.plans import flow, sample
from tidemill.session import work_folder
from tidemill.sinks import files as file_sinks
from tidemill.sinks import tables as table_sinks
from tidemill.sinks.routed import load_entity_file, load_entity_table, target_path, target_table
from tidemill.sinks.versioned import upsert_partitions, upsert_table
from tidemill.sources import files, incremental, landed
from tidemill.sources.tables import read_source, read_table
from tidemill.streaming import landing


def fresh(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_schema(spark: SparkSession) -> str:
    """A new catalog schema whose tables lie in the work folder."""
    schema = f"scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{work_folder(spark)}/{schema}'")
    return schema


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh(spark, "csv")
    file_sinks.save_csv(feed(spark, folder, "raw_stores").drop("_shipped", "_order", "_line", "_part"), path)
    return files.read_csv(spark, path, text_columns=["phone"])


def csv_export(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh(spark, "export")
    table(spark, folder, "lineitem").createOrReplaceTempView("exported_lines")
    table_sinks.export_query_to_csv(
        spark, "SELECT l_orderkey, l_quantity, l_returnflag FROM exported_lines", path
    )
    return files.read_csv(spark, path)


def json_envelope_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Response pages, each a document with an array of an order and its repeat under a negative key."""
    path = fresh(spark, "envelope")
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date")
    repeat = F.struct((-F.col("o_orderkey")).alias("o_orderkey"), "o_custkey", day)
    pages = table(spark, folder, "orders").select(F.array(F.struct("o_orderkey", "o_custkey", day), repeat).alias("orders"))
    file_sinks.save_json(pages, path)
    return landed.since(landed.read_envelope(spark, path, "orders", lines=True), "1998-01-01").drop("_seq")


def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh(spark, "lines")
    table(spark, folder, "documents").select(F.col("text").alias("value")).write.text(path)
    lines = files.read_lines(spark, path)
    return lines.groupBy(F.md5("value").alias("digest")).agg(F.count(F.lit(1)).alias("n"))


def glob_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Only the files with the extension count, at any depth."""
    path = fresh(spark, "glob")
    orders = table(spark, folder, "orders")
    orders.select("o_orderkey", "o_custkey").write.parquet(f"{path}/2001/a")
    orders.select("o_orderkey", "o_custkey").write.json(f"{path}/2001/b")
    return files.select_files(spark, path, "parquet", extension=".PARQUET", recursive=True)


def source_by_kind(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh(spark, "kind")
    table(spark, folder, "supplier").write.json(path)
    return read_source(spark, "json", file=path, lines=True, schema="s_suppkey bigint, s_name string, s_acctbal double")


def incremental_scan(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    mark = incremental.read_mark(table(spark, folder, "part"), column="p_partkey")
    return incremental.new_rows(orders, mark, "o_orderkey")


def incremental_state(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.next_mark(table(spark, folder, "orders"), 5, "o_orderkey")


BATCH = """
    SELECT l_orderkey AS id, l_returnflag AS name, l_extendedprice AS price, l_shipdate AS _shipped, l_linenumber AS _line,
           l_partkey AS _part
    FROM {lineitem}
"""
ITEMS = "SELECT p_partkey AS id, p_name AS name, p_retailprice AS price FROM {part}"
STATUSES = "SELECT o_orderkey AS id, o_totalprice AS price, o_orderstatus AS status FROM {orders}"
CHANGES = """
    SELECT l_orderkey AS id, l_extendedprice AS price, l_returnflag AS status, l_linenumber AS _line, l_partkey AS _part,
           l_shipdate AS _shipped
    FROM {lineitem}
"""
PLACES = """
    SELECT c_custkey AS id, c_name AS name, CASE c_nationkey % 6 WHEN 0 THEN 'a b' WHEN 1 THEN 'b:c' WHEN 2 THEN 'x/y'
        WHEN 3 THEN '50%' WHEN 4 THEN 'O' || chr(39) || 'Neil' END AS place
    FROM {customer}
"""
MOVES = """
    SELECT c_custkey AS id, c_phone_or_name AS name, CASE c_nationkey % 3 WHEN 0 THEN 'b:c' WHEN 1 THEN c_mktsegment END AS place
    FROM (SELECT c_custkey, lower(c_name) AS c_phone_or_name, c_nationkey, c_mktsegment FROM {customer}) AS c
"""
BATCH_ORDER = ("_shipped", "_line", "_part")


def upsert_by_id(spark: SparkSession, folder: str) -> DataFrame:
    return upsert(query(spark, folder, ITEMS), query(spark, folder, BATCH), ["id"], BATCH_ORDER)


def upsert_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same through a table: a first load, then the batch."""
    root, name = fresh(spark, "items"), f"items_{uuid.uuid4().hex}"
    upsert_table(query(spark, folder, ITEMS), name, root, ["id"])
    upsert_table(query(spark, folder, BATCH), name, root, ["id"], BATCH_ORDER)
    return spark.table(name)


def upsert_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    """Orders stored by status; the first line of each order then moves some of them to another status."""
    name, root = f"{scratch_schema(spark)}.orders", fresh(spark, "orders")
    upsert_partitions(query(spark, folder, STATUSES), name, root, ["id"], "status")
    upsert_partitions(query(spark, folder, CHANGES), name, root, ["id"], "status", ["_line", "_part", "_shipped", "price"])
    return spark.table(name)


def csv_misfits(spark: SparkSession, folder: str) -> DataFrame:
    """Prices of the catalogue feed read as numbers; texts that are none become null on request."""
    path = fresh(spark, "misfits")
    feed(spark, folder, "raw_products").select("product_id", F.regexp_replace("product_name", "^\\s+|\\s+$", "|").alias("product_name"), "price").write.csv(
        path, header=True, quote='"', escape='"', quoteAll=True
    )
    return files.read_csv(spark, path, schema="product_id bigint, product_name string, price double", misfits="null")


def partition_values(spark: SparkSession, folder: str) -> DataFrame:
    """Customers stored by values with blanks, colons, slashes, quotes, percent signs and nulls; then all of them move twice."""
    name, root = f"{scratch_schema(spark)}.customers", fresh(spark, "values")
    for sql in (PLACES, MOVES, PLACES):
        upsert_partitions(query(spark, folder, sql), name, root, ["id"], "place", order=())
    upsert_partitions(query(spark, folder, MOVES).filter("id % 2 = 0"), name, root, ["id"], "place", order=())
    return spark.table(name)


def table_append(spark: SparkSession, folder: str) -> DataFrame:
    name = f"{scratch_schema(spark)}.customers"
    table_sinks.save_table(table(spark, folder, "customer"), name, "replace")
    table_sinks.save_table(table(spark, folder, "customer").filter("c_acctbal < 0"), name, "append")
    table_sinks.save_table(table(spark, folder, "customer"), name, "ignore")
    return read_table(spark, name)


def routed_table(spark: SparkSession, folder: str) -> DataFrame:
    schema = scratch_schema(spark)
    load_entity_table(table(spark, folder, "orders"), "pulls", schema)
    return spark.table(f"{schema}.{target_table('pulls')}")


def routed_file(spark: SparkSession, folder: str) -> DataFrame:
    root = fresh(spark, "routed")
    load_entity_file(table(spark, folder, "supplier"), "org", "teams", root)
    return files.read_json_lines(spark, target_path("org", "teams", root))


def sql_parameters(spark: SparkSession, folder: str) -> DataFrame:
    for name in ("orders", "customer"):
        table(spark, folder, name).createOrReplaceTempView(f"sql_{name}")
    text = """
        SELECT c_mktsegment, count(*) AS n, max(o_totalprice) AS top
        FROM sql_orders JOIN sql_customer ON o_custkey = c_custkey
        WHERE o_orderdate >= :since AND o_orderstatus = :status GROUP BY c_mktsegment
    """
    return table_sinks.run_sql(spark, text, {"since": "1998-01-01", "status": "F"})


def table_and_view(spark: SparkSession, folder: str) -> DataFrame:
    """A model table, and a model view that selects from it."""
    schema = scratch_schema(spark)
    table(spark, folder, "part").createOrReplaceTempView("model_part")
    counts = "SELECT p_brand, count(*) AS n FROM model_part GROUP BY p_brand"
    table_sinks.materialize(spark, f"{schema}.by_brand", counts, "table")
    table_sinks.materialize(spark, f"{schema}.large_brand", f"SELECT * FROM {schema}.by_brand WHERE n > 70", "view")
    return spark.table(f"{schema}.large_brand")


def model_union_all(spark: SparkSession, folder: str) -> DataFrame:
    return feed(spark, folder, "all_accounts")


def model_filter(spark: SparkSession, folder: str) -> DataFrame:
    return sample.second_model(feed(spark, folder, "all_accounts"))


def configured_flow(spark: SparkSession, folder: str) -> DataFrame:
    config = {
        "name": "open orders",
        "extractor": {"type": "parquet", "config": {"file": f"{folder}/orders.parquet"}},
        "transformers": [
            {"type": "filter", "config": {"field": "o_orderstatus", "value": "O"}},
            {"type": "rename", "config": {"mappings": {"o_orderkey": "order_id", "o_totalprice": "total"}}},
        ],
    }
    return flow.flow_from_config(spark, config).run()


def composed_flow(spark: SparkSession, folder: str) -> DataFrame:
    """Validated steps: upper-case names, a mark, a suffix, and a load into a replaced table."""
    from tidemill.operators.quality import require_fields

    name = f"{scratch_schema(spark)}.names"
    steps = [
        flow.Step(rows.upper_names, validate_input=require_fields),
        flow.Step(rows.mark_transformed),
        lambda df: rows.suffix_text(df, "name"),
    ]
    source = query(spark, folder, "SELECT c_custkey AS id, lower(c_name) AS name, c_acctbal FROM {customer}")
    flow.Flow("names", lambda: source, steps, load=lambda df: flow.replace_load(df, name)).run()
    return spark.table(name)


DROPS = """
    SELECT event_id, user_id, value, CAST(ts AS TIMESTAMP) AS ts, event_type FROM {events}
"""
DROP_SCHEMA = "event_id bigint, user_id bigint, value double, ts timestamp, event_type string"


def _two_drops(spark: SparkSession, folder: str, load) -> None:
    """Land all events in two drops, by kind of event, and run the load after each."""
    inbox = fresh(spark, "inbox")
    events = query(spark, folder, DROPS)
    early = F.col("event_type").isin("click", "view")
    for drop in (events.filter(early), events.filter(~early)):
        drop.write.mode("append").parquet(inbox)
        load(landing.landing_stream(spark, inbox, DROP_SCHEMA, "parquet"))


def stream_incremental_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Last event per user, kept up to date by a stream over landed files."""
    name, root, checkpoint = f"last_event_{uuid.uuid4().hex}", fresh(spark, "latest"), fresh(spark, "progress")

    def load(stream: DataFrame) -> None:
        landing.upsert_new_files(stream, name, root, checkpoint, ["user_id"], ["_at", "_id"], shape)

    def shape(batch: DataFrame) -> DataFrame:
        ordered = batch.withColumns({"_at": F.col("ts"), "_id": F.col("event_id")})
        return ordered.withColumn("ts", F.col("ts").cast("timestamp_ntz"))

    _two_drops(spark, folder, load)
    return spark.table(name)


def stream_append(spark: SparkSession, folder: str) -> DataFrame:
    target, checkpoint = fresh(spark, "appended"), fresh(spark, "progress")
    _two_drops(spark, folder, lambda stream: landing.append_new_files(stream, target, checkpoint))
    appended = files.read_parquet(spark, target)
    return appended.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


QUERIES = {
    "csv_round_trip": csv_round_trip,
    "csv_export": csv_export,
    "json_envelope_scan": json_envelope_scan,
    "text_lines": text_lines,
    "glob_scan": glob_scan,
    "source_by_kind": source_by_kind,
    "incremental_scan": incremental_scan,
    "incremental_state": incremental_state,
    "upsert_by_id": upsert_by_id,
    "upsert_stored": upsert_stored,
    "upsert_partitioned": upsert_partitioned,
    "csv_misfits": csv_misfits,
    "partition_values": partition_values,
    "table_append": table_append,
    "routed_table": routed_table,
    "routed_file": routed_file,
    "sql_parameters": sql_parameters,
    "table_and_view": table_and_view,
    "model_union_all": model_union_all,
    "model_filter": model_filter,
    "configured_flow": configured_flow,
    "composed_flow": composed_flow,
    "stream_incremental_upsert": stream_incremental_upsert,
    "stream_append": stream_append,
}

_UPSERT = oracle(
    """
    SELECT id, name, price FROM items WHERE id NOT IN (SELECT id FROM batch)
    UNION ALL
    SELECT id, name, price FROM (SELECT * FROM batch QUALIFY row_number() OVER (
        PARTITION BY id ORDER BY _shipped DESC, _line DESC, _part DESC) = 1)
    """,
    items=ITEMS,
    batch=BATCH,
)

ORACLES = {
    "csv_round_trip": oracle(
        """SELECT store_id, store_name, address, city, state, zip_code, country, phone, opening_date, closing_date
           FROM raw_stores""",
        raw_stores=FEEDS["raw_stores"],
    ),
    "csv_export": "SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem",
    "json_envelope_scan": """
        SELECT unnest([o_orderkey, -o_orderkey]) AS o_orderkey, o_custkey, o_orderdate::DATE::VARCHAR AS order_date
        FROM orders WHERE o_orderdate >= '1998-01-01'
    """,
    "text_lines": r"""
        SELECT md5(line) AS digest, count(*) AS n
        FROM (SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents WHERE text IS NOT NULL) GROUP BY 1
    """,
    "glob_scan": "SELECT o_orderkey, o_custkey FROM orders",
    "source_by_kind": "SELECT s_suppkey, s_name, s_acctbal FROM supplier",
    "incremental_scan": "SELECT * FROM orders WHERE o_orderkey > (SELECT max(p_partkey) FROM part)",
    "incremental_state": "SELECT coalesce(max(o_orderkey), 5) AS state FROM orders",
    "upsert_by_id": _UPSERT,
    "upsert_stored": _UPSERT,
    "upsert_partitioned": oracle(
        """
        SELECT id, price, status FROM statuses WHERE id NOT IN (SELECT id FROM changes)
        UNION ALL
        SELECT id, price, status FROM (SELECT * FROM changes QUALIFY row_number() OVER (
            PARTITION BY id ORDER BY _line DESC, _part DESC, _shipped DESC, price DESC) = 1)
        """,
        statuses=STATUSES,
        changes=CHANGES,
    ),
    "csv_misfits": oracle(
        """
        SELECT product_id, regexp_replace(product_name, '^\\s+|\\s+$', '|', 'g') AS product_name, TRY_CAST(price AS DOUBLE) AS price
        FROM raw_products
        """,
        raw_products=FEEDS["raw_products"],
    ),
    "partition_values": oracle(
        "SELECT * FROM places WHERE id % 2 <> 0 UNION ALL SELECT * FROM moves WHERE id % 2 = 0", places=PLACES, moves=MOVES
    ),
    "table_append": "SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_acctbal < 0",
    "routed_table": "SELECT * FROM orders",
    "routed_file": "SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, s_acctbal FROM supplier",
    "sql_parameters": """
        SELECT c_mktsegment, count(*) AS n, max(o_totalprice) AS top FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderdate >= '1998-01-01' AND o_orderstatus = 'F' GROUP BY c_mktsegment
    """,
    "table_and_view": "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand HAVING count(*) > 70",
    "model_union_all": oracle("SELECT * FROM all_accounts", all_accounts=FEEDS["all_accounts"]),
    "model_filter": oracle("SELECT * FROM all_accounts WHERE id = 1", all_accounts=FEEDS["all_accounts"]),
    "configured_flow": """
        SELECT o_orderkey AS order_id, o_custkey, o_orderstatus, o_totalprice AS total, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderstatus = 'O'
    """,
    "composed_flow": "SELECT c_custkey AS id, upper(c_name) || '_transformed' AS name, true AS transformed FROM customer",
    "stream_incremental_upsert": """
        SELECT event_id, user_id, value, ts, event_type
        FROM (SELECT *, event_type NOT IN ('click', 'view') AS late FROM events)
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY late DESC, ts DESC, event_id DESC) = 1
    """,
    "stream_append": "SELECT event_id, user_id, value, ts, event_type FROM events",
}
