"""Whole-table queries of copies, views, sources in document form, configured loads and record sets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import glucose as sets
from checks.feeds import query, table
from checks.movement import fresh, scratch_schema
from tidemill.functions.jsons import row_as_variant, variant_columns
from tidemill.operators.rows import SEQ, union_all
from tidemill.plans import flow, forge, glucose
from tidemill.sinks import files as file_sinks
from tidemill.sinks import tables as table_sinks
from tidemill.sources import landed
from tidemill.sources.files import spread
from tidemill.sources.pages import read_json_pages
from tidemill.sources.raw_layer import load_raw
from tidemill.sources.tables import read_source, read_table

ORDER = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


def variant_copy(spark: SparkSession, folder: str) -> DataFrame:
    """Each order's VARIANT copy alone goes to Parquet; all its members come back by path."""
    path = fresh(spark, "variant")
    row_as_variant(table(spark, folder, "orders")).select("raw_data").write.parquet(path)
    return variant_columns(spark.read.parquet(path), ORDER)


def union_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Three tables with unlike columns as one."""
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    suppliers = table(spark, folder, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return union_all(customers, suppliers, table(spark, folder, "region").select(F.col("r_name").alias("name")))


def view_of_table(spark: SparkSession, folder: str) -> DataFrame:
    """A model table of all brands, and a model view over all of it."""
    schema = scratch_schema(spark)
    table(spark, folder, "part").createOrReplaceTempView("whole_part")
    table_sinks.materialize(spark, f"{schema}.brands", "SELECT p_brand, count(*) AS n, sum(p_size) AS sizes FROM whole_part GROUP BY p_brand", "table")
    table_sinks.materialize(spark, f"{schema}.all_brands", f"SELECT * FROM {schema}.brands", "view")
    return spark.table(f"{schema}.all_brands")


def source_all_columns(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh(spark, "kind")
    table(spark, folder, "supplier").write.json(path)
    return read_source(spark, "json", file=path, lines=True, schema="s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")


def treatment_copies(spark: SparkSession, folder: str) -> DataFrame:
    """All members of the JSON copies that go with stored treatments."""
    rows = glucose.to_target("treatments", glucose.treatments(query(spark, folder, sets.TREATMENTS)))
    copy = "id string, type string, enteredBy string, insulin double, carbs double, duration int, rate double, percent int, absolute double, notes string"
    return rows.select(F.inline(F.array(F.from_json("raw_data", copy))))


def csv_table_load(spark: SparkSession, folder: str) -> DataFrame:
    path, name = fresh(spark, "load"), f"{scratch_schema(spark)}.lines"
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    file_sinks.save_csv(lines, path)
    table_sinks.load_csv(spark, name, path)
    return read_table(spark, name).select(F.col("l_orderkey").cast("bigint"), F.col("l_linenumber").cast("int"), F.col("l_quantity").cast("double"), "l_returnflag")


def _pages(df: DataFrame, key: str, name: str | None, path: str) -> None:
    """One JSON document a file with the rows of a thousand keys: an array, or an object that holds it under a name."""
    pages = df.groupBy(F.floor(F.col(key) / 1000)).agg(F.collect_list(F.struct(*df.columns)).alias("rows"))
    text = F.to_json("rows") if name is None else F.concat(F.lit('{"' + name + '":'), F.to_json("rows"), F.lit("}"))
    pages.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def json_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Users from files that hold an array each, and from files that hold one object."""
    arrays, objects = fresh(spark, "arrays"), fresh(spark, "objects")
    users = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("login"), F.concat(F.lit("u/"), "c_nationkey").alias("url"), F.concat(F.lit("h/"), "c_custkey").alias("html_url"),
    )
    _pages(users, "id", None, arrays)
    one = spread(table(spark, folder, "supplier")).select((-F.col("s_suppkey")).alias("id"), F.col("s_name").alias("login"), F.lit("u").alias("url"), F.lit("h").alias("html_url"))
    one.write.option("maxRecordsPerFile", 1).json(objects)
    read = [forge.read_records(spark, path, "users") for path in (arrays, objects)]
    return union_all(*[df.select(F.col("id").cast("bigint"), *[F.col(c).cast("string") for c in ("login", "url", "html_url")]) for df in read])


def raw_layer(spark: SparkSession, folder: str) -> DataFrame:
    """All five raw feeds loaded as tables: rows, and the sum of their keys."""
    landing, schema = fresh(spark, "raw"), scratch_schema(spark)
    keys = {"customers": ("customer", "c_custkey"), "orders": ("orders", "o_orderkey"), "products": ("part", "p_partkey")}
    for name, (source, key) in keys.items():
        _pages(table(spark, folder, source).select(key), key, name, f"{landing}/{name}")
    file_sinks.save_csv(table(spark, folder, "supplier").select("s_suppkey", "s_name"), f"{landing}/store_locations.csv")
    file_sinks.save_csv(table(spark, folder, "lineitem").select("l_orderkey", "l_quantity"), f"{landing}/inventory.csv")
    load_raw(spark, landing, schema)
    found = {**{name: key for name, (_, key) in keys.items()}, "store_locations": "s_suppkey", "inventory": "l_orderkey"}
    parts = [
        spark.table(f"{schema}.raw_{name}").agg(F.count(F.lit(1)).alias("n"), F.sum(key).cast("long").alias("total")).select(F.lit(name).alias("feed"), "n", "total")
        for name, key in found.items()
    ]
    return union_all(*parts)


def record_sets_load(spark: SparkSession, folder: str) -> DataFrame:
    """The four record sets from their landing folder to their tables, twice: the second load changes nothing.

    An entry whose date is no date lies in no range of time, so it is not loaded.
    """
    landing, schema, root = fresh(spark, "sets"), scratch_schema(spark), fresh(spark, "targets")
    texts = {"entries": sets.ENTRIES, "treatments": sets.TREATMENTS, "profiles": sets.PROFILES, "devicestatus": sets.DEVICE_STATUS}
    for name, text in texts.items():
        query(spark, folder, text).select(F.col("raw").alias("value")).write.text(f"{landing}/{name}")
    loaded = 0
    for _ in range(2):
        bundle = glucose.transform(glucose.read_bundle(spark, landing, as_of="2100-01-01", days=73000))
        loaded = glucose.load(spark, bundle, root, schema)
    parts = [
        spark.table(f"{schema}.{target}").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), F.max("id").alias("last")).select(F.lit(name).alias("name"), "n", "first", "last")
        for name, target in glucose.TARGET_TABLES.items()
    ]
    return union_all(*parts).withColumn("loaded", F.lit(loaded).cast("long"))


def configured_load(spark: SparkSession, folder: str) -> DataFrame:
    """A flow that is wholly made from its configuration, loader included."""
    name = f"{scratch_schema(spark)}.open_orders"
    config = {
        "name": "open orders",
        "extractor": {"type": "parquet", "config": {"file": f"{folder}/orders.parquet"}},
        "transformers": [
            {"type": "filter", "config": {"field": "o_orderstatus", "value": "O"}},
            {"type": "rename", "config": {"mappings": {"o_orderkey": "order_id", "o_totalprice": "total"}}},
        ],
        "loader": {"type": "database", "config": {"table": name, "mode": "replace"}},
    }
    flow.flow_from_config(spark, config).run()
    return read_table(spark, name)


def _documents(spark: SparkSession, folder: str, opening: str, closing: str) -> str:
    """All orders in 16 JSON documents, each one array in one file, with brackets and quotes inside texts.

    Orders without a customer are one more document. A task writes a document as its rows come, without sorting them.
    """

    def framed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = True
        for texts in (batch.column(0) for batch in batches if batch.num_rows):
            marks = pa.array([opening if empty else ",", *[","] * (len(texts) - 1)])
            yield pa.record_batch([pc.binary_join_element_wise(marks, texts, "")], ["value"])
            empty = False
        if not empty:
            yield pa.record_batch([pa.array([closing])], ["value"])

    path = fresh(spark, "documents")
    text = F.to_json(F.struct("o_orderkey", "o_custkey", "o_totalprice", F.concat(F.lit('{"'), "o_orderpriority", F.lit('"]}\\')).alias("note")))
    lines = table(spark, folder, "orders").select(text.alias("value"), F.coalesce(F.pmod("o_custkey", F.lit(16)), F.lit(16)).cast("int").alias("bucket"))
    lines.repartitionById(17, "bucket").select("value").mapInArrow(framed, "value string").write.text(path)
    return path


DOCUMENT = "o_orderkey bigint, o_custkey bigint, o_totalprice double, note string"


def split_json_arrays(spark: SparkSession, folder: str) -> DataFrame:
    return read_json_pages(spark, _documents(spark, folder, "[", "]"), DOCUMENT).drop(SEQ)


def split_json_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """The same under a member of an object that has other members around it."""
    path = _documents(spark, folder, '{"page": {"orders": [{"no": 1}]}, "orders" : [', '], "next": {"token": "}"}}')
    return landed.read_envelope(spark, path, "orders", DOCUMENT, split=True).drop(SEQ)


QUERIES = {
    "variant_copy": variant_copy,
    "union_accounts": union_accounts,
    "view_of_table": view_of_table,
    "source_all_columns": source_all_columns,
    "ns_treatment_copies": treatment_copies,
    "csv_table_load": csv_table_load,
    "json_documents": json_documents,
    "raw_layer": raw_layer,
    "ns_record_sets_load": record_sets_load,
    "configured_load": configured_load,
    "split_json_arrays": split_json_arrays,
    "split_json_envelopes": split_json_envelopes,
}

_NOTED = """SELECT o_orderkey, o_custkey, o_totalprice, '{"' || o_orderpriority || '"]}\\' AS note FROM orders"""

ORACLES = {
    "variant_copy": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "union_accounts": """
        SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
        UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
        UNION ALL SELECT NULL, r_name, NULL FROM region
    """,
    "view_of_table": "SELECT p_brand, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS sizes FROM part GROUP BY p_brand",
    "source_all_columns": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "ns_treatment_copies": f"""
        SELECT id, type, enteredBy, insulin, carbs, duration, rate, percent, absolute, notes FROM ({sets.WIDE})
    """,
    "csv_table_load": "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
    "json_documents": """
        SELECT c_custkey AS id, c_name AS login, 'u/' || c_nationkey AS url, 'h/' || c_custkey AS html_url FROM customer
        UNION ALL SELECT -s_suppkey, s_name, 'u', 'h' FROM supplier
    """,
    "raw_layer": """
        SELECT 'customers' AS feed, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS total FROM customer
        UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders
        UNION ALL SELECT 'products', count(*), CAST(sum(p_partkey) AS BIGINT) FROM part
        UNION ALL SELECT 'store_locations', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier
        UNION ALL SELECT 'inventory', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM lineitem
    """,
    "ns_record_sets_load": """
        WITH parts AS (
            SELECT 'entries' AS name, count(*) AS n, min('e' || event_id) AS first, max('e' || event_id) AS last FROM events
            WHERE event_type IN ('click', 'purchase')
            UNION ALL SELECT 'treatments', count(*), min('t' || event_id), max('t' || event_id) FROM events
            UNION ALL SELECT 'profiles', count(*), min('p' || c_custkey), max('p' || c_custkey) FROM customer
            UNION ALL SELECT 'devicestatus', count(*), min('d' || event_id), max('d' || event_id) FROM events
        )
        SELECT *, CAST(sum(n) OVER () AS BIGINT) AS loaded FROM parts
    """,
    "configured_load": """
        SELECT * EXCLUDE (o_orderkey, o_totalprice), o_orderkey AS order_id, o_totalprice AS total
        FROM orders WHERE o_orderstatus = 'O'
    """,
    "split_json_arrays": _NOTED,
    "split_json_envelopes": _NOTED,
}
