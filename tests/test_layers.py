"""Growth, buckets, reject route, ranges, model sets, marks, sketches, and numbers that are none."""

import glob
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tidemill.errors import ConfigError
from tidemill.operators import records, sketches
from tidemill.operators.rows import keep_last
from tidemill.operators.upsert import upsert
from tidemill.plans import glucose, retail
from tidemill.sinks import models, registry
from tidemill.sinks.buckets import BUCKET, read_buckets, upsert_buckets
from tidemill.sinks.tables import save_bucketed
from tidemill.sources import incremental, ranges


def name(prefix):
    return f"{prefix}_{uuid.uuid4().hex}"


def test_growth_follows_the_calendar(rows):
    data = [(1, 2023, 11, 10.0), (1, 2023, 12, 20.0), (1, 2024, 1, 30.0), (1, 2024, 3, 60.0), (1, 2024, 12, 5.0), (2, 2024, 1, 7.0), (3, 2024, 1, 0.0), (3, 2024, 2, 4.0), (4, 2024, 1, None), (4, 2024, 2, 4.0)]
    mart = rows(data, "store_id int, year int, month int, total_sales double")
    got = {(r.store_id, r.year, r.month): (r.month_growth, r.year_growth) for r in retail.sales_growth(mart).collect()}
    assert got == {
        (1, 2023, 11): (None, None), (1, 2023, 12): (1.0, None), (1, 2024, 1): (0.5, None), (1, 2024, 3): (None, None), (1, 2024, 12): (None, -0.75),
        (2, 2024, 1): (None, None), (3, 2024, 1): (None, None), (3, 2024, 2): (None, None), (4, 2024, 1): (None, None), (4, 2024, 2): (None, None),
    }
    assert retail.sales_growth(mart.limit(0)).count() == 0


def files_of(root):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{root}/{BUCKET}=*/*.parquet")}


def test_bucket_upsert_writes_what_the_batch_touches(spark, rows, folder):
    table, root = name("kept"), f"{folder}/kept"
    first = spark.range(3200).select("id", F.lit("old").alias("value"))
    assert upsert_buckets(first, table, root, ["id"], 32) == 3200
    before = files_of(root)
    assert len(before) == 32
    batch = rows([(5, "new"), (5, "newer"), (9999, "more"), (None, "nameless")], "id long, value string").withColumn("at", F.monotonically_increasing_id())
    for _ in range(2):  # the second is a replay
        upsert_buckets(batch.filter("id is not null").withColumn("at", F.length("value")), table, root, ["id"], 32, ["at"])
        now = files_of(root)
        assert 1 <= len(set(before) - set(now)) <= 2 and len(now) == 32
        got = {r.id: r.value for r in read_buckets(spark, table).collect()}
        assert len(got) == 3201 and got[5] == "newer" and got[9999] == "more" and got[6] == "old"
    with pytest.raises(ConfigError, match="32 buckets"):
        upsert_buckets(first, table, root, ["id"], 16)


def test_bucketed_tables_are_read_without_a_shuffle(spark, rows):
    table = name("bucketed")
    items = spark.range(2000).select("id", (F.col("id") % 7).alias("place"), F.lit("old").alias("value"))
    assert save_bucketed(items, table, ["id"], 8) == 2000
    batch = spark.range(0, 4000, 2).select("id", F.lit(1).cast("long").alias("place"), F.lit("new").alias("value"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = upsert(spark.table(table), batch, ["id"])
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        stored = joined._jdf.queryExecution().executedPlan().toString().split("Union")[-1]
        assert "SortMergeJoin" in plan
        left = stored.split("SortMergeJoin")[1].split("Exchange")[0]
        assert "Bucketed: true" in left and f"{table}" in left
        last = keep_last(spark.table(table), ["id"], ["place"])
        text = last._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "Bucketed: true" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {r.id: r.value for r in joined.collect()}
    assert len(got) == 3000 and got[0] == "new" and got[1] == "old"


FIELDS = {"at": "timestamp_ntz", "value": "double", "n": "bigint", "ok": "boolean", "text": "string"}


def test_reject_route(rows, folder):
    given = {
        '{"at":"2024-01-01T10:00:00Z","value":1,"n":2.0,"ok":true,"text":"a"}': [],
        '{"at":1704103200000,"value":"1.5","text":null}': [],
        '{"at":"soon","value":"NaN","n":"7f","ok":1,"text":5}': ["at is no timestamp_ntz", "value is no double", "n is no bigint", "ok is no boolean", "text is no string"],
        '{"value":null}': ["at is missing", "value is missing"],
        "{}": ["at is missing", "value is missing"],
        '{"at":1': ["no JSON object"],
        "": ["no JSON object"],
        '{"at":1704103200000,"value":true}': ["value is no double"],
        '{"at":1704103200000,"value":{"a":1},"n":9e99}': ["value is no double", "n is no bigint"],
    }
    frame = rows([(r,) for r in given], "raw string")
    judged = records.judge_records(frame, "raw", FIELDS, ["at", "value"])
    assert {r.raw: r.reasons for r in judged.collect()} == given
    good, rejected, counts = records.route_records(judged, "raw", f"{folder}/routed")
    assert counts == {"good": 2, "rejected": 7} and good.columns == list(FIELDS)
    assert {r.raw for r in rejected.collect()} == {r for r, why in given.items() if why}
    assert sorted(r.value for r in good.collect()) == [1.0, 1.5] and {str(r["at"]) for r in good.collect()} == {"2024-01-01 10:00:00"}
    none = rows([(None,)], "raw string")
    assert records.judge_records(none, "raw", FIELDS, []).first().reasons == ["no JSON object"]
    empty = records.route_records(records.judge_records(none.limit(0), "raw", FIELDS, []), "raw", f"{folder}/empty")
    assert (empty[0].count(), empty[1].count(), empty[2]) == (0, 0, {"good": 0, "rejected": 0})


def test_ranges_open_only_matching_files(spark, folder):
    path = f"{folder}/parts"
    for k in range(6):
        spark.range(k * 100, k * 100 + 100).withColumn("x", F.when(F.lit(k != 5), F.col("id"))).coalesce(1).write.mode("append").parquet(path)
    index = ranges.file_ranges(spark.read.parquet(path), "x")
    assert index.count() == 6 and index.agg(F.sum("n_rows")).first()[0] == 600
    scan = ranges.range_scan(spark, index, "x", "id long, x long", 150, 220)
    assert len(scan.inputFiles()) == 2 and sorted(r.x for r in scan.collect()) == list(range(150, 221))
    assert ranges.range_scan(spark, index, "x", "id long, x long", low=390).count() == 110
    assert ranges.range_scan(spark, index, "x", "id long, x long", 1000, 2000).count() == 0
    with pytest.raises(ConfigError):
        ranges.range_scan(spark, index, "x", "id long, x long")


def test_model_order(spark):
    texts = {"c": "SELECT * FROM b JOIN d ON true", "b": "WITH d AS (SELECT 1 AS x) SELECT x FROM d WHERE x IN (SELECT x FROM a)", "a": "SELECT 1 AS x", "d": "SELECT 2 AS y FROM range(1)"}
    assert models.references(spark, texts["b"]) == {"a"} and models.references(spark, texts["c"]) == {"b", "d"}
    order = models.build_order(spark, texts)
    assert order.index("a") < order.index("b") < order.index("c") and order.index("d") < order.index("c")
    with pytest.raises(ConfigError, match="circle"):
        models.build_order(spark, {"a": "SELECT * FROM b", "b": "SELECT * FROM A"})


def test_mark_advances_after_the_load(spark, folder):
    marks, loaded = name("marks"), []
    frame = spark.range(1, 11)

    def fail(rows):
        raise OSError("away")

    def load(rows):
        loaded.append(sorted(r.id for r in rows.collect()))

    with pytest.raises(OSError):
        incremental.load_new_rows(frame, "s", fail, marks, f"{folder}/marks")
    assert incremental.stored_mark(spark, marks, "s") is None
    assert incremental.load_new_rows(frame.filter("id < 5"), "s", load, marks, f"{folder}/marks") == 4
    assert incremental.load_new_rows(frame, "s", load, marks, f"{folder}/marks") == 10
    assert incremental.load_new_rows(frame, "s", load, marks, f"{folder}/marks") == 10
    assert loaded == [[1, 2, 3, 4], [5, 6, 7, 8, 9, 10]]
    assert incremental.load_new_rows(frame.limit(0), "other", load, marks, f"{folder}/marks") is None


def test_sketches_merge_to_the_same_estimate(spark):
    frame = spark.range(20000).select((F.col("id") % 5000).alias("user"), (F.col("id") % 12).alias("month"), F.lit("a").alias("g"))
    merged = sketches.merge_distinct(sketches.sketch_distinct(frame, ["g", "month"], "user"), ["g"]).first()
    at_once = frame.agg(F.approx_count_distinct("user"), F.hll_sketch_estimate(F.hll_sketch_agg("user", sketches.LOG_SIZE)))
    assert merged.distinct_estimate == at_once.first()[1] and abs(merged.distinct_estimate - 5000) <= 4 * sketches.relative_error() * 5000


@pytest.mark.parametrize("value", ['"12d"', '"1f"', '"NaN"', '"0x1p3"', '""', "true", "[1]"])
def test_texts_that_are_no_numbers_fail(rows, value):
    frame = rows([(f'{{"_id":"a","sgv":100,"filtered":{value},"rssi":1}}',)], "raw string")
    with pytest.raises(Exception, match="filtered is no double"):
        glucose.entries(frame).collect()
    whole = rows([(f'{{"_id":"a","sgv":100,"rssi":{value}}}',)], "raw string")
    with pytest.raises(Exception, match="rssi is no int"):
        glucose.entries(whole).collect()


def test_treatment_texts_and_device_values(rows):
    bolus = rows([('{"_id":"a","eventType":"Bolus","insulin":"12d"}',)], "raw string")
    with pytest.raises(Exception, match="insulin is no double"):
        glucose.treatments(bolus).collect()
    good = glucose.treatments(rows([('{"_id":"a","eventType":"Bolus","insulin":" 1.5 ","duration":3.9}',)], "raw string")).first()
    assert (good.insulin, good.duration) == (1.5, 3)
    for raw, said in (('{"pump":{"iob":"abc"}}', "pump.iob"), ('{"loop":{"iob":{"netInsulin":"x"}}}', "netInsulin"), ('{"pump":{"iob":{"bolusiob":[1]}}}', "pump.iob")):
        with pytest.raises(Exception, match=f"{said} is no double"):
            glucose.device_status(rows([(raw,)], "raw string")).collect()
    status = glucose.device_status(rows([('{"pump":{"iob":{"bolusiob":"2.5"}},"loop":{"iob":{"netInsulin":1},"cob":7}}',)], "raw string")).first()
    assert (status.pump.iob, status.loop.iob, status.loop.cob) == (2.5, 1.0, None)


def test_recent_takes_both_forms_of_a_time(rows):
    frame = rows([(json.dumps({"_id": i, "date": at, "created_at": at}),) for i, at in (("a", "2024-06-30T11:00:00Z"), ("b", 1719745200000), ("c", "2024-06-01"), ("d", None), ("e", 0))], "raw string")
    for kind in ("entries", "treatments", "devicestatus"):
        got = {json.loads(r.raw)["_id"] for r in glucose.recent(frame, kind, as_of="2024-06-30 12:00:00").collect()}
        assert got == {"a", "b"}, kind


def test_partition_rows(rows):
    frame = rows([("a b", 1), ("x/y", 2), ("50%", 3), (None, 4)], "place string, v int")
    stats = registry.partition_rows(registry.partition_stats(frame, "d", "place", "v", "/data"), as_of="2024-01-01", metadata={"by": "test"})
    got = {r.partition_key: r for r in stats.collect()}
    assert {k: r.storage_location for k, r in got.items()} == {"a b": "/data/place=a b", "x/y": "/data/place=x%2Fy", "50%": "/data/place=50%25", None: "/data/place=__HIVE_DEFAULT_PARTITION__"}
    assert len({r.id for r in got.values()}) == 4 and {r.metadata for r in got.values()} == {'{"by": "test"}'}
