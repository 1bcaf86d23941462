"""Work that must be dealt over tasks, and memory that must not follow the input."""

import json
import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks import whole
from tidemill.errors import QualityError
from tidemill.plans import glucose
from tidemill.session import work_folder
from tidemill.sinks.versioned import upsert_table
from tidemill.sources import files, pages

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int"
SUPPLIER = "s_suppkey bigint, s_name string"


def given(rows, folder, name, data, schema):
    """A table as one Parquet file with one row group, so that Spark scans it in one task."""
    rows(data, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def tasks_of(spark, run):
    """The tasks of each stage of all jobs that a call starts."""
    context, group = spark.sparkContext, f"tasks-{id(run)}"
    context.setJobGroup(group, group)
    try:
        result = run()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [stage for job in tracker.getJobIdsForGroup(group) for stage in tracker.getJobInfo(job).stageIds]
    return result, [tracker.getStageInfo(stage).numTasks for stage in stages if tracker.getStageInfo(stage)]


def test_single_objects_are_written_by_many_tasks(spark, rows, folder):
    given(rows, folder, "customer", [(1, "a", 2), (2001, "b", None)], CUSTOMER)
    given(rows, folder, "supplier", [(n, f"s{n}") for n in range(1, 41)], SUPPLIER)
    old = set(os.listdir(work_folder(spark)))
    read = whole.json_documents(spark, folder)
    assert sorted(r.id for r in read.collect()) == [*range(-40, 0), 1, 2001]
    made = [f for f in os.listdir(work_folder(spark)) if f.startswith("objects-") and f not in old]
    parts = [re.match(r"part-(\d+)", f)[1] for f in os.listdir(f"{work_folder(spark)}/{made[0]}") if f.startswith("part-")]
    assert len(parts) == 40 and len(set(parts)) > 1


def test_the_schema_of_many_documents_is_found_by_many_tasks(spark, folder):
    values = [{"rows": [{"a": n, "b": "x"}]} for n in range(40)] + [{"rows": [{"a": 1.5, "c": {"d": None}}]}, {"rows": []}, [{"e": True}]]
    for n, value in enumerate(values):
        with open(f"{folder}/{n}.json", "w", encoding=("utf-8", "utf-8-sig", "utf-16-le")[n % 3]) as out:
            json.dump(value, out, indent=n % 2)
    open(f"{folder}/empty.json", "w").close()
    read, tasks = tasks_of(spark, lambda: files.read_json_documents(spark, folder))
    assert read.schema == spark.read.option("multiLine", True).json(folder).schema
    assert max(tasks) > 1
    assert sorted(r.a for row in read.collect() for r in row.rows or []) == [0, 1, 1.5, *range(2, 40)]


def test_one_block_of_a_document_is_many_runs(spark, folder, monkeypatch):
    monkeypatch.setattr(pages, "RUN_BITS", 6, raising=False)
    with open(f"{folder}/one.json", "w") as out:
        json.dump([{"id": n, "v": "]}"} for n in range(4000)], out)
    read = pages.read_json_pages(spark, f"{folder}/one.json", "id int, v string").select("id", F.spark_partition_id().alias("part"), "_seq")
    found = read.orderBy("_seq").collect()
    assert [r.id for r in found] == list(range(4000))
    assert max(Counter(r.part for r in found).values()) < 3000


def test_a_range_of_time_parses_a_record_once(spark, rows):
    given = rows([('{"date": 86400000}',), ('{"date": "1970-01-02T00:00:00Z"}',), ('{"date": "no date"}',), (None,)], "raw string")
    found = glucose.recent(given, "entries", "1970-01-02 12:00:00", days=1)
    assert found.columns == ["raw"] and found.count() == 2
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_an_upsert_computes_its_batch_once(spark, folder):
    spark.sql("CREATE SCHEMA once")
    try:
        for values, stored in (([(1, "a"), (2, "b")], 2), ([(2, "c"), (3, None)], 3)):
            seen = spark.sparkContext.accumulator(0)
            batch = spark.createDataFrame(spark.sparkContext.parallelize(values, 2).map(lambda v, seen=seen: (seen.add(1), v)[1]), "id int, v string")
            assert upsert_table(batch, "once.t", f"{folder}/t", ["id"]) == 2
            assert seen.value == 2 and spark.table("once.t").count() == stored
        assert sorted(map(tuple, spark.table("once.t").collect())) == [(1, "a"), (2, "c"), (3, None)]
        with pytest.raises(QualityError, match="repeats a key"):
            upsert_table(spark.createDataFrame([(4, "x"), (4, "x")], "id int, v string"), "once.t", f"{folder}/t", ["id"])
        assert spark.table("once.t").count() == 3
    finally:
        spark.sql("DROP SCHEMA once CASCADE")
