import json
import os

import pytest
from pyspark.sql import functions as F

from tidemill.errors import ConfigError, FlowError, FormatError
from tidemill.operators import rows as ops
from tidemill.operators.quality import require_fields
from tidemill.plans import flow
from tidemill.session import work_folder
from tidemill.sinks import files as out
from tidemill.sinks import registry, routed, tables
from tidemill.sinks.layers import store
from tidemill.sinks.versioned import publish, table_location, upsert_table
from tidemill.sources import files, incremental, landed, raw_layer
from tidemill.sources.tables import read_source, read_table
from tidemill.streaming import landing


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def schema(spark):
    """A fresh catalog schema."""
    import uuid

    name = f"s{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE SCHEMA {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_types_and_missing_tokens(spark, folder):
    path = write(f"{folder}/a.csv", 'n,x,zip,b,s\n1,1.5,00501,true,"a, ""b"""\nNA,n/a,,FALSE,\n3,2,10001,NULL,  c \n')
    df = files.read_csv(spark, path)
    assert dict(df.dtypes) == {"n": "bigint", "x": "double", "zip": "string", "b": "boolean", "s": "string"}
    assert plain(df) == sorted(
        [(1, 1.5, "00501", True, 'a, "b"'), (None, None, None, False, None), (3, 2.0, "10001", None, "  c ")], key=repr
    )
    assert dict(files.read_csv(spark, path, text_columns=["n"]).dtypes)["n"] == "string"
    assert set(dict(files.read_csv(spark, path, infer=False).dtypes).values()) == {"string"}
    given = "n int, x int, zip string, b string, s string"
    assert plain(files.read_csv(spark, path, schema=given, misfits="null").select("n", "x"))[0] == (1, None)
    with pytest.raises(Exception, match="column x does not hold"):
        files.read_csv(spark, path, schema=given).collect()


def test_csv_options_and_errors(spark, folder):
    path = write(f"{folder}/a.csv", "1;x\n2;y\n")
    assert plain(files.read_csv(spark, path, header=False, sep=";")) == [(1, "x"), (2, "y")]
    for read in (files.read_csv, files.read_parquet, files.read_lines, files.read_json_documents):
        with pytest.raises(FileNotFoundError):
            read(spark, f"{folder}/none")
    with pytest.raises(FormatError):
        files.read_parquet(spark, folder + "/a.csv").collect()


def test_csv_keeps_file_order_for_the_last_row(spark, folder):
    path = write(f"{folder}/a.csv", "k,v\n" + "\n".join(f"{i % 3},{i}" for i in range(200)) + "\n")
    df = files.read_csv(spark, path, ingest_order=True)
    assert plain(ops.drop_bookkeeping(ops.keep_last(df, ["k"]))) == [(0, 198), (1, 199), (2, 197)]


def test_csv_round_trip_keeps_blanks(spark, rows, folder):
    df = rows([(1, "  a "), (2, 'q"x,y')], "k bigint, v string")
    assert out.save_csv(df, f"{folder}/out") == 2
    assert plain(files.read_csv(spark, f"{folder}/out")) == plain(df)


def test_lines_and_json(spark, rows, folder):
    write(f"{folder}/a.txt", "one\ntwo\n")
    assert plain(files.read_lines(spark, f"{folder}/a.txt")) == [("one",), ("two",)]
    write(f"{folder}/one.json", '{"id": 1}')
    assert plain(files.read_json_documents(spark, f"{folder}/one.json")) == [(1,)]
    assert out.save_json(rows([(1, None)], "id int, v string"), f"{folder}/j") == 1
    assert plain(spark.read.text(f"{folder}/j")) == [('{"id":1,"v":null}',)]
    assert plain(files.read_json_lines(spark, f"{folder}/j", "id int")) == [(1,)]


def test_select_files(spark, folder):
    os.makedirs(f"{folder}/d/sub")
    for name in ("d/a.csv", "d/b.CSV", "d/c.txt", "d/sub/d.csv", "d/x_1.csv"):
        write(f"{folder}/{name}", f"{name}\n")
    read = lambda **kw: {r[0] for r in files.select_files(spark, f"{folder}/d", "text", **kw).collect()}
    assert read(extension="csv") == {"d/a.csv", "d/b.CSV", "d/x_1.csv"}
    assert read(extension=".csv", recursive=True) == {"d/a.csv", "d/b.CSV", "d/x_1.csv", "d/sub/d.csv"}
    assert read(pattern="[ac].*") == {"d/a.csv", "d/c.txt"}
    assert read(prefix="x_") == {"d/x_1.csv"}


def test_envelope(spark, folder):
    write(f"{folder}/p.json", json.dumps({"orders": [{"id": 1, "order_date": "2024-01-01"}, {"id": 2, "order_date": "2024-02-01"}]}))
    assert plain(landed.read_envelope(spark, f"{folder}/p.json", "orders").drop("_seq").select("id")) == [(1,), (2,)]
    assert plain(landed.read_orders(spark, f"{folder}/p.json", "2024-01-15").select("id")) == [(2,)]
    with pytest.raises(FormatError, match="no array 'products?'"):
        landed.read_envelope(spark, f"{folder}/p.json", "products")
    write(f"{folder}/q.json", '{"other": 1}')
    with pytest.raises(Exception, match="no array 'orders?'"):
        landed.read_envelope(spark, folder, "orders").collect()
    write(f"{folder}/l.jsonl", '{"orders": [{"id": 1}, {"id": 1}]}\n{"orders": [{"id": 1, "v": "last"}]}\n')
    paged = landed.read_envelope(spark, f"{folder}/l.jsonl", "orders", lines=True)
    assert plain(ops.drop_bookkeeping(ops.keep_last(paged, ["id"]))) == [(1, "last")]


def test_time_range_bounds_are_inclusive(rows):
    df = rows([("2024-01-01T00:00:00.000Z",), ("2024-01-02T00:00:00.000Z",), ("2024-01-02T00:00:00.001Z",)], "at string")
    assert landed.time_range(df, "at", "2024-01-02", days=1).count() == 2
    stamps = df.select(F.col("at").cast("timestamp").cast("timestamp_ntz").alias("at"))
    assert [str(r[0]) for r in landed.time_range(stamps, "at", "2024-01-02", days=1, limit=1).collect()] == ["2024-01-02 00:00:00"]
    millis = stamps.select(F.unix_millis(F.col("at").cast("timestamp")).alias("at"))
    assert landed.time_range(millis, "at", "2024-01-02", days=1).count() == 2


def test_glucose_readings(rows):
    df = rows([("2024-01-02T00:00:00Z", 100), ("2023-01-02T00:00:00Z", 90)], "dateString string, sgv int")
    got = landed.glucose_readings(df, "2024-01-02 12:00:00").collect()
    assert [(r.glucose, r.device, r.type, r.noise) for r in got] == [(100.0, "unknown", "sgv", None)]
    lacking = rows([("2024-01-02T00:00:00Z", None), (None, 1)], "dateString string, sgv int")
    with pytest.raises(Exception, match="lacks sgv"):
        landed.glucose_readings(lacking, "2024-01-02 12:00:00").collect()
    assert landed.glucose_readings(lacking, "2025-01-02 12:00:00").count() == 0


def test_incremental(rows):
    df = rows([(1,), (2,), (3,)], "id int")
    assert incremental.read_mark(df) == 3
    assert incremental.read_mark(df.limit(0), 7) == 7
    assert incremental.read_mark(df, 9) == 3
    assert plain(incremental.new_rows(df, 2)) == [(3,)]
    assert incremental.new_rows(df).count() == 3


def test_pushed_filters(spark, rows, folder):
    rows([(1, "a")], "id int, v string").write.parquet(f"{folder}/p")
    plan = incremental.new_rows(files.read_parquet(spark, f"{folder}/p"), 5).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,5)" in plan and "ReadSchema: struct<id:int>" in plan


def test_save_table_modes(spark, rows, schema):
    df, name = rows([(1, "a")], "id int, v string"), f"{schema}.t"
    assert tables.save_table(df, ["any", schema, "t"]) == 1
    assert tables.save_table(df, name, "append") == 1
    assert tables.save_table(df, name, "ignore") == 0
    assert read_table(spark, name).count() == 2
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        tables.save_table(df, name, "fail")
    with pytest.raises(ValueError, match="if_exists"):
        tables.save_table(df, name, "merge")
    assert tables.save_table(df, name) == 1
    assert read_table(spark, name).count() == 1


def test_sql_surface(spark, rows, schema, folder):
    tables.save_table(rows([(1, "a"), (2, "b")], "id int, v string"), f"{schema}.t")
    assert plain(tables.run_sql(spark, f"SELECT v FROM {schema}.t WHERE id = :id", {"id": 2})) == [("b",)]
    tables.create_table_from_query(spark, f"{schema}.c", f"SELECT id FROM {schema}.t")
    tables.create_table_from_query(spark, f"{schema}.c", f"SELECT 9 AS id FROM {schema}.t")
    assert plain(spark.table(f"{schema}.c")) == [(1,), (2,)]
    tables.create_table_from_query(spark, f"{schema}.c", "SELECT 9 AS id", replace=True)
    assert plain(spark.table(f"{schema}.c")) == [(9,)]
    tables.create_view(spark, f"{schema}.w", f"SELECT id FROM {schema}.t WHERE id = 1")
    tables.create_view(spark, f"{schema}.w", "SELECT 5 AS id")
    assert plain(spark.table(f"{schema}.w")) == [(1,)]
    tables.create_view(spark, f"{schema}.w", "SELECT 5 AS id", replace=True)
    assert plain(spark.table(f"{schema}.w")) == [(5,)]
    tables.export_query_to_csv(spark, f"SELECT * FROM {schema}.t", f"{folder}/out")
    with pytest.raises(NotImplementedError):
        tables.export_query_to_csv(spark, "SELECT 1", f"{folder}/out", {"a": 1})
    tables.load_csv(spark, f"{schema}.l", f"{folder}/out")
    tables.load_csv(spark, f"{schema}.l", f"{folder}/out", replace=True, auto_detect=False)
    assert plain(spark.table(f"{schema}.l")) == [("1", "a"), ("2", "b")]
    tables.materialize(spark, f"{schema}.m", f"SELECT * FROM {schema}.l", "table")
    tables.materialize(spark, f"{schema}.mv", f"SELECT * FROM {schema}.m")
    assert spark.table(f"{schema}.mv").count() == 2
    with pytest.raises(ValueError, match="materialized"):
        tables.materialize(spark, "x", "SELECT 1", "cube")


def test_source_kinds(spark, rows, schema, folder):
    rows([(1,)], "id int").write.json(f"{folder}/land/teams")
    tables.save_table(rows([(1,)], "id int"), f"{schema}.t")
    write(f"{folder}/a.csv", "id\n1\n")
    os.makedirs(f"{folder}/land/orders")
    write(f"{folder}/land/orders/1.json", '{"orders": [{"id": 1}]}')
    assert plain(read_source(spark, "csv", file=f"{folder}/a.csv")) == [(1,)]
    assert plain(read_source(spark, "postgres", table=f"{schema}.t")) == [(1,)]
    assert plain(read_source(spark, "api", endpoint="teams", landing=f"{folder}/land")) == [(1,)]
    assert plain(read_source(spark, "api", endpoint="orders", landing=f"{folder}/land").select("id")) == [(1,)]
    for kind in ("csv", "json", "postgres", "api"):
        with pytest.raises(ConfigError, match="source needs"):
            read_source(spark, kind)
    with pytest.raises(ConfigError, match="unknown source kind"):
        read_source(spark, "xml")


def test_raw_layer(spark, folder, schema):
    for name in ("customers", "orders", "products"):
        os.makedirs(f"{folder}/{name}")
        write(f"{folder}/{name}/1.json", json.dumps({name: [{"id": 1, "v": "a"}, {"id": 1, "v": "b"}]}))
    write(f"{folder}/store_locations.csv", "store_id,zip_code\n1,00501\n1,00502\n")
    write(f"{folder}/inventory.csv", "product_id,quantity\n1,5\n")
    raw_layer.load_raw(spark, folder, schema)
    assert plain(ops.drop_bookkeeping(ops.keep_last(spark.table(f"{schema}.raw_orders"), ["id"]))) == [(1, "b")]
    assert plain(ops.keep_last(spark.table(f"{schema}.raw_store_locations"), ["store_id"]).select("zip_code")) == [("00502",)]
    assert plain(spark.table(f"{schema}.raw_inventory").select("quantity")) == [(5,)]


def test_routes(spark, rows, schema, folder):
    assert routed.target_table("pulls") == "github_pull_requests"
    assert routed.target_table("wikis") == "github_wikis"
    assert routed.target_path("org", "issues") == "data/github/org/issues.json"
    assert routed.load_entity_table(rows([(1,)], "id int"), "issues", schema) == 1
    assert spark.table(f"{schema}.github_issues").count() == 1
    assert routed.load_entity_file(rows([(1,)], "id int"), "repo", "pulls", folder) == 1
    assert os.path.isdir(f"{folder}/github/repo/pull_requests.json")


def test_versions(spark, rows, schema, folder):
    name = f"{schema}.v"
    assert upsert_table(rows([(1, "a", 1), (1, "b", 2)], "id int, v string, _seq int"), name, folder, ["id"]) == 1
    first = table_location(spark, name)
    old = spark.table(name)
    assert upsert_table(rows([(1, "c"), (2, "d")], "id int, v string"), name, folder, ["id"], version="two") == 2
    assert plain(spark.table(name)) == [(1, "c"), (2, "d")]
    assert table_location(spark, name).endswith("/two") and os.path.isdir(first.removeprefix("file:"))
    assert plain(old) == [(1, "b")]
    assert upsert_table(rows([(1, "z")], "id int, v string"), name, folder, ["id"], version="two") == 0
    assert plain(spark.table(name)) == [(1, "c"), (2, "d")]
    publish(rows([(1,)], "id int"), name, folder)
    assert spark.table(name).columns == ["id"]


def test_small_batches_do_not_shuffle_the_table(spark, rows, folder):
    from tidemill.operators.upsert import upsert

    rows([(i, "a") for i in range(100)], "id int, v string").write.parquet(f"{folder}/big")
    rows([(1, "b")], "id int, v string").write.parquet(f"{folder}/batch")
    plan = upsert(spark.read.parquet(f"{folder}/big"), spark.read.parquet(f"{folder}/batch"), ["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text
    assert "Exchange" not in text[: text.index("/big")]


def test_registry(spark, rows, folder):
    spark.sql("DROP SCHEMA IF EXISTS warehouse CASCADE")
    df = rows([(1, "a"), (2, "b"), (3, "b")], "id int, kind string")
    registry.register(registry.registry_row(df, "d", "here", metadata={"a": 1}, as_of="2024-01-01"), f"{folder}/reg")
    registry.register(registry.registry_row(df.limit(1), "d", "there", as_of="2024-02-01"), f"{folder}/reg")
    registry.register(registry.registry_row(df, "e", "e", as_of="2024-02-01"), f"{folder}/reg")
    got = spark.sql(
        "SELECT name, location, row_count, CAST(created_at AS STRING), variant_get(schema, '$.fields[1].name', 'string') AS c "
        "FROM warehouse.datasets ORDER BY name"
    ).collect()
    assert [tuple(r) for r in got] == [("d", "there", 1, "2024-01-01 00:00:00", "kind"), ("e", "e", 3, "2024-02-01 00:00:00", "kind")]
    stats = registry.partition_stats(df, "d", "kind", "id", "here").select("partition_key", "min_value", "max_value", "row_count")
    assert plain(stats) == [("a", "1", "1", 1), ("b", "2", "3", 2)]
    for dataset in ("d", "lost"):
        registry.record_partitions(registry.partition_stats(df, dataset, "kind", "id", "here"), f"{folder}/parts")
    assert registry.record_partitions(registry.partition_stats(df.limit(1), "d", "kind", "id", "here"), f"{folder}/parts") == 1
    assert spark.table(registry.PARTITIONS).count() == 4
    assert {r.dataset for r in registry.unregistered_partitions(spark).collect()} == {"lost"}


def test_stored_layers_and_spread(spark, rows):
    df = rows([(1, "a")], "id int, v string")
    stored = store(df, "layer")
    assert plain(stored) == [(1, "a")]
    assert work_folder(spark) in stored.inputFiles()[0]
    one = df.coalesce(1)
    assert files.spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = df.repartition(16)
    assert files.spread(wide) is wide


def test_flow_order_and_errors(rows):
    seen = []
    source = rows([(1, "a")], "id int, name string")
    step = flow.Step(ops.mark_transformed, validate_input=require_fields, validate_output=lambda d: seen.append(d.columns))
    result = flow.Flow("f", lambda: source, [step, lambda d: ops.suffix_text(d, "name")], load=lambda d: seen.append("load")).run()
    assert plain(result) == [(1, "a_transformed", True)]
    assert seen == [["id", "name", "transformed"], "load"]
    with pytest.raises(FlowError, match="source of 'f' is invalid"):
        flow.Flow("f", lambda: source, validate_source=lambda: False).run()
    with pytest.raises(FlowError, match="target of 'f' is invalid"):
        flow.Flow("f", lambda: source, load=print, validate_target=lambda: False).run()
    with pytest.raises(FlowError, match="must have fields: nope"):
        flow.Flow("f", lambda: source, [flow.Step(ops.mark_transformed, lambda d: require_fields(d, ["nope"]))]).run()
    assert flow.Flow("f", lambda: source, [flow.Step(ops.mark_transformed, lambda d: False)]).run().count() == 1


def test_flow_from_config(spark, folder, schema):
    write(f"{folder}/in.csv", "status,old_name\nactive,x\nidle,y\nNA,z\n")
    config = {
        "name": "c",
        "extractor": {"type": "csv", "config": {"file": f"{folder}/in.csv"}},
        "transformers": [
            {"type": "filter", "config": {"field": "status", "value": "active"}},
            {"type": "rename", "config": {"mappings": {"old_name": "new_name", "gone": "x"}}},
        ],
    }
    file_loader = {"type": "file", "config": {"file_path": f"{folder}/out", "mode": "append"}}
    table_loader = {"type": "database", "config": {"table": f"{schema}.data"}}
    for loader in (file_loader, file_loader, table_loader):
        flow.flow_from_config(spark, {**config, "loader": loader}).run()
    assert plain(files.read_csv(spark, f"{folder}/out")) == [("active", "x")] * 2
    assert spark.table(f"{schema}.data").columns == ["status", "new_name"]
    with pytest.raises(ConfigError, match="with an extractor"):
        flow.flow_from_config(spark, {})
    with pytest.raises(ConfigError, match="unknown transformer"):
        flow.flow_from_config(spark, {**config, "transformers": [{"type": "pivot"}]})
    with pytest.raises(ConfigError, match="unknown loader"):
        flow.flow_from_config(spark, {**config, "loader": {"type": "ftp"}})


def test_replace_load_retries(spark, rows, schema, monkeypatch):
    calls = []

    def flaky(df, table, mode):
        calls.append(mode)
        if len(calls) < 3:
            raise OSError("busy")
        return 1

    monkeypatch.setattr(flow, "save_table", flaky)
    assert flow.replace_load(rows([(1,)], "id int"), delay=0) == 1 and calls == ["replace"] * 3
    calls.clear()
    with pytest.raises(OSError):
        flow.replace_load(rows([(1,)], "id int"), max_attempts=2, delay=0)


def test_streams_take_only_new_files(spark, rows, schema, folder):
    inbox, name = f"{folder}/in", f"{schema}.latest"
    fields = "id int, v string, _seq int"

    def run():
        stream = landing.landing_stream(spark, inbox, fields)
        landing.upsert_new_files(stream, name, f"{folder}/root", f"{folder}/progress", ["id"], ["_seq"])
        landing.append_new_files(stream, f"{folder}/all", f"{folder}/progress2")

    rows([(1, "a", 1), (1, "b", 2), (2, "a", 1)], fields).write.json(inbox)
    run()
    assert plain(spark.table(name)) == [(1, "b"), (2, "a")]
    run()
    assert spark.read.parquet(f"{folder}/all").count() == 3
    rows([(2, "c", 1), (3, "d", 1)], fields).write.mode("append").json(inbox)
    run()
    assert plain(spark.table(name)) == [(1, "b"), (2, "c"), (3, "d")]
    assert spark.read.parquet(f"{folder}/all").count() == 5


@pytest.mark.parametrize("stable", [False, True])
def test_partitioned_upsert_rewrites_only_what_it_touches(spark, rows, schema, folder, stable):
    from tidemill.sinks.versioned import upsert_partitions

    fields, name = "id int, v string, day date, _seq int", f"{schema}.p"
    import datetime as dt

    d1, d2, d3 = (dt.date(2024, 1, i) for i in (1, 2, 3))

    def load(*data):
        return upsert_partitions(rows(list(data), fields), name, folder, ["id"], "day", stable=stable)

    assert load((1, "a", d1, 1), (1, "b", d1, 2), (2, "a", d2, 1), (3, "a", d3, 1)) == 3
    before = {p.rsplit("/", 1)[0] for p in spark.table(name).filter(F.col("day") == d2).inputFiles()}
    assert load((1, "c", d1, 1), (4, "d", d1, 1)) == 2
    assert plain(spark.table(name)) == [(1, "c", d1), (2, "a", d2), (3, "a", d3), (4, "d", d1)]
    assert {p.rsplit("/", 1)[0] for p in spark.table(name).filter(F.col("day") == d2).inputFiles()} == before
    if not stable:
        assert load((3, "moved", d1, 1)) == 1
        assert plain(spark.table(name)) == [(1, "c", d1), (2, "a", d2), (3, "moved", d1), (4, "d", d1)]
        assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2


def test_partition_values_of_any_kind_survive_upserts(spark, rows, schema, folder):
    from tidemill.sinks.versioned import upsert_partitions

    name, odd = f"{schema}.odd", ["b:c", "a b", "50%", "x/y", 'q"q', "O'Neil", "back\\slash", None]
    first = [(i, "old", value) for i, value in enumerate(odd)]
    assert upsert_partitions(rows(first, "id int, v string, k string"), name, f"{folder}/t", ["id"], "k") == len(odd)
    assert plain(spark.table(name)) == sorted(first, key=repr)
    moved = [(i, "new", odd[i - 1]) for i in range(0, len(odd), 2)] + [(99, "more", None)]
    assert upsert_partitions(rows(moved, "id int, v string, k string"), name, f"{folder}/t", ["id"], "k") == len(moved)
    expected = [r for r in first if r[0] % 2] + moved
    assert plain(spark.table(name)) == sorted(expected, key=repr)
    assert upsert_partitions(rows([(1, "away", "b:c")], "id int, v string, k string"), name, f"{folder}/t", ["id"], "k") == 1
    assert ("b:c" in {r[2] for r in plain(spark.table(name))}) and len(plain(spark.table(name))) == len(expected)


def test_csv_keeps_line_ends_and_fails_on_cut_records(spark, rows, folder):
    out.save_csv(rows([(1, "a\nb"), (2, "c")], "n int, s string"), f"{folder}/lines")
    assert plain(files.read_csv(spark, f"{folder}/lines")) == [(1, "a\nb"), (2, "c")]
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        files.read_csv(spark, f"{folder}/lines", multiline=False, infer=False).collect()


def test_old_versions_are_removed_on_request(spark, rows, schema, folder):
    from tidemill.sinks.versioned import remove_versions, upsert_table

    for v in "abc":
        upsert_table(rows([(1, v)], "id int, v string"), f"{schema}.kept", folder, ["id"])
    assert remove_versions(spark, f"{schema}.kept", folder, keep=0) == 2
    assert plain(spark.table(f"{schema}.kept")) == [(1, "c")]


def test_batches_with_repeated_keys(spark, rows, schema, folder):
    from tidemill.operators.upsert import upsert, upsert_columns

    stored, batch = rows([(1, "a", 1), (None, "keep", 1)], "id int, v string, n int"), rows([(1, "b", 2), (1, "c", 3)], "id int, v string, n int")
    with pytest.raises(Exception, match="repeats a key"):
        upsert(stored, batch, ["id"]).collect()
    assert plain(upsert(stored, batch, ["id"], ["n"])) == [(1, "c", 3), (None, "keep", 1)]
    assert plain(upsert_columns(stored, batch, ["id"], ["v"], ["n"])) == [(1, "c", 1), (None, "keep", 1)]


def test_text_times_are_compared_as_instants(rows):
    texts = ["2024-01-02T12:00:00Z", "2024-01-02T13:30:00+02:00", "2024-01-02T12:00:01Z", "2024-01-01T11:59:59Z", "2024-01-01T12:00:00Z"]
    found = landed.time_range(rows([(t,) for t in texts], "at string"), "at", "2024-01-02 12:00:00", days=1)
    assert {r[0] for r in found.collect()} == {texts[0], texts[1], texts[4]}
