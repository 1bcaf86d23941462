"""Issue-tracker, glucose and test-report records."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemill.plans import forge, glucose, testlog


@pytest.fixture
def texts(spark):
    return lambda *documents: spark.createDataFrame([(json.dumps(d) if not isinstance(d, str) else d,) for d in documents], "raw string")


TICKET = {
    "id": 1, "number": 2, "title": "t", "state": "open", "url": "u", "html_url": "h",
    "created_at": "2024-01-01T00:00:00Z", "updated_at": None,
}


def test_issue_defaults_and_explicit_nulls(texts):
    full = TICKET | {
        "body": None, "comments": None, "pull_request": None, "labels": [{"name": "a"}, {"name": "b"}],
        "assignees": [{"login": "x"}], "milestone": {"title": "m"}, "user": {"login": "y"}, "closed_at": "bad",
    }
    bare, filled = forge.transform_text(texts(TICKET, full), "issues").collect()
    assert len(bare) == 16
    assert (bare.body, bare.comments_count, bare.is_pull_request, bare.labels, bare.milestone) == ("", 0, False, [], None)
    assert bare.created_at == dt.datetime(2024, 1, 1) and bare.updated_at is None
    assert (filled.body, filled.comments_count, filled.is_pull_request) == (None, None, True)
    assert (filled.labels, filled.assignees, filled.milestone, filled.author) == (["a", "b"], ["x"], "m", "y")
    assert filled.closed_at is None


@pytest.mark.parametrize("endpoint", list(forge.REQUIRED))
def test_a_missing_required_key_fails_the_batch(texts, endpoint):
    record = {k: "2024-01-01T00:00:00Z" if k.endswith("_at") else 1 for k in forge.REQUIRED[endpoint]}
    assert forge.transform_text(texts(record), endpoint).count() == 1
    for key in record:
        lacking = texts(record, {k: v for k, v in record.items() if k != key})
        with pytest.raises(Exception, match=f"missing required keys: {key}"):
            forge.transform_text(lacking, endpoint).count()
        assert forge.transform_text(lacking, endpoint, strict=False).count() == 2


def test_pulls(texts):
    pull = TICKET | {"merged_at": "2024-01-02T00:00:00+01:00", "draft": True, "base": {"ref": "main"}}
    row = forge.transform_text(texts(pull), "pulls").first()
    assert len(row) == 21
    assert (row.is_draft, row.is_merged, row.base_branch, row.head_branch, row.review_comments_count) == (True, False, "main", None, 0)
    assert row.merged_at == dt.datetime(2024, 1, 1, 23)


def test_commits(texts):
    rows = forge.transform_text(
        texts(
            {"sha": "a", "url": "u"},
            {"sha": "b", "url": "u", "commit": {"message": None, "author": {"name": "n", "date": "2024-01-01T00:00:00Z"}},
             "committer": {"login": "c"}, "parents": [{"sha": "a"}], "stats": {"total": 3}},
        ),
        "commits",
    ).withColumn("stats", F.to_json("stats")).collect()
    assert len(rows[0]) == 14
    assert (rows[0].message, rows[0].parents, rows[0].stats, rows[0].author_name) == ("", [], "{}", None)
    assert (rows[1].message, rows[1].parents, rows[1].stats, rows[1].github_committer) == (None, ["a"], '{"total":3}', "c")


def test_repositories_and_users(texts):
    repo = {"id": 1, "name": "n", "full_name": "o/n", "url": "u", "html_url": "h", "created_at": None, "updated_at": None}
    row = forge.transform_text(texts(repo), "repositories").first()
    assert len(row) == 22
    assert (row.visibility, row.default_branch, row.topics, row.description, row.is_archived) == ("public", "main", [], "", False)
    user = forge.transform_text(texts({"id": 1, "login": "l", "url": "u", "html_url": "h"}), "users").first()
    assert len(user) == 19
    assert (user.type, user.followers, user.is_site_admin, user.created_at) == ("User", 0, False, None)


def test_other_endpoints_keep_all_fields(spark, texts):
    typed = spark.sql("SELECT 1 AS id, 'u' AS url, '2024-01-01T00:00:00Z' AS created_at, 'x' AS extra")
    row = forge.transform(typed, "teams").first()
    assert (row.api_url, row.url, row.extra, row.created_at) == ("u", "u", "x", dt.datetime(2024, 1, 1))
    open_row = forge.transform_text(texts({"id": 1, "url": "u", "n": None, "o": {"p": 1}}), "teams")
    assert open_row.select(F.to_json("extras")).first()[0] == '{"url":"u","n":null,"o":{"p":1}}'


def test_records_from_files(spark, folder):
    with open(f"{folder}/array.json", "w") as f:
        json.dump([TICKET, TICKET | {"id": 2}], f)
    with open(f"{folder}/single.json", "w") as f:
        json.dump(TICKET | {"id": 3, "body": None}, f)
    rows = forge.transform(forge.read_records(spark, folder, "issues"), "issues").orderBy("id").collect()
    assert [(r.id, r.body) for r in rows] == [(1, ""), (2, ""), (3, None)]
    split = forge.transform(forge.read_records(spark, folder, "issues", split=True), "issues").orderBy("id").collect()
    assert split == rows


def test_treatments_by_type(texts):
    base = {"_id": "1", "created_at": "2024-01-01T00:00:00Z", "enteredBy": "me"}
    documents = [
        {"eventType": "Bolus", "insulin": 1.5, "carbs": 9}, {"eventType": "Temp Basal", "rate": "0.5", "percent": 10},
        {"eventType": "Site Change", "device": "d", "insulin": 1}, {"eventType": "Correction", "insulin": 2.5, "note2": [1]},
        {}, {"eventType": "CARBS", "device": "d"},
    ]
    got = glucose.treatments(texts(*[base | d for d in documents])).withColumn("extras", F.to_json("extras")).collect()
    assert [r.type for r in got] == ["bolus", "temp basal", "site change", "correction", "", "carbs"]
    assert (got[0].insulin, got[0].duration, got[0].carbs, got[0].extras) == (1.5, 0, None, None)
    assert (got[1].rate, got[1].duration, got[1].percent, got[1].absolute) == (0.5, 0, 10, 0.0)
    assert (got[2].device, got[2].insulin) == ("d", None)
    assert (got[3].insulin, got[3].extras) == (2.5, '{"eventType":"Correction","insulin":2.5,"note2":[1]}')
    assert got[4].extras == "{}" and (got[5].carbs, got[5].device) == (0.0, None)


@pytest.mark.parametrize("bad, message", [({"eventType": None}, "eventType is null"), ({"eventType": "Bolus", "insulin": None}, "insulin is null")])
def test_null_type_or_number_fails_the_batch(texts, bad, message):
    with pytest.raises(Exception, match=message):
        glucose.treatments(texts({"_id": "1"} | bad)).collect()


def test_profiles_and_device_status(texts):
    store = {"Day": {"dia": 3, "sens": [{"time": "0", "value": 5}], "units": "mg/dl"}}
    found, missing = glucose.profiles(
        texts({"_id": "1", "defaultProfile": "Day", "store": store}, {"_id": "2", "defaultProfile": "Night", "store": store})
    ).withColumn("sens", F.to_json("sens")).collect()
    assert (found.dia, found.units, found.sens) == (3.0, "mg/dl", '[{"time":"0","value":5}]')
    assert (missing.id, missing.dia) == ("2", None)
    with_parts, without = glucose.device_status(
        texts({"_id": "1", "pump": {"iob": {"bolusiob": 1.5}}, "loop": {"iob": 3, "cob": {"cob": 4}}}, {"_id": "2", "pump": {"iob": 0.5}})
    ).collect()
    assert (with_parts.pump.iob, with_parts.loop.iob, with_parts.loop.cob, with_parts.uploader) == (1.5, None, 4.0, None)
    assert (without.pump.iob, without.loop) == (0.5, None)


def test_load_upserts_by_id(spark, texts, folder):
    spark.sql("DROP SCHEMA IF EXISTS glucose_test CASCADE")
    entry = {"_id": "a", "date": 1704067200000, "sgv": 100, "type": "sgv"}
    first = glucose.transform({
        "entries": texts(entry, entry | {"_id": "b"}),
        "profiles": texts({"_id": "p", "startDate": "2024"}),
        "treatments": texts({"_id": "t", "eventType": "Carbs", "enteredBy": "me"}),
        "devicestatus": texts({"_id": "d", "device": "x"}),
    })
    assert glucose.load(spark, first, folder, "glucose_test") == 5
    second = glucose.transform({"entries": texts(entry | {"sgv": 180}, entry | {"_id": "c"})})
    assert glucose.load(spark, second, folder, "glucose_test") == 2
    stored = spark.table("glucose_test.nightscout_entries").orderBy("id").collect()
    assert [(r.id, r.sgv, r.sgv_mmol) for r in stored] == [("a", 180, 10.0), ("b", 100, 5.6), ("c", 100, 5.6)]
    assert json.loads(stored[0].raw_data)["sgv_mmol"] == 10.0
    assert spark.table("glucose_test.nightscout_treatments").first().entered_by == "me"
    assert glucose.load(spark, second, folder, "glucose_test", upsert=False) == 2
    assert spark.table("glucose_test.nightscout_entries").count() == 5
    with pytest.raises(Exception, match="no id"):
        glucose.load(spark, glucose.transform({"entries": texts({"sgv": 1})}), folder, "glucose_test")


def test_bundle_of_recent_records(spark, folder):
    day = 86_400_000
    sets = {
        "entries": [{"_id": f"e{i}", "date": 1704067200000 - i * day, "sgv": 100} for i in range(4)],
        "treatments": [{"_id": "t1", "created_at": "2023-12-31T12:00:00.000Z"}, {"_id": "t2", "created_at": "2023-12-01T00:00:00.000Z"}],
        "profiles": [{"_id": "p", "created_at": "1999-01-01T00:00:00Z"}],
        "devicestatus": [{"_id": "d", "created_at": "2024-01-01T00:00:00.001Z"}],
    }
    for name, records in sets.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write("\n".join(map(json.dumps, records)) + "\n")
    bundle = glucose.transform(glucose.read_bundle(spark, folder, "2024-01-01", days=2))
    assert {n: sorted(r.id for r in df.collect()) for n, df in bundle.items()} == {
        "entries": ["e0", "e1", "e2"], "treatments": ["t1"], "profiles": ["p"], "devicestatus": [],
    }
    assert glucose.read_bundle(spark, folder, "2024-01-01", days=2, limit=1)["entries"].collect()[0].raw.startswith('{"_id": "e0"')


REPORT = {
    "metadata": {"invocation_id": "i", "generated_at": "2024-01-01T00:00:00Z"},
    "results": [
        {"unique_id": "test.shop.orders.unique_id.abc", "status": "fail", "failures": 3, "message": "m",
         "timing": [{"elapsed": 1.5}], "adapter_response": {"test_type": "generic"}, "column_name": "id"},
        {"unique_id": "test.x.y", "status": "pass", "timing": []},
        {"unique_id": "model.shop.a", "status": "success"}, {"unique_id": "model", "status": "error"}, {"status": "error"},
    ],
}


def test_reports_flatten(texts):
    got = testlog.flatten_text(texts(REPORT, '{"broken')).collect()
    assert [(r.result_id, r.test_name, r.model_name, r.status) for r in got] == [
        ("test.shop.orders.unique_id.abc", "unique_id", "orders", "fail"), ("test.x.y", "x", None, "pass"),
        ("model", None, None, "error"), (None, None, None, "error"),
    ]
    assert (got[0].execution_time, got[0].test_type, got[0].rows_affected) == (1.5, "generic", 3)
    assert got[1].execution_time is None


def test_report_files_and_history(spark, folder):
    spark.sql("DROP TABLE IF EXISTS monitoring_t.results")
    spark.sql("CREATE SCHEMA IF NOT EXISTS monitoring_t")
    with open(f"{folder}/run.json", "w") as f:
        json.dump({**REPORT, "results": REPORT["results"][:2]}, f)
    results = testlog.flatten(testlog.read_reports(spark, f"{folder}/run.json"))
    assert testlog.report(results) == 1
    assert testlog.read_reports(spark, f"{folder}/none.json").count() == 0
    testlog.log_results(results, f"{folder}/log", "monitoring_t.results")
    changed = results.withColumns({"status": F.lit("pass"), "test_name": F.lit("other")})
    testlog.log_results(changed, f"{folder}/log", "monitoring_t.results")
    stored = spark.table("monitoring_t.results").orderBy("result_id").collect()
    assert [(r.status, r.test_name) for r in stored] == [("pass", "unique_id"), ("pass", "x")]
    assert testlog.latest(spark.table("monitoring_t.results"), "pass", 1).count() == 1
    assert testlog.failures(results).count() == 1


def test_numbers_of_another_kind_fail_and_are_never_lost(rows):
    from tidemill.plans import glucose

    good = '{"_id":"a","date":99999999999999999,"sgv":120,"noise":1.0,"rssi":100.0,"filtered":"9"}'
    row = glucose.entries(rows([(good,)], "raw string")).first()
    assert (row.sgv, row.noise, row.rssi, row.filtered, row.date) == (120.0, 1, 100, 9.0, None)
    for bad in ('"sgv":"120"', '"sgv":"LOW"', '"noise":1.5', '"rssi":{}', '"filtered":"x"'):
        with pytest.raises(Exception, match="is no (double|int)"):
            glucose.entries(rows([('{"_id":"a",' + bad + "}",)], "raw string")).collect()
    pump = glucose.device_status(rows([('{"_id":"a","pump":{"reservoir":"12.5"}}',)], "raw string")).first().pump
    assert pump.reservoir == 12.5


def test_variant_copies_and_unions(spark):
    from tidemill.functions.jsons import row_as_variant, variant_columns
    from tidemill.operators.rows import union_all

    frame = spark.sql("SELECT 1L AS id, 'x' AS `a b`, CAST(NULL AS DOUBLE) AS v UNION ALL SELECT NULL, '', 2.5D")
    copies = row_as_variant(frame).select("raw_data")
    got = {tuple(r) for r in variant_columns(copies, "id bigint, `a b` string, v double, other int").collect()}
    assert got == {(1, "x", None, None), (None, "", 2.5, None)}
    both = union_all(frame, frame.select("id"), frame.limit(0))
    assert both.columns == ["id", "a b", "v"] and both.count() == 4
    with pytest.raises(ValueError):
        union_all()
