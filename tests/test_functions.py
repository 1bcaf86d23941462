import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.functions import dates, jsons, numbers, text


def column(spark, values, dtype, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_title_case_starts_a_word_at_every_run_of_letters(spark):
    values = ["o'neil mary-ann", "3rd", "VAN DER berg", "", None, "élan ÉTÉ"]
    assert column(spark, values, "string", text.title_case) == [
        "O'Neil Mary-Ann", "3Rd", "Van Der Berg", "", None, "Élan Été",
    ]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB'- 3z\t_é", max_size=12), min_size=1, max_size=20))
def test_text_functions_agree_with_python(spark, values):
    assert column(spark, values, "string", text.title_case) == [v.title() for v in values]
    assert column(spark, values, "string", text.strip) == [v.strip() for v in values]


def test_strip_removes_all_unicode_white_space(spark):
    values = ["   x y 　\t\n", "\x1cx\x1f", "x", "   "]
    assert column(spark, values, "string", text.strip) == [v.strip() for v in values]


def test_digits(spark):
    values = ["+1 (555) 010-99", "٣4", None, "x"]
    assert column(spark, values, "string", text.digits_only) == ["155501099", "٣4", "", ""]
    assert column(spark, values, "string", text.ascii_digits_only) == ["155501099", "4", "", ""]


def test_dotted_part(spark):
    names = ["test.shop.orders.unique_id.abc", "a.b", "plain", None]
    assert column(spark, names, "string", lambda c: text.dotted_part(c, 2)) == ["unique_id", "a", None, None]
    assert column(spark, names, "string", lambda c: text.dotted_part(c, 3, 3)) == ["orders", None, None, None]


def test_lenient_dates(spark):
    values = ["2024-01-02", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00", "bad", "", None, "02/01/2024"]
    moment = dt.datetime
    assert column(spark, values, "string", lambda c: dates.parse_timestamp(c, ["dd/MM/yyyy"])) == [
        moment(2024, 1, 2), moment(2024, 1, 2, 3, 4, 5), moment(2024, 1, 2, 1, 4, 5), None, None, None, moment(2024, 1, 2),
    ]


def test_strict_dates_fail_the_job(spark):
    assert column(spark, ["2024-01-02", None], "string", dates.parse_timestamp_strict)[1] is None
    with pytest.raises(Exception, match="not a date: bad"):
        column(spark, ["2024-01-02", "bad"], "string", dates.parse_timestamp_strict)


def test_elapsed_days_are_whole_and_never_negative(spark):
    pairs = [
        ("2024-01-01 12:00:00", "2024-01-03 11:00:00", 1),
        ("2024-01-01 12:00:00", "2024-01-01 13:00:00", 0),
        ("2024-01-01 12:00:00", "2024-01-01 01:00:00", None),
        ("2024-01-01 12:00:00", None, None),
    ]
    df = spark.createDataFrame([p[:2] for p in pairs], "a string, b string")
    a, b = (F.col(c).cast("timestamp_ntz") for c in "ab")
    assert [r[0] for r in df.select(dates.elapsed_days(a, b)).collect()] == [p[2] for p in pairs]


def test_days_until_midnight_round_down(spark):
    values = ["2024-03-01 00:00:00", "2024-03-01 00:00:01", "2024-03-10 15:00:00", "2024-03-11 09:00:00", None]
    as_of = dates.instant("2024-03-10 18:00:00")
    assert column(
        spark, values, "string", lambda c: dates.days_until_midnight_of(as_of, c.cast("timestamp_ntz"))
    ) == [9, 8, -1, -2, None]


def test_json_dates_by_type(spark):
    documents = ["1704067201500", '"2024-01-01T00:00:01.5Z"', "0", '""', "1.5", "null", '"bad"', '{"a":1}', None]
    moment = dt.datetime(2024, 1, 1, 0, 0, 1, 500000)
    got = column(spark, documents, "string", lambda c: dates.parse_variant_timestamp(F.parse_json(c)))
    assert got == [moment, moment] + [None] * 7


def test_numbers(spark):
    values = ["12.5", " 3 ", "-1", "n/a", "12d", "5f", "1e3", "nan", None, "7."]
    parsed = column(spark, values, "string", numbers.parse_number)
    assert parsed == [12.5, 3.0, -1.0, None, None, None, 1000.0, None, None, 7.0]
    assert column(spark, [-1.0, 0.0, None], "double", numbers.not_negative) == [None, 0.0, None]


def test_ratio_rule_for_zero_holds_even_without_a_part(spark):
    df = spark.createDataFrame([(1.0, 4.0), (None, 0.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    got = [r[0] for r in df.select(numbers.ratio(F.col("a"), F.col("b"), when_zero=0.0)).collect()]
    assert got == [0.25, 0.0, 0.0, None]


def test_mmol(spark):
    values = list(range(0, 1000))
    assert column(spark, values, "int", numbers.mmol_per_litre) == [round(v / 18.0, 1) for v in values]


def test_absent_and_null_keys_differ(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": null}',), ("{}",)], "raw string")
    parsed = jsons.parse_records(df, "raw", "a variant")
    got = parsed.select(
        jsons.present(F.col("a")), jsons.filled(F.col("a")), jsons.default_if_absent(F.col("a"), "int", F.lit(9))
    ).collect()
    assert [tuple(r) for r in got] == [(True, True, 1), (True, False, None), (False, False, 9)]


def test_each_text_is_parsed_once(spark):
    df = spark.createDataFrame([('{"a": 1, "b": 2}',)], "raw string")
    parsed = jsons.require_keys(jsons.parse_records(df, "raw", "a variant, b variant"), ["a", "b"])
    plan = parsed.select(F.col("a").cast("int"), F.col("b").cast("int"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_scalar_or_member(spark):
    documents = ["1.5", '{"bolusiob": 2.5}', '{"other": 1}', "null", None]
    got = column(spark, documents, "string", lambda c: jsons.scalar_or_member(F.parse_json(c), "bolusiob", "double"))
    assert got == [1.5, 2.5, None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_iso_forms_and_limits_in_any_session_zone(spark, rows, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        forms = {
            "2024-01-01T10:00+02:00": dt.datetime(2024, 1, 1, 8),
            "2024-01-01 10:00:00 Europe/Paris": dt.datetime(2024, 1, 1, 9),
            "20240102": dt.datetime(2024, 1, 2),
            "20240102T0304": dt.datetime(2024, 1, 2, 3, 4),
            "2024-W01-1": dt.datetime(2024, 1, 1),
            "2020-W53-7": dt.datetime(2021, 1, 3),
            "2024-W60-1": None,
            "2024-01-01 10:00:00 Nowhere/Atall": None,
        }
        df = rows([(t,) for t in forms], "t string")
        assert {r.t: r.p for r in df.select("t", dates.parse_timestamp(F.col("t")).alias("p")).collect()} == forms
        days = rows([("2024-03-10 02:30:00", "2024-03-11 03:00:00")], "a string, b string").select(
            dates.elapsed_days(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz"))
        )
        assert days.first()[0] == 1
        far = rows([(99999999999999999,), (0,)], "m long").select(dates.from_epoch_millis(F.col("m")))
        assert [r[0] for r in far.collect()] == [None, dt.datetime(1970, 1, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
