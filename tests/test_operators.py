import random

import pytest
from pyspark.sql import functions as F

from tidemill.errors import QualityError
from tidemill.operators import joins, quality
from tidemill.operators import rows as ops
from tidemill.operators.upsert import newest, upsert, upsert_columns


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_keep_last_takes_nulls_as_one_key(rows):
    df = rows([(1, "a", 1), (1, "b", 2), (None, "c", 1), (None, "d", 3)], "k int, v string, _seq int")
    assert plain(ops.keep_last(df, ["k"])) == [(1, "b", 2), (None, "d", 3)]


def test_keep_last_limits_groups_before_the_shuffle(rows):
    df = rows([(1, "a", 1)], "k int, v string, _seq int")
    plan = ops.keep_last(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:]


def test_keep_last_needs_its_order_column(rows):
    with pytest.raises(ValueError, match="_seq"):
        ops.keep_last(rows([(1,)], "k int"), ["k"])


def test_last_rule_wins(rows):
    df = rows([(-1,), (5,), (50,), (None,)], "q int")
    rules = [(F.col("q") <= 0, "none"), (F.col("q") < 10, "few")]
    assert [r[0] for r in df.select(ops.last_rule_wins("many", rules)).collect()] == ["few", "few", "many", "many"]
    assert [r[0] for r in df.select(ops.last_rule_wins("x", [])).collect()] == ["x"] * 4


def test_missing_values(rows):
    df = rows([(1, None, 1.0), (2, "x", float("nan")), (3, "y", 2.0)], "k int, s string, d double")
    assert plain(ops.drop_missing(df, ["s", "d"])) == [(3, "y", 2.0)]
    assert plain(ops.fill(df, {"s": ""}).select("s")) == [("",), ("x",), ("y",)]
    assert plain(ops.nan_to_null(df).select("d")) == [(1.0,), (2.0,), (None,)]


def test_projections(rows):
    df = rows([(1, "a")], "id int, name string")
    assert plain(ops.upper_names(df)) == [(1, "A")]
    assert plain(ops.suffix_text(df, "name")) == [(1, "a_transformed")]
    assert plain(ops.mark_transformed(df)) == [(1, "a", True)]
    assert ops.rename(df, {"name": "label"}).columns == ["id", "label"]
    assert plain(ops.add_if_absent(df, "name", F.lit("z"))) == [(1, "a")]
    assert plain(ops.where_equals(rows([(1,), (None,), (2,)], "id int"), "id", 1)) == [(1,)]
    assert str(ops.stamp(df, "2024-01-01").first()["last_updated"]) == "2024-01-01 00:00:00"
    assert ops.stamp(df).first()["last_updated"] is not None
    assert plain(ops.kept_and_dropped(df, df.limit(0))) == [(1, 0, 1)]


@pytest.fixture
def skewed(rows):
    """A third of all rows under one key, a third under null, the rest spread and partly unmatched."""
    dice = random.Random(7)
    keys = [1] * 400 + [None] * 400 + [dice.randrange(2, 60) for _ in range(400)]
    facts = rows([(k, i) for i, k in enumerate(keys)], "k int, i int")
    lookup = rows([(k, f"n{k}") for k in range(0, 40)] + [(1, "twin"), (None, "null")], "k int, name string")
    return facts, lookup


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_salted_join_equals_a_plain_join(skewed, how):
    facts, lookup = skewed
    expected = plain(facts.join(lookup, "k", how))
    assert plain(joins.salted_join(facts, lookup, ["k"], how)) == expected
    assert plain(joins.lookup_join(facts, lookup, "k", how, broadcast_limit=0)) == expected
    assert plain(joins.lookup_join(facts, lookup, "k", how)) == expected


def test_salted_join_on_two_keys(skewed):
    facts, lookup = skewed
    facts, lookup = facts.withColumn("j", F.lit(5)), lookup.withColumn("j", F.lit(5))
    assert plain(joins.salted_join(facts, lookup, ["k", "j"])) == plain(facts.join(lookup, ["k", "j"], "left"))


def test_salting_spreads_the_hot_key_over_tasks(spark, skewed):
    facts, lookup = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.salted_join(facts.repartition(16), lookup, ["k"]).filter("k = 1")
        per_task = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_task) == 4


def test_hot_keys_are_bounded_and_found(skewed):
    facts, _ = skewed
    hot = joins.hot_keys(facts, ["k"], most=3)
    assert hot.count() <= 3
    assert hot.join(facts.filter("k = 1").limit(1).select(joins.key_hash(["k"]).alias("h")), F.col("h") == F.col("_hot")).count() == 1


def test_shared_columns_get_suffixes(rows):
    left, right = rows([(1, "a")], "k int, v string"), rows([(1, "b")], "k int, v string")
    assert joins.lookup_join(left, right, "k").columns == ["k", "v_x", "v_y"]


def test_orphans_report_null_references(rows):
    child = rows([(1, "a"), (9, "b"), (None, "c")], "k int, v string")
    parent = rows([(1,), (1,), (None,)], "id int")
    for limit in (None, 0):
        assert plain(joins.orphans(child, "k", parent, "id", broadcast_limit=limit)) == [(9, "b"), (None, "c")]


def test_upsert(rows):
    old = rows([(1, "a"), (2, "b")], "id int, v string")
    batch = rows([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "id int, v string, _seq int")
    assert plain(newest(batch, ["id"])) == [(2, "y"), (3, "z")]
    assert plain(upsert(old, batch, ["id"])) == [(1, "a"), (2, "y"), (3, "z")]


def test_partial_upsert_keeps_other_columns(rows):
    schema = "id int, name string, status string"
    old = rows([(1, "one", "pass"), (2, None, "fail")], schema)
    batch = rows([(2, "new name", None), (3, "three", "pass")], schema)
    assert plain(upsert_columns(old, batch, ["id"], ["status"])) == [
        (1, "one", "pass"), (2, None, None), (3, "three", "pass"),
    ]


def test_checks(rows):
    df = rows([(1, "a"), (1, "b"), (None, None), (None, "z")], "k int, v string")
    assert quality.not_null(df, "k").count() == 2
    assert plain(quality.unique(df, "k")) == [(1, 2), (None, 2)]
    assert plain(quality.accepted_values(df, "v", ["a", "b"])) == [(None, "z")]
    checks = [
        quality.Check("not_null", "k"), quality.Check("unique", "v"), quality.Check("accepted_values", "v", ["a", "b", "z"]),
        quality.Check("cross_table", "k", reference=rows([(1,)], "id int"), reference_column="id"),
    ]
    assert plain(quality.run_suite(df, checks)) == [
        ("accepted_values_v", "v", 0, "pass"), ("cross_table_k", "k", 2, "fail"),
        ("not_null_k", "k", 2, "fail"), ("unique_v", "v", 0, "pass"),
    ]
    with pytest.raises(ValueError, match="unknown check"):
        quality.run_suite(df, [quality.Check("odd", "k")])


def test_gate_checks_in_order(rows):
    df = rows([(1, None), (2, "x")], "k int, v string")
    assert quality.validate(df, max_nulls_percent=50.0) is df
    with pytest.raises(QualityError, match="2 rows, fewer than 3"):
        quality.validate(df, min_rows=3, required_columns=["nope"])
    with pytest.raises(QualityError, match=r"columns not there: \['nope'\]"):
        quality.validate(df, required_columns=["k", "nope"])
    with pytest.raises(QualityError, match=r"'v': '50.00%'"):
        quality.validate(df)
    with pytest.raises(QualityError, match="0 rows"):
        quality.validate(df.limit(0))


def test_profile(rows):
    df = rows([(1, "a", True), (3, "a", None), (None, None, False)], "n int, s string, b boolean")
    got = {r["column"]: r for r in quality.profile(df, "step").collect()}
    assert (got["n"]["kind"], got["n"]["min"], got["n"]["max"], got["n"]["mean"]) == ("numeric", "1", "3", 2.0)
    assert (got["s"]["kind"], got["s"]["distinct_count"], got["s"]["null_count"]) == ("other", 1, 1)
    assert got["b"]["kind"] == "numeric" and got["b"]["row_count"] == 3 and got["b"]["column_count"] == 3
    assert round(got["n"]["null_percent"], 4) == 33.3333
    assert [r["null_percent"] for r in quality.profile(df.limit(0)).collect()] == [0.0] * 3
    assert quality.profile(df, approximate=True).filter("column = 's'").first()["distinct_count"] == 1


def test_record_checks(rows):
    good = rows([(1, "a")], "id int, name string")
    assert plain(quality.require_fields(good)) == [(1, "a")]
    with pytest.raises(QualityError, match="must have fields: tag"):
        quality.require_fields(good, ["id", "tag"])
    with pytest.raises(Exception, match="must have a 'name' field"):
        quality.require_fields(rows([(1, None)], "id int, name string")).collect()


def test_split_valid(rows):
    df = rows([("1", "2.5"), ("x", "1"), (None, "1"), ("2", "12d"), ("3", None)], "id string, v string")
    good, bad = quality.split_valid(df, "id int, v double, note string", ["id"])
    assert plain(good) == [(1, 2.5, None), (3, None, None)]
    assert plain(bad) == [("2", "12d"), ("x", "1"), (None, "1")]
