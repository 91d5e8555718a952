"""Keyed updates, inserts and their outcomes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import objsync as ob

TARGET = [("a", "old a", 1), ("b", "old b", 2), ("c", None, 3), (None, "no id", 4)]


@pytest.fixture
def target(spark):
    return spark.createDataFrame(TARGET, "Id string, Description string, n int")


def updates(spark, rows):
    return spark.createDataFrame(rows, "Id string, Description string")


def by_id(df):
    return {r["Id"]: tuple(r)[1:] for r in df.collect()}


def test_update(spark, target):
    changes = updates(spark, [("a", "new"), ("x", "lost"), (None, "nobody")])
    assert by_id(ob.update_by_key(target, changes, "Id")) == {
        "a": ("new", 1),
        "b": ("old b", 2),
        "c": (None, 3),
        None: ("no id", 4),
    }


def test_repeated_keys_change_nothing(spark, target):
    changes = updates(spark, [("a", "one"), ("a", "two"), ("b", "new")])
    after = by_id(ob.update_by_key(target, changes, "Id"))
    assert after["a"] == ("old a", 1)
    assert after["b"] == ("new", 2)
    results = ob.update_results(target, changes, "Id").orderBy("Id", "Error").collect()
    assert [tuple(r) for r in results] == [
        ("a", False, False, "duplicate key in the update"),
        ("a", False, False, "duplicate key in the update"),
        ("b", True, False, ""),
    ]


def test_null_rules(spark, target):
    changes = updates(spark, [("a", None), ("c", "new c")])
    assert by_id(ob.update_by_key(target, changes, "Id", "keep"))["a"] == ("old a", 1)
    assert by_id(ob.update_by_key(target, changes, "Id", "set"))["a"] == (None, 1)
    with pytest.raises(Exception, match="null in an update of column Description"):
        ob.update_by_key(target, changes, "Id").collect()
    with pytest.raises(ValueError):
        ob.update_by_key(target, changes, "Id", "ignore")
    refused = by_id(ob.update_results(target, changes, "Id"))
    assert refused["a"] == (False, False, "null value in the update")
    assert by_id(ob.update_results(target, changes, "Id", "set"))["a"] == (True, False, "")


def test_update_is_safe_to_repeat(spark, target):
    changes = updates(spark, [("a", "new")])
    once = ob.update_by_key(target, changes, "Id")
    twice = ob.update_by_key(once, changes, "Id")
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_unknown_and_missing_keys(spark, target):
    changes = updates(spark, [("x", "1"), (None, "2")])
    assert by_id(ob.update_results(target, changes, "Id")) == {
        "x": (False, False, "no row with this key"),
        None: (False, False, "key is missing"),
    }


def test_update_columns_are_checked(spark, target):
    with pytest.raises(ValueError):
        ob.update_by_key(target, spark.createDataFrame([("a", 1)], "Id string, z int"), "Id")
    with pytest.raises(ValueError):
        ob.update_by_key(target, spark.createDataFrame([(1,)], "n int"), "Id")


def test_update_of_nothing_but_keys(spark, target):
    changes = spark.createDataFrame([("a",)], "Id string")
    assert by_id(ob.update_by_key(target, changes, "Id")) == by_id(target)


def test_a_hot_key(spark, target):
    """Most updates carry one key; none of them is lost from the outcomes."""
    many = spark.range(20000).select(
        F.when(F.col("id") % 3 > 0, "a").otherwise(F.col("id").cast("string")).alias("Id"),
        F.lit("t").alias("Description"),
    )
    results = ob.update_results(target, many, "Id")
    counts = {r["Error"]: r["n_rows"] for r in ob.error_summary(results).collect()}
    assert counts == {"duplicate key in the update": 13333, "no row with this key": 6667}


def test_a_hot_key_in_the_target_is_split(spark):
    """Rows without a key share one join partition, which Spark may split."""
    hot = spark.range(0, 200000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 60000).alias("Id"),
        F.md5(F.col("id").cast("string")).alias("d"),
    )
    changes = spark.range(30000).select(F.col("id").alias("Id"), F.lit("new").alias("d"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        after = ob.update_by_key(hot, changes, "Id")
        rows = after.collect()
        plan = after._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in conf:
            spark.conf.unset(name)
    assert "skew=true" in plan
    assert len(rows) == 200000
    expected = hot.where("Id < 30000").count()
    assert sum(r["d"] == "new" for r in rows) == expected


def test_insert(spark, target):
    rows = spark.createDataFrame([("z", 9)], "Id string, n int")
    after = ob.insert_rows(target, rows)
    assert after.columns == target.columns
    assert by_id(after)["z"] == (None, 9)
    assert by_id(ob.insert_results(rows, "Id")) == {"z": (True, True, "")}


def test_summaries(spark):
    schema = "Success string, Created string, Id string, Error string"
    results = spark.createDataFrame(
        [
            ("true", "TRUE", "1", ""),
            ("True", "false", "2", ""),
            ("yes", "true", "3", "bad"),
            ("false", "false", "4", "bad"),
            (None, None, "5", "gone"),
        ],
        schema,
    )
    counts = {r["status"]: r["n_rows"] for r in ob.result_summary(results).collect()}
    assert counts == {"created": 1, "updated": 1, "failed": 3}
    assert sorted(map(tuple, ob.failed_rows(results).collect())) == [
        ("3", "bad"),
        ("4", "bad"),
        ("5", "gone"),
    ]
    errors = {r["Error"]: r["n_rows"] for r in ob.error_summary(results).collect()}
    assert errors == {"bad": 2, "gone": 1}


def test_job_status(spark):
    batches = spark.createDataFrame(
        [
            ("done", 1, "Completed"),
            ("done", 2, "Completed"),
            ("failed", 1, "Failed"),
            ("failed", 2, "Completed"),
            ("open", 1, "Completed"),
            ("open", 2, "InProgress"),
            ("unknown", 1, None),
        ],
        "job_id string, batch_id int, state string",
    )
    assert {r["job_id"]: tuple(r)[1:] for r in ob.job_status(batches).collect()} == {
        "done": (2, 0, 0, True, True),
        "failed": (2, 0, 1, True, False),
        "open": (2, 1, 0, False, False),
        "unknown": (1, 1, 0, False, False),
    }


def test_rejected_nulls(spark, target):
    changes = updates(spark, [("a", None), ("c", "new c")])
    after = by_id(ob.update_by_key(target, changes, "Id", "reject"))
    assert after["a"] == ("old a", 1) and after["c"] == ("new c", 3)
    said = by_id(ob.update_results(target, changes, "Id", "reject"))
    assert said == {"a": (False, False, "null value in the update"), "c": (True, False, "")}


def test_key_of_another_type(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "Id long, v string")
    changes = spark.createDataFrame([("1", "new"), ("x", "lost")], "Id string, v string")
    assert by_id(ob.update_by_key(target, changes, "Id")) == {1: ("new",), 2: ("b",)}
    with pytest.raises(ValueError, match="key Id is array"):
        ob.update_by_key(target, changes.withColumn("Id", F.array("Id")), "Id")


def test_refused_inserts(spark, target):
    rows = updates(spark, [("x", "1"), ("y", "2"), ("y", "3"), (None, "4")])
    said = sorted(tuple(r) for r in ob.insert_results(rows.where("Id is not null"), "Id").collect())
    twice = ("y", False, False, "duplicate key in the insert")
    assert said == [("x", True, True, ""), twice, twice]
    assert by_id(ob.insert_results(rows, "Id"))[None] == (False, False, "key is missing")
    assert ob.insert_rows(target, rows, "Id").count() == len(TARGET) + 1
