"""Manifests, dataset publish and tables."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import objsync as ob
from objsync.plans import publish

SCHEMA = (
    T.StructType()
    .add("id", "long")
    .add("name", "string")
    .add('odd "name"', "double")
    .add("day", "date")
    .add("price", T.DecimalType(12, 2))
)


def entries(text):
    return json.loads(text)["objects"][0]["fields"]


def test_manifest():
    config = {
        "string": {"type": "Text", "canTruncateValue": "true"},
        "date": {"type": "Date", "format": "yyyy-MM-dd"},
        "decimal(12,2)": {"type": "Numeric", "precision": "12", "scale": "2", "defaultValue": "1.5"},
        "long": {"type": "Numeric", "precision": "18"},
    }
    text = ob.dataset_manifest(SCHEMA, "Sales", config)
    manifest = json.loads(text)
    assert manifest["fileFormat"] == {
        "charsetName": "UTF-8",
        "fieldsDelimitedBy": ",",
        "numberOfLinesToIgnore": 0,
    }
    (dataset,) = manifest["objects"]
    assert dataset["fullyQualifiedName"] == dataset["label"] == dataset["name"] == "Sales"
    plain = {"description": "", "isSystemField": False, "isUniqueId": False, "isMultiValue": False}
    names = ["id", "name", 'odd "name"', "day", "price"]
    parts = [
        {"type": "Numeric", "precision": 18, "defaultValue": 0, "scale": 0},
        {"type": "Text", "canTruncateValue": "true"},
        {"type": "Numeric", "precision": 16, "defaultValue": 0, "scale": 6},
        {"type": "Date", "format": "yyyy-MM-dd"},
        {"type": "Numeric", "precision": 12, "defaultValue": 1.5, "scale": 2},
    ]
    assert dataset["fields"] == [
        {**plain, "fullyQualifiedName": f"Sales.{n}", "label": n, "name": n, **part}
        for n, part in zip(names, parts)
    ]


def test_types_without_an_entry_are_text():
    types = {f["name"]: f["type"] for f in entries(ob.dataset_manifest(SCHEMA, "S"))}
    assert types["day"] == types["price"] == types["name"] == "Text"


def test_config_as_json_text_with_its_own_type_member():
    config = json.dumps({"long": {"kind": "Date", "format": "s"}})
    fields = entries(ob.dataset_manifest(SCHEMA, "S", config, type_key="kind"))
    assert fields[0]["type"] == "Date" and fields[0]["format"] == "s"
    assert fields[2]["type"] == "Numeric" and fields[3]["type"] == "Text"


def test_field_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    rows = ob.field_table(df, "Sales").collect()
    assert [(r["name"], r["type"], r["precision"], r["scale"]) for r in rows] == [
        ("id", "Numeric", 18, 0),
        ("name", "Text", None, None),
        ('odd "name"', "Numeric", 16, 6),
        ("day", "Text", None, None),
        ("price", "Text", None, None),
    ]


def lines_of(spark, path):
    parts = ob.published_parts(spark, path).orderBy("run", "part_no").collect()
    return sorted("".join(p["payload"] for p in parts).split("\n")[1:])


def test_publish_modes(spark, tmp_path):
    path = str(tmp_path / "dataset")
    first = spark.range(3)
    second = spark.range(10, 12)
    ob.publish_dataset(first, path, "S", ["id"])
    assert lines_of(spark, path) == ["0", "1", "2"]
    ob.publish_dataset(second, path, "S", ["id"], mode="ignore", app="Folder")
    assert lines_of(spark, path) == ["0", "1", "10", "11", "2"]
    ob.publish_dataset(second, path, "S", ["id"], mode="Overwrite", max_bytes=2)
    assert lines_of(spark, path) == ["10", "11"]
    parts = ob.published_parts(spark, path).orderBy("part_no").collect()
    assert [(p["part_no"], p["payload"]) for p in parts] == [(1, "\n10"), (2, "\n11")]
    (header,) = ob.published_manifests(spark, path).collect()
    assert (header["operation"], header["format"], header["alias"]) == ("Overwrite", "Csv", "S")
    assert entries(header["manifest"])[0]["name"] == "id"
    every = publish.commits(spark, path).orderBy("committed_at").collect()
    assert [c["operation"] for c in every] == ["Append", "Append", "Overwrite"]
    assert {c["action"] for c in every} == {"Process"}


def test_refused_scale_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "refused")
    config = {"long": {"type": "Numeric", "precision": "18", "scale": "7"}}
    with pytest.raises(ValueError, match="scale 7"):
        ob.publish_dataset(spark.range(3), path, "S", ["id"], config=config)
    assert not os.path.exists(path)


def test_failed_part_leaves_no_commit(spark, tmp_path):
    path = str(tmp_path / "failing")
    ob.publish_dataset(spark.range(2), path, "S", ["id"])
    broken = spark.range(5).select(
        F.when(F.col("id") == 3, F.raise_error(F.lit("no")).cast("bigint"))
        .otherwise(F.col("id"))
        .alias("id")
    )
    with pytest.raises(Exception, match="no"):
        ob.publish_dataset(broken, path, "S", ["id"], mode="overwrite")
    assert lines_of(spark, path) == ["0", "1"]
    ob.publish_dataset(spark.range(5), path, "S", ["id"], mode="overwrite")
    assert lines_of(spark, path) == ["0", "1", "2", "3", "4"]


@pytest.mark.parametrize(
    "part, totals",
    [
        ((2, 1, 2, "\nx"), (1, 1, 2)),  # a number is missing
        ((1, 1, 9, "\nx"), (1, 1, 9)),  # a text was altered
        ((1, 1, 2, "\nx"), (1, 2, 2)),  # a row was lost
        ((1, 2, 4, "\nx\ny"), (1, 2, 4)),  # above the limit
    ],
)
def test_parts_that_are_not_whole_leave_no_commit(spark, tmp_path, monkeypatch, part, totals):
    path = str(tmp_path / "torn")

    def torn(df, parts_path, order_by, max_bytes, *_):
        schema = "shard bigint, seq bigint, n_rows bigint, n_bytes bigint, payload string"
        spark.createDataFrame([(0, *part)], schema).write.parquet(parts_path)
        return dict(zip(("n_batches", "n_rows", "n_bytes"), totals), max_bytes=max_bytes)

    monkeypatch.setattr(publish, "write_payloads", torn)
    with pytest.raises(RuntimeError):
        ob.publish_dataset(spark.range(2), path, "S", ["id"], max_bytes=3)
    assert not os.path.exists(f"{path}/commits")


def test_nothing_published(spark, tmp_path):
    with pytest.raises(Exception):
        ob.published_parts(spark, str(tmp_path / "nothing"))


def test_publish_of_no_rows(spark, tmp_path):
    path = str(tmp_path / "empty")
    ob.publish_dataset(spark.range(0), path, "S", ["id"])
    assert ob.published_parts(spark, path).count() == 0


def test_tables(spark, tmp_path):
    df = spark.range(5).select("id", F.lit("x").alias("t"))
    path = str(tmp_path / "it's an extract")
    ob.save_extract(df.limit(1), path)
    ob.save_extract(df, path)
    assert ob.register_extract(spark, "extract", path).count() == 5
    kind = spark.sql("DESCRIBE TABLE EXTENDED extract").where("col_name = 'Type'")
    assert kind.first()["data_type"] == "EXTERNAL"
    spark.sql("DROP TABLE extract")
    assert spark.read.parquet(path).count() == 5

    ob.create_empty_table(df, "loaded")
    assert spark.table("loaded").count() == 0
    assert spark.table("loaded").dtypes == df.dtypes
    ob.save_table(df, "loaded")
    assert spark.table("loaded").count() == 5
    spark.sql("DROP TABLE loaded")
    ob.create_empty_table(df, "outside", str(tmp_path / "outside"))
    assert spark.table("outside").count() == 0
    spark.sql("DROP TABLE outside")


def test_replacing_a_table_by_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "versions")
    ob.save_extract(spark.range(5), f"{path}/first")
    ob.register_extract(spark, "versioned", f"{path}/first")
    ob.replace_extract(spark.table("versioned").where("id > 2"), "versioned", path)
    assert sorted(r["id"] for r in spark.table("versioned").collect()) == [3, 4]
    broken = spark.table("versioned").select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        ob.replace_extract(broken, "versioned", path)
    assert spark.table("versioned").count() == 2
    spark.sql("DROP TABLE versioned")
    assert spark.read.parquet(f"{path}/first").count() == 5
