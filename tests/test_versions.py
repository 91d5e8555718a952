"""Extracts with versions: conflicts, updates by file, reading at a version, removal."""

from __future__ import annotations

import os
import threading

import pytest
from pyspark.sql import functions as F

import objsync as ob
from objsync.plans.versions import candidate_files


@pytest.fixture
def extract(spark, tmp_path):
    path = str(tmp_path / "an extract")
    rows = spark.range(1000).select("id", F.col("id").cast("string").alias("name"), F.lit(None).cast("string").alias("x"))
    rows = rows.unionByName(spark.createDataFrame([(None, "no key", None), (5, "twice", None)], "id long, name string, x string"))
    assert ob.commit_extract(rows.repartitionByRange(8, "id"), path, "id") == 1
    return path


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("nulls", ["keep", "set", "reject"])
def test_update_files_equals_update_by_key(spark, extract, nulls):
    updates = spark.createDataFrame(
        [("5", "new 5"), ("6", None), ("7", "a"), ("7", "b"), ("5000", "none"), ("odd", "none"), (None, "none")],
        "id string, name string",
    )
    before = ob.read_extract(spark, extract)
    expected = rows(ob.update_by_key(before, updates, "id", nulls))
    assert ob.update_files(spark, extract, updates, nulls) == 2
    assert rows(ob.read_extract(spark, extract)) == expected
    assert rows(ob.read_extract(spark, extract, 1)) == rows(before)
    last = ob.extract_versions(spark, extract).where("version = 2").first()
    assert (last["n_written"], last["n_rows"], last["base"], last["operation"]) == (1, 1002, 1, "update")


def test_an_update_that_meets_nothing_writes_no_file(spark, extract):
    updates = spark.createDataFrame([(7000, "x")], "id long, name string")
    ob.update_files(spark, extract, updates)
    assert ob.extract_versions(spark, extract).where("version = 2").first()["n_written"] == 0
    assert ob.read_extract(spark, extract).count() == 1002


def test_candidates_leave_out_files_inside_the_range(spark, extract):
    # keys of the first and the last file: those between are told by their bitmaps
    held = ob.extract_versions(spark, extract).first()
    files = spark.read.parquet(f"{extract}/{held['list']}")
    some = candidate_files(files, spark.createDataFrame([(1,), (998,)], "k long"))
    assert files.count() == 8 and 2 <= some.count() < 8


def test_of_two_writers_one_is_refused(spark, extract):
    ob.commit_extract(spark.range(3).selectExpr("id", "'a' as name", "'b' as x"), extract, "id", base=1)
    with pytest.raises(ob.WriteConflict):
        ob.update_files(spark, extract, spark.createDataFrame([(5, "late")], "id long, name string"), base=1)
    assert ob.read_extract(spark, extract).count() == 3

    made, refused = [], []

    def write(name):
        try:
            made.append(ob.commit_extract(spark.createDataFrame([(1, name, "x")], "id long, name string, x string"), extract, "id", base=2))
        except ob.WriteConflict:
            refused.append(name)

    writers = [threading.Thread(target=write, args=(f"w{i}",)) for i in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert made == [3] and len(refused) == 3
    assert ob.read_extract(spark, extract).first()["name"] not in refused


def data_files(path):
    return {f for _, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


def test_vacuum_removes_what_no_kept_version_names(spark, extract):
    first = data_files(extract)
    ob.update_files(spark, extract, spark.createDataFrame([(5, "new")], "id long, name string"))
    ob.update_files(spark, extract, spark.createDataFrame([(900, "new")], "id long, name string"))
    expected = {v: rows(ob.read_extract(spark, extract, v)) for v in (2, 3)}
    assert ob.extract_vacuum(spark, extract, keep=2) == 1
    assert len(first - data_files(extract)) == 1
    assert {v: rows(ob.read_extract(spark, extract, v)) for v in (2, 3)} == expected
    with pytest.raises(ValueError):
        ob.read_extract(spark, extract, 1)
    assert ob.extract_vacuum(spark, extract, keep=2) == 0
    with pytest.raises(ValueError):
        ob.extract_vacuum(spark, extract, keep=0)


def test_an_extract_without_versions(spark, tmp_path):
    path = str(tmp_path / "none")
    assert ob.extract_versions(spark, path).collect() == []
    with pytest.raises(ValueError):
        ob.read_extract(spark, path)
    with pytest.raises(ValueError):
        ob.update_files(spark, path, spark.range(1).withColumn("x", F.lit(1)))
