"""Queries on tables repeated with shifted keys, as larger copies are made."""

from __future__ import annotations

import duckdb

import __spark_entry__ as entry_point
from tests.compare import difference

SF_DIR = "/root/testdata/sf0.01"


def test_apply_schema_user_ids_past_short(spark, tmp_path):
    # a copy with user ids shifted past 32767, as in the 60x events
    duckdb.sql(
        f"COPY (SELECT event_id + 100000 AS event_id, ts, user_id + 40000 AS user_id,"
        f" event_type, value, props FROM '{SF_DIR}/events.parquet')"
        f" TO '{tmp_path}/events.parquet' (FORMAT parquet)"
    )
    sql = entry_point.oracle_sql()["apply_schema"]
    fn = entry_point.queries()["apply_schema"]
    assert difference(spark, "apply_schema", fn, sql, str(tmp_path)) is None


def test_substring_dedup_every_anchor_split(spark, monkeypatch):
    # the path of hot anchors, window by window, gives what the path by anchors gives
    from objsync.llm import substring_dedup

    monkeypatch.setattr(substring_dedup, "SPLIT_FROM", 0)
    sql = entry_point.oracle_sql()["op10_substring_dedup"]
    fn = entry_point.queries()["op10_substring_dedup"]
    assert difference(spark, "op10_substring_dedup", fn, sql, SF_DIR) is None


def test_read_result_sets_split_lands_in_many_tasks(spark, tmp_path):
    # each split of the input lands its own file; no task takes the whole table
    import glob

    from objsync.session import shared_dir

    duckdb.sql(
        f"COPY (SELECT * FROM '{SF_DIR}/documents.parquet') TO '{tmp_path}/documents.parquet'"
        " (FORMAT parquet, ROW_GROUP_SIZE 100)"
    )
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        before = set(glob.glob(f"{shared_dir(spark)}/objsync/result-sets-*"))
        sql = entry_point.oracle_sql()["read_result_sets_split"]
        fn = entry_point.queries()["read_result_sets_split"]
        assert difference(spark, "read_result_sets_split", fn, sql, str(tmp_path)) is None
        (landed,) = set(glob.glob(f"{shared_dir(spark)}/objsync/result-sets-*")) - before
        assert len(glob.glob(f"{landed}/part-*")) > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_payload_order_judged_before_lines(spark):
    # the keys of a payload are sorted once, not once for each of its lines
    staged = spark.createDataFrame(
        [(1, 2, 9, "h\n1,a\n2,b"), (2, 1, 5, "h\n3,c")], "batch_no bigint, n_rows bigint, n_bytes bigint, payload string"
    )
    lines = entry_point.payload_lines(staged, "h", 100, "batch_no")
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("array_sort")
    assert sorted(r["line"] for r in lines.collect()) == ["1,a", "2,b", "3,c"]
    assert all(r["in_order"] for r in lines.collect())
