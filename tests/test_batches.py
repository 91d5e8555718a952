"""CSV lines, row positions and batches."""

from __future__ import annotations

import datetime
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

import objsync as ob
from objsync.operators import batches
from objsync.operators.positions import range_sorted


def line_of(spark, values, schema):
    df = spark.createDataFrame([values], schema)
    return df.select(ob.csv_line(df)).first()[0]


def test_csv_values(spark):
    values = ["plain", 'a "b"', "x,y", "two\nlines", "cr\rhere", " s ", "", None, "#h", "b\\s"]
    schema = ", ".join(f"c{i} string" for i in range(len(values)))
    assert line_of(spark, tuple(values), schema) == (
        'plain,"a ""b""","x,y","two\nlines","cr\rhere", s ,,,#h,b\\s'
    )


def test_csv_types(spark):
    schema = "i int, d double, b boolean, t timestamp_ntz, f timestamp_ntz, y date, n int"
    values = (
        -1,
        1e10,
        True,
        datetime.datetime(2016, 1, 2, 3, 4, 5),
        datetime.datetime(2016, 1, 2, 3, 4, 5, 120000),
        datetime.date(2016, 1, 2),
        None,
    )
    assert line_of(spark, values, schema) == (
        "-1,1.0E10,true,2016-01-02 03:04:05.0,2016-01-02 03:04:05.12,2016-01-02,"
    )


def test_csv_header():
    schema = T.StructType().add("Id", "string").add("a,b", "string").add('q"', "string")
    assert ob.csv_header(schema) == 'Id,"a,b","q"""'


# No carriage return directly before or after a line feed outside the reader's reach:
# readers may take the pair for one line end.
TEXT = st.text(
    st.sampled_from(list('ab ,"\n#\\é€;\t')) | st.characters(min_codepoint=32, max_codepoint=500),
    max_size=12,
)


@settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(st.lists(st.tuples(TEXT, st.none() | TEXT), min_size=1, max_size=40))
def test_csv_round_trip(spark, tmp_path_factory, pairs):
    rows = [(i, a, b) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    path = str(tmp_path_factory.mktemp("trip") / "files")
    staged = ob.payloads(df, ["id"], max_bytes=200, unique_order=True)
    staged.select("batch_no", "payload").write.partitionBy("batch_no").text(path)
    back = ob.apply_schema(ob.read_result_sets(spark, path), df.schema)
    assert sorted(map(tuple, back.collect())) == [(i, a, b or "") for i, a, b in rows]


def test_single_column_round_trip(spark, tmp_path):
    rows = [("x",), ("",), (None,), (" ",), ("last",)]
    df = spark.createDataFrame(rows, "a string").coalesce(1)
    path = str(tmp_path / "one")
    staged = ob.payloads(df, ["a"])
    staged.select("payload").write.text(path)
    back = sorted(r["a"] for r in ob.read_result_sets(spark, path).collect())
    assert back == ["", "", " ", "last", "x"]


def test_sizes(spark):
    df = spark.range(1000).select("id", F.lit("é").alias("t"))
    exact = ob.estimate_bytes(df).first()
    expected = sum(len(f"{i},é".encode()) for i in range(1000))
    assert tuple(exact) == (1000, expected)
    assert tuple(ob.estimate_bytes(df.limit(0)).first()) == (0, 0)
    sampled = ob.estimate_bytes_sampled(df).first()
    assert sampled["n_rows"] == 1000 and 400 * 10 <= sampled["n_bytes"] <= 600 * 10
    small = df.limit(7)
    assert tuple(ob.estimate_bytes_sampled(small).first()) == tuple(
        ob.estimate_bytes(small).first()
    )
    uneven = ob.estimate_bytes_sampled(spark.range(10, 29), sample_rows=10).first()
    assert tuple(uneven) == (19, 20)


def test_batch_count():
    target = 10 * 1024 * 1024
    assert ob.batch_count(0) == 1
    assert ob.batch_count(target) == 1
    assert ob.batch_count(target + 1) == 2
    assert ob.batch_count(298944, 65536) == 5


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_row_positions(spark, unique, partitions):
    df = spark.range(1000).select(
        (F.col("id") * 7919 % 1009).alias("k"), (F.col("id") % 13).alias("w")
    )
    placed = ob.row_positions(
        df, ["k"], weight=F.col("w"), unique_order=unique, partitions=partitions
    )
    before = 0
    for i, row in enumerate(sorted(placed.collect())):
        assert (row["row_index"], row["weight_before"]) == (i, before)
        before += row["w"]


def test_row_positions_descending_and_empty(spark):
    df = spark.range(100)
    rows = ob.row_positions(df, [F.col("id").desc()], unique_order=True).collect()
    assert all(r["row_index"] == 99 - r["id"] for r in rows)
    assert ob.row_positions(df.limit(0), ["id"]).collect() == []


def test_positions_of_copies_are_spread_and_stable(spark):
    """Two thirds of the rows are one value: no partition may hold them all."""
    df = spark.range(30000).select(
        F.when(F.col("id") < 20000, F.lit("same")).otherwise(F.col("id").cast("string")).alias("k")
    )
    placed = ob.row_positions(df, ["k"], partitions=8)
    indexes = [r["row_index"] for r in placed.collect()]
    assert sorted(indexes) == list(range(30000))
    assert indexes == [r["row_index"] for r in placed.collect()]
    ranged = range_sorted(df, ["k"], partitions=8)
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3 * 30000 / 8


def test_paginate(spark):
    df = spark.range(95)
    pages = ob.paginate(df, ["id"], 10, unique_order=True)
    assert {(r["id"], r["page_no"], r["page_row"]) for r in pages.collect()} == {
        (i, i // 10 + 1, i % 10) for i in range(95)
    }
    with pytest.raises(ValueError):
        ob.paginate(df, ["id"], 0)


def test_planned_batches_are_whole_and_bounded(spark):
    df = spark.range(2000).select("id", F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")))
    planned = ob.plan_batches(df, ["id"], 1000, unique_order=True)
    rows = planned.collect()
    assert sorted(r["id"] for r in rows) == list(range(2000))
    sizes = {}
    for r in rows:
        sizes.setdefault(r["batch_no"], []).append(r["n_bytes"])
    assert max(sum(s) - max(s) for s in sizes.values()) <= 1000
    total = sum(map(sum, sizes.values()))
    assert len(sizes) <= ob.batch_count(total, 1000) == max(sizes)


def test_plan_of_one_batch(spark):
    assert {r["batch_no"] for r in ob.plan_batches(spark.range(50), ["id"]).collect()} == {1}


def test_rows_larger_than_a_batch_leave_no_gap(spark):
    df = spark.range(40).select(
        "id", F.repeat(F.lit("x"), F.when(F.col("id") % 10 == 5, 500).otherwise(3)).alias("t")
    )
    rows = sorted(ob.plan_batches(df, ["id"], 100, unique_order=True).collect())
    numbers = [r["batch_no"] for r in rows]
    assert numbers == sorted(numbers)
    assert sorted(set(numbers)) == list(range(1, max(numbers) + 1))
    totals = {}
    for r in rows:
        totals.setdefault(r["batch_no"], []).append(r["n_bytes"])
    assert max(sum(t) - max(t) for t in totals.values()) <= 100


def test_payloads(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, None)], "Id int, line string")
    with_header = ob.payloads(df, ["Id"], max_bytes=16, unique_order=True)
    assert sorted(map(tuple, with_header.collect())) == [
        (1, 2, 15, "Id,line\n1,a\n2,b"),
        (2, 1, 10, "Id,line\n3,"),
    ]
    without = ob.payloads(df, ["line"], header=False)
    assert [tuple(r) for r in without.collect()] == [(1, 3, 11, "\n3,\n1,a\n2,b")]


def greedy(sizes, max_rows, max_bytes, header):
    seq, rows, used, out = 1, 0, header, []
    for size in sizes:
        if rows and (used + size > max_bytes or rows >= max_rows):
            seq, rows, used = seq + 1, 0, header
        rows, used = rows + 1, used + size
        out.append(seq)
    return out


@pytest.mark.parametrize("arrow_rows", [3, 10000])
@pytest.mark.parametrize(
    "max_rows, max_bytes, header", [(7, 10**9, 0), (10**6, 100, 10), (5, 60, 12), (3, 1, 0)]
)
def test_cut_matches_brute_force(spark, arrow_rows, max_rows, max_bytes, header):
    df = spark.range(300).select(
        "id", F.repeat(F.lit("é"), (F.col("id") * 31 % 60).cast("int")).alias("t")
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", arrow_rows)
    try:
        shard = F.expr("id div 110")
        cut = ob.cut_batches(df, ["id"], max_rows, max_bytes, header, shard=shard).collect()
        ranged = ob.cut_batches(df, ["id"], max_rows, max_bytes, header).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for rows, known in ((cut, True), (ranged, False)):
        shards = {}
        for r in sorted(rows):
            shards.setdefault(r["shard"], []).append(r)
        assert sorted(r["id"] for r in rows) == list(range(300))
        for number, members in shards.items():
            if known:
                assert {r["id"] // 110 for r in members} == {number}
            sizes = [len(f"{r['id']},{r['t']}\n".encode()) for r in members]
            assert [r["seq"] for r in members] == greedy(sizes, max_rows, max_bytes, header)


@pytest.mark.parametrize("arrow_rows", [3, 10000])
@pytest.mark.parametrize("max_rows, max_bytes", [(7, 10**9), (10**6, 100), (3, 1)])
def test_cut_payloads_match_the_cut(spark, arrow_rows, max_rows, max_bytes):
    df = spark.range(300).select(
        "id", F.repeat(F.lit("é"), (F.col("id") * 31 % 60).cast("int")).alias("t")
    )
    shard = F.expr("id div 110")
    header = "id,t"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", arrow_rows)
    try:
        found = ob.cut_payloads(df, ["id"], max_rows, max_bytes, shard=shard).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = {}
    for number in range(3):
        ids = range(number * 110, min(number * 110 + 110, 300))
        lines = [f"{i},{'é' * (i * 31 % 60)}" for i in ids]
        sizes = [len(line.encode()) + 1 for line in lines]
        for line, seq in zip(lines, greedy(sizes, max_rows, max_bytes, len(header) + 1)):
            expected.setdefault((number, seq), [header]).append(line)
    assert {(r["shard"], r["seq"]): r["payload"].split("\n") for r in found} == expected
    for r in found:
        assert r["n_rows"] == len(expected[r["shard"], r["seq"]]) - 1
        assert r["n_bytes"] == len(r["payload"].encode())
        assert r["n_bytes"] <= max_bytes or r["n_rows"] == 1


def test_cut_payloads_of_nothing(spark):
    assert ob.cut_payloads(spark.range(0), ["id"]).collect() == []


def test_cut_of_copies(spark):
    """A key that holds every row still gives balanced shards within the caps."""
    df = spark.range(20000).select(F.lit("same").alias("k"))
    cut = ob.cut_batches(df, ["k"], max_rows=500, partitions=8)
    rows = cut.groupBy("shard", "seq").count().collect()
    assert sum(r["count"] for r in rows) == 20000
    assert max(r["count"] for r in rows) <= 500
    shards = {}
    for r in rows:
        shards[r["shard"]] = shards.get(r["shard"], 0) + r["count"]
    assert max(shards.values()) < 20000 / 2


def test_staged_batches_can_be_written_again(spark, tmp_path):
    path = str(tmp_path / "staged")
    df = spark.range(500)
    for _ in range(2):
        staged = ob.stage_batches(df, path, ["id"], max_bytes=300, unique_order=True)
        check = ob.check_staged(staged, ob.staged_totals(spark, path)).first()
        total = sum(len(str(i)) + 1 for i in range(500))
        assert check["success"] is True
        assert check["n_rows"] == 500
        assert check["n_bytes"] == total + len("id") * check["n_batches"]
        assert check["n_batches"] >= math.ceil(check["n_bytes"] / 300)


@pytest.mark.parametrize("max_bytes", [1, 12, 300])
def test_payloads_keep_their_limit(spark, max_bytes):
    """Short rows, where newlines count most, and rows above the limit."""
    df = spark.range(2000).select(
        "id", F.when(F.col("id") % 500 == 7, F.repeat(F.lit("x"), 400)).otherwise("").alias("t")
    )
    found = ob.payloads(df, ["id"], max_bytes, unique_order=True).orderBy("batch_no").collect()
    assert [r["batch_no"] for r in found] == list(range(1, len(found) + 1))
    lines = []
    for r in found:
        head, *own = r["payload"].split("\n")
        assert head == "id,t" and len(own) == r["n_rows"]
        assert r["n_bytes"] == len(r["payload"]) and (r["n_bytes"] <= max_bytes or len(own) == 1)
        lines += own
    assert [int(line.split(",")[0]) for line in lines] == list(range(2000))


def test_numbers_run_over_all_shards(spark, tmp_path):
    path = str(tmp_path / "cut")
    cut = ob.cut_payloads(spark.range(3000), ["id"], max_rows=70, partitions=7, unique_order=True)
    cut.write.parquet(path)
    found = batches.numbered(spark.read.parquet(path), [], "n").orderBy("n").collect()
    assert [r["n"] for r in found] == list(range(1, len(found) + 1))
    rows = [int(x) for r in found for x in r["payload"].split("\n")[1:]]
    assert rows == list(range(3000))


def test_files_with_headers(spark, tmp_path):
    path = str(tmp_path / "files")
    df = spark.range(0, 50, 1, 4).select("id", F.lit('a,"b"').alias("t"))
    ob.write_result_set(df.where("id > 15"), path)
    assert ob.apply_schema(ob.read_result_sets(spark, path), df.schema).exceptAll(df.where("id > 15")).count() == 0
    assert ob.read_result_sets(spark, path).count() == 34


def test_unsound_batches_are_found(spark):
    schema = "batch_no bigint, n_rows bigint, n_bytes bigint, payload string"
    good = [(1, 1, 3, "a\nb"), (2, 1, 1, "c")]
    assert ob.check_staged(spark.createDataFrame(good, schema)).first()["success"] is True
    for bad in ([(1, 1, 4, "a\nb")], [(2, 1, 1, "c")], [(1, 1, 1, "c"), (1, 1, 1, "c")]):
        assert ob.check_staged(spark.createDataFrame(bad, schema)).first()["success"] is False
    assert ob.check_staged(spark.createDataFrame([], schema)).first()["success"] is True


def test_a_row_without_a_shard_is_refused(spark):
    df = spark.range(5)
    shard = F.when(F.col("id") < 4, F.lit(1))
    with pytest.raises(Exception, match="no shard"):
        ob.cut_batches(df, ["id"], shard=shard).collect()


def test_bare_types_need_no_quotes(spark):
    df = spark.sql(
        "SELECT 1.50D AS a, true AS b, date'2020-01-02' AS c, timestamp'2020-01-02 03:04:05' AS d,"
        " CAST(NULL AS INT) AS e, array('x', 'y') AS f"
    )
    line = df.select(ob.csv_line(df)).first()[0]
    assert line == '1.5,true,2020-01-02,2020-01-02 03:04:05.0,,"[x, y]"'
