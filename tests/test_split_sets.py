"""Result sets read in chunks against the whole read of their files."""

from __future__ import annotations

import random
from collections import Counter

import pytest

import objsync as ob
from objsync.sources.split_sets import open_after

FILES = {
    "one.csv": '\n\nId,Name,Note\n1,"a ""q"" b","line one\nline, two\n\nline four"\n2,ab"c,"x"y",z\n3,,""\n\n'
    + '4,"' + "long\n" * 50 + 'end"\n5, "s p",q"\n6,"\n""\n","""\n"""\n7,short\n8,"ab"cd,1\n9,1,2,3,4\n',
    "sub/two.csv": 'Note,Id\r\n"n, m",8\r\n"",9\r\n',
    "sub/three.csv": '"I\nd",Id\n"1\n2",10',
    "four.csv": "Id,Id,Name\n1,2,twice\n",
    "empty.csv": "",
}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sub").mkdir()
    for name, text in FILES.items():
        (tmp_path / name).write_bytes(text.encode())
    return str(tmp_path)


@pytest.mark.parametrize("chunk_bytes", [1, 7, 60, 1 << 22])
def test_equal_to_the_whole_read(spark, folder, chunk_bytes):
    whole, split = ob.read_result_sets(spark, folder), ob.read_result_sets_split(spark, folder, chunk_bytes)
    assert split.columns == whole.columns
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, whole.collect()))


def test_a_file_in_many_splits(spark, tmp_path):
    rng = random.Random(4)
    parts = ["a", "b c", "é", '"', "\n", ",", "\n\n", '""', " "]
    rows = [(str(i), "".join(rng.choices(parts, k=rng.randrange(60))), "x") for i in range(4000)]
    df = spark.createDataFrame(rows, "id string, text string, more string")
    ob.write_result_set(df.coalesce(1), f"{tmp_path}/set")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {name: spark.conf.get(name) for name in names}
    try:
        for name in names:
            spark.conf.set(name, "16k")
        lines = spark.read.text(f"{tmp_path}/set", lineSep="\n")
        assert lines.rdd.getNumPartitions() > 4
        got = ob.read_result_sets_split(spark, f"{tmp_path}/set", 4000)
        assert sorted(map(tuple, got.collect())) == sorted(rows)
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


def test_many_headers_in_one_scan(spark, tmp_path):
    for i in range(60):
        (tmp_path / f"{i:03d}.csv").write_text(f'key,c{i},"c{(i + 1) % 60}"\n{i},a{i},b{i}\n')
    got = ob.read_result_sets_split(spark, str(tmp_path))
    assert len(got.columns) == 61
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") <= 2
    row = {r["key"]: r for r in got.collect()}["59"]
    assert (row["c59"], row["c0"], row["c1"]) == ("a59", "b59", "")


@pytest.mark.parametrize(
    ("line", "inside", "after"),
    [
        (b"a,b", False, False), (b'"a', False, True), (b'a"', True, False), (b'a""', True, True), (b'x,"', False, True),
        (b'x"y', False, False), (b'"a"b,"c', False, True), (b'"a"b"c', False, False), (b"", True, True), (b'","', True, True),
    ],
)
def test_state_after_a_line(line, inside, after):
    assert open_after(line, inside) is after


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n\n")
    with pytest.raises(ValueError):
        ob.read_result_sets_split(spark, str(tmp_path))
