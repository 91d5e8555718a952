"""Landed result sets, pages and object queries."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException

import objsync as ob


def land(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_bytes(text.encode())
    return str(folder)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    path = land(
        tmp_path / "some folder",
        a="id,name,amount\n1,x,10\n",
        b="amount,id,name\n20,2,y\n",
        c="name,id\nz,3\n",
        d="id,name,amount\n",
        e="",
    )
    df = ob.read_result_sets(spark, path)
    assert df.columns == ["id", "name", "amount"]
    assert rows(df) == [("1", "x", "10"), ("2", "y", "20"), ("3", "z", "")]


def test_header_only(spark, tmp_path):
    df = ob.read_result_sets(spark, land(tmp_path / "h", a="id,name\n"))
    assert df.dtypes == [("id", "string"), ("name", "string")]
    assert df.count() == 0


def test_no_header_at_all(spark, tmp_path):
    with pytest.raises(ValueError):
        ob.read_result_sets(spark, land(tmp_path / "none", a=""))
    with pytest.raises(PySparkException):
        ob.read_result_sets(spark, str(tmp_path / "missing"))


def test_values(spark, tmp_path):
    path = land(
        tmp_path / "values",
        a='id,text\r\n1,"a ""quoted"", value"\r\n2,\r\n3,""\r\n4,"two\nlines"\r\n'
        "5, spaced \r\n6\r\n7,back\\slash\r\n8,#hash\r\n",
    )
    assert rows(ob.read_result_sets(spark, path)) == [
        ("1", 'a "quoted", value'),
        ("2", ""),
        ("3", ""),
        ("4", "two\nlines"),
        ("5", " spaced "),
        ("6", ""),
        ("7", "back\\slash"),
        ("8", "#hash"),
    ]


def test_odd_header_names(spark, tmp_path):
    path = land(
        tmp_path / "names",
        a='Id,Owner.Name,"a,b",id\n1,x,c,2\n',
        b="id,Id,Id\n3,old,4\n",
    )
    df = ob.read_result_sets(spark, path)
    assert df.columns == ["Id", "Owner.Name", "a,b", "id"]
    assert rows(df) == [("1", "x", "c", "2"), ("4", "", "", "3")]


def test_nested_folders(spark, tmp_path):
    land(tmp_path / "n" / "batch=1", a="id\n1\n")
    land(tmp_path / "n" / "batch=2", a="id\n2\n")
    df = ob.read_result_sets(spark, str(tmp_path / "n"))
    assert df.columns == ["id"]
    assert rows(df) == [("1",), ("2",)]


def test_known_header_is_checked(spark, tmp_path):
    path = land(tmp_path / "known", a="id,name\n1,x\n", b="id,name\n2,\n")
    assert rows(ob.read_result_sets(spark, path, ["id", "name"])) == [("1", "x"), ("2", "")]
    land(tmp_path / "known", c="name,id\ny,3\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        ob.read_result_sets(spark, path, ["id", "name"]).collect()


def land_pages(folder, pages):
    folder.mkdir()
    for i, page in enumerate(pages):
        (folder / f"p{i}.json").write_text(json.dumps(page, indent=1))
    return str(folder)


def page(done, *records):
    return {"totalSize": 3, "done": done, "records": list(records)}


def test_pages(spark, tmp_path):
    record = {"attributes": {"type": "x", "url": "u"}, "Id": "1", "Amount": 12.5, "Flag": True}
    path = land_pages(
        tmp_path / "pages",
        [
            page(False, record, {"Id": "2", "Amount": None}),
            page(True, {"Id": "3", "Owner": {"Name": "n"}}),
        ],
    )
    pages = ob.read_pages(spark, path)
    df = ob.page_records(pages)
    assert df.columns == ["Amount", "Flag", "Id", "Owner"]
    assert sorted(df.collect(), key=lambda r: r["Id"]) == [
        ("12.5", "true", "1", None),
        (None, None, "2", None),
        (None, None, "3", '{"Name":"n"}'),
    ]
    known = ob.page_records(ob.read_pages(spark, path, ["Id", "Owner", "Missing"]))
    owners = {r["Id"]: r["Owner"] for r in known.collect()}
    assert json.loads(owners.pop("3")) == {"Name": "n"}
    assert owners == {"1": None, "2": None}
    assert [r["Missing"] for r in known.collect()] == [None] * 3
    assert tuple(ob.page_status(pages).first()) == (2, 1, 3, True)


def test_incomplete_and_empty_pages(spark, tmp_path):
    path = land_pages(tmp_path / "open", [page(False, {"Id": "1"}), page(False)])
    status = ob.page_status(ob.read_pages(spark, path, ["Id"]))
    assert tuple(status.first()) == (2, 0, 1, False)


@pytest.mark.parametrize("columns", [None, [], ["Id"]])
def test_a_lost_or_repeated_page_is_noticed(spark, tmp_path, columns):
    def landed(name, *pages, total="totalSize"):
        path = land_pages(tmp_path / name, list(pages))
        return ob.page_status(ob.read_pages(spark, path, columns, total_field=total)).first()

    parts = [(False, "12"), (False, "34"), (True, "5")]
    a, b, c = ({**page(done, *[{"Id": i} for i in ids]), "totalSize": 5} for done, ids in parts)
    assert tuple(landed("whole", a, b, c)) == (3, 1, 5, True)
    assert tuple(landed("lost", a, c)) == (2, 1, 3, False)
    assert tuple(landed("twice", a, b, b, c)) == (4, 1, 7, False)
    # totals that differ are of different extracts; pages that tell none are not compared
    assert not landed("mixed", {**a, "totalSize": 6}, b, c)["complete"]
    silent = {k: v for k, v in b.items() if k != "totalSize"}
    assert landed("silent", a, silent, c)["complete"]
    nothing = page(True)
    assert landed("nothing", {**nothing, "totalSize": 0})["complete"]
    nested = {"meta": {"n": 2}, **nothing}
    assert not landed("nested", nested, total="meta.n")["complete"]


def test_load_refuses_a_lost_page(spark, tmp_path):
    first = page(False, {"Id": "1", "Deep": {"x": [1, {"y": 2}]}})
    last = page(True, {"Id": "3"})
    path = land_pages(tmp_path / "lost", [first, last])
    with pytest.raises(ValueError, match="2 records"):
        ob.load_object(spark, pages=path)
    df = ob.load_object(spark, pages=path, accept_incomplete=True)
    assert sorted(r["Id"] for r in df.collect()) == ["1", "3"]
    middle = page(False, {"Id": "2"})
    path = land_pages(tmp_path / "whole", [first, middle, last])
    assert sorted(r["Id"] for r in ob.load_object(spark, pages=path).collect()) == ["1", "2", "3"]


def test_other_member_names(spark, tmp_path):
    path = land_pages(tmp_path / "other", [{"isDone": True, "rows": [{"a": 1}]}])
    pages = ob.read_pages(spark, path, ["a"], records_field="rows", done_field="isDone")
    assert rows(ob.page_records(pages)) == [("1",)]
    assert pages.first()["done"] is True


@pytest.mark.parametrize("columns", [None, ["Name", "Email"]])
def test_single_response_with_nested_records(spark, tmp_path, columns):
    response = {
        "action": "query",
        "results": {"records": [{"Name": "n", "Email": "e"}, {"Name": "m"}]},
    }
    path = land_pages(tmp_path / "single", [response])
    pages = ob.read_pages(spark, path, columns, records_field="results.records")
    found = ob.page_records(pages).select("Name", "Email").collect()
    assert sorted(map(tuple, found)) == [("m", None), ("n", "e")]
    assert pages.first()["done"] is None


def test_both_fields_below_one_member(spark, tmp_path):
    path = land_pages(tmp_path / "below", [{"r": {"last": True, "rows": [{"a": 1}]}}])
    pages = ob.read_pages(spark, path, ["a"], records_field="r.rows", done_field="r.last")
    assert pages.first()["done"] is True
    assert rows(ob.page_records(pages)) == [("1",)]


def test_query_leaves_no_view(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    result = ob.query_objects(spark, {"account": df}, "select id from account where id > 1")
    assert rows(result) == [(2,)]
    assert not spark.catalog.tableExists("account")
    again = ob.query_objects(spark, {"account": df}, "select name from account")
    assert rows(again) == [("a",), ("b",)]
    df.createTempView("taken")
    with pytest.raises(ValueError):
        ob.query_objects(spark, {"taken": df}, "select * from taken")
    assert spark.catalog.tableExists("taken")
    spark.catalog.dropTempView("taken")
    with pytest.raises(PySparkException):
        ob.query_objects(spark, {"account": df}, "select nothing from account")
    assert not spark.catalog.tableExists("account")


def test_load_object(spark, tmp_path):
    path = land(tmp_path / "load", a="id,amount,name\n1,2.5,x y\n2,10,z\n")
    df = ob.load_object(
        spark,
        result_sets=path,
        infer=True,
        encode_fields="name",
        object_name="opportunity",
        query="select id, name, amount from opportunity where amount < 5",
    )
    assert df.dtypes == [("id", "int"), ("name", "string"), ("amount", "double")]
    assert rows(df) == [(1, "x+y", 2.5)]
    pages = land_pages(tmp_path / "load-pages", [{**page(True, {"id": 1}, {"id": 2}), "totalSize": 2}])
    assert rows(ob.load_object(spark, pages=pages, columns=["id"], infer=True)) == [(1,), (2,)]
    part = land_pages(tmp_path / "load-part", [page(False, {"id": 1})])
    with pytest.raises(ValueError, match="0 of 1 pages are the last"):
        ob.load_object(spark, pages=part)
    assert rows(ob.load_object(spark, pages=part, accept_incomplete=True)) == [("1",)]
    none = land_pages(tmp_path / "load-none", [{**page(True), "totalSize": 0}])
    assert rows(ob.load_object(spark, pages=none)) == []
    with pytest.raises(ValueError):
        ob.load_object(spark, result_sets=path, pages=pages)
    with pytest.raises(ValueError):
        ob.load_object(spark)
    with pytest.raises(ValueError):
        ob.load_object(spark, result_sets=path, query="select 1")


def test_headers_of_any_shape(spark, tmp_path):
    folder = tmp_path / "odd"
    folder.mkdir()
    (folder / "a[1].csv").write_text("A,B\n1,2\n")
    (folder / "a1.csv").write_text("B\n3\n")
    (folder / "blank.csv").write_text("\nA,B\n4,5\n")
    (folder / "long.csv").write_text('A,"' + "x\n" * 70 + 'y",B\n6,7,8\n')
    got = ob.read_result_sets(spark, str(folder))
    long_name = next(c for c in got.columns if "x" in c)
    assert len(long_name.split("\n")) == 71
    rows = {(r["A"], r["B"], r[long_name]) for r in got.collect()}
    assert rows == {("1", "2", ""), ("", "3", ""), ("4", "5", ""), ("6", "8", "7")}


def test_torn_page_fails(spark, tmp_path):
    folder = tmp_path / "torn"
    folder.mkdir()
    (folder / "1.json").write_text('{"done": true, "records": [{"a": "1"}]}')
    (folder / "2.json").write_text('{"done": false, "records": [{"a": "2"}')
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        ob.page_records(ob.read_pages(spark, str(folder), ["a"])).collect()
