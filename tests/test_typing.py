"""Casts, alignment and inference."""

from __future__ import annotations

import datetime
import math
import random
import re
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import objsync as ob
from objsync.functions import casts

BAD = object()

CASES = [
    (T.IntegerType(), "1", 1),
    (T.IntegerType(), "+5", 5),
    (T.IntegerType(), "-2147483648", -2147483648),
    (T.IntegerType(), "2147483648", BAD),
    (T.IntegerType(), " 1 ", BAD),
    (T.IntegerType(), "1\n", BAD),
    (T.IntegerType(), "1.5", BAD),
    (T.IntegerType(), "1_0", BAD),
    (T.IntegerType(), "١", BAD),
    (T.IntegerType(), "", None),
    (T.IntegerType(), None, None),
    (T.LongType(), "3000000000", 3000000000),
    (T.LongType(), "9223372036854775807", 9223372036854775807),
    (T.LongType(), "-9223372036854775808", -9223372036854775808),
    (T.LongType(), "9223372036854775808", BAD),
    (T.LongType(), "9" * 45, BAD),
    (T.LongType(), "0" * 60 + "7", 7),
    (T.ByteType(), "127", 127),
    (T.ByteType(), "128", BAD),
    (T.ShortType(), "-32768", -32768),
    (T.ShortType(), "40000", BAD),
    (T.DoubleType(), "1e3", 1000.0),
    (T.DoubleType(), ".5", 0.5),
    (T.DoubleType(), "1.", 1.0),
    (T.DoubleType(), "-Infinity", -math.inf),
    (T.DoubleType(), "NaN", math.nan),
    (T.DoubleType(), "inf", BAD),
    (T.DoubleType(), "1d", BAD),
    (T.DoubleType(), "0x1p3", BAD),
    (T.DoubleType(), "1,234.50", BAD),
    (T.DoubleType(), " 1.0", BAD),
    (T.FloatType(), "0.5", 0.5),
    (T.BooleanType(), "true", True),
    (T.BooleanType(), "TRUE", True),
    (T.BooleanType(), "False", False),
    (T.BooleanType(), "t", BAD),
    (T.BooleanType(), "yes", BAD),
    (T.BooleanType(), "1", BAD),
    (T.DecimalType(12, 2), "1,234.50", Decimal("1234.50")),
    (T.DecimalType(12, 2), "-1e3", Decimal("-1000.00")),
    (T.DecimalType(12, 2), "12345678901.00", BAD),
    (T.DecimalType(12, 2), "1.2.3", BAD),
    (T.DecimalType(12, 2), "NaN", BAD),
    (T.DateType(), "2016-01-01", datetime.date(2016, 1, 1)),
    (T.DateType(), "2016-1-1", datetime.date(2016, 1, 1)),
    (T.DateType(), "2016-02-30", BAD),
    (T.DateType(), "2016-01-01 00:00:00", BAD),
    (T.TimestampType(), "2016-01-01 00:00:00", datetime.datetime(2016, 1, 1)),
    (T.TimestampType(), "2016-1-1 0:0:0.5", datetime.datetime(2016, 1, 1, 0, 0, 0, 500000)),
    (T.TimestampType(), "2016-02-30 00:00:00", BAD),
    (T.TimestampType(), "2016-01-01 25:00:00", BAD),
    (T.TimestampType(), "2016-01-01T00:00:00.000Z", BAD),
    (T.TimestampType(), "2016-01-01", BAD),
]


def test_cast_edges(spark):
    """All cases at once: one column per case, permissive, with rejects."""
    schema = T.StructType([T.StructField(f"c{i}", t) for i, (t, _, _) in enumerate(CASES)])
    text = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(CASES))])
    records = spark.createDataFrame([tuple(v for _, v, _ in CASES)], text)
    typed = ob.apply_schema(records, schema, "permissive", rejects_col="rejects")
    # a date-time is compared as text, so that the local zone plays no part
    row = typed.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in schema
        ],
        "rejects",
    ).first()
    rejected = {r["column"]: r["value"] for r in row["rejects"]}
    for i, (data_type, value, expected) in enumerate(CASES):
        got = row[f"c{i}"]
        label = f"{data_type.simpleString()} {value!r}"
        if expected is BAD:
            assert got is None, label
            assert rejected.pop(f"c{i}") == value, label
        elif isinstance(expected, float) and math.isnan(expected):
            assert math.isnan(got), label
        else:
            assert got == expected, label
    assert rejected == {}


def test_strict_mode_fails(spark):
    records = spark.createDataFrame([("1",), ("x",)], "a string")
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    with pytest.raises(PySparkException, match="column a: not a int: x"):
        ob.apply_schema(records, schema).collect()


def test_empty_fails_only_where_the_field_is_not_nullable(spark):
    records = spark.createDataFrame([("",)], "a string")
    nullable = T.StructType([T.StructField("a", T.IntegerType())])
    assert ob.apply_schema(records, nullable).first()["a"] is None
    required = T.StructType([T.StructField("a", T.IntegerType(), nullable=False)])
    with pytest.raises(PySparkException):
        ob.apply_schema(records, required).collect()


def test_unsupported_type_and_modes_are_refused(spark):
    records = spark.createDataFrame([("1",)], "a string")
    with pytest.raises(TypeError):
        ob.apply_schema(
            records, T.StructType([T.StructField("a", T.ArrayType(T.StringType()))])
        )
    with pytest.raises(ValueError):
        ob.apply_schema(records, records.schema, "lenient")
    with pytest.raises(ValueError):
        ob.apply_schema(records, records.schema, rejects_col="r")


def test_names_match_exactly_and_may_hold_dots(spark):
    records = spark.createDataFrame([("1", "2", "3")], "a string, b string, c string").toDF(
        "Owner.Name", "ID", "back`tick"
    )
    row = ob.align(records, ["Owner.Name", "Id", "back`tick", "ID"]).first()
    assert tuple(row) == ("1", "", "3", "2")


def test_strings_keep_null_and_empty_apart(spark):
    records = spark.createDataFrame([(None,), ("",)], "a string")
    rows = ob.apply_schema(records, records.schema).collect()
    assert [r["a"] for r in rows] == [None, ""]


def test_rejects_without_typed_columns(spark):
    records = spark.createDataFrame([("x", "1")], "a string, k string")
    schema = T.StructType([T.StructField("a", T.StringType())])
    assert ob.cast_rejects(records, schema, "k").collect() == []


INFERRED = [
    (["1", "", "2"], "int"),
    (["1", "3000000000"], "bigint"),
    (["1", "99999999999999999999"], "double"),
    (["1", "9" * 60], "double"),
    (["3000000000", "1.5"], "double"),
    (["NaN", "-Infinity", "1e3"], "double"),
    (["2016-01-01 00:00:00", ""], "timestamp"),
    (["2016-01-01 00:00:00", "5"], "string"),
    (["5", "2016-01-01 00:00:00"], "string"),
    (["2016-02-30 00:00:00"], "string"),
    (["2016-01-01"], "string"),
    (["", "", None], "string"),
    ([" 1 "], "string"),
    (["1", "N/A"], "string"),
    (["-"], "string"),
    (["١"], "string"),
]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_inference_ignores_order_and_partitioning(spark, partitions):
    height = max(len(values) for values, _ in INFERRED)
    rows = [
        tuple(values[i] if i < len(values) else None for values, _ in INFERRED)
        for i in range(height)
    ]
    random.Random(partitions).shuffle(rows)
    names = [f"c{i}" for i in range(len(INFERRED))]
    schema = ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame(rows, schema).repartition(partitions)
    expected = [t for _, t in INFERRED]
    assert [r["type"] for r in ob.infer_types(df).orderBy("position").collect()] == expected
    assert [f.dataType.simpleString() for f in ob.infer_schema(df)] == expected


def class_bit(text: str) -> int:
    """The class of one value, by plain Python."""
    number = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    if re.fullmatch(r"[+-]?[0-9]+", text):
        value = int(text)
        if -(2**31) <= value < 2**31:
            return casts.INT_BIT
        return casts.LONG_BIT if -(2**63) <= value < 2**63 else casts.DOUBLE_BIT
    if re.fullmatch(number, text) or re.fullmatch(r"[+-]?(NaN|Infinity)", text):
        return casts.DOUBLE_BIT
    parts = re.fullmatch(
        r"([0-9]{4})-([0-9]{1,2})-([0-9]{1,2}) ([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})"
        r"(\.[0-9]{1,9})?",
        text,
    )
    if parts:
        try:
            datetime.datetime(*map(int, parts.groups()[:6]))
            return casts.TIMESTAMP_BIT
        except ValueError:
            pass
    return casts.TEXT_BIT


def test_value_classes_match_plain_python(spark):
    random_text = random.Random(7)
    pieces = [
        "0", "7", "12", "345678901", "+", "-", ".", "e", "E5", "NaN", "Infinity", " ", ":",
        "2016-02-", "29", "30", "-1-", "2016", " 1:2:3", " 23:59:59", " 24:00:00", ".5", "x",
        "\n", "9" * 12, "é",
    ]
    values = {
        "".join(random_text.choices(pieces, k=random_text.randint(1, 4))) for _ in range(6000)
    }
    values |= {str(sign * 2**bits + off) for sign in (1, -1) for bits in (31, 63) for off in (-1, 0, 1)}
    df = spark.createDataFrame([(v,) for v in sorted(values)], "v string")
    found = df.select("v", casts.type_bit(F.col("v")).alias("bit")).collect()
    assert {r["v"]: r["bit"] for r in found} == {v: class_bit(v) for v in values}


def test_inference_of_no_rows(spark):
    empty = spark.createDataFrame([], "a string, b string")
    assert [f.dataType for f in ob.infer_schema(empty)] == [T.StringType()] * 2


def test_sampled_inference_looks_at_the_first_rows(spark):
    rows = [(str(i),) for i in range(10)] + [("late text",)]
    df = spark.createDataFrame(rows, "a string").coalesce(1)
    assert ob.infer_schema(df, sample_rows=10)["a"].dataType == T.IntegerType()
    assert ob.infer_schema(df)["a"].dataType == T.StringType()


def test_typed_rows_choices(spark):
    df = spark.createDataFrame([("1", "a b")], "n string, t string")
    assert ob.typed_rows(df).dtypes == [("n", "string"), ("t", "string")]
    assert ob.typed_rows(df, infer=True).dtypes == [("n", "int"), ("t", "string")]
    given = T.StructType([T.StructField("n", T.LongType())])
    assert ob.typed_rows(df, given, infer=True).dtypes == [("n", "bigint")]
    assert ob.typed_rows(df, infer=True, encode_fields="t").first()["t"] == "a+b"
    assert ob.typed_rows(df, encode_fields="t").first()["t"] == "a+b"
    with pytest.raises(ValueError):
        ob.typed_rows(df, infer="yes")


def test_encoding_names_are_not_trimmed(spark):
    df = spark.createDataFrame([("a b", "c d", 1)], "x string, y string, n int")
    assert tuple(ob.encode_fields(df, "x, y,n").first()) == ("a+b", "c d", 1)
    assert tuple(ob.encode_fields(df, None).first()) == ("a b", "c d", 1)


def test_form_encoding(spark):
    text = "az AZ09.-*_~+/é€&=\n"
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(ob.form_encode(F.col("t"))).first()[0] == (
        "az+AZ09.-*_%7E%2B%2F%C3%A9%E2%82%AC%26%3D%0A"
    )
