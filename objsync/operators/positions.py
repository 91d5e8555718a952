"""A global row position, and a running total in the same order, without one task
ever seeing all rows.

Rows are range-partitioned on the order columns and sorted within each partition.
Every row takes its partition number and its place inside the partition, and the
result is written to the shared folder: range bounds come from sampling, so only a
written copy gives the same numbers to every later read. The offset of a partition
is the sum of the partitions before it, one small row per partition.

Where the order columns are not unique, a row hash and a row number complete the
sort key, so a value or a group of copies that holds a large part of the rows is
spread over many partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objsync.functions.text import quoted
from objsync.session import new_run_dir

PART, PLACE, TOTAL, WEIGHT = "_part", "_place", "_total", "_weight"
_TIE_HASH, _TIE_ROW = "_tie_hash", "_tie_row"
_PLACE_BITS = (1 << 33) - 1


def _hashable(df: DataFrame) -> list[Column]:
    """The columns that have a hash: all without a map in them."""
    return [
        F.col(quoted(f.name))
        for f in df.schema.fields
        if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()
    ]


def range_sorted(
    df: DataFrame,
    order_by: list[str | Column],
    unique_order: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """``df`` in range partitions on ``order_by``, each of them sorted.

    Unless the caller knows that ``order_by`` is unique, the input is first written
    with a row number, which then breaks ties as plain data: a retried task sees the
    same numbers, and sampling for the range bounds reads the copy rather than
    computing the input again.
    """
    keys = [F.col(quoted(k)) if isinstance(k, str) else k for k in order_by]
    if not unique_order:
        path = new_run_dir(df.sparkSession, "numbered")
        numbered = df.select(
            "*",
            F.xxhash64(F.lit(0), *_hashable(df)).alias(_TIE_HASH),
            F.monotonically_increasing_id().alias(_TIE_ROW),
        )
        numbered.write.parquet(path)
        df = df.sparkSession.read.schema(numbered.schema).parquet(path)
        keys = [*keys, F.col(_TIE_HASH), F.col(_TIE_ROW)]
    ranged = (
        df.repartitionByRange(partitions, *keys)
        if partitions
        else df.repartitionByRange(*keys)
    )
    return ranged.sortWithinPartitions(*keys).drop(_TIE_HASH, _TIE_ROW)


def _with_running_total(ranged: DataFrame) -> DataFrame:
    """Append the sum of the weights before each row of its partition."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            weights = batch.column(batch.schema.get_field_index(WEIGHT)).to_numpy()
            ends = before + np.cumsum(weights, dtype=np.int64)
            if len(ends):
                before = int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ends - weights, pa.int64())],
                names=[*batch.schema.names, TOTAL],
            )

    schema = T.StructType([*ranged.schema.fields, T.StructField(TOTAL, T.LongType())])
    return ranged.mapInArrow(totals, schema)


def row_positions(
    df: DataFrame,
    order_by: list[str | Column],
    weight: Column | None = None,
    unique_order: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """``df`` with ``row_index`` (from 0) in ``order_by`` order.

    With ``weight``, a non-negative whole number per row, also ``weight_before``:
    the sum of the weights of all earlier rows.
    """
    placed, _ = place_rows(df, order_by, None, weight, unique_order, partitions)
    return placed.drop(WEIGHT)


def place_rows(
    df: DataFrame,
    order_by: list[str | Column],
    keep: list[Column] | None = None,
    weight: Column | None = None,
    unique_order: bool = False,
    partitions: int | None = None,
) -> tuple[DataFrame, int]:
    """Rows with their positions, as ``row_positions`` gives them, and their weight;
    and the largest weight.

    ``keep`` replaces the columns of ``df`` in the result. It and ``weight``, which
    may refer to it, are computed when the rows are in order: sampling for the range
    bounds evaluates ``df`` itself, and should not evaluate them as well.
    """
    spark = df.sparkSession
    ranged = range_sorted(df, order_by, unique_order, partitions)
    if keep is not None:
        ranged = ranged.select(*keep)
    names = ranged.columns
    if weight is not None:
        ranged = ranged.withColumn(WEIGHT, weight.cast("bigint"))
    ranged = ranged.select(
        "*",
        F.spark_partition_id().alias(PART),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS)).alias(PLACE),
    )
    if weight is not None:
        ranged = _with_running_total(ranged)
    path = new_run_dir(spark, "positions")
    ranged.write.parquet(path)

    stored = spark.read.schema(ranged.schema).parquet(path)
    sums = [F.count("*").alias("rows")]
    if weight is not None:
        sums += [F.sum(WEIGHT).alias("weight"), F.max(WEIGHT).alias("largest")]
    # one row per partition of the written table, as many as the shuffle had
    parts = sorted(stored.groupBy(PART).agg(*sums).collect(), key=lambda r: r[PART])
    row_starts = accumulate((r["rows"] for r in parts), initial=0)
    weight_starts = accumulate(
        (r["weight"] if weight is not None else 0 for r in parts), initial=0
    )
    offsets = spark.createDataFrame(
        [(r[PART], rows, w) for r, rows, w in zip(parts, row_starts, weight_starts)],
        f"{PART} int, _rows_before bigint, _weight_before bigint",
    )
    columns = [
        *[F.col(quoted(c)) for c in names],
        (F.col("_rows_before") + F.col(PLACE)).alias("row_index"),
    ]
    if weight is not None:
        before = F.col("_weight_before") + F.col(TOTAL)
        columns += [before.alias("weight_before"), F.col(WEIGHT)]
    placed = stored.join(F.broadcast(offsets), PART).select(*columns)
    largest = max((r["largest"] for r in parts), default=0) if weight is not None else 0
    return placed, largest


def paginate(
    df: DataFrame,
    order_by: list[str | Column],
    page_size: int = 1000,
    unique_order: bool = False,
) -> DataFrame:
    """``df`` with ``page_no`` from 1 and ``page_row`` from 0 within the page."""
    if page_size < 1:
        raise ValueError("page_size must be at least 1")
    index = F.col("row_index")
    return row_positions(df, order_by, unique_order=unique_order).select(
        *[F.col(quoted(c)) for c in df.columns],
        (F.call_function("div", index, F.lit(page_size)) + 1).alias("page_no"),
        (index % page_size).cast("bigint").alias("page_row"),
    )
