"""Object writes: rows staged as upload batches for an uploader to send."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from objsync.functions.text import csv_header, csv_line
from objsync.operators.batches import (
    NO_ROW_LIMIT,
    TARGET_BATCH_BYTES,
    cut_payloads,
    numbered,
)
from objsync.session import new_run_dir

_TOTALS = "n_batches bigint, n_rows bigint, n_bytes bigint, max_bytes bigint"


def write_payloads(
    df: DataFrame,
    path: str,
    order_by: list[str],
    max_bytes: int = TARGET_BATCH_BYTES,
    header: bool = True,
    unique_order: bool = False,
) -> dict[str, int]:
    """Write ``df`` as upload batches, cut by size, and return what was to be written.

    One range shuffle and one write. The totals ``n_batches, n_rows, n_bytes,
    max_bytes`` are observed while rows are sent: ``n_rows`` counts the rows before
    they are gathered into batches.
    """
    rows, sent = Observation(), Observation()
    cut = cut_payloads(
        df,
        order_by,
        NO_ROW_LIMIT,
        max_bytes,
        unique_order=unique_order,
        with_header=header,
        observed=rows,
    )
    totals = [
        F.count("*").alias("n_batches"),
        F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"),
    ]
    cut.observe(sent, *totals).write.mode("overwrite").parquet(path)
    return {
        "n_batches": sent.get["n_batches"],
        "n_rows": rows.get["n_rows"],
        "n_bytes": sent.get["n_bytes"],
        "max_bytes": max_bytes,
    }


def payloads(
    df: DataFrame,
    order_by: list[str],
    max_bytes: int = TARGET_BATCH_BYTES,
    header: bool = True,
    unique_order: bool = False,
) -> DataFrame:
    """``df`` as upload batches: ``(batch_no, n_rows, n_bytes, payload)``.

    A payload has ``max_bytes`` at most, header and newlines counted, unless it holds
    a single row. Batches are filled in row order within each range of rows that a
    task has, so only the last of a range may be small. They are written once, as the
    bounds of ranges come from sampling.
    """
    spark = df.sparkSession
    path = new_run_dir(spark, "payloads")
    write_payloads(df, path, order_by, max_bytes, header, unique_order)
    return numbered(spark.read.parquet(path), [], "batch_no")


def stage_batches(
    df: DataFrame,
    path: str,
    order_by: list[str],
    max_bytes: int = TARGET_BATCH_BYTES,
    unique_order: bool = False,
) -> DataFrame:
    """Write the upload batches of ``df`` below ``path`` and return them as stored.

    The totals that the batches must have are stored beside them, last. A second run
    replaces the first; one that fails half-way is found by ``check_staged``.
    """
    spark = df.sparkSession
    totals = write_payloads(df, f"{path}/batches", order_by, max_bytes, True, unique_order)
    record = spark.createDataFrame([totals], _TOTALS).coalesce(1)
    record.write.mode("overwrite").json(f"{path}/totals")
    return read_staged(spark, path)


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """Staged batches: ``(batch_no, n_rows, n_bytes, payload)``."""
    return numbered(spark.read.parquet(f"{path}/batches"), [], "batch_no")


def staged_totals(spark: SparkSession, path: str) -> dict[str, int]:
    """What the batches staged below ``path`` must add up to."""
    return spark.read.schema(_TOTALS).json(f"{path}/totals").first().asDict()


def check_staged(staged: DataFrame, expected: dict[str, int] | None = None) -> DataFrame:
    """``(n_batches, n_rows, n_bytes, success)`` over staged batches or parts.

    ``success`` is the logical and over all of them: each payload has the size that
    was recorded for it, and numbers run from 1 without a gap. With the ``expected``
    totals, the sums are also those, and no payload of several rows is larger than
    ``max_bytes``.
    """
    number = F.col(next(c for c in staged.columns if c in ("batch_no", "part_no")))
    sums = {
        "n_batches": F.count("*"),
        "n_rows": F.coalesce(F.sum("n_rows"), F.lit(0)),
        "n_bytes": F.coalesce(F.sum("n_bytes"), F.lit(0)),
    }
    whole: Column = F.octet_length("payload") == F.col("n_bytes")
    if expected is not None:
        whole &= (F.col("n_bytes") <= expected["max_bytes"]) | (F.col("n_rows") == 1)
    sound = F.bool_and(whole) & (F.max(number) == F.count("*")) & (F.min(number) == 1)
    success = F.coalesce(sound, F.lit(True))
    if expected is not None:
        for name, total in sums.items():
            success &= total == expected[name]
    return staged.agg(*[c.alias(n) for n, c in sums.items()], success.alias("success"))


def write_result_set(df: DataFrame, path: str) -> None:
    """Write ``df`` as CSV files with a header line each, one for each partition."""
    header = csv_header(df.schema)

    def with_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            if first and batch.num_rows:
                yield pa.RecordBatch.from_pylist([{"line": header}], schema=batch.schema)
                first = False
            yield batch

    df.select(csv_line(df).alias("line")).mapInArrow(with_header, "line string").write.mode(
        "overwrite"
    ).text(path)
