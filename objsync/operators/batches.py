"""Encoded rows, their size, and their split into upload batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objsync.functions.text import csv_header, csv_line, quoted, row_bytes
from objsync.operators.positions import (
    WEIGHT,
    place_rows,
    range_sorted,
    row_positions,
)

# Batch limits.
TARGET_BATCH_BYTES = 10 * 1024 * 1024
CUT_MAX_BYTES = 10_000_000
CUT_MAX_ROWS = 10_000
SIZE_SAMPLE_ROWS = 10

#: For cuts by size alone.
NO_ROW_LIMIT = 1 << 62
#: Shards whose first numbers are broadcast; more are joined like any table.
BROADCAST_SHARDS = 1_000_000

_SIZE = "_size"


def estimate_bytes(df: DataFrame) -> DataFrame:
    """``(n_rows, n_bytes)`` of the encoded rows: exact, one aggregate."""
    return df.select(row_bytes(csv_line(df)).alias("b")).agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("n_bytes"),
    )


def estimate_bytes_sampled(
    df: DataFrame, sample_rows: int = SIZE_SAMPLE_ROWS, seed: int = 0
) -> DataFrame:
    """``(n_rows, n_bytes)`` with the size scaled up from a few random rows.

    The sample stands for ``n_rows / sample_rows`` times its size, in whole
    numbers. A table no larger than the sample is measured exactly.
    """
    # only the rows that are drawn are encoded
    drawn = df.orderBy(F.rand(seed)).limit(sample_rows)
    sample = drawn.select(row_bytes(csv_line(df)).alias("b")).agg(
        F.coalesce(F.sum("b"), F.lit(0)).alias("sample_bytes")
    )
    total = df.agg(F.count("*").alias("n_rows"))
    scaled = F.col("sample_bytes") * F.call_function(
        "div", F.col("n_rows"), F.lit(sample_rows)
    )
    return (
        total.select("n_rows", F.lit(0).cast("bigint").alias("sample_bytes"))
        .union(sample.select(F.lit(0).cast("bigint"), "sample_bytes"))
        .agg(F.sum("n_rows").alias("n_rows"), F.sum("sample_bytes").alias("sample_bytes"))
        .select(
            "n_rows",
            F.when(F.col("n_rows") > sample_rows, scaled)
            .otherwise(F.col("sample_bytes"))
            .alias("n_bytes"),
        )
    )


def batch_count(total_bytes: int, max_bytes: int = TARGET_BATCH_BYTES) -> int:
    """How many batches a total size asks for."""
    return 1 if total_bytes <= max_bytes else total_bytes // max_bytes + 1


def plan_batches(
    df: DataFrame,
    order_by: list[str | Column],
    max_bytes: int = TARGET_BATCH_BYTES,
    size: Column | None = None,
    unique_order: bool = False,
    keep: list[Column] | None = None,
) -> DataFrame:
    """``df`` with ``batch_no`` from 1, ``row_index`` and ``n_bytes`` of the row.

    A row goes to the batch its first byte falls in when all rows are laid out in
    ``order_by`` order, so every batch holds ``max_bytes`` at most plus the end of
    one row, whatever the keys look like, and a total just above ``k * max_bytes``
    gives ``k + 1`` batches. The number is a function of the data alone. Numbers run
    without a gap, also where single rows are larger than a batch.

    ``keep`` replaces the columns of ``df`` in the result; ``size`` may refer to it.
    """
    if keep is None:
        keep = [F.col(quoted(c)) for c in df.columns]
    size = row_bytes(csv_line(df)) if size is None else size
    placed, largest = place_rows(
        df, order_by, keep, weight=size, unique_order=unique_order
    )
    added = ("row_index", "weight_before", WEIGHT)
    batch_no = F.call_function("div", F.col("weight_before"), F.lit(max_bytes)) + 1
    planned = placed.select(
        *[F.col(quoted(c)) for c in placed.columns if c not in added],
        F.col(WEIGHT).alias("n_bytes"),
        "row_index",
        batch_no.alias("batch_no"),
    )
    return _without_gaps(planned) if largest > max_bytes else planned


def _without_gaps(planned: DataFrame) -> DataFrame:
    """Number the batches anew, one row per batch in the join."""
    used = planned.select(F.col("batch_no").alias("_used")).distinct()
    numbers = row_positions(used, ["_used"], unique_order=True).select(
        "_used", (F.col("row_index") + 1).alias("_dense")
    )
    return planned.join(numbers, F.col("batch_no") == F.col("_used")).select(
        *[F.col(quoted(c)) for c in planned.columns if c != "batch_no"],
        F.col("_dense").alias("batch_no"),
    )


def batch_payloads(planned: DataFrame, header: str | None = None) -> DataFrame:
    """One row per batch: ``(batch_no, n_rows, n_bytes, payload)``.

    ``planned`` holds ``batch_no``, ``row_index`` and ``line``. The payload starts
    with ``header`` if there is one, then a newline and the lines in row order. Rows
    are sorted by batch, so that a task holds the lines of one batch at a time.
    """
    ordered = (
        planned.select("batch_no", "row_index", "line")
        .repartition("batch_no")
        .sortWithinPartitions("batch_no", "row_index")
        .select("batch_no", "line")
    )
    new_collector = _payload_collector(["batch_no"], header or "")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, last = new_collector()
        for batch in batches:
            yield from add([batch.column(0).to_numpy()], batch.column(1))
        yield from last()

    return ordered.mapInArrow(
        assemble, "batch_no bigint, n_rows bigint, n_bytes bigint, payload string"
    )


def _payload_collector(names: list[str], header: str):
    """Makes, for each task, a function that takes the rows of one chunk and one that
    closes the last batch; both give the payloads that are then complete.

    Rows of a batch follow each other, told apart by the columns called ``names``.
    """

    def new_collector():
        found, lines = None, []

        def last():
            if found is not None:
                text = "\n".join([header, *lines])
                record = dict(zip(names, found))
                record.update(n_rows=len(lines), n_bytes=len(text.encode()), payload=text)
                yield pa.RecordBatch.from_pylist([record])

        def add(keys: list[np.ndarray], chunk: pa.Array):
            nonlocal found, lines
            changed = np.zeros(max(len(chunk) - 1, 0), dtype=bool)
            for key in keys:
                changed |= np.diff(key) != 0
            starts = [0, *(np.flatnonzero(changed) + 1).tolist()] if len(chunk) else []
            for start, stop in zip(starts, [*starts[1:], len(chunk)]):
                here = [int(key[start]) for key in keys]
                if here != found:
                    yield from last()
                    found, lines = here, []
                lines += chunk.slice(start, stop - start).to_pylist()

        return add, last

    return new_collector


def cut_batches(
    df: DataFrame,
    order_by: list[str | Column],
    max_rows: int = CUT_MAX_ROWS,
    max_bytes: int = CUT_MAX_BYTES,
    header_bytes: int = 0,
    shard: Column | None = None,
    unique_order: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """``df`` with ``shard`` and ``seq``: batches filled greedily in row order.

    A batch takes rows until the next one would pass ``max_bytes`` (header and
    newlines counted) or it holds ``max_rows``; only a row that is too large by
    itself passes the limit, alone. Filling starts anew in every shard, so shards
    run in parallel; batches are numbered from 1 within each.

    By default a shard is one range partition, which is balanced for any keys but
    may differ from one evaluation to the next: write the result before using it
    twice. A ``shard`` column makes the cut a function of the data; each of its shards
    is streamed through one task, so it is for shards of bounded size, and a row
    without a shard is refused.
    """
    ordered = _in_shards(df, order_by, shard, unique_order, partitions).withColumn(
        _SIZE, row_bytes(csv_line(df)) + 1
    )
    schema = T.StructType(
        [f for f in ordered.schema.fields if f.name != _SIZE]
        + [T.StructField("seq", T.LongType(), False)]
    )
    new_counter = _greedy_counter(max_rows, max_bytes, header_bytes)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = new_counter()
        for batch in batches:
            index = batch.schema.get_field_index
            numbers = number(
                batch.column(index(_SIZE)).to_numpy(),
                batch.column(index("shard")).to_numpy(),
            )
            kept = [n for n in batch.schema.names if n != _SIZE]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(index(n)) for n in kept], pa.array(numbers)],
                names=[*kept, "seq"],
            )

    return ordered.mapInArrow(fill, schema)


def cut_payloads(
    df: DataFrame,
    order_by: list[str],
    max_rows: int = CUT_MAX_ROWS,
    max_bytes: int = CUT_MAX_BYTES,
    shard: Column | None = None,
    unique_order: bool = False,
    partitions: int | None = None,
    with_header: bool = True,
    observed: Observation | None = None,
) -> DataFrame:
    """Batches cut as by ``cut_batches``: ``(shard, seq, n_rows, n_bytes, payload)``.

    Each payload is the header line, empty on request, and the rows' lines. Rows are
    shuffled once and a task holds the lines of the open batch only, so this is the
    cheapest way to batch a large table, with strict limits. ``observed`` receives
    ``n_rows``, counted before rows are gathered.
    """
    header = csv_header(df.schema) if with_header else ""
    # encoded once the rows are in order, as sampling evaluates what is before
    ordered = (
        _in_shards(df, order_by, shard, unique_order, partitions)
        .select("shard", csv_line(df).alias("line"))
        .withColumn(_SIZE, row_bytes(F.col("line")) + 1)
    )
    if observed is not None:
        # after the shuffle, as sampling for its bounds would count rows twice
        ordered = ordered.observe(observed, F.count("*").alias("n_rows"))
    new_counter = _greedy_counter(max_rows, max_bytes, len(header.encode()) + 1)

    new_collector = _payload_collector(["shard", "seq"], header)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = new_counter()
        add, last = new_collector()
        for batch in batches:
            shards = batch.column(0).to_numpy()
            numbers = number(batch.column(2).to_numpy(), shards)
            yield from add([shards, numbers], batch.column(1))
        yield from last()

    return ordered.mapInArrow(
        assemble,
        "shard bigint, seq bigint, n_rows bigint, n_bytes bigint, payload string",
    )


def numbered(cut: DataFrame, within: list[str], name: str) -> DataFrame:
    """A stored ``cut`` of range shards with one number from 1, without a gap, in row
    order: ``(*within, name, n_rows, n_bytes, payload)``.

    Numbers start anew for each value of the columns ``within``. Only shard and seq are
    read for them, and one small row per shard is joined.
    """
    sizes = cut.groupBy(*within, "shard").agg(F.max("seq").alias("_n"))
    before = Window.partitionBy(*within, F.lit(0)).orderBy("shard")
    before = F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(*within, "shard", F.coalesce(before, F.lit(0)).alias("_before"))
    if starts.count() <= BROADCAST_SHARDS:
        starts = F.broadcast(starts)
    number = (F.col("_before") + F.col("seq")).alias(name)
    return cut.join(starts, [*within, "shard"]).select(
        *within, number, "n_rows", "n_bytes", "payload"
    )


def _in_shards(
    df: DataFrame,
    order_by: list[str | Column],
    shard: Column | None,
    unique_order: bool,
    partitions: int | None,
) -> DataFrame:
    if shard is None:
        return range_sorted(df, order_by, unique_order, partitions).withColumn(
            "shard", F.spark_partition_id().cast("bigint")
        )
    keys = [F.col(quoted(k)) if isinstance(k, str) else k for k in order_by]
    given = shard.cast("bigint")
    refused = F.raise_error(F.lit("a row has no shard")).cast("bigint")
    return (
        df.withColumn("shard", F.when(given.isNotNull(), given).otherwise(refused))
        .repartition("shard")
        .sortWithinPartitions("shard", *keys)
    )


def _greedy_counter(max_rows: int, max_bytes: int, header_bytes: int):
    """Makes, for each task, a function that numbers the rows of one chunk.

    It remembers the batch that is open from one chunk to the next, and steps from
    batch to batch rather than from row to row.
    """

    def new_counter():
        open_shard, seq, rows, used = None, 0, 0, header_bytes

        def number(sizes: np.ndarray, shards: np.ndarray) -> np.ndarray:
            nonlocal open_shard, seq, rows, used
            ends = np.cumsum(sizes)
            numbers = np.empty(len(ends), dtype=np.int64)
            at = 0
            while at < len(ends):
                if shards[at] != open_shard:
                    open_shard, seq, rows, used = shards[at], 1, 0, header_bytes
                start = int(ends[at - 1]) if at else 0
                stop = min(
                    int(np.searchsorted(ends, start + max_bytes - used, "right")),
                    int(np.searchsorted(shards, open_shard, "right")),
                    at + max_rows - rows,
                )
                if stop <= at:
                    if rows:
                        seq, rows, used = seq + 1, 0, header_bytes
                        continue
                    stop = at + 1
                numbers[at:stop] = seq
                rows += stop - at
                used += int(ends[stop - 1]) - start
                at = stop
            return numbers

        return number

    return new_counter
