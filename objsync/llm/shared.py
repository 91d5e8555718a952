"""Written intermediate tables, bounded bitmaps of hashes, and connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.session import new_run_dir


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder, so that nothing before it runs again."""
    path = new_run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_kept: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]):
    """What a worker keeps from task to task under ``name``, until ``lean`` drops it."""
    if name not in _kept:
        _kept[name] = make()
    return _kept[name]


def give_back(keep: str | None = None) -> None:
    """Return the free memory of this worker, which lives on between stages, to the system.

    Objects kept under other names than ``keep`` are dropped first.
    """
    for name in [n for n in _kept if n != keep]:
        del _kept[name]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run, keep: str | None = None):
    """The pass ``run`` over batches, at whose end its worker gives free memory back.

    It starts without what passes of other kinds kept in the worker.
    """

    def passes(batches):
        if any(n != keep for n in _kept):
            give_back(keep)
        try:
            yield from run(batches)
        finally:
            give_back(keep)

    return passes


def bitmap(df: DataFrame, key: Column, max_bits: int = 1 << 26) -> np.ndarray:
    """Bits of all hashes ``key`` (longs), of ``max_bits`` (a power of two) at most.

    A filter only: a hash without its bit is not among the keys, and what passes is
    joined exactly afterwards. The size does not grow with the keys beyond the bound;
    with more of them more rows pass.
    """
    n = df.count()
    size = 1 << 16
    while size < min(max_bits, 16 * n):
        size *= 2
    slot = key.bitwiseAND(F.lit(size - 1))
    words = (
        df.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(size // 64, dtype=np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes.astype(np.uint64) & np.uint64(len(bits) * 64 - 1)
    word = bits[(slot >> np.uint64(6)).astype(np.int64)]
    return (word >> (slot & np.uint64(63))) & np.uint64(1) != 0


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the smallest of its component.

    Alternating star contraction: each node points its larger neighbours, then its
    smaller ones and itself, to its smallest neighbour, until nothing changes. Edges are
    written after each round. A node of many edges is aggregated before it is shuffled
    and its joins can be split.
    """
    spark = edges.sparkSession
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    before = _summary(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a <> b").distinct(), "edges")
        # every edge leads from a larger node to a smaller one
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        after = written(small.where("a <> b").distinct(), "edges")
        summary = _summary(after)
        if summary == before:
            break
        now, before = after, summary
    roots = after.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _summary(edges: DataFrame):
    """Two sums of hashes and a count: equal for equal sets of edges."""
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    g = F.xxhash64("b", "a", F.lit(7)).cast("decimal(38,0)")
    return edges.agg(F.count("*"), F.sum(h), F.sum(g)).first()


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def crc_fold(id_column: str = "doc_id") -> Column:
    """``crc32(doc_id as text) mod 3``."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def maybe_among(spark: SparkSession, ids: DataFrame, column: str):
    """A column function that is true for all longs of ``ids``' ``column`` and few others.

    It takes a bitmap of the ids to the tasks, and only the column itself passes through
    Python. A null is not among the ids.
    """
    from .words import mix, signed

    def hashed(values: np.ndarray) -> np.ndarray:
        return mix(values.astype(np.int64).view(np.uint64))

    def hashes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"h": signed(hashed(batch.column(0).to_numpy()))})

    listed = ids.select(F.col(column).cast("long")).where(F.col(column).isNotNull())
    bits = spark.sparkContext.broadcast(bitmap(listed.mapInArrow(hashes, "h long"), F.col("h")))

    @F.arrow_udf("boolean")
    def among(values: pa.Array) -> pa.Array:
        found = in_bitmap(bits.value, hashed(values.fill_null(0).to_numpy(zero_copy_only=False)))
        return pa.array(found & values.is_valid().to_numpy(False))

    return among
