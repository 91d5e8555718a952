"""Exact centroid clustering of integer vectors, over zone maps in Hilbert order.

1. Vectors become integers, ``floor(scale * x)``, and are ordered along a Hilbert curve
   through all their dimensions, with a spread of equal ones by place in the input, so
   that many copies are dealt over the tasks. Runs of the order are blocks, one row of a
   written table each, with the least and greatest value of every dimension (their box).
2. A round reads the blocks. The box gives each centroid a least and a greatest distance
   to anything in the block; only centroids whose least distance is not above the smallest
   greatest one are candidates, and the vectors are compared with these alone.
3. Tasks add up components per cluster; the sums are aggregated by cluster and dimension
   and the driver holds no more than the centroids.

All arithmetic is exact. Distances are taken in doubles where every intermediate value
is an integer below 2**53, in 64-bit integers elsewhere.

Defined results: vectors that are null, not of ``length`` components or hold null or
non-finite ones are left out; components beyond 2**26 after scaling count as 2**26 (their
distances fit a long; an inertia beyond one is the greatest long); rows that repeat an id
are separate vectors; a null id is kept and hashed as an empty text; of equal hashes the
smaller vector comes first; with fewer vectors than centroids there are as many centroids
as vectors; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written
from .vectors import Vectors, binary, unpacked
from .words import mix

LENGTH = 64
SCALE = 64
#: The greatest component after scaling.
MOST = 1 << 26
#: Vectors of a block.
BLOCK = 512
#: Bits of the curve for each dimension.
BITS = 4

_LONG = (1 << 63) - 1
_RESULT = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
)


def _whole_numbers(batch: pa.RecordBatch, length: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that are kept, and their vectors as integers."""
    v = Vectors(batch.column("vector"))
    rows = np.flatnonzero(v.finite & (v.lengths == length))
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * v.matrix(rows, length))
    return rows, np.clip(scaled, -MOST, MOST).astype(np.int32)


def _kept(length: int, scale: int):
    def run(batches):
        for batch in batches:
            rows, vectors = _whole_numbers(batch, length, scale)
            yield pa.RecordBatch.from_arrays([batch.column("h").take(pa.array(rows)), binary(vectors)], ["h", "vector"])

    return run


def _bounds(length: int, scale: int):
    def run(batches):
        low, high = np.full(length, MOST, np.int64), np.full(length, -MOST, np.int64)
        for batch in batches:
            _, vectors = _whole_numbers(batch, length, scale)
            if len(vectors):
                low, high = np.minimum(low, vectors.min(axis=0)), np.maximum(high, vectors.max(axis=0))
        yield pa.RecordBatch.from_pydict({"dim": np.arange(length), "low": low, "high": high})

    return run


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on a Hilbert curve of grid cells, as rows of bytes in order.

    ``cells`` has a row for each point and a column for each dimension, with values of
    ``bits`` bits. The axes are transformed one bit plane at a time, all points at once.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for plane in range(bits - 1, 0, -1):
        bit = 1 << plane
        for i in range(n):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & (bit - 1))
            x[0] ^= np.where(flip, bit - 1, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for plane in range(bits - 1, 0, -1):
        bit = 1 << plane
        turn = np.where((x[-1] & bit) != 0, turn ^ (bit - 1), turn)
    x ^= turn
    # the highest bit of all dimensions first
    planes = [(x >> plane) & 1 for plane in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def _keyed(length: int, scale: int, low: np.ndarray, high: np.ndarray):
    def run(batches):
        seen = 0
        for batch in batches:
            rows, vectors = _whole_numbers(batch, length, scale)
            cells = ((vectors - low) << BITS) // (high - low + 1)
            place = np.arange(seen, seen + len(rows)).astype(np.uint64)
            seen += len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(rows)),
                    binary(hilbert_keys(cells, BITS)),
                    pa.array(mix(place).view(np.int64)),
                    binary(vectors),
                ],
                ["vec_id", "key", "spread", "vector"],
            )

    return run


def _pack(block: int):
    """Sorted vectors as one row for each run of ``block``."""

    def packed(table: pa.Table) -> pa.RecordBatch:
        ids = table["vec_id"]
        vectors = unpacked(table["vector"].combine_chunks(), "i4")
        return pa.RecordBatch.from_pydict(
            {
                "ids": [ids.fill_null(0).to_numpy().tobytes()],
                "absent": [(~ids.is_valid().to_numpy()).astype("u1").tobytes()],
                "vectors": [vectors.tobytes()],
                "low": [vectors.min(axis=0).tobytes()],
                "high": [vectors.max(axis=0).tobytes()],
            }
        )

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, block - size)
                held.append(part)
                size, at = size + part.num_rows, at + part.num_rows
                if size == block:
                    yield packed(pa.Table.from_batches(held))
                    held, size = [], 0
        if size:
            yield packed(pa.Table.from_batches(held))

    return run


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The numbers of the centroids that may be nearest to something in a box."""
    low, high = low.astype(np.int64), high.astype(np.int64)
    below, above = low - centroids, centroids - high
    least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=1)
    greatest = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=1)
    return np.flatnonzero(least <= greatest.min())


def assigned(vectors: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray):
    """The nearest centroid of each vector of a block, ties to the smaller number, and the squared distance."""
    some = candidates(low, high, centroids)
    near = centroids[some]
    most = max(int(np.abs(low.astype(np.int64)).max()), int(np.abs(high.astype(np.int64)).max()), int(np.abs(near).max()))
    if 4 * vectors.shape[1] * most * most < 1 << 53:
        v, c = vectors.astype(np.float64), near.astype(np.float64)
        squares = (v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)
        squares = squares.astype(np.int64)
    else:
        squares = np.stack([((vectors - c) ** 2).sum(axis=1) for c in near], axis=1)
    # candidates are in ascending order, so the first of equals has the smallest number
    best = np.argmin(squares, axis=1)
    return some[best], squares[np.arange(len(vectors)), best]


def _each_block(batches, length: int):
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            vectors = np.frombuffer(row["vectors"], "i4").reshape(-1, length).astype(np.int64)
            yield row, vectors, np.frombuffer(row["low"], "i4"), np.frombuffer(row["high"], "i4")


def _sums(centroids: np.ndarray):
    """Of each cluster, by dimension: vectors and sum of components; as dimension -1 the distances."""

    def run(batches):
        k, length = centroids.shape
        sums = np.zeros((k, length), np.int64)
        n = np.zeros(k, np.int64)
        distance = [0] * k
        for _, vectors, low, high in _each_block(batches, length):
            of, squares = assigned(vectors, low, high, centroids)
            np.add.at(sums, of, vectors)
            n += np.bincount(of, minlength=k)
            for c in np.unique(of).tolist():
                distance[c] += sum(squares[of == c].tolist())
        cluster = np.repeat(np.arange(k), length + 1)
        dim = np.tile(np.arange(-1, length), k)
        total = [x for c in range(k) for x in [distance[c], *sums[c].tolist()]]
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": cluster,
                "dim": dim,
                "n": np.repeat(n, length + 1),
                "total": pa.array(total, pa.decimal128(38, 0)),
            }
        )

    return run


def _totals(blocks: DataFrame, centroids: np.ndarray):
    """Vectors, component sums and summed distances of each cluster."""
    k, length = centroids.shape
    rows = blocks.mapInArrow(_sums(centroids), "cluster long, dim long, n long, total decimal(38,0)")
    n, sums, distance = [0] * k, [[0] * length for _ in range(k)], [0] * k
    for cluster, dim, count, total in rows.groupBy("cluster", "dim").agg(F.sum("n"), F.sum("total")).collect():
        if dim < 0:
            n[cluster], distance[cluster] = count, int(total)
        else:
            sums[cluster][dim] = int(total)
    return n, sums, distance


def _results(centroids: np.ndarray, distance: list[int]):
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    held = np.array([min(d, _LONG) for d in distance], np.int64)
    whole = min(sum(distance), _LONG)

    def run(batches):
        for row, vectors, low, high in _each_block(batches, centroids.shape[1]):
            of, squares = assigned(vectors, low, high, centroids)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": pa.array(np.frombuffer(row["ids"], "i8"), mask=np.frombuffer(row["absent"], "u1") > 0),
                    "cluster": of.astype(np.int32),
                    "distance": squares,
                    "cluster_inertia": held[of],
                    "inertia": np.full(len(of), whole),
                    "centroid_sha256": [sha[c] for c in of.tolist()],
                }
            )

    return run


def clusters(
    embeddings: DataFrame,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    length: int = LENGTH,
    scale: int = SCALE,
    count: int = 16,
    rounds: int = 3,
    block: int = BLOCK,
) -> DataFrame:
    """The cluster of each vector, its distance, and what the clusters come to."""
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))

    h = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = rows.select(h.alias("h"), "vector").mapInArrow(_kept(length, scale), "h string, vector binary")
    first = first.orderBy("h", "vector").limit(count).toArrow()
    if not first.num_rows:
        return spark.createDataFrame([], _RESULT)
    centroids = unpacked(first["vector"].combine_chunks(), "i4").astype(np.int64)

    box = rows.select("vector").mapInArrow(_bounds(length, scale), "dim long, low long, high long")
    box = box.groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").toArrow()
    keyed = rows.mapInArrow(
        _keyed(length, scale, box["low"].to_numpy(), box["high"].to_numpy()),
        "vec_id long, key binary, spread long, vector binary",
    )
    blocks = keyed.repartitionByRange("key", "spread").sortWithinPartitions("key", "spread").select("vec_id", "vector")
    blocks = written(
        blocks.mapInArrow(_pack(block), "ids binary, absent binary, vectors binary, low binary, high binary"), "zones"
    )
    for _ in range(rounds):
        n, sums, _ = _totals(blocks, centroids)
        centroids = np.array(
            [[s // m for s in sums[c]] if (m := n[c]) else centroids[c].tolist() for c in range(len(centroids))], np.int64
        )
    _, _, distance = _totals(blocks, centroids)
    return blocks.mapInArrow(_results(centroids, distance), _RESULT)
