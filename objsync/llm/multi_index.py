"""Nearest vectors by inner product, through an inverted multi-index.

1. The two halves of a vector are quantised by a codebook each, fitted on a bounded
   sample; a pair of centroids is a cell, and every vector is in one.
2. Cells lie one after the other in pieces of bounded size; a cell beyond it, such as one
   of many copies, is split by a row hash. A piece is one row of a written table.
3. A query visits cells by the sum of its distances to the two centroids (the negative
   inner products), taken from a heap over the sorted distances of both halves, until it
   has seen a share of all entries. The share is the one that found ``recall`` of the
   true neighbours of a bounded sample of queries, which are compared with every vector.
4. Queries are searched in blocks. A block meets the pieces that hold a visited cell;
   there the entries of each cell are reranked for the queries that visit it, in double
   precision on the original vectors. The best of each piece are merged per block.

Where no structure helps, such as for random directions, the share is large; its cost is
then that of comparing the queries with much of the table, still in blocks.

Defined results: vectors that are null, empty or zero or hold null or non-finite
components take no part; vectors of different lengths are searched apart, those of one
length together; rows that repeat an id are separate, each query row with its own results,
and only the query's own row is left out; ties go to the smaller id, a null id last, then
to the earlier row; a null id is no query; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written
from .vectors import Vectors, binary, fitted_centres, nearest_centres, unpacked
from .words import mix

#: Centroids of each half; the square of it is the number of cells.
CENTROIDS = 64
#: Rows that fit the codebooks, and queries that fit the share, at most (expected numbers).
SAMPLE = 16_384
SAMPLE_QUERIES = 256
#: Share of the true neighbours of the sampled queries that is to be found.
RECALL = 0.95
#: Entries of a piece (twice as many at most, but for the chance of the hash), and queries
#: of a block.
PIECE = 8192
QUERY_BLOCK = 512

_FOUND = np.dtype([("score", "f8"), ("absent", "u1"), ("id", "i8"), ("row", "i8")])
_RESULT = "query_id long, rank int, vec_id long, score double"


def _share_of_hash(h: Column, share: float) -> Column:
    """True for about ``share`` of all hashes."""
    return F.shiftrightunsigned(h, 11) < F.lit(int(share * (1 << 53)))


def _lengths(batches):
    found: dict[int, int] = {}
    for batch in batches:
        v = Vectors(batch.column("vector"))
        for length, n in zip(*np.unique(v.lengths[v.finite & v.nonzero], return_counts=True), strict=True):
            found[int(length)] = found.get(int(length), 0) + int(n)
    yield pa.RecordBatch.from_pydict({"length": list(found), "n": list(found.values())}, _schema("length", "n"))


def _schema(*longs: str, **others: pa.DataType) -> pa.Schema:
    return pa.schema([(x, pa.int64()) for x in longs] + list(others.items()))


def _of_length(length: int):
    def run(batches):
        for batch in batches:
            v = Vectors(batch.column("vector"))
            rows = np.flatnonzero(v.finite & v.nonzero & (v.lengths == length))
            yield pa.RecordBatch.from_arrays([batch.column("h").take(pa.array(rows)), binary(v.matrix(rows, length))], ["h", "vector"])

    return run


@dataclass
class Index:
    """Codebooks and cell sizes of the vectors of one length: all bounded by constants."""

    length: int
    books: tuple[np.ndarray, np.ndarray]
    sizes: np.ndarray | None = None
    share: float = 1.0

    @property
    def half(self) -> int:
        return (self.length + 1) // 2

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        left, right = vectors[:, : self.half], vectors[:, self.half :]
        return nearest_centres(left, self.books[0]) * len(self.books[1]) + nearest_centres(right, self.books[1])

    def distances(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return -queries[:, : self.half] @ self.books[0].T, -queries[:, self.half :] @ self.books[1].T

    def visited(self, queries: np.ndarray) -> np.ndarray:
        """Which cells each query visits: a row of flags for each."""
        out = np.zeros((len(queries), len(self.sizes)), dtype=bool)
        enough = self.share * self.sizes.sum()
        sizes = self.sizes.tolist()
        for q, (left, right) in enumerate(zip(*self.distances(queries), strict=True)):
            out[q, list(_cells_by_distance(left, right, sizes, enough))] = True
        return out

    def layout(self, piece: int) -> tuple[np.ndarray, np.ndarray]:
        """The first piece of each cell and the number of pieces it is split into."""
        first, parts = np.zeros(len(self.sizes), np.int64), np.ones(len(self.sizes), np.int64)
        at, held = 0, 0
        for cell, n in enumerate(self.sizes.tolist()):
            if held and held + n > piece:
                at, held = at + 1, 0
            first[cell], parts[cell] = at, max(1, -(-n // piece))
            if parts[cell] > 1:
                at, held = at + int(parts[cell]), 0
            else:
                held += n
        return first, parts


def _cells_by_distance(left: np.ndarray, right: np.ndarray, sizes: list[int], enough: float):
    """Cells in the order of summed distance, until more than ``enough`` entries are seen."""
    by_left, by_right = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    near, far = left[by_left].tolist(), right[by_right].tolist()
    by_left, by_right, width = by_left.tolist(), by_right.tolist(), len(right)
    heap, seen = [(near[0] + far[0], 0, 0)], 0
    while heap and seen <= enough:
        _, i, j = heap[0]
        cell = by_left[i] * width + by_right[j]
        yield cell
        seen += sizes[cell]
        # the next of this row of pairs; a row starts once the one before it has
        if j + 1 < width:
            heapq.heapreplace(heap, (near[i] + far[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if j == 0 and i + 1 < len(near):
            heapq.heappush(heap, (near[i + 1] + far[0], i + 1, 0))


def _assign(index: Index, every: int):
    def run(batches):
        for batch in batches:
            v = Vectors(batch.column("vector"))
            rows = np.flatnonzero(v.finite & v.nonzero & (v.lengths == index.length))
            vectors = v.matrix(rows, index.length)
            ids = batch.column("vec_id").take(pa.array(rows))
            asks = (ids.fill_null(1).to_numpy() % every == 0) & ids.is_valid().to_numpy(False)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(pa.array(rows)),
                    ids,
                    pa.array(asks),
                    pa.array(index.cells(vectors), pa.int64()),
                    binary(vectors),
                ],
                ["row", "vec_id", "asks", "cell", "vector"],
            )

    return run


def _in_order(products: np.ndarray) -> np.ndarray:
    """Sums of each row, added from the first component on."""
    return np.cumsum(products, axis=1)[:, -1]


def _best(owner: np.ndarray, found: np.ndarray, most: int) -> np.ndarray:
    """Places in ``found`` of the best of each owner, in the order of owner and rank."""
    order = np.lexsort((found["row"], found["id"], found["absent"], -found["score"], owner))
    sorted_owner = owner[order]
    first = np.searchsorted(sorted_owner, sorted_owner)
    return order[np.arange(len(order)) - first < most]


def _rerank(queries, own_rows, visited, cells, rows, ids, absent, vectors, most):
    """The best entries of a piece for each query: owners (places in the block), and entries."""
    scores = np.full((len(queries), len(vectors)), -np.inf)
    borders = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1], [True])))
    for a, b in zip(borders[:-1], borders[1:], strict=True):
        asking = np.flatnonzero(visited[:, cells[a]])
        if len(asking):
            scores[asking, a:b] = queries[asking] @ vectors[a:b].T
    order = np.argsort(rows)
    at = np.minimum(np.searchsorted(rows[order], own_rows), len(rows) - 1)
    same = rows[order[at]] == own_rows
    scores[np.flatnonzero(same), order[at[same]]] = -np.inf
    bound = np.full(len(queries), -np.inf)
    if len(vectors) > most:
        bound = np.partition(scores, len(vectors) - most, axis=1)[:, len(vectors) - most]
    # a product may round in another way for an equal vector: take all within that, and
    # add those up in one fixed order
    slack = 1e-12 * np.linalg.norm(queries, axis=1) * np.linalg.norm(vectors, axis=1).max()
    owner, entry = np.nonzero((scores >= (bound - slack)[:, None]) & (scores > -np.inf))
    found = np.zeros(len(owner), _FOUND)
    for a in range(0, len(owner), 1 << 16):
        o, e = owner[a : a + (1 << 16)], entry[a : a + (1 << 16)]
        found["score"][a : a + (1 << 16)] = _in_order(queries[o] * vectors[e])
    found["absent"], found["id"], found["row"] = absent[entry], ids[entry], rows[entry]
    keep = _best(owner, found, most)
    return owner[keep], found[keep]


def _true_neighbours(queries: np.ndarray, own_rows: np.ndarray, most: int):
    """The best entries of a task for each of some queries, whatever their cells."""

    def run(batches):
        owner, found, cell = np.zeros(0, np.int64), np.zeros(0, _FOUND), np.zeros(0, np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                rows, vectors = part.column("row").to_numpy(), unpacked(part.column("vector"), "f8")
                near = np.zeros(len(rows), np.int64)
                o, f = _rerank(
                    queries, own_rows, np.ones((len(queries), 1), bool), near, rows, rows, near.astype("u1"), vectors, most
                )
                at = np.argsort(rows)
                c = part.column("cell").to_numpy()[at[np.searchsorted(rows[at], f["row"])]]
                owner, found, cell = (np.concatenate(x) for x in ((owner, o), (found, f), (cell, c)))
                keep = _best(owner, found, most)
                owner, found, cell = owner[keep], found[keep], cell[keep]
        yield pa.RecordBatch.from_pydict(
            {"query": owner, "score": np.ascontiguousarray(found["score"]), "row": np.ascontiguousarray(found["row"]), "cell": cell}
        )

    return run


def _fit_share(index: Index, entries: DataFrame, most: int, recall: float) -> float:
    """The share of entries to see until ``recall`` of the true neighbours are found."""
    asking = entries.where("asks")
    n = asking.count()
    if not n:
        return 1.0
    drawn = asking.where(_share_of_hash(F.xxhash64("row"), min(1.0, SAMPLE_QUERIES / n)))
    drawn = drawn.select("row", "vector").orderBy("row").toArrow()
    if not drawn.num_rows:
        return 1.0
    queries = unpacked(drawn["vector"].combine_chunks(), "f8")
    best = entries.select("row", "cell", "vector").mapInArrow(
        _true_neighbours(queries, drawn["row"].to_numpy(), most), "query long, score double, row long, cell long"
    )
    by_rank = F.row_number().over(_window("query", F.desc("score"), "row"))
    best = best.withColumn("rank", by_rank).where(F.col("rank") <= most).select("query", "cell").toArrow()
    seen = []
    left, right = index.distances(queries)
    for q, cell in zip(best["query"].to_numpy(), best["cell"].to_numpy(), strict=True):
        total = (left[q][:, None] + right[q][None, :]).ravel()
        seen.append(index.sizes[total < total[cell]].sum() / index.sizes.sum())
    return float(np.quantile(seen, recall, method="higher")) if seen else 1.0


def _window(key: str, *order):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(*order)


def _placed(first: np.ndarray, parts: np.ndarray):
    def run(batches):
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            spread = mix(batch.column("row").to_numpy().view(np.uint64)) % parts[cell].astype(np.uint64)
            piece = pa.array(first[cell] + spread.astype(np.int64))
            yield pa.RecordBatch.from_arrays([piece, *batch.columns], ["piece", *batch.schema.names])

    return run


_PIECE_SCHEMA = "piece long, rows binary, ids binary, absent binary, asks binary, cells binary, vectors binary"


def _pack(batches):
    """Sorted entries as one row for each piece."""
    held: list[pa.RecordBatch] = []

    def packed():
        t = pa.Table.from_batches(held).combine_chunks()
        ids = t["vec_id"]
        return pa.RecordBatch.from_pydict(
            {
                "piece": t["piece"][:1].combine_chunks(),
                "rows": [t["row"].to_numpy().tobytes()],
                "ids": [ids.fill_null(0).to_numpy().tobytes()],
                "absent": [(~ids.is_valid().to_numpy()).astype("u1").tobytes()],
                "asks": [t["asks"].to_numpy().astype("u1").tobytes()],
                "cells": [t["cell"].to_numpy().tobytes()],
                "vectors": [b"".join(t["vector"].to_pylist())],
            }
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        piece = batch.column("piece").to_numpy()
        borders = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1]))).tolist() + [len(piece)]
        for a, b in zip(borders[:-1], borders[1:], strict=True):
            if held and held[0].column("piece")[0].as_py() != piece[a]:
                yield packed()
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
    if held:
        yield packed()


def _array(batch: pa.RecordBatch, name: str, dtype: str, i: int = 0) -> np.ndarray:
    return np.frombuffer(batch.column(name)[i].as_py(), dtype)


_BLOCK_SCHEMA = "block string, pieces array<long>, own_rows binary, own_ids binary, queries binary, visited binary"


def _route(index: Index, first: np.ndarray, parts: np.ndarray):
    """The queries of each piece in blocks, with the cells they visit and their pieces."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                asks = np.flatnonzero(_array(batch, "asks", "u1", i))
                rows, ids = _array(batch, "rows", "i8", i), _array(batch, "ids", "i8", i)
                vectors = _array(batch, "vectors", "f8", i).reshape(-1, index.length)
                for k in range(0, len(asks), QUERY_BLOCK):
                    some = asks[k : k + QUERY_BLOCK]
                    visited = index.visited(vectors[some])
                    cells = np.flatnonzero(visited.any(axis=0) & (index.sizes > 0))
                    pieces = [np.arange(first[c], first[c] + parts[c]) for c in cells]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "block": [f"{batch.column('piece')[i].as_py()}:{k}"],
                            "pieces": pa.array([np.unique(np.concatenate(pieces))], pa.list_(pa.int64())),
                            "own_rows": [rows[some].tobytes()],
                            "own_ids": [ids[some].tobytes()],
                            "queries": [vectors[some].tobytes()],
                            "visited": [np.packbits(visited, axis=1).tobytes()],
                        }
                    )

    return run


_BEST_SCHEMA = "block string, own_ids binary, owner binary, found binary"


def _search(length: int, cells: int, most: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                queries = _array(batch, "queries", "f8", i).reshape(-1, length)
                bits = _array(batch, "visited", "u1", i).reshape(len(queries), -1)
                owner, found = _rerank(
                    queries,
                    _array(batch, "own_rows", "i8", i),
                    np.unpackbits(bits, axis=1, count=cells).astype(bool),
                    _array(batch, "cells", "i8", i),
                    _array(batch, "rows", "i8", i),
                    _array(batch, "ids", "i8", i),
                    _array(batch, "absent", "u1", i),
                    _array(batch, "vectors", "f8", i).reshape(-1, length),
                    most,
                )
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": batch.column("block").slice(i, 1),
                        "own_ids": batch.column("own_ids").slice(i, 1),
                        "owner": [owner.astype("i4").tobytes()],
                        "found": [found.tobytes()],
                    }
                )

    return run


def _merge(most: int):
    """Blocks in order, each as the best of all its pieces."""

    def run(batches):
        now, own, owner, found = None, None, None, None

        def rows():
            rank = np.arange(len(owner)) - np.searchsorted(owner, owner) + 1
            return pa.RecordBatch.from_pydict(
                {
                    "query_id": own[owner],
                    "rank": rank.astype(np.int32),
                    "vec_id": pa.array(found["id"], pa.int64(), mask=found["absent"] > 0),
                    "score": np.ascontiguousarray(found["score"]),
                }
            )

        for batch in batches:
            for i, block in enumerate(batch.column("block").to_pylist()):
                if block != now:
                    if now is not None:
                        yield rows()
                    now, own = block, _array(batch, "own_ids", "i8", i)
                    owner, found = np.zeros(0, np.int32), np.zeros(0, _FOUND)
                owner = np.concatenate((owner, _array(batch, "owner", "i4", i)))
                found = np.concatenate((found, _array(batch, "found", _FOUND, i)))
                keep = _best(owner, found, most)
                owner, found = owner[keep], found[keep]
        if now is not None:
            yield rows()

    return run


def _search_length(rows: DataFrame, length: int, n: int, every: int, most: int, recall: float, piece: int) -> DataFrame:
    spark = rows.sparkSession
    drawn = rows.withColumn("h", F.xxhash64("vec_id", "vector")).where(_share_of_hash(F.col("h"), min(1.0, SAMPLE / n)))
    drawn = drawn.select("h", "vector").mapInArrow(_of_length(length), "h long, vector binary").dropDuplicates(["h"])
    points = unpacked(drawn.orderBy("h").select("vector").toArrow()["vector"].combine_chunks(), "f8")
    if not len(points):
        return spark.createDataFrame([], _RESULT)
    half = (length + 1) // 2
    index = Index(length, (fitted_centres(points[:, :half], CENTROIDS), fitted_centres(points[:, half:], CENTROIDS)))

    entries = written(
        rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            _assign(index, every), "row long, vec_id long, asks boolean, cell long, vector binary"
        ),
        "entries",
    )
    sizes = entries.groupBy("cell").count().toArrow()
    index.sizes = np.zeros(len(index.books[0]) * len(index.books[1]), np.int64)
    index.sizes[sizes["cell"].to_numpy()] = sizes["count"].to_numpy()
    index.share = _fit_share(index, entries, most, recall)
    first, parts = index.layout(piece)

    pieces = entries.mapInArrow(_placed(first, parts), "piece long, row long, vec_id long, asks boolean, cell long, vector binary")
    pieces = pieces.repartition("piece").sortWithinPartitions("piece", "cell", "row").mapInArrow(_pack, _PIECE_SCHEMA)
    pieces = written(pieces, "pieces")
    blocks = written(pieces.mapInArrow(_route(index, first, parts), _BLOCK_SCHEMA), "blocks")
    meets = blocks.select("*", F.explode("pieces").alias("piece")).drop("pieces").join(pieces, "piece")
    best = meets.drop("piece", "asks").mapInArrow(_search(length, len(index.sizes), most), _BEST_SCHEMA)
    return best.repartition("block").sortWithinPartitions("block").mapInArrow(_merge(most), _RESULT)


def nearest(
    embeddings: DataFrame,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    every: int = 20,
    neighbours: int = 20,
    recall: float = RECALL,
    piece: int = PIECE,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest vectors of each row whose id is divisible by ``every``."""
    rows = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))
    lengths = rows.mapInArrow(_lengths, "length long, n long").groupBy("length").agg(F.sum("n").alias("n"))
    out = None
    for length, n in sorted(lengths.collect()):
        found = _search_length(rows, length, n, every, neighbours, recall, piece)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else embeddings.sparkSession.createDataFrame([], _RESULT)
