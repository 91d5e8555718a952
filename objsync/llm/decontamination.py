"""Benchmark decontamination with one FM-index per training shard.

Documents stream through tasks in shards of some MiB of text. Of a shard only runs of
words that the benchmark has, at least as long as its shortest window, can hold a
window; an FM-index is built over these runs, every window of the benchmark is searched
in it backwards through wavelet-tree ranks, its occurrences are located by sampled
suffix positions, and overlapping ones merge into spans. Nothing is shuffled.

The benchmark is sent to the tasks in blocks of at most ``block_words`` words, one pass
over the documents for each, so that what is broadcast has a bound.

Defined results: a null or empty text has no words and no hits and stays as it is; a
null item text is no item; a null item id marks hits but is not listed; items that share
an id count once; repeated rows each get their own, equal result; an empty benchmark or
table gives no hits; result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fm_index import FMIndex
from .shared import lean
from .words import ALNUM_FOLDED, Texts, blocks, encoded

WINDOW = 10
#: Words of benchmark text in one broadcast block; its windows take some 40 bytes a word.
BLOCK_WORDS = 200_000
SHARD_BYTES = 4 << 20


class _Block:
    """The windows of some items, as rows of word numbers by length."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        texts = Texts([text for _, text in items], ALNUM_FOLDED)
        self.ids = [i for i, _ in items]
        self.vocabulary, word = np.unique(texts.hashes, return_inverse=True)
        # 0 ends an index, 1 separates its runs
        word = word.astype(np.int32) + 2
        self.sigma = len(self.vocabulary) + 2
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.windows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        lengths = np.minimum(texts.counts, window)
        self.shortest = int(lengths[lengths > 0].min()) if (lengths > 0).any() else 0
        for length in np.unique(lengths[lengths > 0]):
            at, owner = [], []
            for item in np.flatnonzero(lengths == length):
                n = texts.counts[item] - length + 1
                at.append(texts.first[item] + np.arange(n))
                owner.append(np.full(n, item))
            at, owner = np.concatenate(at), np.concatenate(owner)
            rows = word[at[:, None] + np.arange(length)]
            rows, which = np.unique(rows, axis=0, return_inverse=True)
            order = np.argsort(which.ravel(), kind="stable")
            bounds = np.searchsorted(which.ravel()[order], np.arange(len(rows) + 1))
            self.windows.append((rows, owner[order], bounds))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers of the shard's words; 0 for words that no item has."""
        out = np.zeros(len(hashes), dtype=np.int64)
        maybe = np.flatnonzero(self.maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        if len(maybe) and len(self.vocabulary):
            found = np.minimum(
                np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1
            )
            same = self.vocabulary[found] == hashes[maybe]
            out[maybe[same]] = found[same] + 2
        return out


def _runs(texts: Texts, number: np.ndarray, shortest: int):
    """The index sequence of a shard, and the word each of its places stands for."""
    edge = np.zeros(len(number) + 1, dtype=bool)
    edge[texts.first] = True
    known = number > 0
    opens = known & (edge[:-1] | ~np.append(False, known[:-1]))
    closes = known & (edge[1:] | ~np.append(known[1:], False))
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    keep = end - start >= shortest
    start, size = start[keep], (end - start)[keep]
    if not len(start):
        return None
    to = np.cumsum(size + 1)
    word = np.arange(to[-1]) - np.repeat(to - size - 1 - start, size + 1)
    seq = number[np.minimum(word, len(number) - 1)]
    seq[to - 1] = 1
    return seq, word


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [low, high), and the range of each."""
    size = high - low
    which = np.repeat(np.arange(len(low)), size)
    return np.arange(size.sum()) + np.repeat(low - np.cumsum(size) + size, size), which


def _hits(texts: Texts, block: _Block):
    """Words hit (a flag for each) and the (text, item) pairs that hit."""
    steps = np.zeros(len(texts.hashes) + 1, dtype=np.int64)
    pairs: list[np.ndarray] = []
    runs = block.shortest and _runs(texts, block.numbers(texts.hashes), block.shortest)
    if runs:
        index = FMIndex(runs[0], block.sigma)
        for rows, owner, bounds in block.windows:
            low, high = index.search(rows.astype(np.int64))
            suffixes, window = _expand(low, high)
            word = runs[1][index.locate(suffixes)]
            np.add.at(steps, word, 1)
            np.add.at(steps, word + rows.shape[1], -1)
            text = np.searchsorted(texts.first, word, side="right") - 1
            found = np.unique(np.stack((text, window), axis=1), axis=0)
            entry, which = _expand(bounds[found[:, 1]], bounds[found[:, 1] + 1])
            pairs.append(np.stack((found[which, 0], owner[entry]), axis=1))
    hit = np.cumsum(steps[:-1]) > 0
    return hit, np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)


def _spans(hit: np.ndarray) -> np.ndarray:
    step = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    return np.stack((np.flatnonzero(step == 1), np.flatnonzero(step == -1)), axis=1)


def _without(texts: Texts, d: int, spans: np.ndarray) -> bytes:
    """Text ``d`` less its spans, from the first to the last byte of their words."""
    first, begin = texts.first[d], texts.begin[d]
    end = texts.begin[d + 1] - 1 if d + 1 < len(texts.begin) else len(texts.blob)
    kept, at = [], begin
    for a, b in spans:
        kept.append(texts.blob[at : texts.starts[first + a]])
        at = texts.ends[first + b - 1]
    kept.append(texts.blob[at:end])
    return b"".join(kept)


def _shard(data: list[bytes | None], before, block: _Block, clean: bool):
    """Per text: number of words, merged spans, item ids, and the text left over."""
    texts = Texts([t or b"" for t in data], ALNUM_FOLDED)
    hit, pairs = _hits(texts, block)
    items: dict[int, set[str]] = {}
    for d, item in pairs.tolist():
        if block.ids[item] is not None:
            items.setdefault(d, set()).add(block.ids[item])
    out = []
    for d, text in enumerate(data):
        mine = hit[texts.first[d] : texts.first[d + 1]]
        ids = items.get(d, set())
        if before is not None:
            ids = ids | set(before[1][d])
            for a, b in np.array(before[0][d], dtype=np.int64).reshape(-1, 2):
                mine[a:b] = True
        spans = _spans(mine) if mine.any() else np.zeros((0, 2), np.int64)
        left = _without(texts, d, spans) if clean and len(spans) else text
        out.append((len(mine), spans.ravel().tolist(), sorted(ids), left))
    return out


def _item_blocks(benchmark: DataFrame, id_column: str, text_column: str, block_words: int):
    """Lists of items of about ``block_words`` words; one list is held at a time."""
    held: list[tuple[str | None, bytes]] = []
    words = 0
    rows = benchmark.select(F.col(id_column).cast("string"), text_column)
    for item, text in rows.where(F.col(text_column).isNotNull()).toLocalIterator():
        held.append((item, text.encode()))
        words += text.count(" ") + 1
        if words >= block_words:
            yield held
            held, words = [], 0
    yield held


def mark_passages(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep_text: bool = False,
    clean: bool = False,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Documents with ``n_words``, ``hit_spans`` and ``hit_items``.

    ``hit_spans`` is a flat array of word numbers (start, end, start, end, ...), merged
    and in order; ``hit_items`` are the ids of items with windows in the document, as
    sorted strings. The text is left out unless ``keep_text``; with ``clean`` (and
    ``keep_text``) it comes without the spans.
    """
    own = {"n_words", "hit_spans", "hit_items"}
    spark = documents.sparkSession
    now = documents.select(*[c for c in documents.columns if c not in own])
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", T.ArrayType(T.LongType())),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
    ]
    groups = _item_blocks(benchmark, item_id, item_text, block_words)
    items = next(groups)
    while items is not None:
        following = next(groups, None)
        last = following is None
        block = spark.sparkContext.broadcast(_Block(items, window))
        with_text = keep_text or not last
        through = [
            f
            for f in now.schema.fields
            if f.name not in own and (with_text or f.name != text_column)
        ]
        schema = T.StructType([*through, *added])
        now = now.mapInArrow(
            lean(_pass_over(block, [f.name for f in through], text_column, clean and last)), schema
        )
        items = following
    return now


def _pass_over(block, through: list[str], text_column: str, clean: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = encoded(batch.column(text_column))
            for a, b in blocks(data, SHARD_BYTES):
                part = batch.slice(a, b - a)
                before = None
                if "hit_spans" in batch.schema.names:
                    before = [part.column(c).to_pylist() for c in ("hit_spans", "hit_items")]
                rows = _shard(data[a:b], before, block.value, clean)
                columns = {c: part.column(c) for c in through}
                if clean and text_column in columns:
                    columns[text_column] = pa.array([r[3] for r in rows], pa.binary()).cast(
                        part.column(text_column).type
                    )
                columns["n_words"] = pa.array([r[0] for r in rows], pa.int64())
                columns["hit_spans"] = pa.array([r[1] for r in rows], pa.list_(pa.int64()))
                columns["hit_items"] = pa.array([r[2] for r in rows], pa.list_(pa.string()))
                yield pa.RecordBatch.from_pydict(columns)

    return run


def decontaminate(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``documents`` with the spans of benchmark passages taken out of their texts."""
    marked = mark_passages(documents, benchmark, keep_text=True, clean=True, **options)
    return marked.select(*[c for c in documents.columns if c in marked.columns])


def passage_digest(marked: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row per document with counts, and a digest of the items found."""
    # the flat array is start, end, start, ...: ends count for their words, starts against
    n_hit = F.aggregate(
        F.transform("hit_spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return marked.select(
        id_column,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
