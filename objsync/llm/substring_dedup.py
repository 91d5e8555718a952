"""Removal of word windows that an earlier document has, by FM-indexes of content shards.

A window of 13 words belongs to the shard of its anchor, the smallest hash of the word
4-grams in it, so equal windows meet in one shard whatever documents they are in, and
each document is cut into segments of consecutive windows with one anchor. Work follows
the text that is shared rather than the number of pairs:

1. The anchors of all documents are counted; those in two documents or more go into a
   bounded bitmap. It only filters: segments let through by mistake match nothing.
2. Segments with such anchors are reduced to distinct ones with their smallest document.
   Equal segments meet in a map-side aggregate first, so copies are cheap. Anchors with
   very many different segments are split further, window by window.
3. Each shard builds an FM-index (wavelet tree, document array) over its segments and
   searches their windows backwards in it: matching statistics up to the window's
   length. The range of a window gives the smallest document that has it.
4. Occurrences are joined back by segment; covered words merge to spans per document.

Words are compared by 48-bit hashes inside one shard, windows by 13 of them.

Defined results: null or empty texts have no words; a null id is never smaller than
another and nothing of its document is removed; rows that repeat an id are not compared
with each other, equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fm_index import FMIndex
from .shared import bitmap, in_bitmap, written
from .words import WHITE, Texts, blocks, encoded, mix, range_hashes, signed

WINDOW = 13
ANCHOR = 4
WORD_BYTES = 6
#: Different segments of one anchor from which its windows are spread over shards.
SPLIT_FROM = 2000
SHARD_WORDS = 1 << 15


def _anchors(texts: Texts, window: int):
    """First window, number of windows, text and anchor of each segment, in order."""
    grams = texts.grams(ANCHOR)
    n = max(0, len(texts.hashes) - window + 1)
    reach, least = 1, grams
    span = window - ANCHOR + 1
    while reach < span:
        step = min(reach, span - reach)
        least = np.minimum(least[: len(least) - step], least[step:])
        reach += step
    ok = np.flatnonzero(texts.gram_ok(window))
    least, owner = least[:n][ok], texts.owner()[ok]
    new = np.ones(len(ok), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return ok[at], np.diff(np.append(at, len(ok))), owner[at], least[at]


def _fingerprints(texts: Texts) -> np.ndarray:
    """A hash of the word sequence of each text."""
    place = np.arange(len(texts.hashes)) - np.repeat(texts.first[:-1], texts.counts)
    sums = np.concatenate(([0], np.cumsum(mix(texts.hashes ^ mix(place.astype(np.uint64))))))
    sums = sums.astype(np.uint64)
    return mix(sums[texts.first[1:]] - sums[texts.first[:-1]])


def _each_block(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        data = encoded(batch.column("text"))
        ids = batch.column("doc_id")
        for a, b in blocks(data):
            yield ids.slice(a, b - a), data[a:b], Texts([t or b"" for t in data[a:b]], WHITE)


def _emit_anchors(window: int):
    def run(batches):
        for ids, _, texts in _each_block(batches):
            _, _, owner, anchor = _anchors(texts, window)
            yield pa.RecordBatch.from_pydict(
                {"anchor": signed(anchor), "doc_id": ids.take(pa.array(owner))}
            )

    return run


def _emit_segments(bits, window: int, with_words: bool):
    """Segments whose anchor may be shared."""

    def run(batches):
        for ids, _, texts in _each_block(batches):
            start, size, owner, anchor = _anchors(texts, window)
            keep = in_bitmap(bits.value, anchor)
            start, size, owner, anchor = start[keep], size[keep], owner[keep], anchor[keep]
            segment = range_hashes(texts.hashes, start, start + size + window - 1)
            columns = {
                "segment": signed(segment),
                "anchor": signed(anchor),
                "doc_id": ids.take(pa.array(owner)),
            }
            if with_words:
                # copies in this block go on once, with their smallest and largest document
                doc = ids.to_numpy(zero_copy_only=False)[owner]
                order = np.lexsort((doc, segment))
                segment, doc = segment[order], doc[order]
                first = np.flatnonzero(np.append(len(segment) > 0, segment[1:] != segment[:-1]))
                start, size, anchor = start[order][first], size[order][first], anchor[order][first]
                columns = {
                    "segment": signed(segment[first]),
                    "anchor": signed(anchor),
                    "least": pa.array(doc[first]),
                    "most": pa.array(np.maximum.reduceat(doc, first) if len(first) else doc[first]),
                }
                raw = np.ascontiguousarray(texts.hashes.view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES])
                blob = raw.tobytes()
                columns["words"] = pa.array(
                    [
                        blob[a * WORD_BYTES : (a + n + window - 1) * WORD_BYTES]
                        for a, n in zip(start.tolist(), size.tolist(), strict=True)
                    ],
                    pa.binary(),
                )
            else:
                columns["print"] = signed(_fingerprints(texts)[owner])
                columns["start"] = start - texts.first[owner]
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _search_shards(window: int):
    """For rows in order of ``shard``: the smallest document of each segment's windows."""

    def one(rows: pa.Table) -> pa.RecordBatch:
        # copies of a segment from different tasks meet here, in the shard of their anchor
        rows = rows.group_by(["segment", "skip"], use_threads=False).aggregate(
            [("least", "min"), ("most", "max"), ("words", "first")]
        )
        rows = rows.rename_columns(["segment", "skip", "least", "most", "words"])
        raw = rows.column("words").to_pylist()
        sizes = np.fromiter((len(x) // WORD_BYTES for x in raw), dtype=np.int64, count=len(raw))
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8).reshape(-1, WORD_BYTES)
        wide = np.zeros((len(flat), 8), dtype=np.uint8)
        wide[:, :WORD_BYTES] = flat
        vocabulary, number = np.unique(wide.view(np.uint64).ravel(), return_inverse=True)
        to = np.cumsum(sizes + 1)
        seq = np.ones(to[-1], dtype=np.int64)  # 1 separates segments
        inside = np.ones(to[-1], dtype=bool)
        inside[to - 1] = False
        seq[inside] = number + 2
        doc = np.repeat(rows.column("least").to_numpy(), sizes + 1)
        index = FMIndex(seq, len(vocabulary) + 2, labels=doc)
        count = sizes - window + 1
        begin = np.repeat(to - sizes - 1, count) + np.arange(count.sum())
        begin -= np.repeat(np.cumsum(count) - count, count)
        # equal windows are searched once
        code = range_hashes(seq.astype(np.uint64), begin, begin + window)
        _, one_of, which = np.unique(code, return_index=True, return_inverse=True)
        # each window occurs: one with a single suffix left is at its own place alone
        low, high = index.search(seq[begin[one_of][:, None] + np.arange(window)], least=2)
        smallest = doc[begin[one_of]]
        shared = np.flatnonzero(high - low > 1)
        if len(shared):
            shared = shared[np.argsort(low[shared])]
            # ranges of different windows are disjoint; odd entries fill the gaps
            edges = np.stack((low[shared], high[shared]), axis=1).ravel()
            labels = np.append(index.labels, index.labels[:1])
            smallest[shared] = np.minimum.reduceat(labels, edges)[::2]
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32)),
            pa.array(smallest[which.ravel()]),
        )
        return pa.RecordBatch.from_pydict(
            {
                "segment": rows.column("segment").combine_chunks(),
                "skip": rows.column("skip").combine_chunks(),
                "most": rows.column("most").combine_chunks(),
                "firsts": lists,
            }
        )

    def run(batches):
        held: pa.Table | None = None
        for batch in batches:
            if not len(batch):
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
            shard = rows.column("shard").to_numpy()
            new = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            words = pc.binary_length(rows.column("words")).to_numpy() // WORD_BYTES
            before = np.append(0, np.cumsum(words))[new]  # words before each shard
            at = 0
            while True:  # the last shard may go on in the next batch
                cut = int(np.searchsorted(before, before[at] + SHARD_WORDS))
                if cut >= len(new):
                    break
                yield one(rows.slice(new[at], new[cut] - new[at]))
                at = cut
            held = rows.slice(new[at])
        if held is not None and held.num_rows:
            yield one(held.combine_chunks())

    return run


def _covered(window: int):
    """Spans of words covered by windows that a smaller document has."""

    def run(batches):
        for batch in batches:
            lists = batch.column("firsts")
            size = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            if not len(row):
                continue
            doc = batch.column("doc_id").to_numpy()
            at = batch.column("start").to_numpy() + batch.column("skip").to_numpy()
            hit = np.flatnonzero(lists.flatten().to_numpy() < doc[row])
            row, word = row[hit], at[row[hit]] + place[hit]
            new = np.ones(len(row), dtype=bool)
            new[1:] = (row[1:] != row[:-1]) | (word[1:] != word[:-1] + 1)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(row))[: len(first)] - 1
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": doc[row[first]],
                    "print": batch.column("print").to_numpy()[row[first]],
                    "low": word[first],
                    "high": word[last] + window,
                }
            )

    return run


def _whole(bits):
    """Every document as it is; the text goes along where something may be removed."""

    def run(batches):
        for ids, data, texts in _each_block(batches):
            prints = _fingerprints(texts)
            may = in_bitmap(bits.value, prints) if len(prints) else np.zeros(0, bool)
            digests = [hashlib.sha256(b" ".join((t or b"").split())).hexdigest() for t in data]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": ids,
                    "print": signed(prints),
                    "n_words": pa.array(texts.counts),
                    "digest": digests,
                    "text": pa.array([t if m else None for t, m in zip(data, may, strict=True)], pa.binary()),
                }
            )

    return run


def _cut(batches):
    for batch in batches:
        n_removed, digests = [], []
        for text, spans, n, digest in zip(
            *(batch.column(c).to_pylist() for c in ("text", "spans", "n_words", "digest")), strict=True
        ):
            gone = np.zeros(n, dtype=bool)
            for span in spans or ():
                gone[span["low"] : span["high"]] = True
            n_removed.append(int(gone.sum()))
            if n_removed[-1]:
                words = text.split()
                kept = b" ".join(words[i] for i in np.flatnonzero(~gone).tolist())
                digest = hashlib.sha256(kept).hexdigest()
            digests.append(digest)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_words": batch.column("n_words"),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
            }
        )


def _inputs(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )


def removal_spans(
    documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW
) -> DataFrame:
    """``(doc_id, print, spans)``: words covered by windows of a smaller document.

    ``print`` is a hash of the document's words, which tells apart rows that repeat an
    id; ``spans`` are structs of ``low`` and ``high`` word numbers and may overlap.
    """
    sc = documents.sparkSession.sparkContext
    docs = _inputs(documents, id_column, text_column).where("doc_id is not null")
    anchors = docs.mapInArrow(_emit_anchors(window), "anchor long, doc_id long")
    shared = (
        anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    )
    shared = written(shared.select("anchor"), "anchors")
    bits = sc.broadcast(bitmap(shared, F.col("anchor"), 1 << 28))
    segments = docs.mapInArrow(
        _emit_segments(bits, window, True), "segment long, anchor long, least long, most long, words binary"
    )
    places = docs.mapInArrow(
        _emit_segments(bits, window, False), "segment long, anchor long, doc_id long, print long, start long"
    )
    # at most one anchor in SPLIT_FROM segments is hot
    hot = (
        places.select("anchor", "segment").distinct().groupBy("anchor").count()
        .where(F.col("count") > SPLIT_FROM).select("anchor", F.lit(True).alias("hot"))
    )
    marked = segments.join(F.broadcast(hot), "anchor", "left")
    # equal segments have one anchor, so its shard takes all their copies in one shuffle
    cold = marked.where(F.col("hot").isNull()).select(
        "segment", "least", "most", F.lit(0).cast("long").alias("skip"), "words",
        F.xxhash64("anchor").alias("shard"),
    )
    distinct = (
        marked.where(F.col("hot"))
        .groupBy("segment", "anchor")
        .agg(F.min("least").alias("least"), F.max("most").alias("most"), F.first("words").alias("words"))
    )
    last = F.floor(F.length("words") / WORD_BYTES).cast("long") - window
    split = (
        distinct.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("skip"))
        .select(
            "segment",
            "least",
            "most",
            "skip",
            F.substring("words", (F.col("skip") * WORD_BYTES + 1).cast("int"), F.lit(window * WORD_BYTES)).alias("words"),
        )
        .withColumn("shard", F.xxhash64("words"))
    )
    shards = cold.unionByName(split)
    firsts = (
        shards.repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_search_shards(window), "segment long, skip long, most long, firsts array<long>")
        .where(F.array_min("firsts") < F.col("most"))
    )
    firsts = written(firsts, "firsts")
    spans = (
        places.join(firsts, "segment")
        .select("doc_id", "print", "start", "skip", "firsts")
        .mapInArrow(_covered(window), "doc_id long, print long, low long, high long")
        .groupBy("doc_id", "print")
        .agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    )
    return written(spans, "spans")


def dedup_digest(
    documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW
) -> DataFrame:
    """Per document the words it has and loses, and a digest of those it keeps."""
    sc = documents.sparkSession.sparkContext
    spans = removal_spans(documents, id_column=id_column, text_column=text_column, window=window)
    bits = sc.broadcast(bitmap(spans, F.col("print")))
    whole = _inputs(documents, id_column, text_column).mapInArrow(
        _whole(bits), "doc_id long, print long, n_words long, digest string, text binary"
    )
    return (
        whole.join(spans, ["doc_id", "print"], "left")
        .select("doc_id", "n_words", "digest", "text", "spans")
        .mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    )
