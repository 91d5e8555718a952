"""Best-fit packing by patterns of document lengths, fitted by non-negative least squares.

Tasks turn texts into pieces of at most ``capacity`` tokens. Only the histogram of piece
lengths, of at most ``capacity`` entries, comes to the driver. There patterns of two to
five lengths that fill a sequence are enumerated, their repeat counts are fitted to the
histogram by projected gradients, rounded down, and what is left is packed best fit
first, again pattern by pattern with repeats. The plan is a list of ranges: the pieces
of one length that are its k-th to m-th go to certain sequences and offsets. Its size
depends on the capacity, not on the documents. Pieces are numbered within their length in
two levels, so that a length that most pieces have is not in one task.

Defined results: a null or empty text is one piece that holds the end token alone; rows
that repeat an id are packed each; an empty table gives an empty result; further columns
are not read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import kept, lean, written
from .words import WHITE, Texts, blocks, encoded

CAPACITY = 4096
END_ID = 1
#: Words whose tokens a task remembers; beyond it the memory starts anew.
REMEMBERED_WORDS = 2_000_000
#: Pieces numbered together within a length.
NUMBERED_TOGETHER = 50_000

# --------------------------------------------------------------------------- tokens

#: Words of Latin letters and then signs, whose parts the vocabulary's own pre-tokenizer
#: cuts in the same way; all other words go through the whole tokenizer.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]*)([-,.;:!?#$%&*|()]*)")


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class Encoder:
    """Token ids of words, remembered by word hash."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self._forget()

    def _forget(self):
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _plain(self, part: str) -> list[int]:
        letters = part.lower()
        if not letters.isascii():
            letters = "".join([self.letters[b] for b in letters.encode()])
        return [t.id for t in self.tokenizer.model.tokenize(letters)]

    def _encode(self, words: list[str]) -> list[list[int]]:
        out: list[list[int] | None] = []
        other = []
        for word in words:
            match = _PLAIN.fullmatch(word)
            if match:
                out.append([i for part in match.groups() if part for i in self._plain(part)])
            else:
                out.append(None)
                other.append(word)
        encodings = iter(self.tokenizer.encode_batch_fast(other, add_special_tokens=False))
        return [ids if ids is not None else next(encodings).ids for ids in out]

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and where each text's start."""
        unique, one, which = np.unique(texts.hashes, return_index=True, return_inverse=True)
        found = np.searchsorted(self.hashes, unique)
        known = np.zeros(len(unique), dtype=bool)
        inside = found < len(self.hashes)
        known[inside] = self.hashes[found[inside]] == unique[inside]
        if not known.all():
            if len(self.hashes) > REMEMBERED_WORDS:
                self._forget()
                known[:] = False
            new = np.flatnonzero(~known)
            words = [
                texts.blob[texts.starts[i] : texts.ends[i]].decode() for i in one[new].tolist()
            ]
            ids = self._encode(words)
            size = np.fromiter((len(x) for x in ids), dtype=np.int64, count=len(ids))
            at = len(self.ids) + np.cumsum(size) - size
            self.ids = np.concatenate([self.ids, np.array([i for x in ids for i in x], np.uint32)])
            place = np.searchsorted(self.hashes, unique[new])
            self.at = np.insert(self.at, place, at)
            self.size = np.insert(self.size, place, size)
            self.hashes = np.insert(self.hashes, place, unique[new])
            found = np.searchsorted(self.hashes, unique)
        entry = found[which.ravel()]
        size = self.size[entry]
        to = np.cumsum(size)
        ids = self.ids[np.arange(to[-1] if len(to) else 0) + np.repeat(self.at[entry] - to + size, size)]
        return ids, np.append(0, to)[texts.first]


def _emit_pieces(path: str, capacity: int, with_ids: bool):
    def run(batches):
        encoder = kept(path, lambda: Encoder(path))
        for batch in batches:
            data = encoded(batch.column("text"))
            for a, b in blocks(data):
                texts = Texts([t or b"" for t in data[a:b]], WHITE)
                ids, begin = encoder.encode(texts)
                rows = []
                for d in range(b - a):
                    own = np.append(ids[begin[d] : begin[d + 1]], np.uint32(END_ID)).astype("<u4")
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        part = own[start : start + capacity]
                        rows.append((d, piece, start, len(part), zlib.crc32(part.tobytes()), part))
                columns = list(zip(*rows, strict=True))
                out = {"doc_id": batch.column("doc_id").slice(a, b - a).take(pa.array(columns[0]))}
                for name, values in zip(("piece", "start", "length", "ids_crc32"), columns[1:5], strict=True):
                    out[name] = pa.array(values, pa.int32() if name == "piece" else pa.int64())
                if with_ids:
                    out["ids"] = pa.array(columns[5], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(out)

    return run


def token_pieces(
    documents: DataFrame,
    tokenizer_path: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces ``(doc_id, piece, start, length, ids_crc32)`` and, on request, their ids."""
    docs = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.mapInArrow(
        lean(_emit_pieces(tokenizer_path, capacity, with_ids), tokenizer_path), schema + ", ids array<int>" * with_ids
    )


# ----------------------------------------------------------------------------- plan


def _patterns(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of up to five lengths (0: none) that together fill a sequence, or nearly."""
    present = np.flatnonzero(counts)
    present = present[present < capacity]
    if not len(present):
        return np.zeros((0, 5), dtype=np.int64)

    def fitting(room: np.ndarray) -> np.ndarray:
        """The largest length that there is up to ``room``; 0: none."""
        i = np.searchsorted(present, room, side="right") - 1
        return np.where(i >= 0, present[np.maximum(i, 0)], 0)

    found = []
    for parts in range(1, 5):
        for tilt in (1.0, 0.8, 0.6):
            row, room = [present], capacity - present
            for left in range(parts, 0, -1):
                share = room if left == 1 else (room / left * tilt).astype(np.int64)
                length = fitting(share)
                row.append(length)
                room = room - length
            row += [np.zeros_like(present)] * (4 - parts)
            found.append(np.stack(row, axis=1)[room <= capacity // 512])
    rows = np.sort(np.concatenate(found), axis=1)[:, ::-1]
    return np.unique(rows, axis=0)


def _fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative repeats whose lengths come nearest to ``counts``, by least squares."""
    flat = patterns.ravel()
    wanted = counts.astype(float).copy()
    wanted[0] = 0
    uses = np.bincount(flat, minlength=len(counts)).astype(float)
    step = 1.0 / max(1.0, patterns.shape[1] * uses[1:].max(initial=0))
    x = np.zeros(len(patterns))
    ahead, t = x, 1.0
    for _ in range(rounds):
        made = np.bincount(flat, weights=np.repeat(ahead, patterns.shape[1]), minlength=len(counts))
        off = made - wanted
        off[0] = 0
        after = np.maximum(0, ahead - step * off[patterns].sum(axis=1))
        t_after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = after + (t - 1) / t_after * (after - x)
        x, t = after, t_after
    return x


def plan(counts: np.ndarray, capacity: int) -> dict[str, np.ndarray]:
    """Ranges ``(length, low, high, base, each, offset)`` in order of length and low.

    The pieces of ``length`` numbered low to high - 1 go to sequences from ``base`` on,
    ``each`` of them to one, the first at ``offset``.
    """
    left = counts.astype(np.int64).copy()
    left[0] = 0
    used = np.zeros(len(left), dtype=np.int64)
    ranges: list[tuple[int, ...]] = []
    sequences = 0

    def place(pattern: list[tuple[int, int]], repeats: int):
        nonlocal sequences
        offset = 0
        for length, each in pattern:
            ranges.append((length, used[length], used[length] + repeats * each, sequences, each, offset))
            used[length] += repeats * each
            left[length] -= repeats * each
            offset += length * each
        sequences += repeats

    if left[capacity]:
        place([(capacity, 1)], int(left[capacity]))
    patterns = _patterns(left, capacity)
    if len(patterns):
        fitted = np.floor(_fit(patterns, left) + 1e-6).astype(np.int64)
        for i in np.argsort(-fitted, kind="stable"):
            if fitted[i] < 1:
                break
            lengths, each = np.unique(patterns[i][patterns[i] > 0], return_counts=True)
            repeats = min(int(fitted[i]), int((left[lengths] // each).min()))
            if repeats:
                place(list(zip(lengths[::-1].tolist(), each[::-1].tolist(), strict=True)), repeats)
    lengths = np.flatnonzero(left)
    while len(lengths):
        pattern, room, below = [], capacity, len(lengths)
        while below:
            below = int(np.searchsorted(lengths[:below], room, side="right"))
            if not below:
                break
            length = int(lengths[below - 1])
            each = min(int(left[length]), room // length)
            pattern.append((length, each))
            room -= each * length
            below -= 1
        place(pattern, min(int(left[length]) // each for length, each in pattern))
        lengths = lengths[left[lengths] > 0]
    table = np.array(sorted(ranges), dtype=np.int64).reshape(-1, 6)
    return dict(zip(("length", "low", "high", "base", "each", "offset"), table.T, strict=True))


def _placed(ranges):
    def run(batches):
        plan_ = ranges.value
        # numbers are below 2^48, so that length and number make one key
        keys = (plan_["length"] << 48) + plan_["low"]
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            at = np.searchsorted(keys, (length << 48) + number, side="right") - 1
            inside = number - plan_["low"][at]
            each = plan_["each"][at]
            columns = {c: batch.column(c) for c in batch.schema.names if c != "number"}
            columns["sequence_id"] = pa.array(plan_["base"][at] + inside // each)
            columns["offset"] = pa.array(plan_["offset"][at] + inside % each * length)
            yield pa.RecordBatch.from_pydict(columns)

    return run


def pack(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``pieces`` must be a stored table."""
    spark = pieces.sparkSession
    histogram = pieces.groupBy("length").count().toArrow()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    counts[histogram["length"].to_numpy()] = histogram["count"].to_numpy()
    ranges = spark.sparkContext.broadcast(plan(counts, capacity))
    groups = int(counts.max() // NUMBERED_TOGETHER) + 1
    order = ["doc_id", "piece", "start", "ids_crc32"]
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64(*order), F.lit(groups)))
    sizes = dealt.groupBy("length", "part").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("length", "part").orderBy(*order))
    numbered = (
        dealt.withColumn("rank", rank)
        .join(sizes, ["length", "part"])
        .select(*pieces.columns, (F.col("before") + F.col("rank") - 1).alias("number"))
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return numbered.mapInArrow(lean(_placed(ranges)), schema + ", sequence_id long, offset long")


def pack_documents(documents: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, **options) -> DataFrame:
    """Pieces of all documents with their places in sequences of ``capacity`` tokens."""
    pieces = token_pieces(documents, tokenizer_path, capacity=capacity, **options)
    return pack(written(pieces, "pieces"), capacity=capacity)
