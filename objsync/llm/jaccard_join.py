"""N-gram Jaccard join by grouped prefixes.

Documents are sets of word shingles. Shingles have one global order: those of common
lines and passages last, then those with a rare word first (a shingle is at most as
frequent as its rarest word), then by hash. Any order gives the same result; this one,
from counts over all documents, keeps common shingles out of prefixes. Two sets can only
reach the threshold if their prefixes in that order share a shingle.

1. Equal sets are one class; classes with equal prefixes and sizes are one group, found
   by map-side aggregation, so a large group of copies is one row from then on.
2. Prefix shingles of groups meet by shingle. Each group is paired with a few centres of
   its shingles, the first groups in some fixed orders, and each class with its group: a
   number of pairs in proportion to the rows. Those that share most of what they need are
   verified on whole sets and give a first partition.
3. Pairs that the first step left open are those between different components of that
   partition. Classes of both meet where their first common shingle may be: its places in
   the two orders leave room for what the threshold needs in common, which for the smaller
   set is half of the prefix only. All such pairs that share enough prefix shingles are
   verified on whole sets. Pairs inside
   a component are already connected and need no enumeration, however large it is.
4. Components over all verified links.

Shingles are compared by 64-bit hashes.

Defined results: null, empty or wordless texts have no shingles and are linked with
nothing; a text of fewer words than a shingle is one shingle of all its words; rows that
repeat an id are separate documents; a null id is never the smallest of a component
(null if it has no other); an empty table gives an empty result; further columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import bitmap, components, in_bitmap, lean, maybe_among, written
from .words import WHITE_FOLDED, Texts, mix, range_hashes, signed, text_blocks

SHINGLE = 5
#: Stands for a null id where a class needs a document that holds it.
NO_ID = -(1 << 63)
#: The threshold in hundredths.
SIMILARITY = 80
#: Counters of word hashes, a power of two; one byte each is sent to the tasks.
COUNTERS = 1 << 20
#: Shingles of one task that are counted at once, and the count that makes one common.
COUNTED_TOGETHER = 4_000_000
COMMON = 8
#: Each makes an order of equally good groups; the first group of a shingle is a centre.
CENTRES = [0] + [int(signed(mix(np.array([i], dtype=np.uint64)))[0]) for i in range(1, 6)]
#: Of the shingles that a pair needs in common, the share that its centre must have seen.
SEEN = 0.8


def _each_block(batches):
    for batch in batches:
        ids = batch.column("doc_id")
        for a, b, texts in text_blocks(batch.column("text")):
            yield ids.slice(a, b - a), Texts(texts, WHITE_FOLDED)


def _count(batches):
    """Counts of what the task reads: words by counter, and shingles that repeat in it."""
    counts = np.zeros(COUNTERS, dtype=np.int64)
    held = np.empty(COUNTED_TOGETHER, dtype=np.uint64)
    size = 0

    def repeated():
        # sorted in place: the buffer is as large as a task's shingles may be
        some = held[:size]
        some.sort()
        starts = np.flatnonzero(np.concatenate(([True], some[1:] != some[:-1])))
        n = np.diff(np.append(starts, size))
        many = n > 1
        return pa.RecordBatch.from_pydict(
            {"word": np.zeros(many.sum(), dtype=bool), "slot": signed(some[starts[many]]), "n": n[many]}
        )

    for _, texts in _each_block(batches):
        slot = (texts.hashes & np.uint64(COUNTERS - 1)).astype(np.int64)
        counts += np.bincount(slot, minlength=COUNTERS)
        grams = texts.grams(SHINGLE)[texts.gram_ok(SHINGLE)]
        while len(grams):
            part = grams[: COUNTED_TOGETHER - size]
            held[size : size + len(part)] = part
            size, grams = size + len(part), grams[len(part) :]
            if size == COUNTED_TOGETHER:
                yield repeated()
                size = 0
    if size:
        yield repeated()
    some = np.flatnonzero(counts)
    for a in range(0, len(some), 1 << 16):
        part = some[a : a + (1 << 16)]
        yield pa.RecordBatch.from_pydict(
            {"word": np.ones(len(part), dtype=bool), "slot": part, "n": counts[part]}
        )


class _Order:
    """The order of shingles: the counters' logarithms, and a bitmap of common shingles."""

    def __init__(self, docs: DataFrame):
        counts = written(
            docs.mapInArrow(lean(_count), "word boolean, slot long, n long").groupBy("word", "slot").agg(F.sum("n").alias("n")),
            "counts",
        )
        words = counts.where("word").toArrow()
        self.levels = np.zeros(COUNTERS, dtype=np.uint8)
        # six bits are left for the flag and the logarithm
        level = np.minimum(np.log2(np.maximum(words["n"].to_numpy(), 1)), 31)
        self.levels[words["slot"].to_numpy()] = level.astype(np.uint8)
        common = counts.where(~F.col("word") & (F.col("n") >= COMMON)).select("slot")
        self.common = bitmap(common, F.col("slot"))

    def keys(self, texts: Texts) -> np.ndarray:
        """Shingle hashes of all places, led by their rank."""
        grams = texts.grams(SHINGLE)
        of_word = self.levels[(texts.hashes & np.uint64(COUNTERS - 1)).astype(np.int64)]
        rank = of_word[: len(grams)].copy()
        for j in range(1, SHINGLE):
            np.minimum(rank, of_word[j : j + len(grams)], out=rank)
        rank |= in_bitmap(self.common, grams).astype(np.uint8) << 5
        return (rank.astype(np.uint64) << np.uint64(58)) | (grams >> np.uint64(6))


def _sets(texts: Texts, order: _Order):
    """For each text its shingles as sorted distinct keys."""
    keys = order.keys(texts)
    for d, n in enumerate(texts.counts.tolist()):
        at = texts.first[d]
        if n >= SHINGLE:
            yield np.unique(keys[at : at + n - SHINGLE + 1])
        elif n:
            yield range_hashes(texts.hashes[at : at + n], np.array([0]), np.array([n]))
        else:
            yield np.zeros(0, dtype=np.uint64)


def _hash_of(values: np.ndarray) -> int:
    return int(signed(range_hashes(values, np.array([0]), np.array([len(values)])))[0])


def _prefix_size(n: int) -> int:
    return n - (SIMILARITY * n + 99) // 100 + 1


def _emit_classes(order):
    def run(batches):
        for ids, texts in _each_block(batches):
            n, whole, head, prefix = [], [], [], []
            for keys in _sets(texts, order.value):
                n.append(len(keys))
                first = keys[: _prefix_size(len(keys))] if len(keys) else keys
                whole.append(_hash_of(keys))
                head.append(_hash_of(first))
                prefix.append(signed(first))
            sizes = np.fromiter((len(x) for x in prefix), dtype=np.int64, count=len(prefix))
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            flat = np.concatenate(prefix) if prefix else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": ids,
                    "n": pa.array(n, pa.int64()),
                    "class": pa.array(whole, pa.int64()),
                    "head": pa.array(head, pa.int64()),
                    "prefix": pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int64())),
                }
            )

    return run


def _holder(doc_id: np.ndarray, cls: np.ndarray) -> np.ndarray:
    return mix(mix(doc_id.astype(np.int64).view(np.uint64)) ^ cls.view(np.uint64))


def _holds(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    # two places for each holder, so that few others pass
    return in_bitmap(bits, h) & in_bitmap(bits, mix(h))


def _emit_sets(bits, order):
    """The whole sets of documents that may stand for a class in some pair."""

    def run(batches):
        for ids, texts in _each_block(batches):
            sets = list(_sets(texts, order.value))
            cls = np.array([_hash_of(s) for s in sets], dtype=np.int64)
            doc = ids.fill_null(NO_ID).to_numpy()
            keep = np.flatnonzero(_holds(bits.value, _holder(doc, cls))) if len(cls) else []
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(doc[keep], pa.int64()),
                    "class": pa.array(cls[keep], pa.int64()),
                    "grams": pa.array([signed(sets[i]) for i in keep], pa.list_(pa.int64())),
                }
            )

    return run


def _only(bits, column: str):
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(bits.value, batch.column(column).to_numpy())))

    return run


def _holder_column(batches):
    for batch in batches:
        h = _holder(batch.column("doc_id").to_numpy(), batch.column("class").to_numpy())
        yield pa.RecordBatch.from_pydict({"h": signed(np.concatenate((h, mix(h))))})


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, order) -> DataFrame:
    """Those of the class pairs ``(a, b)`` whose whole sets reach the threshold."""
    sc = docs.sparkSession.sparkContext
    pairs = written(pairs.select("a", "b").distinct(), "pairs")
    needed = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    needed = written(classes.join(needed, "class").select(F.col("least").alias("doc_id"), "class"), "needed")
    # others that pass have the set of their own class and meet no pair
    bits = sc.broadcast(bitmap(needed.mapInArrow(lean(_holder_column), "h long"), F.col("h"), 1 << 28))
    sets = docs.mapInArrow(lean(_emit_sets(bits, order)), "doc_id long, class long, grams array<long>")
    # both joins read one shuffle of the sets
    sets = sets.groupBy("class").agg(F.first("grams").alias("grams"))
    both = pairs.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b")
    common = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - common
    links = written(both.where(common * 100 >= union * SIMILARITY).select("a", "b"), "links")
    bits.destroy()
    return links


def _beyond(n: str) -> Column:
    """Shingles of a set after its prefix."""
    return F.floor((F.col(n) * SIMILARITY + 99) / 100) - 1


def _required(n_a: Column, n_b: Column) -> Column:
    """Shingles in common that two sets of these sizes need."""
    # of the union, which has n_a + n_b less the common ones
    return F.floor(((n_a + n_b) * SIMILARITY + 99 + SIMILARITY) / (100 + SIMILARITY))


def _open_pairs(held: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of different roots that the place of a common shingle leaves possible.

    ``held`` has rows of (shingle, its place i from 0, class, n, root). Two sets have at
    most as many shingles in common as follow their first common one in either order, and
    itself. As the smaller set needs at least what two sets of its size need, only its
    first shingles are joined.
    """
    small = held.where(F.col("n") - F.col("i") >= _required(F.col("n"), F.col("n")))
    small = small.toDF("shingle", "i_a", "a", "n_a", "root_a")
    large = held.toDF("shingle", "i_b", "b", "n_b", "root_b")
    left = F.least(F.col("n_a") - F.col("i_a"), F.col("n_b") - F.col("i_b"))
    met = small.join(large, "shingle").where(
        (F.col("root_a") != F.col("root_b"))
        & (F.struct("n_a", "a") < F.struct("n_b", "b"))
        & (F.col("n_a") * 100 >= F.col("n_b") * SIMILARITY)
        & (left >= _required(F.col("n_a"), F.col("n_b")))
    )
    return met.select("a", "b").distinct()


def _prefixes_of(wanted: DataFrame, groups: DataFrame) -> DataFrame:
    """``wanted`` with the prefix of its ``group``; a bitmap keeps others from the shuffle."""
    wanted = written(wanted, "wanted")
    among = maybe_among(wanted.sparkSession, wanted.select("group").distinct(), "group")("group")
    return wanted.join(groups.where(among), "group")


def _with_common(pairs: DataFrame, members: DataFrame, groups: DataFrame) -> DataFrame:
    """``pairs (a, b)`` with the number ``c`` of shingles that both prefixes have."""
    needed = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    prefixes = _prefixes_of(members.select("class", "group").join(needed, "class"), groups)
    prefixes = written(prefixes.select("class", "prefix"), "prefixes")
    both = pairs.join(prefixes.toDF("a", "left"), "a").join(prefixes.toDF("b", "right"), "b")
    return both.select("a", "b", F.size(F.array_intersect("left", "right")).alias("c"))


def _may_reach(pairs: DataFrame, classes: DataFrame, share: float) -> DataFrame:
    """Those of ``pairs (a, b, c)`` with ``share`` of the common prefix shingles that they need.

    Beyond the end of the prefix that ends first, two sets have at most as many
    shingles in common as follow it; ``c`` of those before are known to be common.
    """
    size = classes.select("class", "n")
    both = pairs.join(size.toDF("a", "n_a"), "a").join(size.toDF("b", "n_b"), "b")
    required = _required(F.col("n_a"), F.col("n_b"))
    return both.where(
        (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * SIMILARITY)
        & (F.col("c") >= (required - F.greatest(_beyond("n_a"), _beyond("n_b"))) * share)
    )


def similar_documents(
    documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``documents``."""
    sc = documents.sparkSession.sparkContext
    docs = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    order = sc.broadcast(_Order(docs))
    rows = written(
        docs.mapInArrow(lean(_emit_classes(order)), "doc_id long, n long, class long, head long, prefix array<long>"),
        "shingled",
    )
    full = rows.where("n > 0")
    classes = written(
        full.groupBy("class", "n", "head").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("least")),
        "classes",
    )
    heads = classes.groupBy("n", "head").agg(F.min("class").alias("group"))
    members = written(classes.join(heads, ["n", "head"]).select("class", "n", "group"), "members")
    groups = written(
        full.groupBy("n", "head").agg(F.min("class").alias("group"), F.first("prefix").alias("prefix")),
        "groups",
    ).select("group", "prefix")
    placed = groups.select("group", F.posexplode("prefix").alias("i", "shingle"))
    shared = (
        placed.groupBy("shingle")
        .agg(F.min("group").alias("first"), F.max("group").alias("last"), F.count("*").alias("held_by"))
        .where("first < last")
        .select("shingle", "first", "last", F.expr("held_by > 2").alias("several"))
    )
    shared = written(shared, "shared")
    bits = sc.broadcast(bitmap(shared, F.col("shingle"), 1 << 28))
    maybe = placed.mapInArrow(lean(_only(bits, "shingle")), "group long, i int, shingle long")
    meets = written(maybe.join(shared.select("shingle", "several"), "shingle"), "meets")
    bits.destroy()

    # a group that shares nearly all of its prefix is near what others are copies of
    alone = meets.groupBy("group").agg(F.count("*").alias("shared")).join(
        members.where("class = group").select("group", "n"), "group"
    )
    alone = alone.select("group", (F.col("n") - _beyond("n") - F.col("shared")).alias("alone"))
    several = meets.where("several").select("group", "shingle")
    ranked = several.join(alone, "group")
    firsts = [
        F.min_by("group", F.struct("alone", F.col("group").bitwiseXOR(F.lit(x)))) for x in CENTRES
    ]
    centres = ranked.groupBy("shingle").agg(F.array_distinct(F.array(*firsts)).alias("centres"))
    stars = several.join(centres, "shingle").select("group", "centres", F.explode("centres").alias("centre"))
    # two centres of a shingle meet once; where only two groups have it, there is one pair
    stars = stars.where((F.col("group") < F.col("centre")) | ~F.array_contains("centres", F.col("group")))
    stars = stars.select(F.least("group", "centre").alias("a"), F.greatest("group", "centre").alias("b"))
    stars = stars.union(shared.where("not several").select("first", "last"))
    stars = stars.groupBy("a", "b").agg(F.count("*").alias("c"))
    inside = members.where("class <> group").select(F.col("group").alias("a"), F.col("class").alias("b"))
    # pairs left out here are seen again in the second step
    near = _may_reach(stars, classes, SEEN).select("a", "b")
    inside = inside.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = _verified(near.union(inside), docs, classes, order)
    roots = components(links)

    rooted = written(
        members.join(roots.withColumnRenamed("node", "class"), "class", "left").select(
            "class", "n", "group", F.coalesce("root", "class").alias("root")
        ),
        "rooted",
    )
    # shingles of groups by class; a group with classes in several components meets itself
    mixed = rooted.groupBy("group").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    own = _prefixes_of(mixed.where("low < high").select("group"), groups)
    own = own.select("group", F.posexplode("prefix").alias("i", "shingle"))
    whole = rooted.join(mixed.where("low = high").select("group"), "group")
    held = meets.select("group", "i", "shingle").join(whole, "group").unionByName(own.join(rooted, "group"))
    open_ = (
        held.groupBy("shingle")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low < high")
        .select("shingle")
    )
    held = written(held.join(open_, "shingle").select("shingle", "i", "class", "n", "root"), "open")
    pairs = written(_open_pairs(held), "met")
    pairs = _may_reach(_with_common(pairs, members, groups), classes, 1.0)
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _verified(pairs, docs, classes, order)
    order.destroy()
    # what the first step joined is given as stars, which need no further rounds
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))

    labelled = rows.select("doc_id", "n", "class").join(roots.withColumnRenamed("node", "class"), "class", "left")
    labelled = labelled.withColumn("root", F.coalesce("root", "class"))
    smallest = labelled.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    return labelled.join(smallest, "root", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"),
    )
