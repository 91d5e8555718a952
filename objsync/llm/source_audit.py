"""How the sources of a language differ in their words.

1. A text's bytes go through one translate table, which lowers A-Z and blanks all that is
   no letter, and are split; a ``Counter`` of each document gives its terms with their
   number. Tasks add these up by language, source and term before they are shuffled.
2. A language keeps the terms that enough of its documents have. A group (language and
   source) has a smoothed probability for each kept term, a whole number of billionths;
   all terms that it lacks share one value, so only the counts above zero are stored.
3. Divergences between sources are sums over terms of absolute differences. Terms are
   dealt into slices by hash and sources into tiles; a slice of a tile is one row. Two
   tiles of a slice meet once, as matrices over the terms that either has; terms that
   neither has differ by the same amount and are added as a product at the end.

Defined results: null text, language or source is an empty one; rows that repeat an id are
separate documents; an occurring group without kept terms is still compared (its value is
0 where the language keeps none); a language with one source has no pairs; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import text_or_empty, written
from .words import BLOCK_BYTES, encoded

#: Documents of a language that a kept term must be in.
DOCUMENTS = 30
#: Added to each count, and the whole that probabilities are parts of.
ADDED = 5
WHOLE = 1_000_000_000
#: Terms of a group that are listed.
LISTED = 50
#: Kept terms of a slice, and sources of a tile (expected numbers).
SLICE = 4096
TILE = 64
#: Entries that a task adds up before it sends them on.
HELD = 200_000

_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: bytes) -> Counter:
    """The terms of a text and how often each occurs; a long text goes in parts cut at a blank."""
    found: Counter = Counter()
    at = 0
    while at < len(text):
        to = at + BLOCK_BYTES
        part = text[at:to].translate(_TABLE)
        while to < len(text) and part[-1:] != b" ":
            # a term goes on: up to the next blank, however far it is
            more = text[to : to + BLOCK_BYTES].translate(_TABLE)
            cut = more.find(b" ")
            cut = len(more) if cut < 0 else cut + 1
            part, to = part + more[:cut], to + cut
        found.update(part.split())
        at = to
    return found


def _count(batches):
    """Of what the task reads, by group and term: occurrences, and documents with the term."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def sums():
        groups = [(*group, term, n, docs[term]) for group, (seen, docs) in held.items() for term, n in seen.items()]
        lang, source, term, n, docs = zip(*groups, strict=True) if groups else ((), (), (), (), ())
        return pa.RecordBatch.from_pydict(
            {
                "lang": pa.array(lang, pa.string()),
                "source": pa.array(source, pa.string()),
                "term": pa.array(term, pa.binary()).cast(pa.string()),
                "n": pa.array(n, pa.int64()),
                "docs": pa.array(docs, pa.int64()),
            }
        )

    for batch in batches:
        columns = (batch.column("lang").to_pylist(), batch.column("source").to_pylist(), encoded(batch.column("text")))
        for lang, source, text in zip(*columns, strict=True):
            found = terms_of(text)
            seen, docs = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(seen)
            seen.update(found)
            docs.update(found.keys())
            size += len(seen)
            if size >= HELD:
                yield sums()
                held, size = {}, 0
    yield sums()


def _probability(n: Column, total: Column, terms: Column) -> Column:
    wide = "decimal(38,0)"
    share = (F.lit(WHOLE).cast("decimal(10,0)") * (n + ADDED).cast("decimal(28,0)")).cast(wide)
    return F.call_function("div", share, (total + ADDED * terms).cast(wide)) + 1


_TILES = "lang string, slice long, tile long, size long, sources array<string>, terms array<string>, at binary, p binary, base binary"


def _pack(batches):
    """Sorted entries as one row for each slice of a tile.

    An entry without a term stands for its group, with the value of the terms it lacks
    and the number of terms in the slice; those with a term follow it.
    """
    now, held = None, []

    def packed():
        t = pa.Table.from_batches(held).combine_chunks()
        own = t["term"].is_null().to_numpy()
        group = np.cumsum(own) - 1
        terms = t["term"].combine_chunks().filter(pa.array(~own)).dictionary_encode()
        at = np.stack([group[~own], terms.indices.to_numpy()]).astype("i4")
        p = t["p"].to_numpy()
        return pa.RecordBatch.from_pydict(
            {
                "lang": [now[0]],
                "slice": [now[1]],
                "tile": [now[2]],
                "size": [t["size"][0].as_py()],
                "sources": pa.array([t["source"].filter(pa.array(own)).to_pylist()], pa.list_(pa.string())),
                "terms": pa.array([terms.dictionary.to_pylist()], pa.list_(pa.string())),
                "at": [at.tobytes()],
                "p": [p[~own].tobytes()],
                "base": [p[own].tobytes()],
            }
        )

    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "slice", "tile")), strict=True))
        borders = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]] + [len(keys)]
        for a, b in zip(borders[:-1], borders[1:], strict=True):
            if keys[a] != now:
                if held:
                    yield packed()
                now, held = keys[a], []
            held.append(batch.slice(a, b - a))
    if held:
        yield packed()


def _matrix(row: dict, side: str, terms: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """What a group has for terms it lacks, and a row of probabilities for each group."""
    base = np.frombuffer(row["base" + side], "i8")
    group, term = np.frombuffer(row["at" + side], "i4").reshape(2, -1)
    column = np.array([terms[t] for t in row["terms" + side]], np.int64)
    p = np.repeat(base[:, None], len(terms), axis=1)
    p[group, column[term]] = np.frombuffer(row["p" + side], "i8")
    return base, p


def _compare(batches):
    """Differences over the terms of a slice, for each pair of sources of two tiles."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            terms = {t: k for k, t in enumerate(dict.fromkeys(row["terms"] + row["terms_b"]))}
            base, p = _matrix(row, "", terms)
            base_b, q = _matrix(row, "_b", terms)
            rest = row["size"] - len(terms)
            for a, source in enumerate(row["sources"]):
                later = a + 1 if row["tile"] == row["tile_b"] else 0
                n = len(base_b) - later
                if n:
                    differ = np.abs(q[later:] - p[a]).sum(axis=1) + rest * np.abs(base_b[later:] - base[a])
                    names = pa.array([source] * n, pa.string())
                    yield pa.RecordBatch.from_pydict(
                        {
                            "lang": pa.array([row["lang"]] * n, pa.string()),
                            "source": names,
                            "item": pa.array(row["sources_b"][later:], pa.string()),
                            "value": differ,
                        }
                    )


def divergence(
    documents: DataFrame,
    *,
    min_documents: int = DOCUMENTS,
    listed: int = LISTED,
    slice_terms: int = SLICE,
    tile: int = TILE,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: pairs of sources, and the terms a source prefers."""
    docs = documents.select(*(text_or_empty(c).alias(c) for c in ("lang", "source", "text")))
    counts = docs.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = written(counts, "terms")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept = written(kept.where(F.col("docs") >= min_documents).select("lang", "term", "lang_n"), "kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    counts = written(counts.drop("docs").join(kept, ["lang", "term"]), "counts")

    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0, ["total", "terms", "lang_total"])
    # sources of a language are numbered in order; a language without terms has one empty slice
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    base = F.when(F.col("terms") > 0, _probability(F.lit(0), F.col("total"), F.col("terms"))).otherwise(0)
    groups = groups.withColumn("tile", F.floor((place - 1) / tile)).withColumn("base", base)
    groups = written(groups.withColumn("slices", F.ceil(F.greatest("terms", F.lit(1)) / slice_terms)), "groups")
    slice_of = F.pmod(F.xxhash64("term"), F.col("slices")).alias("slice")
    mine = written(
        counts.join(groups, ["lang", "source"]).select(
            "lang",
            "source",
            "tile",
            slice_of,
            "term",
            _probability(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
            _probability(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
        ),
        "probabilities",
    )
    sizes = kept.join(groups.select("lang", "slices").distinct(), "lang").groupBy("lang", slice_of).agg(F.count("*").alias("size"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice")
    own = groups.select("lang", "source", "tile", every, "base").join(sizes, ["lang", "slice"], "left")
    own = own.select(
        "lang", "slice", "tile", "source", F.lit(None).cast("string").alias("term"), F.col("base").alias("p"), F.coalesce("size", F.lit(0)).alias("size")
    )
    entries = own.unionByName(mine.select("lang", "slice", "tile", "source", "term", "p", F.lit(0).cast("long").alias("size")))
    tiles = entries.repartition("lang", "slice", "tile").sortWithinPartitions(
        "lang", "slice", "tile", "source", F.col("term").asc_nulls_first()
    )
    tiles = written(tiles.mapInArrow(_pack, _TILES), "tiles")
    return _pairs(tiles).unionByName(_terms(mine, listed))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))


def _pairs(tiles: DataFrame) -> DataFrame:
    other = tiles.select("lang", "slice", *(F.col(c).alias(c + "_b") for c in tiles.columns if c not in ("lang", "slice", "size")))
    met = tiles.join(other, ["lang", "slice"]).where("tile <= tile_b")
    differ = met.mapInArrow(_compare, "lang string, source string, item string, value long")
    differ = differ.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    both = differ.select("lang", both.alias("of"), "value").select("lang", "of.source", "of.item", "value")
    return _ranked(both, "pair")


def _terms(mine: DataFrame, listed: int) -> DataFrame:
    more = mine.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(more, "term").where(F.col("rank") <= listed)
