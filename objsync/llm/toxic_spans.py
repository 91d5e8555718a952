"""Toxic spans by a linear-chain conditional random field over words.

Labels are of documents, so tokens are labelled first: features of words (the word and
its prefixes) that labelled toxic documents have and clean ones do not, by a
log-likelihood ratio over distinct texts, mark the toxic tokens of toxic documents. Near
copies share one vote; if that leaves most toxic texts without a marker, as when they are
one group of copies, features that texts vote for singly are added. On
these tokens a CRF with two tags is fitted: weights of marker features, a bias, and
transitions. Forward-backward marginals tag tokens; a document's score is a logistic of
the expected number of its toxic tokens beyond what a clean text of its length gathers,
and their places are the offending offsets.

Fitting uses ``SAMPLE`` distinct labelled texts at most, and ``FITTED`` of these of each
label for the gradients, all of them whole. For the gradients of the field a text is
passed in stretches of ``STRETCH`` words, so only transitions between two stretches do not
count; the score is fitted, and every text scored, without stretches.

Defined results: a null or empty text has no tokens and the score of none; without
toxic labels nothing is toxic; labels that are null do not count; a document labelled
both ways is toxic; repeated rows are scored alike; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import crc_fold, give_back, lean, written
from .words import ALNUM_FOLDED, Texts, blocks, encoded, mix, signed, text_blocks

#: Labelled texts that features are counted on, at most (about), a third of them toxic.
SAMPLE = 6000
#: Texts of each label that the gradients are computed on, at most.
FITTED = 150
#: Words that are passed in one go for the gradients.
STRETCH = 3000
PREFIXES = range(3, 8)
#: Log-likelihood ratio from which a feature is a marker, and clean texts per toxic one.
RATIO, CLEAN = 24.0, 0.02
#: Minima of a text's sketch, and the share of equal ones from which texts are near copies.
SKETCH, ALIKE = 32, 0.4
THRESHOLD = 0.7


def _features(texts: Texts) -> np.ndarray:
    """Feature hashes, a row for each prefix length and one for the whole words; 0: none."""
    blob = np.frombuffer(texts.blob + b"\0" * 8, dtype=np.uint8)
    size = texts.ends - texts.starts
    out = np.zeros((len(PREFIXES) + 1, len(size)), dtype=np.uint64)
    held = np.zeros(len(size), dtype=np.uint64)
    for j in range(max(PREFIXES)):
        held = held * np.uint64(257) + ALNUM_FOLDED.code[blob[texts.starts + j]] + np.uint64(1)
        if j + 1 in PREFIXES:
            row = j + 1 - PREFIXES[0]
            out[row] = np.where(size > j + 1, mix(held ^ np.uint64((j + 1) << 60)), np.uint64(0))
    out[-1] = texts.hashes
    return out


def _sketches(batches):
    """``(id, sketch)`` of texts with words: least hashes of their runs of three words."""
    seeds = mix(np.arange(1, SKETCH + 1, dtype=np.uint64))[:, None]
    for batch in batches:
        data = [t or b"" for t in encoded(batch.column("text"))]
        ids, sketches = [], []
        for a, b in blocks(data):
            texts = Texts(data[a:b], ALNUM_FOLDED)
            for d in np.flatnonzero(texts.counts).tolist():
                h = texts.hashes[texts.first[d] : texts.first[d + 1]]
                if len(h) > 2:
                    h = mix(mix(mix(h[:-2]) + h[1:-1]) + h[2:])
                low = np.full(SKETCH, np.iinfo(np.uint64).max, dtype=np.uint64)
                for at in range(0, len(h), 1 << 14):
                    low = np.minimum(low, mix(h[at : at + (1 << 14)][None] ^ seeds).min(axis=1))
                ids.append(batch.column("id")[a + d].as_py())
                sketches.append(low.tobytes())
        yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "sketch": pa.array(sketches, pa.binary())})


def copy_groups(sketches: np.ndarray) -> np.ndarray:
    """A number for each row; near copies, by two equal minima and a look at all, share it."""
    n = len(sketches)
    label = np.arange(n)
    edges = []
    for j in range(0, SKETCH if n else 0, 2):
        order = np.lexsort((sketches[:, j + 1], sketches[:, j]))
        key = sketches[order, j : j + 2]
        new = np.append(True, (key[1:] != key[:-1]).any(axis=1))
        head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        alike = (sketches[order] == sketches[head]).mean(axis=1) >= ALIKE
        edges.append(np.stack((order[alike], head[alike])))
    while n:
        a, b = np.concatenate(edges, axis=1)
        after = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        after = after[after]
        if (after == label).all():
            break
        label = after
    return label


def _votes(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids of the sampled texts with words and the vote of each: one for a group of near copies."""
    got = rows.mapInArrow(lean(_sketches), "id long, sketch binary").join(rows.select("id", "toxic"), "id").toArrow()
    ids = got["id"].to_numpy()
    sketches = np.frombuffer(b"".join(got["sketch"].to_pylist()), dtype=np.uint64).reshape(-1, SKETCH)
    both = copy_groups(sketches) * 2 + got["toxic"].to_numpy()
    _, group, size = np.unique(both, return_inverse=True, return_counts=True)
    order = np.argsort(ids)
    return ids[order], (1 / size[group])[order]


def _emit_features(votes):
    def run(batches):
        ids, vote = votes.value
        for batch in batches:
            data = [t or b"" for t in encoded(batch.column("text"))]
            toxic = batch.column("toxic").to_numpy()
            at = np.searchsorted(ids, batch.column("id").to_numpy())
            for a, b in blocks(data):
                texts = Texts(data[a:b], ALNUM_FOLDED)
                features = _features(texts)
                for d in np.flatnonzero(texts.counts).tolist():
                    own = np.unique(features[:, texts.first[d] : texts.first[d + 1]])
                    own = own[own > 0]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "feature": signed(own),
                            "toxic": np.full(len(own), toxic[a + d], dtype=np.int32),
                            "vote": np.full(len(own), vote[at[a + d]]),
                        }
                    )

    return run


def _few(texts: DataFrame, sample: int) -> DataFrame:
    """Rows of distinct texts ``(id, toxic)`` drawn by the id, a hash: a third toxic as far as there are."""
    sizes = {int(r["toxic"]): r["count"] for r in texts.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, sample / 3 / max(1, sizes.get(1, 0))).otherwise(
        sample * 2 / 3 / max(1, sizes.get(0, 0))
    )
    return texts.where(F.pmod("id", F.lit(1_000_000)) < share * 1_000_000)


def _sampled(labelled: DataFrame, sample: int) -> DataFrame:
    texts = labelled.groupBy("text").agg(F.max("toxic").cast("int").alias("toxic"))
    return _few(texts.withColumn("id", F.xxhash64("text")), sample)


class Tagger:
    """Markers with weights, bias and transitions of the field; logistic of the score."""

    def __init__(self, markers: np.ndarray):
        self.markers = np.sort(markers)
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(self.markers & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.weights = np.full(len(markers), 2.0)
        self.bias = -3.0
        self.moves = np.zeros((2, 2))
        self.slope, self.base = 2.0, -1.0
        self.stray = 0.0  # expected toxic tokens for each word of clean texts

    def found(self, texts: Texts):
        """Words with markers, and which: (marker, word) pairs."""
        features = _features(texts)
        row, word = np.nonzero(self.maybe[(features & np.uint64(0xFFFF)).astype(np.int64)])
        value = features[row, word]
        at = np.searchsorted(self.markers, value)
        same = self.markers[np.minimum(at, len(self.markers) - 1)] == value if len(self.markers) else at < 0
        return at[same], word[same]

    def emissions(self, n: int, pairs) -> np.ndarray:
        marker, word = pairs
        return self.bias + np.bincount(word, weights=self.weights[marker], minlength=n)

    def marginals(self, emission: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of the toxic tag for each word of some texts (in ``first`` order)."""
        return self._passes(emission, first)[0]

    def _passes(self, emission: np.ndarray, first: np.ndarray):
        """Log odds of the toxic tag, passed forwards and backwards, texts side by side."""
        counts = np.diff(first)
        order = np.argsort(-counts, kind="stable")
        begin, counts = first[:-1][order], counts[order]
        forward, backward = np.zeros(len(emission)), np.zeros(len(emission))
        (m00, m01), (m10, m11) = self.moves
        last = np.zeros(len(order))
        longest = int(counts[0]) if len(counts) else 0
        live = np.searchsorted(-counts, -np.arange(longest), side="left")
        for t in range(longest):
            n = live[t]
            r = last[:n]
            if t:
                r = np.logaddexp(m01, m11 + r) - np.logaddexp(m00, m10 + r)
            r = r + emission[begin[:n] + t]
            forward[begin[:n] + t] = r
            last[:n] = r
        last[:] = 0
        for t in range(longest - 1, 0, -1):  # what the words after say about the one before
            n = live[t]
            r = last[:n] + emission[begin[:n] + t]
            r = np.logaddexp(m10, m11 + r) - np.logaddexp(m00, m01 + r)
            backward[begin[:n] + t - 1] = r
            last[:n] = r
        return 1 / (1 + np.exp(-np.clip(forward + backward, -50, 50))), forward, backward

    def fit_field(self, texts: Texts, toxic: np.ndarray, rounds: int = 60) -> None:
        """Gradient steps on the likelihood of the tokens' tags."""
        pairs = self.found(texts)
        n = len(texts.hashes)
        owner = texts.owner()
        tags = np.zeros(n)
        tags[pairs[1][toxic[owner[pairs[1]]] == 1]] = 1
        inner = np.ones(n, dtype=bool)
        first = np.concatenate([np.arange(a, b, STRETCH) for a, b in zip(texts.first[:-1], texts.first[1:], strict=True)] + [[n]])
        inner[first[:-1].astype(np.int64)] = False  # words that follow one
        inner = np.flatnonzero(inner)
        uses = np.maximum(1, np.bincount(pairs[0], minlength=len(self.weights)))
        seen = np.zeros((2, 2))
        np.add.at(seen, (tags[inner - 1].astype(int), tags[inner].astype(int)), 1)
        for _ in range(rounds):
            emission = self.emissions(n, pairs)
            p, forward, backward = self._passes(emission, first)
            off = tags - p
            self.weights += 2.0 * np.bincount(pairs[0], weights=off[pairs[1]], minlength=len(uses)) / uses
            self.weights *= 0.999
            self.bias += 2.0 * off.sum() / max(1.0, tags.sum() + p.sum())
            # expected transitions from the passes
            a, b = forward[inner - 1], backward[inner] + emission[inner]
            joint = np.exp(
                np.stack([np.zeros(len(a)), b, a, a + b]) + self.moves.reshape(4, 1)
                - np.max(np.stack([np.zeros(len(a)), b, a, a + b]), axis=0)
            )
            expected = (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
            self.moves += 0.5 * (seen - expected) / (seen + expected + 10)
            self.moves -= self.moves[0, 0]

    def _feature(self, counts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The logarithm of expected toxic tokens less those that a clean text so long may have."""
        stray = self.stray * words
        return np.log(np.maximum(counts - stray - 2 * np.sqrt(stray), 0) + 0.05)

    def fit_score(self, counts: np.ndarray, words: np.ndarray, toxic: np.ndarray, rounds: int = 500) -> None:
        """A logistic of the feature of expected toxic tokens, both labels weighing alike."""
        z = self._feature(counts, words)
        weight = np.where(toxic == 1, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (1 - toxic).sum()))
        for _ in range(rounds):
            off = weight * (toxic - 1 / (1 + np.exp(-(self.slope * z + self.base))))
            self.slope = max(0.5, self.slope + 0.5 * (off * z).sum() - 1e-4 * self.slope)
            self.base += 0.5 * off.sum() - 1e-4 * self.base

    def score(self, counts: np.ndarray, words: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self._feature(counts, words) + self.base)))

    def tag(self, texts: Texts):
        """Toxic words and, for each text, their expected number."""
        pairs = self.found(texts)
        some = np.unique(texts.owner()[pairs[1]]) if len(pairs[1]) else np.zeros(0, np.int64)
        expected = np.zeros(len(texts.counts))
        words: list[np.ndarray] = []
        if len(some):
            # a text without markers has no word above one half, as bias is below zero
            emission = self.emissions(len(texts.hashes), pairs)
            counts = texts.counts[some]
            at = np.concatenate([np.arange(texts.first[d], texts.first[d + 1]) for d in some])
            p = self.marginals(emission[at], np.append(0, np.cumsum(counts)))
            hit = np.flatnonzero(p > 0.5)
            owner = np.repeat(some, counts)[hit]
            expected += np.bincount(owner, weights=p[hit], minlength=len(expected))
            words.append(at[hit])
        return (np.concatenate(words) if words else np.zeros(0, np.int64)), expected


def _covered(tagger):
    """How many texts have a marker."""

    def run(batches):
        for batch in batches:
            data = [t or b"" for t in encoded(batch.column("text"))]
            n = 0
            for a, b in blocks(data):
                texts = Texts(data[a:b], ALNUM_FOLDED)
                n += len(np.unique(texts.owner()[tagger.value.found(texts)[1]]))
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return run


def _markers(rows: DataFrame) -> np.ndarray:
    """Features that toxic texts have and clean ones do not, of ``(text, toxic, id)`` rows."""
    context = rows.sparkSession.sparkContext
    ids, vote = _votes(rows)
    toxic = rows.where("toxic = 1").select("id").toArrow()["id"].to_numpy()
    hot = np.isin(ids, toxic)
    if not hot.any():
        return np.zeros(0, np.uint64)
    one = F.col("toxic") == 1
    sums = {"k1": F.when(one, F.col("vote")), "k0": F.when(~one, F.col("vote")), "t1": F.when(one, 1.0), "t0": F.when(~one, 1.0)}
    counts = rows.mapInArrow(lean(_emit_features(context.broadcast((ids, vote)))), "feature long, toxic int, vote double")
    counts = counts.groupBy("feature").agg(*[F.coalesce(F.sum(v), F.lit(0.0)).alias(k) for k, v in sums.items()])

    def marks(k1: str, k0: str, n1: float, n0: float):
        k1, k0 = F.col(k1), F.col(k0)
        share, both = n1 / (n1 + n0), k1 + k0

        def part(k, p: float):
            return F.when(k > 0, k * F.log(k / (both * max(p, 1e-9)))).otherwise(0.0)

        ratio = 2 * (part(k1, share) + part(k0, 1 - share))
        return (ratio >= RATIO) & (k0 <= CLEAN * k1) & (k1 > both * share)

    by_group = marks("k1", "k0", float(vote[hot].sum()), float(vote[~hot].sum()))
    by_text = marks("t1", "t0", float(hot.sum()), float((~hot).sum()))
    got = counts.select("feature", by_group.alias("group")).where(by_group | by_text).toArrow()
    every = got["feature"].to_numpy().view(np.uint64)
    some = every[got["group"].to_numpy()]
    shared = context.broadcast(Tagger(some))
    n = rows.where("toxic = 1").mapInArrow(lean(_covered(shared)), "n long").agg(F.sum("n")).first()[0] or 0
    return some if 2 * n >= hot.sum() else every


def _strays(tagger):
    """Expected toxic tokens and words of clean texts."""

    def run(batches):
        for batch in batches:
            for a, b, part in text_blocks(batch.column("text")):
                texts = Texts(part, ALNUM_FOLDED)
                expected = float(tagger.value.tag(texts)[1].sum())
                yield pa.RecordBatch.from_pydict({"expected": [expected], "words": [float(texts.counts.sum())]})

    return run


def fit(labelled: DataFrame, sample: int = SAMPLE, fitted: int = FITTED) -> Tagger:
    """A tagger from rows of ``text`` and ``toxic``; those with ``id`` are drawn already."""
    if "id" not in labelled.columns:
        labelled = _sampled(labelled.where("text is not null and toxic is not null"), sample)
    rows = written(labelled.select("id", "text", "toxic"), "labelled")
    markers = _markers(rows)
    tagger = Tagger(markers)
    some = rows.orderBy("id")
    few = some.where("toxic = 1").limit(fitted).unionByName(some.where("toxic = 0").limit(fitted)).toArrow()
    if len(markers) and len(few):
        toxic = few["toxic"].to_numpy().astype(float)
        texts = Texts(encoded(few["text"]), ALNUM_FOLDED)
        tagger.fit_field(texts, toxic)
        tagger.bias = min(tagger.bias, -0.1)
        shared = labelled.sparkSession.sparkContext.broadcast(tagger)
        clean = rows.where("toxic = 0").mapInArrow(lean(_strays(shared)), "expected double, words double")
        expected, words = clean.agg(F.sum("expected"), F.sum("words")).first()
        tagger.stray = (expected or 0.0) / max(1.0, words or 0.0)
        tagger.fit_score(tagger.tag(texts)[1], texts.counts, toxic)
    return tagger


def _scored(tagger):
    def run(batches):
        for batch in batches:
            for a, b, part in text_blocks(batch.column("text")):
                texts = Texts(part, ALNUM_FOLDED)
                words, expected = tagger.value.tag(texts)
                owner = np.searchsorted(texts.first, words, side="right") - 1
                # code points: bytes that do not continue a character
                blob = np.frombuffer(texts.blob, dtype=np.uint8)
                places: list[list[int]] = [[] for _ in range(b - a)]
                for d in np.unique(owner).tolist():
                    own = words[owner == d]
                    begin = texts.begin[d]
                    point = np.append(0, np.cumsum((blob[begin : texts.ends[own[-1]]] & 0xC0) != 0x80))
                    both = np.stack((point[texts.starts[own] - begin], point[texts.ends[own] - begin]), axis=1)
                    places[d] = both.ravel().tolist()
                out = {c: batch.column(c).slice(a, b - a) for c in batch.schema.names if c != "text"}
                out["score"] = pa.array(tagger.value.score(expected, texts.counts))
                out["offsets"] = pa.array(places, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    return run


def labelled_texts(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Distinct texts with labels, about ``sample`` of them, without the held-out third.

    They are drawn by ids and hashes alone, and one document of each is then read for its
    text; the drawn ids are bounded by the sample.
    """
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    learned = documents.where((crc_fold() != 1) & F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("id"), "text")
    texts = learned.select("doc_id", "id").join(marks, "doc_id").groupBy("id")
    texts = written(texts.agg(F.max("toxic").cast("int").alias("toxic"), F.min("doc_id").alias("doc_id")), "marked")
    drawn = F.broadcast(_few(texts, sample))
    return learned.join(drawn, ["doc_id", "id"]).dropDuplicates(["id"]).select("id", "text", "toxic")


def score_documents(documents: DataFrame, tagger: Tagger) -> DataFrame:
    """``(doc_id, held_out, score, predicted, offsets)`` for every row of ``documents``.

    ``offsets`` holds start and end of each toxic word in turn, in code points.
    """
    shared = documents.sparkSession.sparkContext.broadcast(tagger)
    held = F.coalesce(crc_fold() == 1, F.lit(False)).alias("held_out")
    scored = documents.select("doc_id", "text", held).mapInArrow(
        lean(_scored(shared)), "doc_id long, held_out boolean, score double, offsets array<long>"
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(documents: DataFrame, tagger: Tagger) -> DataFrame:
    """``documents`` less those predicted to be toxic, columns as they are.

    Texts go to Python and only a flag comes back.
    """
    shared = documents.sparkSession.sparkContext.broadcast(tagger)

    @F.arrow_udf("boolean")
    def clean(column: pa.Array) -> pa.Array:
        keep = np.zeros(len(column), dtype=bool)
        for a, b, part in text_blocks(column):
            texts = Texts(part, ALNUM_FOLDED)
            keep[a:b] = shared.value.score(shared.value.tag(texts)[1], texts.counts) < THRESHOLD
        give_back()  # such a column has no end of its own
        return pa.array(keep)

    return documents.where(clean("text"))
