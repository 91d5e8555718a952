"""Vector search and clustering, and source divergence, against brute force."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from objsync.llm import multi_index, source_audit, zone_clusters

SCHEMA = "vec_id long, embedding array<double>, rank string, cluster string"


def frame(spark, rows):
    """Rows of vectors with columns whose names clash with those of the results."""
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)


ODD = [
    (40, None),
    (60, []),
    (80, [0.0] * 8),
    (100, [1.0, None] + [0.5] * 6),
    (120, [float("nan")] * 8),
    (140, [float("inf")] + [0.0] * 7),
    (None, [2.0] * 8),
    (160, [1.0, 2.0, 3.0]),
    (161, [3.0, 2.0, 1.0]),
    (180, [5.0]),
    (181, [-1.0]),
]


def brute(rows, every, most):
    """The nearest of each query row, by scores added up in order."""
    held = [(r, i, np.array(v, float)) for r, (i, v) in enumerate(rows) if v and None not in v]
    held = [(r, i, v) for r, i, v in held if np.isfinite(v).all() and v.any()]
    out = []
    for r, i, v in held:
        if i is None or i % every:
            continue
        found = []
        for s, j, w in held:
            if s != r and len(w) == len(v):
                found.append((-float(np.cumsum(v * w)[-1]), j is None, j or 0, j))
        found.sort(key=lambda x: x[:3])
        out += [(i, k + 1, j, -score) for k, (score, _, _, j) in enumerate(found[:most])]
    return out


def random_rows(n, dims, seed):
    rng = np.random.default_rng(seed)
    return [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(n, dims)))]


def test_search_of_odd_vectors_is_exact_where_all_is_seen(spark):
    # equal vectors with and without equal ids, and a third of the rows the same
    rows = random_rows(60, 8, 1) + ODD + [(20, [1.0] * 8)] * 2 + [(200 + i, [1.0] * 8) for i in range(35)]
    got = multi_index.nearest(frame(spark, rows), neighbours=7, recall=1.0, piece=16)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 20, 7))
    assert multi_index.nearest(frame(spark, ODD[:3])).collect() == []
    assert multi_index.nearest(frame(spark, [])).collect() == []


def test_search_finds_most_neighbours_and_sees_less_where_there_is_structure(spark, monkeypatch):
    shares = []
    monkeypatch.setattr(
        multi_index, "_fit_share", lambda *a, f=multi_index._fit_share: shares.append(f(*a)) or shares[-1]
    )
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16)) * 4
    grouped = [(i, (centres[i % 30] + rng.normal(size=16) * 0.2).tolist()) for i in range(3000)]
    for rows in (random_rows(3000, 16, 2), grouped):
        got = {(q, v) for q, _, v, _ in multi_index.nearest(frame(spark, rows), piece=300).collect()}
        true = {(q, v) for q, _, v, _ in brute(rows, 20, 20)}
        assert len(got) == len(true) and len(got & true) >= 0.9 * len(true)
    assert shares[1] < shares[0] < 0.5


def test_cells_come_in_the_order_of_summed_distance():
    rng = np.random.default_rng(0)
    left, right = rng.normal(size=5), rng.normal(size=7)
    cells = list(multi_index._cells_by_distance(left, right, [1] * 35, 35))
    total = (left[:, None] + right).ravel()
    assert sorted(cells) == list(range(35)) and (np.diff(total[cells]) >= 0).all()
    assert len(list(multi_index._cells_by_distance(left, right, [2] * 35, 11))) == 6


def test_large_cells_are_split():
    index = multi_index.Index(2, (np.zeros((2, 1)), np.zeros((2, 1))), np.array([3, 50, 0, 4]))
    first, parts = index.layout(10)
    assert first.tolist() == [0, 1, 6, 6] and parts.tolist() == [1, 5, 1, 1]


def clusters_by_hand(rows, count, rounds, length):
    kept = []
    for i, v in rows:
        if v and len(v) == length and None not in v and np.isfinite(v).all():
            kept.append((i, [max(-(1 << 26), min(1 << 26, math.floor(64 * x))) for x in v]))
    firsts = sorted(kept, key=lambda r: hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest())
    centres = [v for _, v in firsts[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centres = [
            [sum(x) // len(members[k]) for x in zip(*members[k], strict=True)] if k in members else c
            for k, c in enumerate(centres)
        ]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, k in found:
        inertia[k] += d
    most = (1 << 63) - 1
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, k, d, min(inertia[k], most), min(sum(inertia.values()), most), sha[k]) for i, d, k in found]


@pytest.mark.parametrize("block", [3, 512])
def test_clusters_are_exact(spark, block):
    rows = random_rows(150, 8, 5) + ODD + [(700 + i, [0.25] * 8) for i in range(80)]
    rows += [(900, [-0.01] * 8)] * 2 + [(901, [1e300, -1e300, 1e9] + [0.0] * 5), (902, [3e5] * 8)]
    got = zone_clusters.clusters(frame(spark, rows), length=8, count=5, block=block).collect()
    key = repr
    assert sorted(map(tuple, got), key=key) == sorted(clusters_by_hand(rows, 5, 3, 8), key=key)
    few = [(7, [0.5] * 8), (8, [1.5] * 8)]
    got = zone_clusters.clusters(frame(spark, few), length=8, count=5).collect()
    assert sorted(map(tuple, got)) == sorted(clusters_by_hand(few, 5, 3, 8))
    assert zone_clusters.clusters(frame(spark, ODD), count=5).collect() == []


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (5, 1)])
def test_hilbert_neighbours_touch(dims, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = zone_clusters.hilbert_keys(cells, bits)
    order = sorted(range(len(cells)), key=lambda i: keys[i].tobytes())
    steps = np.abs(np.diff(cells[order], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_boxes_exclude_far_centroids_only():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-500, 500, size=(12, 4))
    for _ in range(50):
        vectors = rng.integers(-60, 60, size=(20, 4)) + rng.integers(-500, 500, size=4)
        low, high = vectors.min(axis=0), vectors.max(axis=0)
        some = zone_clusters.candidates(low, high, centroids)
        squares = ((vectors[:, None] - centroids) ** 2).sum(axis=2)
        of, distance = zone_clusters.assigned(vectors, low, high, centroids)
        assert of.tolist() == squares.argmin(axis=1).tolist() and distance.tolist() == squares.min(axis=1).tolist()
        assert set(of.tolist()) <= set(some.tolist())
    assert len(zone_clusters.candidates(np.zeros(4), np.ones(4), np.array([[0, 0, 0, 0], [90, 0, 0, 0]]))) == 1


TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
TEXTS = [
    ("en", "a", "One two, TWO three"),
    ("en", "b", "two one one été x1y " * 3),
    ("en", "c", None),
    ("en", "d", ""),
    ("en", None, "one two two"),
    (None, "a", "alone here"),
    (None, "b", "alone there"),
    ("de", "a", "einmal"),
    ("fr", "a", "un"),
    ("fr", "b", "deux"),
]


def divergence_by_hand(rows, least, listed):
    rows = [(lang or "", source or "", text or "") for lang, source, text in rows]
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for _, _, t in rows]
    found = [(lang, source, Counter(TERM.findall(t))) for (lang, source, _), t in zip(rows, lower, strict=True)]
    docs, whole, groups = Counter(), Counter(), defaultdict(Counter)
    for lang, source, c in found:
        groups[lang, source].update(c)
        for t, n in c.items():
            docs[lang, t] += 1
            whole[lang, t] += n
    out = []

    def p(n, total, v):
        return 1 + 10**9 * (n + 5) // (total + 5 * v)

    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least]
        v, total = len(kept), sum(whole[lang, t] for t in kept)
        mine = {
            s: {t: p(c[t], sum(c[u] for u in kept), v) for t in kept} for (x, s), c in groups.items() if x == lang
        }
        for s in mine:
            pairs = [(sum(abs(mine[s][t] - mine[o][t]) for t in kept), o) for o in mine if o != s]
            terms = []
            for t in kept:
                q = p(whole[lang, t], total, v)
                if groups[lang, s][t] and mine[s][t] > q:
                    terms.append((mine[s][t] - q, t))
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                ranked = [(lang, s, part, x, n, k + 1) for k, (n, x) in enumerate(items)]
                out += ranked if part == "pair" else ranked[:listed]
    return out


@pytest.mark.parametrize(("least", "slice_terms", "tile", "listed"), [(1, 2, 2, 50), (2, 1, 1, 1), (3, 4096, 64, 50)])
def test_divergence(spark, least, slice_terms, tile, listed):
    rows = TEXTS + [("en", "a", "word " * 400_000 + "é" * 1_200_000 + " last")] + TEXTS[:3]
    docs = spark.createDataFrame([(1, *r, 9) for r in rows], "doc_id int, lang string, source string, text string, rank int")
    got = source_audit.divergence(docs, min_documents=least, slice_terms=slice_terms, tile=tile, listed=listed)
    assert sorted(map(tuple, got.collect())) == sorted(divergence_by_hand(rows, least, listed))


def test_divergence_of_nothing(spark, empty):
    assert source_audit.divergence(empty.withColumn("lang", empty["source"])).collect() == []


@pytest.mark.parametrize("near", [-3, -1, 0, 1, 5])
def test_terms_across_the_parts_of_a_long_text(near):
    size = source_audit.BLOCK_BYTES
    text = ("ab " * size)[: size + near] + "é" * 9 + " Zz"
    assert source_audit.terms_of(text.encode()) == Counter(
        t.lower().encode() for t in TERM.findall(text)
    )
