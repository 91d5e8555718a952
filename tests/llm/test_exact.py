"""Operators with exact results against brute force, on rows of every awkward kind."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest

from objsync.llm import decontamination, host_rules, jaccard_join, packing, secret_scan, substring_dedup
from objsync.llm.fm_index import FMIndex
from objsync.llm.queries import tokenizer_path
from objsync.llm.shared import components

from .conftest import ROWS

WHITE = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def same(got, expected):
    key = repr
    return sorted(map(tuple, got), key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("seed", range(8))
def test_fm_index_finds_and_locates_all(seed):
    rng = np.random.default_rng(seed)
    seq = np.tile(rng.integers(1, rng.integers(3, 12), rng.integers(1, 120)), 1 + seed % 3)
    index = FMIndex(seq, int(seq.max()) + 1, sample=4)
    size = int(rng.integers(1, 5))
    patterns = np.array([seq[i : i + size] for i in range(max(1, len(seq) - size + 1)) if i + size <= len(seq)])
    for pattern, low, high in zip(patterns, *index.search(patterns), strict=True):
        places = [i for i in range(len(seq) - size + 1) if (seq[i : i + size] == pattern).all()]
        assert sorted(index.locate(np.arange(low, high))) == places


def test_substring_dedup(documents, empty):
    words = [(i, WHITE.findall(t or "")) for i, t in ROWS]
    first = {}
    for i, w in words:
        for j in range(len(w) - 12) if i is not None else ():
            key = tuple(w[j : j + 13])
            first[key] = min(i, first.get(key, i))
    expected = []
    for i, w in words:
        gone = set()
        for j in range(len(w) - 12) if i is not None else ():
            if first[tuple(w[j : j + 13])] < i:
                gone |= set(range(j, j + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        expected.append((i, len(w), len(gone), sha(kept)))
    assert same(substring_dedup.dedup_digest(documents).collect(), expected)
    assert substring_dedup.dedup_digest(empty).collect() == []


@pytest.mark.parametrize("block_words", [3, 200_000])
def test_decontamination(spark, documents, empty, block_words):
    items = [(1, "brown fox jumps over the lazy dog near the old river bank"), (2, "TWO words"), (3, None), (4, " "), (2, "two words")]
    items += [(None, "noon today")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for item, text in items:
        w = ALNUM.findall(lower(text))
        n = min(10, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[j : j + n]), set()).add(item)
    expected = []
    for i, text in ROWS:
        w, hit, found = ALNUM.findall(lower(text)), set(), set()
        for window, ids in windows.items():
            for j in range(len(w) - len(window) + 1):
                if tuple(w[j : j + len(window)]) == window:
                    hit |= set(range(j, j + len(window)))
                    found |= {str(x) for x in ids if x is not None}
        expected.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    marked = decontamination.mark_passages(documents, bench, block_words=block_words)
    assert same(decontamination.passage_digest(marked).collect(), expected)
    left = decontamination.decontaminate(documents, bench, block_words=block_words)
    assert left.columns == [c for c in documents.columns if c != "n_words"] or left.columns == documents.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[7] == "" and texts[4] is None and texts[9] == "x " * 300
    assert decontamination.mark_passages(empty, bench).collect() == []
    assert not [r for r in decontamination.mark_passages(documents, bench.where("false")).collect() if r.hit_items]


def test_jaccard_join(documents, empty):
    sets = []
    for _, t in ROWS:
        w = WHITE.findall(lower(t))
        sets.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    reach = [{i} for i in range(len(ROWS))]
    for _ in ROWS:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    reach[i] |= reach[j]
    expected = []
    for (i, _), s, others in zip(ROWS, sets, reach, strict=True):
        ids = [ROWS[k][0] for k in others if ROWS[k][0] is not None]
        expected.append((i, len(s), (min(ids) if ids else None) if s else i))
    assert same(jaccard_join.similar_documents(documents).collect(), expected)
    assert jaccard_join.similar_documents(empty).collect() == []


def _near_copies():
    """Groups of edited copies, and texts with equal prefixes of which only some are linked."""
    rng = np.random.default_rng(5)
    common = [f"c{i}" for i in range(16)]
    texts = [" ".join(rng.choice(common, 30)) for _ in range(40)]
    # rare words first, then common ones: the prefixes are equal, the rest is not
    for _ in range(6):
        rest = list(rng.choice(common[4:], 13))
        texts += [" ".join([f"rare{i}" for i in range(6)] + common[:4] + rest + [last]) for last in common[4:8]]
    for g in range(8):
        words = [f"g{g}w{i}" for i in range(60)]
        for _ in range(12):
            edited = list(words)
            for at in rng.integers(0, 60, rng.integers(0, 4)):
                edited[at] = f"e{rng.integers(0, 3)}"
            texts.append(" ".join(edited[: rng.integers(52, 61)]))
    return [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts, strict=True)]


def test_jaccard_join_of_near_copies(spark):
    rows = _near_copies()
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    expected = [(i, len(s), root[i]) for i, s in sets.items()]
    assert 3 < len({r for r in root.values() if list(root.values()).count(r) > 1})
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert same(jaccard_join.similar_documents(docs).collect(), expected)


def test_components(spark):
    edges = [(5, 4), (4, 3), (9, 8), (3, 9), (20, 21), (7, 7)]
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(5, 3), (4, 3), (3, 3), (9, 3), (8, 3), (20, 20), (21, 20)}


def test_packing(documents, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    expected = []
    for i, t in ROWS:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4")
            expected.append((i, n, at, len(part), zlib.crc32(part.tobytes())))
    rows = packing.pack_documents(documents, tokenizer_path()).collect()
    assert same([tuple(r)[:5] for r in rows], expected)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack_documents(empty, tokenizer_path()).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_whole_and_tight(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(1 + rng.gamma(1.5, 60 * (1 + seed), 20_000).astype(int), 1024)
    counts = np.bincount(lengths, minlength=1025)
    ranges = packing.plan(counts, 1024)
    placed = np.bincount(ranges["length"], weights=ranges["high"] - ranges["low"], minlength=1025)
    assert (placed == counts).all()
    sequences = int((ranges["base"] + (ranges["high"] - ranges["low"]) // ranges["each"]).max())
    assert sequences <= 1.01 * lengths.sum() / 1024 + 1


def test_secrets(documents, empty):
    assign = re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    found = secret_scan.secrets_digest(secret_scan.find_secrets(documents)).collect()
    expected = []
    for i, t in ROWS:
        t = t or ""
        spans = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(t) if len(m[2]) > 7]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) > 15]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) > 31]
        text = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))
        kinds = [s[2] for s in spans]
        expected.append((i, *(kinds.count(k) for k in ("assign", "access", "hex")), sha(text), text))
    assert same(found, expected)
    assert secret_scan.find_secrets(empty).collect() == []
    masked = {r.doc_id: r.text for r in secret_scan.mask_secrets(documents).collect()}
    assert masked[10].endswith("[secret]' [secret]") and masked[4] is None


def test_weak_parts_only_together(spark):
    rows = [(4, "https://h/" + "u" * 900 + " pwd=hunter22"), (1, "client_id: foo99 far"), (2, "client_id: foo99 pwd=hunter22"), (3, "pwd=hunter22 " + "x " * 150 + "client_id: foo99")]
    found = secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: [s.kind for s in r.spans] for r in found} == {
        1: [],
        2: ["weak_identifier", "weak_secret"],
        3: [],
        4: ["weak_endpoint", "weak_secret"],
    }


def test_overlapping_and_null_id_secrets_are_masked(spark):
    overlap = 'token=abcdefgh12 https://h/?pwd="hunter22" username: bob'
    rows = [(1, overlap), (None, "client_id: foo99 pwd=hunter22"), (None, "client_id: foo99 pwd=hunter22")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = sorted(r.text for r in secret_scan.mask_secrets(docs).collect())
    assert len(texts) == 3 and texts[:2] == ["[secret] [secret]"] * 2 and "hunter22" not in texts[2]
    found = secret_scan.find_secrets(docs).where("doc_id is null").collect()
    assert [[s.kind for s in r.spans] for r in found] == [["weak_identifier", "weak_secret"]] * 2


def test_host_rules(documents, empty):
    expected = []
    for i, t in ROWS:
        t = t or ""
        w = WHITE.findall(t)
        lines = [x for x in t.split("\n") if WHITE.search(x)]
        windows = [tuple(w[j : j + 5]) for j in range(len(w) - 4)]
        twice = {x for x in set(windows) if windows.count(x) > 1} if len(w) < 5000 else set()
        covered = {k for j, x in enumerate(windows) if x in twice for k in range(j, j + 5)}
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        symbols = len(re.findall(r"[#*$%&|<>]", t))
        expected.append((i, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed))
    got = host_rules.judge_documents(documents).collect()
    assert same([tuple(r)[:7] for r in got], expected)
    assert not [r for r in got if r.base_failed and r.kept]
    assert host_rules.judge_documents(empty).collect() == []


def test_bad_host_is_dropped(spark):
    good = "one two three four five six seven eight nine ten eleven"
    rows = [(i, good if i % 10 else "x", "fine") for i in range(60)]
    rows += [(100 + i, "x" if i % 10 else good, "bad") for i in range(60)]
    got = host_rules.judge_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r.doc_id for r in got.where("kept").collect()} == {i for i in range(60) if i % 10}


def test_many_secrets_in_one_text(spark):
    """More matches than a run holds: places are exact, and masking leaves none."""
    text = " ".join(f"token=abcdefg{i:05d} é login: user{i}" for i in range(3000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = secret_scan.secrets_digest(secret_scan.find_secrets(docs)).first()
    base = ",".join(f"assign:{m.start()}:{m.end()}" for m in re.finditer(r"token=[a-z0-9]+", text))
    assert row["n_assign"] == 3000 and row["base_sha256"] == sha(base)
    masked = secret_scan.mask_secrets(docs).first()["text"]
    assert masked == " ".join(["[secret] é [secret]"] * 3000)
