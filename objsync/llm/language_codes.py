"""Language identification by error-correcting output codes.

Each language has a codeword; each bit of the codewords is predicted by a logistic
classifier over hashed byte trigrams of the whole text. Decoding takes the language
whose codeword has the least loss, weighted by how well each bit was learned, and flags
texts whose two nearest codewords are about as near.

The classifiers are fitted on ``SAMPLE`` labelled documents at most, spread over the
languages; only their trigram histograms come to the driver. All texts are read whole.

Defined results: a text that is null or has no letter is ``und`` with score 0; without
any labelled document everything is; with one language, that language; rows without a
language are not learned from; repeated rows are predicted alike; an empty table gives an
empty result; further columns are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import crc_fold, written
from .words import BLOCK_BYTES, blocks, encoded

DIMENSIONS = 4096
#: Labelled documents that the classifiers are fitted on, at most (about).
SAMPLE = 2000
#: Stands for a null id where a text needs a document that has it.
NO_ID = -(1 << 63)
#: Texts whose best two codewords differ by less in loss are ambiguous.
MARGIN = 0.5
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32


def histograms(texts: list[bytes]) -> np.ndarray:
    """Square roots of trigram shares, a row for each text."""
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    for d, text in enumerate(texts):
        counts = np.zeros(DIMENSIONS, dtype=np.int64)
        for at in range(0, len(text), BLOCK_BYTES):
            b = _FOLD[np.frombuffer(text[at : at + BLOCK_BYTES + 2], dtype=np.uint8)]
            if len(b) >= 3:
                h = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D)
                counts += np.bincount(h >> np.uint32(20), minlength=DIMENSIONS)
        out[d] = np.sqrt(counts / max(1, counts.sum()))
    return out


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` languages."""
    if n <= 2:
        return np.array([[1.0], [-1.0]])[:n]
    if n <= 5:  # every split of the languages
        bits = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1)]
        return np.array([b for b in bits if min(b) < 0], dtype=float).T
    rng = np.random.default_rng(0)
    tries = [rng.choice([-1.0, 1.0], (n, int(np.ceil(10 * np.log2(n))))) for _ in range(50)]

    def nearest(code: np.ndarray) -> float:
        return -np.max((code @ code.T) - 2 * code.shape[1] * np.eye(n))

    return max(tries, key=nearest)


class Codes:
    """Fitted bit classifiers and the decoding."""

    def __init__(self, x: np.ndarray, languages: list[str], rounds: int = 120):
        self.languages = sorted(set(languages))
        code = codewords(len(self.languages))
        self.code = code
        target = code[[self.languages.index(v) for v in languages]]
        shares = np.bincount([self.languages.index(v) for v in languages]).astype(float)
        weight = (1 / shares)[[self.languages.index(v) for v in languages]]
        weight = (weight / weight.sum()).astype(np.float32)[:, None]
        w = np.zeros((DIMENSIONS, code.shape[1]), dtype=np.float32)
        bias = np.zeros(code.shape[1], dtype=np.float32)
        ahead, ahead_bias = w, bias
        for t in range(rounds):  # accelerated gradients; rows of x have length one
            margin = (x @ ahead + ahead_bias) * target
            pull = weight * target / (1 + np.exp(np.clip(margin, -30, 30)))
            after = ahead * (1 - 1e-4) + 4 * (x.T @ pull).astype(np.float32)
            after_bias = (ahead_bias + 4 * pull.sum(axis=0)).astype(np.float32)
            ahead = after + t / (t + 3) * (after - w)
            ahead_bias = after_bias + t / (t + 3) * (after_bias - bias)
            w, bias = after, after_bias
        self.w, self.bias = w, bias
        right = (np.sign(x @ w + bias) == target).mean(axis=0)
        self.trust = np.maximum(right - 0.5, 0.01) / np.maximum(right - 0.5, 0.01).mean()

    def decode(self, x: np.ndarray):
        """Language numbers, scores from 0 to 1, and whether two were about as near."""
        margin = (x @ self.w + self.bias)[:, None, :] * self.code[None]
        loss = (np.logaddexp(0, -margin) * self.trust).sum(axis=2)
        share = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        two = np.sort(loss, axis=1)[:, :2]
        close = two[:, -1] - two[:, 0] < MARGIN if loss.shape[1] > 1 else np.zeros(len(x), bool)
        return best, share[np.arange(len(x)), best], close


def _emit_histograms(batches):
    for batch in batches:
        data = [t or b"" for t in encoded(batch.column("text"))]
        for a, b in blocks(data, each=4 * DIMENSIONS):
            rows = [h.tobytes() for h in histograms(data[a:b])]
            yield pa.RecordBatch.from_pydict(
                {"lang": batch.column("lang").slice(a, b - a), "histogram": pa.array(rows, pa.binary())}
            )


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Codes | None:
    """Codes from ``(doc_id, text, lang)`` rows, ``sample`` distinct texts of them at most.

    Each language gives the texts of its smallest hashes, an equal number of each and one
    at least; they are drawn by hashes and ids, and only theirs are read.
    """
    labelled = labelled.where("lang is not null and text is not null").withColumn("print", F.xxhash64("text"))
    texts = labelled.groupBy("lang", "print").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("doc_id"))
    texts = written(texts, "languages")
    quota = max(1, sample // max(1, texts.select("lang").distinct().count()))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("print"))
    drawn = F.broadcast(texts.withColumn("rank", rank).where(F.col("rank") <= quota).drop("rank"))
    picked = labelled.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID))).join(drawn, ["lang", "print", "doc_id"])
    picked = picked.dropDuplicates(["lang", "print"]).orderBy("lang", "print").select("text", "lang")
    rows = picked.mapInArrow(_emit_histograms, "lang string, histogram binary").toArrow()
    if not len(rows):
        return None
    x = np.frombuffer(b"".join(rows["histogram"].to_pylist()), dtype=np.float32)
    return Codes(x.reshape(-1, DIMENSIONS), rows["lang"].to_pylist())


def _predicted(codes):
    def run(batches):
        fitted = codes.value
        for batch in batches:
            data = encoded(batch.column("text"))
            for a, b in blocks(data, each=4 * DIMENSIONS):
                part = [t or b"" for t in data[a:b]]
                letters = [any(c.isalpha() for c in t.decode()) for t in part]
                if fitted is None:
                    names, score, close = [UNKNOWN] * len(part), np.zeros(len(part)), [False] * len(part)
                else:
                    best, score, close = fitted.decode(histograms(part))
                    names = [fitted.languages[i] if ok else UNKNOWN for i, ok in zip(best, letters, strict=True)]
                    score = np.where(letters, score, 0.0)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(a, b - a),
                        "held_out": batch.column("held_out").slice(a, b - a),
                        "lang_pred": pa.array(names, pa.string()),
                        "score": pa.array(score, pa.float64()),
                        "ambiguous": pa.array(np.asarray(close, dtype=bool)),
                    }
                )

    return run


def identify_languages(documents: DataFrame, *, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, ambiguous)`` for every row.

    Documents of the held-out third are never learned from.
    """
    docs = documents.select("doc_id", "text", "lang")
    codes = fit(docs.where(crc_fold() != 1), sample)
    shared = documents.sparkSession.sparkContext.broadcast(codes)
    held = F.coalesce(crc_fold() == 1, F.lit(False)).alias("held_out")
    return docs.select("doc_id", "text", held).mapInArrow(
        _predicted(shared), "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"
    )
