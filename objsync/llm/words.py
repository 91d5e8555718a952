"""Words and word hashes of whole texts, by numpy over their UTF-8 bytes.

All word patterns used here are sets of ASCII characters, so a text can be cut byte by
byte: bytes of longer characters always belong to a word. Hashes have 64 bits and are
the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes worked on at once; a longer text is cut between words.
BLOCK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


class Alphabet:
    """Which bytes are part of a word, and the byte that stands for each of them."""

    def __init__(self, separators: Iterable[int], fold: bool):
        self.is_word = np.ones(256, dtype=bool)
        self.is_word[list(separators)] = False
        self.code = np.arange(256, dtype=np.uint8)
        if fold:
            self.code[65:91] += 32

    def ends(self, blob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words start and end in ``blob``."""
        inside = np.zeros(len(blob) + 2, dtype=np.int8)
        inside[1:-1] = self.is_word[blob]
        step = np.diff(inside)
        return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


_WHITE = [0x20, *range(0x09, 0x0E)]
#: ``[^\x20\x09-\x0D]+`` as it is, and with A-Z lower-cased.
WHITE = Alphabet(_WHITE, fold=False)
WHITE_FOLDED = Alphabet(_WHITE, fold=True)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased: digits, letters, non-ASCII.
ALNUM_FOLDED = Alphabet(
    [b for b in range(128) if not (chr(b).isdigit() or chr(b).isalpha())], fold=True
)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < n:
        steps = np.full(max(n, BLOCK_BYTES + 4096), base, dtype=np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if n <= 8 * BLOCK_BYTES:
            _powers[name] = known
    return known[:n]


def _block_hashes(blob: np.ndarray, alphabet: Alphabet):
    starts, ends = alphabet.ends(blob)
    n = len(blob)
    sums = np.zeros(n + 1, dtype=np.uint64)
    codes = alphabet.code[blob].astype(np.uint64)
    codes += np.uint64(1)
    codes *= _power(_BASE, "up", n)
    np.cumsum(codes, out=sums[1:])
    inverse = _power(_BASE_INVERSE, "down", n + 1)
    value = (sums[ends] - sums[starts]) * inverse[starts]
    return starts, ends, mix(value ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def word_hashes(blob: bytes, alphabet: Alphabet):
    """Starts, ends (bytes) and hashes of the words of ``blob``, in order."""
    data = np.frombuffer(blob, dtype=np.uint8)
    if len(data) <= 2 * BLOCK_BYTES:
        return _block_hashes(data, alphabet)
    parts, at = [], 0
    while at < len(data):
        to = at + BLOCK_BYTES
        while to < len(data):  # up to the next separator, however far it is
            near = np.flatnonzero(~alphabet.is_word[data[to : to + BLOCK_BYTES]])
            if len(near):
                to += int(near[0])
                break
            to += BLOCK_BYTES
        starts, ends, hashes = _block_hashes(data[at:to], alphabet)
        parts.append((starts + at, ends + at, hashes))
        at = to
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ``values[start:end]`` for many ranges; equal contents, equal hashes."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mix(values) * _power(_BASE, "up", n), out=sums[1:])
    value = (sums[end] - sums[start]) * _power(_BASE_INVERSE, "down", n + 1)[start]
    return mix(value ^ ((end - start).astype(np.uint64) << np.uint64(40)))


class Texts:
    """Some texts with their words: word ``i`` of text ``d`` is at ``first[d] + i``."""

    def __init__(self, texts: list[bytes], alphabet: Alphabet):
        self.blob = b"\x20".join(texts)
        sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.begin = np.concatenate(([0], np.cumsum(sizes + 1)))[: len(texts)]
        self.starts, self.ends, self.hashes = word_hashes(self.blob, alphabet)
        self.first = np.searchsorted(self.starts, np.append(self.begin, len(self.blob) + 1))
        self.counts = np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; see ``gram_ok`` for those inside a text."""
        h = self.hashes
        n = max(0, len(h) - k + 1)
        out = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            out = out * np.uint64(0xD6E8FEB86659FD93) + h[j : j + n]
            out ^= out >> np.uint64(32)
        return mix(out)

    def gram_ok(self, k: int) -> np.ndarray:
        n = max(0, len(self.hashes) - k + 1)
        last = np.repeat(self.first[1:], self.counts)[:n]
        return np.arange(n) + k <= last


def encoded(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The texts of a column as UTF-8; None stays None."""
    return column.cast(pa.binary()).to_pylist()


def blocks(
    texts: list[bytes | None], size: int = BLOCK_BYTES, each: int = 1
) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together, one text at least.

    A text counts for ``each`` bytes besides its own.
    """
    at, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or b"") + each
        if held >= size:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def text_blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """Ranges as of ``blocks`` with their texts, null ones empty; only one range is held."""
    data = column.cast(pa.binary())
    ends = np.cumsum(pc.binary_length(data).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(data):
        before = ends[at - 1] if at else 0
        to = min(len(data), int(np.searchsorted(ends, before + size)) + 1)
        yield at, to, [t or b"" for t in data.slice(at, to - at).to_pylist()]
        at = to


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
