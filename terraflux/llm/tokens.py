"""Vectorised words, word hashes and shingle hashes of a batch of texts.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case, found with numpy over the UTF-8
bytes of many texts at once, so that Python work is per batch, not per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = U64(0xD6E8FEB86659FD93)
_BYTE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_powers = (np.ones(1, U64), np.ones(1, U64))

#: Bytes of text that are worked on at once; a longer text is a batch of its own.
BATCH_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit integers: every input bit reaches every output bit."""
    x = x ^ (x >> U64(32))
    x = x * _STEP
    x = x ^ (x >> U64(29))
    x = x * U64(0xA24BAED4963EE407)
    return x ^ (x >> U64(32))


def _power(base: int, n: int) -> np.ndarray:
    out = np.empty(n, U64)
    out[0], have = 1, 1
    while have < n:  # doubling: powers below have, times base**have
        more = min(have, n - have)
        out[have : have + more] = out[:more] * U64(pow(base, have, 1 << 64))
        have += more
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, BATCH_BYTES + 65536)
        made = _power(_BASE, size), _power(pow(_BASE, -1, 1 << 64), size)
        if n > 4 * BATCH_BYTES:  # a very long text: not kept
            return made
        _powers = made
    return _powers


def batches(texts: list[bytes | None], limit: int = BATCH_BYTES) -> Iterator[slice]:
    """Slices of ``texts`` of about ``limit`` bytes; whole texts only."""
    begin = size = 0
    for i, text in enumerate(texts):
        more = len(text) + 1 if text else 1
        if size and size + more > limit:
            yield slice(begin, i)
            begin, size = i, 0
        size += more
    if begin < len(texts):
        yield slice(begin, len(texts))


class Tokens:
    """Words of several texts. ``first[d]:first[d + 1]`` are the words of text ``d``; null is the empty text."""

    def __init__(self, texts: list[bytes | None]):
        self.n = len(texts)
        self.cased = b"\n".join([t or b"" for t in texts]) + b"\n"
        self.raw = self.cased.translate(LOWER)
        self.buf = np.frombuffer(self.raw, np.uint8)
        lengths = np.fromiter((len(t) + 1 if t else 1 for t in texts), np.int64, self.n)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        space = np.concatenate([[True], IS_SPACE[self.buf]])
        edge = np.flatnonzero(space[1:] != space[:-1])
        self.starts, self.ends = edge[::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self._hashes: np.ndarray | None = None

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, a function of the word's bytes only."""
        if self._hashes is None:
            up, down = powers(len(self.buf) + 1)
            sums = np.empty(len(self.buf) + 1, U64)
            sums[0] = 0
            part = _BYTE[self.buf]
            part *= up[: len(part)]
            np.cumsum(part, out=sums[1:])
            self._hashes = mix((sums[self.ends] - sums[self.starts]) * down[self.starts])
        return self._hashes

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``width``-word shingles and their bounds per text; fewer words: the whole sequence, none: nothing."""
        words, n = self.hashes(), len(self.starts)
        size = np.where(self.counts >= width, self.counts - width + 1, np.minimum(self.counts, 1))
        bounds = np.concatenate([[0], np.cumsum(size)])
        factor = [U64(pow(int(_STEP), j + 1, 1 << 64)) for j in range(width)]
        total = np.zeros(max(n - width + 1, 0), U64)
        for j in range(width):
            total += words[j : j + len(total)] * factor[j]
        begins = np.arange(bounds[-1]) + np.repeat(self.first[:-1] - bounds[:-1], size)
        out = total[np.minimum(begins, len(total) - 1)] if len(total) else np.zeros(bounds[-1], U64)
        for d in np.flatnonzero((self.counts > 0) & (self.counts < width)):
            own = words[self.first[d] : self.first[d + 1]]
            out[bounds[d]] = np.add.reduce(own * np.array(factor[: len(own)], U64))
        return mix(out), bounds

    def words(self, d: int) -> list[bytes]:
        return self.raw[self.offsets[d] : self.offsets[d + 1]].split()


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    column = batch.column(name)
    return column.cast(pa.binary()).to_pylist() if not pa.types.is_binary(column.type) else column.to_pylist()


def folded(texts: list[bytes | None]) -> list[bytes | None]:
    """The texts in lower case, accented letters included; their words stay the same in number."""
    return [t if t is None else t.lower() if t.isascii() else t.decode("utf-8", "replace").lower().encode() for t in texts]
