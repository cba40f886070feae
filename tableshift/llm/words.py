"""Words of whole texts as numpy arrays: spans, 64-bit hashes and sliding windows over Arrow string buffers.

A word is a run of bytes other than the six ASCII blanks (space and 0x09-0x0D), the same rule as ``[^\\x20\\x09-\\x0D]+`` on
the decoded text. Nulls and empty texts have no words. Work goes chunk by chunk (whole documents, about ``CHUNK`` bytes),
so temporaries stay small however large the Arrow batch; only a single longer text makes a chunk longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64, at least ``length`` of each."""
    if len(_powers[0]) < length:
        size = max(length, CHUNK + (CHUNK >> 2))
        for i, base in enumerate((_BASE, _BACK)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


class Texts:
    """The words of consecutive documents.

    ``data`` holds the documents' bytes, ``bounds[d]:bounds[d+1]`` those of document ``d``; word ``w`` is
    ``data[starts[w]:ends[w]]`` and the words of document ``d`` are ``firsts[d]:firsts[d+1]``.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds
        inside = ~BLANK[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True  # a document's end parts words, blank or not
        first, last = inside.copy(), inside.copy()
        if len(data):
            first[1:] &= ~inside[:-1] | edge[1:-1]
            last[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.firsts = np.searchsorted(self.starts, bounds)

    @property
    def counts(self) -> np.ndarray:
        """Words per document."""
        return np.diff(self.firsts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash per word; equal words have equal hashes in every batch and task."""
        powers, back = _power_tables(len(self.data) + 1)
        values = _BYTE[LOWER[self.data] if lower else self.data]
        values *= powers[:len(values)]
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values, out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * back[self.starts])

    def document_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.firsts) - 1), self.counts)

    def text_of(self, document: int) -> bytes:
        return self.data[self.bounds[document]:self.bounds[document + 1]].tobytes()


def chunks(texts: pa.Array | pa.ChunkedArray, size: int = CHUNK) -> Iterator[tuple[slice, Texts]]:
    """The texts in groups of whole documents of about ``size`` bytes, each with its place in the array."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):  # an array too large for one chunk of small offsets
        texts = pa.concat_arrays([c.cast(pa.large_string()) for c in texts.chunks])
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        end = min(end, n, at + 65_536)
        yield slice(at, end), Texts(raw[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at])
        at = end


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` consecutive word hashes, by the place of the first; shorter tails have none."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(length):
        total = total * np.uint64(_BASE) + hashes[i:i + n]
    return mix(total)


def within(firsts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Whether ``length`` consecutive words from each place lie in one document (places as in ``runs``)."""
    n = total - length + 1
    if n <= 0:
        return np.zeros(0, bool)
    good = np.ones(n, bool)
    # The last length-1 words of every document start no run.
    for back in range(1, length):
        places = firsts[1:] - back
        places = places[(places >= firsts[:-1]) & (places < n)]
        good[places] = False
    return good


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, by doubling."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:]) if len(values) > span else values[:0]
        span *= 2
    rest = width - span
    return values if not rest else (np.minimum(values[:-rest], values[rest:]) if len(values) > rest else values[:0])
