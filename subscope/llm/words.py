"""Words, spans and 64-bit hashes of whole text batches, computed on UTF-8 bytes.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. White space is ASCII, so UTF-8 bytes can be examined one by one. All
functions work on one Arrow batch inside a task; nothing here knows Spark.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_RNG = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
RADIX = 0x9E3779B97F4A7C15
RADIX_INVERSE = pow(RADIX, -1, 2**64)
BLOCK = 1 << 18


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


POWERS = _powers(RADIX, BLOCK + 1)
INVERSES = _powers(RADIX_INVERSE, BLOCK + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets, starting at 0. NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=n + 1 + column.offset)
    offsets = offsets[column.offset :]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span. Spans are in order and do not overlap.

    A span's sum of byte values times powers of an odd radix is the difference of two
    running sums, brought to a common exponent by the inverse power, modulo 2**64. Blocks
    bound the memory; a span longer than a block is summed by pieces.
    """
    out = np.zeros(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = int(np.searchsorted(ends, base + BLOCK, side="right"))
        if j <= i:
            out[i] = _long_span(raw[base : int(ends[i])])
            i += 1
            continue
        stop = int(ends[j - 1])
        sums = np.zeros(stop - base + 1, dtype=np.uint64)
        np.multiply(BYTE_VALUES[raw[base:stop]], POWERS[: stop - base], out=sums[1:])
        np.cumsum(sums, out=sums)
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * INVERSES[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def _long_span(span: np.ndarray) -> np.uint64:
    total, factor = 0, 1
    step = pow(RADIX, BLOCK, 2**64)
    for at in range(0, len(span), BLOCK):
        piece = span[at : at + BLOCK]
        part = int(np.sum(BYTE_VALUES[piece] * POWERS[: len(piece)], dtype=np.uint64))
        total = (total + factor * part) % 2**64
        factor = factor * step % 2**64
    return np.uint64((total + len(span)) % 2**64)


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    if mask[0]:
        starts, ends = np.concatenate(([0], edges[1::2])), edges[::2]
    if mask[-1]:
        ends = np.concatenate((ends, [len(mask)]))
    return starts.astype(np.int64), ends.astype(np.int64)


@dataclass
class WordBatch:
    """All words of a batch of texts, in order.

    ``first[d]:first[d + 1]`` are the words of text ``d``.
    """

    raw: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(column: pa.Array, lower: bool = True, hashed: bool = True) -> WordBatch:
    """The words of each text; with ``lower``, A-Z become a-z before hashing."""
    raw, offsets = text_bytes(column)
    if lower:
        raw = LOWER[raw]
    inside = ~WHITE[raw]
    starts, ends = spans_of(inside)
    # A word may not reach over the border of two texts.
    borders = offsets[1:-1]
    borders = np.unique(borders[(borders > 0) & (borders < len(raw))])
    at = np.searchsorted(starts, borders, side="right") - 1
    cut = (at >= 0) & (starts[at] < borders) & (ends[at] > borders) if len(starts) else at >= 0
    if cut.any():
        borders = borders[cut]
        starts = np.sort(np.concatenate((starts, borders)))
        ends = np.sort(np.concatenate((ends, borders)))
    first = np.searchsorted(starts, offsets, side="left")
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    hashes = span_hashes(raw, starts, ends) if hashed else np.zeros(0, np.uint64)
    return WordBatch(raw, offsets, starts, ends, doc, first, hashes)


def windows(batch: WordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width`` consecutive words within a text, and their first word."""
    n = len(batch.hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        factor = np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 2**64))
        total += batch.hashes[k : k + n] * factor
    at = np.flatnonzero(batch.doc[:n] == batch.doc[width - 1 :])
    return mix(total[at]), at
