"""Byte spans of a column of texts, and hashes of them, for whole Arrow batches.

A batch is one array of bytes and the offsets of its texts. Tokens are pairs of
start and end in it; all their hashes come from one running sum, so no Python
object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts of a batch are worked on in blocks of so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
#: An odd multiplier, hence invertible modulo 2**64.
BASE = 0x9E3779B97F4A7C15


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null: empty) end to end, and the n + 1 offsets."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, at, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The batch as ``(bytes, offsets)`` of consecutive texts, about ``limit`` bytes each."""
    data, offsets = text_bytes(texts)
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of the longest runs of true bytes within a text."""
    if not len(member):
        none = np.zeros(0, np.int64)
        return none, none, none
    breaks = np.zeros(len(member) + 1, bool)
    breaks[offsets] = True
    before, after = np.zeros(len(member), bool), np.zeros(len(member), bool)
    before[1:] = member[:-1]
    after[:-1] = member[1:]
    starts = np.flatnonzero(member & (~before | breaks[:-1]))
    ends = np.flatnonzero(member & (~after | breaks[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, wherever it lies."""
    n = len(data) + 1
    powers = np.cumprod(np.full(n, BASE, np.uint64))
    inverse = np.cumprod(np.full(n, pow(BASE, -1, 1 << 64), np.uint64))
    sums = np.zeros(n, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments, empty ones included."""
    running = np.zeros(len(values) + 1)
    np.cumsum(values, out=running[1:])
    return running[offsets[1:]] - running[offsets[:-1]]
