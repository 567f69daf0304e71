"""Simple-8b: ids in 64-bit words, a selector of 4 bits and 60 bits of ids in each.

A selector says how many ids a word holds and how many bits each has. An id beyond 60
bits is escaped: its word has selector 0 and the id's place in a list of whole 64-bit
numbers. Ids are coded in blocks of ``BLOCK``, whose words and escapes are found through
offsets, so that a block can be read alone and all words of a frame are decoded at once.
The last word of a block may go on with ids of the next, which has them too.

A frame is one run of ids with the documents that lie in it, as bytes:

    header      magic, ids a block, documents, ids, words, escapes, part, number
    documents   id, place in the part, piece, number of ids (int64 each), flags (uint8)
    blocks      first word of each block and the end (uint64)
    words, escapes (uint64), CRC-32 of all before it (uint32)

All numbers are little-endian.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

#: Ids a word and bits an id, by selector; selector 0 is the escape and counts one id.
COUNTS = np.array([1, 240, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
WIDEST, ESCAPE = 60, 0
BLOCK = 4096
MAGIC = b"S8F1"
HEADER = "<4sIQQQQQQ"


def bit_lengths(ids: np.ndarray) -> np.ndarray:
    """Bits of each unsigned id."""
    if ids.dtype.itemsize <= 4:
        return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    high = (ids >> np.uint64(32)).astype(np.uint32)
    low = (ids & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    bits = np.frexp(low.astype(np.float64))[1]
    if high.any():
        bits = np.where(high > 0, 32 + np.frexp(high.astype(np.float64))[1], bits)
    return bits.astype(np.uint8)


def _choices(bits: np.ndarray) -> np.ndarray:
    """For each position the selector of a word that begins there: the one with the most ids."""
    n, least = len(bits), int(bits.min(initial=255))
    chosen = np.where(bits > WIDEST, ESCAPE, len(COUNTS) - 1).astype(np.uint8)
    # the most bits among ``window`` ids from each position; nothing behind the end is in the way
    reach, window = np.append(bits, np.zeros(int(COUNTS.max()), np.uint8)), 1
    for selector in range(len(COUNTS) - 2, 0, -1):
        count, width = int(COUNTS[selector]), int(BITS[selector])
        if width < least:
            break
        while window < count:
            step = min(window, count - window)
            reach = np.maximum(reach[: len(reach) - step], reach[step:])
            window += step
        chosen[reach[:n] <= width] = selector
    return chosen


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, escapes, and the offsets of the blocks among the words."""
    chosen = _choices(bit_lengths(ids))
    ids = ids.astype(np.uint64)
    steps = COUNTS[chosen].tolist()
    starts: list[int] = []
    offsets = [0]
    for begin in range(0, len(ids), block):
        at, end = begin, min(begin + block, len(ids))
        while at < end:
            starts.append(at)
            at += steps[at]
        offsets.append(len(starts))
    places = np.array(starts, np.int64)
    selectors = chosen[places].astype(np.int64)
    words = selectors.astype(np.uint64) << np.uint64(60)
    padded = np.append(ids, np.zeros(int(COUNTS.max()), np.uint64))
    for selector in np.unique(selectors).tolist():
        rows = np.flatnonzero(selectors == selector)
        if selector == ESCAPE:
            words[rows] |= np.arange(len(rows), dtype=np.uint64)
        else:
            first, width = places[rows], int(BITS[selector])
            for k in range(int(COUNTS[selector]) if width else 0):
                words[rows] |= padded[first + k] << np.uint64(width * k)
    return words, ids[places[selectors == ESCAPE]], np.array(offsets, np.uint64)


def decode(words: np.ndarray, escapes: np.ndarray, offsets: np.ndarray, count: int, block: int = BLOCK) -> np.ndarray:
    """The ids of whole blocks, all words at once; ``escapes`` are those of the frame."""
    out = np.zeros(count + int(COUNTS.max()), np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    before = np.cumsum(counts) - counts
    of_block = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets.astype(np.int64)))
    first = before[offsets[:-1].astype(np.int64)] if len(words) else before
    places = before - first[of_block] + of_block * block
    payload = words & np.uint64((1 << 60) - 1)
    for selector in np.unique(selectors).tolist():
        rows = np.flatnonzero(selectors == selector)
        at, packed = places[rows], payload[rows]
        if selector == ESCAPE:
            out[at] = escapes[packed.astype(np.int64)]
        else:
            width = int(BITS[selector])
            for k in range(int(COUNTS[selector]) if width else 0):
                out[at + k] = (packed >> np.uint64(width * k)) & np.uint64((1 << width) - 1)
    return out[:count]


#: Flags of a document in a frame: its id is null; it is one of several pieces.
NULL_ID, PIECE = 1, 2


@dataclass
class Frame:
    """A run of ids and its documents; ``part`` and ``number`` give its place among all frames."""

    doc_ids: list[int]
    places: list[int]
    pieces: list[int]
    lengths: list[int]
    flags: list[int]
    ids: np.ndarray
    part: int
    number: int

    def to_bytes(self, block: int = BLOCK) -> bytes:
        words, escapes, offsets = encode(self.ids, block)
        header = struct.pack(HEADER, MAGIC, block, len(self.doc_ids), len(self.ids), len(words), len(escapes), self.part, self.number)
        longs = [np.array(c, "<i8").tobytes() for c in (self.doc_ids, self.places, self.pieces, self.lengths)]
        body = b"".join([header, *longs, bytes(self.flags), *(a.astype("<u8").tobytes() for a in (offsets, words, escapes))])
        return body + struct.pack("<I", zlib.crc32(body))


class FrameReader:
    """A frame at ``at`` of a file's bytes; ``end`` is where it ends."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        magic, self.block, docs, self.count, words, escapes, self.part, self.number = struct.unpack_from(HEADER, data, at)
        if magic != MAGIC:
            raise ValueError(f"no frame at byte {at}")
        self.blocks = -(-self.count // self.block)
        place = at + struct.calcsize(HEADER)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal place
            found = np.frombuffer(data, kind, n, place)
            place += found.nbytes
            return found

        self.doc_ids, self.places, self.pieces, self.lengths = (take("<i8", docs) for _ in range(4))
        self.flags = take("u1", docs)
        self.offsets, self.words, self.escapes = take("<u8", self.blocks + 1), take("<u8", words), take("<u8", escapes)
        if zlib.crc32(memoryview(data)[at:place]) != struct.unpack_from("<I", data, place)[0]:
            raise ValueError(f"the frame at byte {at} is damaged")
        self.end = place + 4

    def ids(self) -> np.ndarray:
        return decode(self.words, self.escapes, self.offsets, self.count, self.block)

    def read(self, first: int, last: int) -> np.ndarray:
        """Ids from ``first`` to before ``last``; only the words of their blocks are decoded."""
        a, b = first // self.block, min(self.blocks, -(-last // self.block))
        if a >= b:
            return np.zeros(0, np.uint64)
        offsets = self.offsets[a : b + 1]
        words = self.words[int(offsets[0]) : int(offsets[-1])]
        count = min(self.count, b * self.block) - a * self.block
        found = decode(words, self.escapes, offsets - offsets[0], count, self.block)
        return found[first - a * self.block : last - a * self.block]


def frames(data: bytes, between: int = 1) -> list[FrameReader]:
    """All frames of a file; ``between`` bytes follow each."""
    out, at = [], 0
    while at < len(data):
        out.append(FrameReader(data, at))
        at = out[-1].end + between
    return out


_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32, the lowest power in the highest bit."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (_POLYNOMIAL if b & 1 else 0)
    return out


def crc32_joined(first: int, second: int, size: int) -> int:
    """The CRC-32 of two strings end to end from those of each; the second has ``size`` bytes."""
    power, shift, bits = 1 << 31, 1 << 30, 8 * size  # x to the 0, x to the 1
    while bits:
        if bits & 1:
            power = _times(power, shift)
        shift, bits = _times(shift, shift), bits >> 1
    return _times(power, first) ^ second
