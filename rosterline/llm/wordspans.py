"""Words of a batch of texts as numpy spans over its UTF-8 bytes, and hashes of any byte range of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 4 << 20         # bytes of text that a worker holds spans of at once; a longer text is a chunk of its own
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than texts) of a string array without NULLs."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    off = np.frombuffer(texts.buffers()[1], kind, len(texts) + 1, texts.offset * kind().itemsize).astype(np.int64)
    data = texts.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(texts: pa.Array, size: int = CHUNK):
    """(first, last, bytes, offsets) of runs of whole texts, each of at most ``size`` bytes or one text."""
    data, off = flat(texts)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
        yield at, end, data[off[at]:off[end]], off[at:end + 1] - off[at]
        at = end


def spans(is_word: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of the runs of word bytes, none across two texts, and the marks of the first bytes."""
    first = np.zeros(len(is_word) + 1, bool)
    first[off[:-1]] = True
    first[-1] = True
    start = is_word & first[:-1]
    start[1:] |= is_word[1:] & ~is_word[:-1]
    end = is_word & first[1:]
    end[:-1] |= is_word[:-1] & ~is_word[1:]
    start = np.flatnonzero(start)
    return start, np.flatnonzero(end) + 1, np.searchsorted(off, start, "right") - 1, first[:-1]


def mixed(key: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values of 64-bit keys."""
    key = (key ^ (key >> np.uint64(30))) * MIX[0]
    key = (key ^ (key >> np.uint64(27))) * MIX[1]
    return key ^ (key >> np.uint64(31))


class Hashes:
    """Hashes of byte ranges by differences of one running sum; equal bytes have equal hashes."""

    def __init__(self, data: np.ndarray):
        powers = np.full(len(data) + 1, BASE, np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=self.sums[1:])
        self.back = np.full(len(data) + 1, pow(BASE, -1, 1 << 64), np.uint64)
        self.back[0] = 1
        np.cumprod(self.back, out=self.back)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])


def codes(keys) -> tuple[np.ndarray, int]:
    """Dense numbers of equal values of an array, and how many there are."""
    found = (keys if isinstance(keys, pa.Array) else pa.array(keys)).dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(found.dictionary)
