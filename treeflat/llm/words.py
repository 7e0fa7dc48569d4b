"""Words of many texts at once: numpy over the bytes of an Arrow column, one pass, no loop over words.

A word's hash is a polynomial over random byte values modulo 2^64, taken as a difference of prefix sums, then mixed; words of
a text are found and hashed in pieces of about ``PIECE`` bytes, cut at white space, so long texts need no more memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from treeflat.llm.common import ship

ship(__name__)

#: Bytes that are looked at together.
PIECE = 1 << 20
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE, _GOLDEN = 0x9E3779B97F4A7C15, np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: White space and ASCII punctuation.
NOT_WORD = SPACE | np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


_BYTES = mix((np.arange(1, 257, dtype=np.uint64)) * _GOLDEN)


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n + 1:
        size = max(n + 1, PIECE + 4096)
        inverse = pow(_BASE, -1, 2**64)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0], _powers[1]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def split(data: np.ndarray, breaks: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``; a word also ends at each of ``breaks`` (positions)."""
    inside = ~apart[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[breaks] = True
    before = np.empty(len(data), bool)
    before[:1] = True
    before[1:] = ~inside[:-1]
    starts = np.flatnonzero(inside & (before | cut[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = True
    after[:-1] = ~inside[1:]
    ends = np.flatnonzero(inside & (after | cut[1:])) + 1
    return starts, ends


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _powers_to(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(column: pa.Array, apart: np.ndarray = SPACE, lower: np.ndarray = LOWER) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, rows' word counts, hashes of their words) for runs of rows with about ``PIECE`` bytes.

    Bytes are mapped by ``lower`` first; bytes in ``apart`` separate words.
    """
    data, at = raw(column)
    n, first = len(at) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + PIECE, "right")) - 1)
        counts, found = np.zeros(last - first, np.int64), []
        low, high = int(at[first]), int(at[last])
        while low < high:
            end = min(high, low + 2 * PIECE)
            if end < high:  # one long text: cut after its last white space, or go on to the next
                space = np.flatnonzero(apart[data[low:end]])
                if len(space):
                    end = low + int(space[-1]) + 1
                else:
                    further = np.flatnonzero(apart[data[end:high]])
                    end = end + int(further[0]) + 1 if len(further) else high
            piece = lower[data[low:end]]
            bounds = np.clip(at[first : last + 1] - low, 0, len(piece))
            starts, ends = split(piece, bounds, apart)
            found.append(hashes(piece, starts, ends))
            counts += np.diff(np.searchsorted(starts, bounds))
            low = end
        yield first, counts, np.concatenate(found) if found else np.zeros(0, np.uint64)
        first = last


def windows(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling (Karp-Rabin) hashes of ``size`` words in a row, and how many each row has."""
    have = np.maximum(counts - size + 1, 0)
    if len(words) < size:
        return np.zeros(0, np.uint64), have
    n = len(words) - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out *= np.uint64(_BASE)
        out += words[k : k + n]
    ends = np.cumsum(counts)
    first = ends - counts
    keep = np.zeros(n + 1, np.int32)  # +1 where a row's windows begin, -1 after its last
    rows = have > 0
    keep[first[rows]] += 1
    np.subtract.at(keep, np.minimum(first[rows] + have[rows], n), 1)
    return mix(out[np.cumsum(keep[:n]) > 0]), have


def slices(counts: np.ndarray) -> np.ndarray:
    """Where each row begins, and the end."""
    return np.concatenate([[0], np.cumsum(counts)])
