"""Words of many texts at once: places and 64-bit hashes over one byte buffer, with numpy.

Texts stay UTF-8 bytes. All word rules here have ASCII separators only, so bytes decide as
characters would. Equal words have equal hashes; unequal words collide with a chance of about
pairs / 2**64, which callers accept where they say so.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLOCK = 1 << 20
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

# Lower case for A-Z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Words [^\x20\x09-\x0D]+ : all bytes but ASCII white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

# Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ : digits, a-z and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, dtype=np.uint64)
    down = np.full(n, _INVERSE, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def buffer(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end, and where each begins; NULL counts as empty."""
    plain = pc.fill_null(column, "").cast(pa.large_binary())
    _, places, data = plain.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[plain.offset : plain.offset + len(plain) + 1]
    if data is None or not len(plain):
        return np.empty(0, dtype=np.uint8), np.zeros(len(plain) + 1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return (LOWER[raw] if lower else raw), offsets - offsets[0]


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of member bytes; no run crosses from one text to the next."""
    if not len(member):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    begins, ends = member.copy(), member.copy()
    begins[1:] &= ~member[:-1]
    ends[:-1] &= ~member[1:]
    filled = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    begins[first] = member[first]
    ends[last] = member[last]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the first run of each text, and the number of runs at the end."""
    return np.searchsorted(starts, offsets, side="left")


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch, by differences of a running polynomial."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + _BLOCK, side="right")))
        size = int(ends[j - 1] - low)
        up, down = _powers(max(_BLOCK, size))
        total = np.empty(size + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(_VALUE[data[low : low + size]] * up[:size], out=total[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = _mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out
