"""Vectorised text kernels shared by the operators of this subpackage.

Arrow string columns are read as flat byte buffers, so one numpy pass covers
every text of a chunk; nothing loops over words in Python.  Chunks hold at most
``CHUNK_BYTES`` of text (a single longer text forms its own chunk), which bounds
the memory of a task whatever the Arrow batch size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

#: Words are maximal runs of bytes other than space and \t \n \v \f \r.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)
#: A fixed random 64-bit value for each byte.
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply, twice)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> np.ndarray:
    """The first n powers of the hash base, modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(1 << int(n - 1).bit_length(), _BASE, np.uint64)
        p[0] = 1
        _POWERS = np.cumprod(p, dtype=np.uint64)
    return _POWERS[:n]


def strings(column: pa.Array) -> pa.Array:
    """Text column with nulls as empty strings and 64-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def chunks(column: pa.Array, limit: int = CHUNK_BYTES,
           rows: int = 1 << 30) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive slices of a text column.

    A slice has at most ``limit`` bytes and ``rows`` texts, but always one text."""
    column = strings(column)
    if len(column) == 0:
        return
    _, off_buf, data = column.buffers()
    offs = np.frombuffer(off_buf, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), i + rows, len(column))
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def runs(buf: np.ndarray, offs: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes with ``member`` true, cut at text ends: (starts, ends, text of each run)."""
    if len(buf) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    cut = np.zeros(len(buf) + 1, bool)
    cut[offs] = True
    before = np.empty(len(buf), bool)
    before[0] = True
    before[1:] = ~member[:-1]
    starts = np.flatnonzero(member & (before | cut[:-1]))
    after = np.empty(len(buf), bool)
    after[-1] = True
    after[:-1] = ~member[1:]
    ends = np.flatnonzero(member & (after | cut[1:])) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of every text: (starts, ends, text of each word)."""
    return runs(buf, offs, ~_IS_SPACE[buf])


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of byte spans; equal bytes give equal hashes, empty spans a constant."""
    lens = ends - starts
    out = np.zeros(len(starts), np.uint64)
    full = np.flatnonzero(lens > 0)
    if len(full):
        n = lens[full]
        first = np.zeros(len(n), np.int64)
        np.cumsum(n[:-1], out=first[1:])
        pos = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(first, n)
        v = _BYTE[buf[pos + np.repeat(starts[full], n)]] * powers(int(n.max()))[pos]
        out[full] = np.add.reduceat(v, first)
    return mix(out + lens.astype(np.uint64) * _GOLD)


def windows(hashes: np.ndarray, group: np.ndarray, n: int,
            among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hashes of n consecutive hashes within a group: (index of the first, hash).

    ``group`` must be non-decreasing; ``among`` restricts the indexes looked at.
    """
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(m) if among is None else among[among < m]
    at = at[group[at] == group[at + n - 1]]
    acc = hashes[at]
    for k in range(1, n):
        acc = acc * _BASE + hashes[at + k]
    return at, mix(acc)


def per_group(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Sum of integer values by group number."""
    return np.bincount(group, weights=values, minlength=n).astype(np.int64)


def code_points(buf: np.ndarray) -> np.ndarray:
    """Running count of code points: c[j] - c[i] is their number in bytes i to j."""
    c = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=c[1:])
    return c
