"""Words, hashes and shingles of whole Arrow string batches.

Tasks get texts as Arrow buffers. The helpers here look at the UTF-8 bytes of
many documents at once; every byte over 0x7F belongs to a character outside
ASCII, so the ASCII word rules of the operators hold bytewise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

T = TypeVar("T")
#: Bytes of text that are looked at together; a longer text is one slice of its own.
SLICE_BYTES = 1 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
_COMBINE = np.uint64(0xAF251AF3B0F025B5)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def byte_table(chars: str | bytes, inside: bool = True) -> np.ndarray:
    """True for the given bytes (inside) or for all others."""
    table = np.full(256, not inside)
    table[np.frombuffer(chars.encode() if isinstance(chars, str) else chars, np.uint8)] = inside
    return table


#: Words are runs without space, tab, line feed, vertical tab, form feed and carriage return.
NOT_SPACE = byte_table(b"\x20\x09\x0a\x0b\x0c\x0d", inside=False)
#: Words are runs of digits, letters and everything outside ASCII.
WORD_CHARS = byte_table(bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def _codes(seed: int) -> np.ndarray:
    return mix(np.arange(256, dtype=np.uint64) + np.uint64(seed * 1000 + 1)) | np.uint64(1)


_CODES = {(seed, low): _codes(seed)[LOWER if low else np.arange(256)] for seed in (1, 2) for low in (False, True)}
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", int(_STEP)), ("down", pow(int(_STEP), -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


_resident: dict[str, object] = {}


def resident(name: str, make: Callable[[], T]) -> T:
    """What a Python worker keeps from task to task: the tables of one operator. Those of another go when they come.

    Spark uses workers again for other operators and later jobs, where tables that all stay would add up.
    """
    if name not in _resident:
        _resident.clear()
        _resident[name] = make()
    return _resident[name]


def places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of runs, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `limit` bytes of text each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row starts, with the end of the last; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and the number of the first word of each row, with the end."""
    inside = table[data]
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over its bytes, from prefix sums over the whole slice."""
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[seed, lower][data] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each word on (shorter by k - 1); a caller masks those that leave a row."""
    n = max(0, len(hashes) - k + 1)
    out = hashes[:n].copy()
    for j in range(1, k):
        out = out * _COMBINE + hashes[j : j + n]
    return mix(out)


def room(first: np.ndarray) -> np.ndarray:
    """For each word, how many words of its row there are from it on."""
    ends = np.repeat(first[1:], np.diff(first))
    return ends - np.arange(len(ends))


def rows_of(first: np.ndarray) -> np.ndarray:
    """For each word, the number of its row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def signed(x: np.ndarray) -> pa.Array:
    """Unsigned 64-bit numbers as Spark's long."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))
