"""Words of Arrow text columns as numpy arrays, straight from the UTF-8 buffers.

A text column is never turned into Python strings: word limits come from a byte table and each
word becomes a 64-bit polynomial hash, computed for a block of bytes at once. Blocks bound the
memory, so one very long text costs no more than many short ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
ROWS_BYTES = 4 << 20

_rng = np.random.default_rng(20240229)
#: One odd 64-bit value per byte, and the base of the polynomial.
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 60, 1 << 62)) * 2 + 1
_POW: dict[str, np.ndarray] = {}


def byte_table(keep) -> np.ndarray:
    """256 booleans: which bytes belong to a word."""
    return np.array([bool(keep(b)) for b in range(256)])


#: Words are what lies between the six ASCII white-space bytes (0x20, 0x09-0x0D).
SPACED = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words of ASCII letters, digits and every byte above 0x7F.
ALNUM = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
#: A-Z to a-z, all other bytes as they are.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)
_LOWER_BYTE = _BYTE[LOWER]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (xor-shift-multiply rounds)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POW or len(_POW["p"]) < n:
        size = max(n, BLOCK + (1 << 16))
        for key, base in (("p", _BASE), ("i", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, np.uint64(base), dtype=np.uint64)
            steps[0] = 1
            _POW[key] = np.multiply.accumulate(steps)
    return _POW["p"], _POW["i"]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets of n + 1 texts); a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(at) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = ROWS_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of text (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, done + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def word_spans(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(byte starts, byte ends, text number) of every word; words never cross texts."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = keep[data]
    cuts = np.zeros(n + 1, bool)
    cuts[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cuts[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cuts[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each word (A-Z lower-cased unless ``lower`` is false), block by block."""
    out = np.empty(len(starts), np.uint64)
    values = _LOWER_BYTE if lower else _BYTE
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + BLOCK, side="right")))
        base, stop = int(starts[a]), int(ends[b - 1])
        power, inverse = _powers(stop - base + 1)
        sums = np.zeros(stop - base + 1, np.uint64)
        np.cumsum(values[data[base:stop]] * power[: stop - base], out=sums[1:])
        s, e = starts[a:b] - base, ends[a:b] - base
        out[a:b] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        a = b
    return out


def hash_text(word: str) -> int:
    """The hash that ``word_hashes`` gives a single word."""
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(word_hashes(raw, np.array([0]), np.array([len(raw)]))[0])


def shingles(hashes: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every run of ``size`` words within one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = hashes[:n].copy()
    for k in range(1, size):
        total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + n]
    same = owner[:n] == owner[size - 1 :]
    return mix(total[same]), owner[:n][same]


def signed(h: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the signed longs that Spark holds."""
    return h.view(np.int64)
