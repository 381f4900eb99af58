"""Words, shingles and windows of whole Arrow text columns as numpy arrays.

The functions work on the column's bytes without making a Python string for
each row. They run inside Spark tasks, on chunks of a few MB."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text handled at once (arrays of them fit a core's cache); a longer single text is handled alone.
CHUNK_BYTES = 1 << 18

_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: True for bytes of words: all but blank and 0x09 to 0x0D.
SOLID = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_STEP = 0xC2B2AE3D27D4EB4F


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the n + 1 offsets of its rows; nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(batches, column: str = "text", limit: int = CHUNK_BYTES):
    """Slices of the batches with at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at, ends = 0, np.cumsum(size)
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and hash of each word, A-Z in lower case; words end with their row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, U64)
    solid = SOLID[data]
    full = off[1:] > off[:-1]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    first = off[:-1][full]
    begin[first] = solid[first]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:]
    last = off[1:][full] - 1
    stop[last] = solid[last]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    row = np.searchsorted(off, start, side="right") - 1
    return start, end, row, span_hash(LOWER[data], start, end)


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, equal for equal bytes anywhere."""
    n = len(data)
    power = np.cumprod(np.full(n + 1, BASE, U64))
    total = np.zeros(n + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * power[:n], out=total[1:])
    del power
    inverse = np.cumprod(np.full(n + 1, pow(BASE, -1, 1 << 64), U64))
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(U64) * U64(_STEP))


def window_hash(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of the ``k`` bytes (or code units) from each position that has as many after it."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out, have, done, block, size = None, 0, 0, data.astype(U64) + U64(1), 1
    while size <= k:  # a block covers size units; k is built from its binary digits
        if k & size:
            part = block[done:done + n]
            out = part.copy() if out is None else out * U64(pow(BASE, size, 1 << 64)) + part
            done += size
        if size * 2 <= k:
            block = block[:len(block) - size] * U64(pow(BASE, size, 1 << 64)) + block[size:]
        size *= 2
    return mix(out)


def shingles(row: np.ndarray, word: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of ``k`` words, rows together, and the n_rows + 1 offsets.

    A row with fewer words has one shingle, its whole sequence; one without words has none."""
    count = np.bincount(row, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(count)])
    many = np.maximum(count - k + 1, np.minimum(count, 1))
    off = np.concatenate([[0], np.cumsum(many)])
    out = np.empty(off[-1], U64)
    weight = [U64(pow(_STEP, j + 1, 1 << 64)) for j in range(k)]
    if len(word) >= k:
        n = len(word) - k + 1
        whole = word[:n] * weight[0]
        for j in range(1, k):
            whole += word[j:j + n] * weight[j]
        inside = row[:n] == row[k - 1:]
        place = np.repeat(count >= k, many)
        out[place] = mix(whole[inside])
    for size in range(1, k):
        short = np.flatnonzero(count == size)
        if len(short):
            total = np.full(len(short), size, U64)
            for j in range(size):
                total += word[first[short] + j] * weight[j]
            out[off[short]] = mix(total)
    return out, off
