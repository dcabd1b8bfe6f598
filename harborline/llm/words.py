"""Words and shingles of Arrow text columns as 64-bit hashes, in numpy inside tasks.

A word is a maximal run of bytes other than ASCII white space, with A-Z lower-cased; bytes of
one UTF-8 character are never split, because all of them are above 127. Hashes are 64 bits
wide: two different words or shingles of the corpus are taken for one with a chance of about
``n ** 2 / 2 ** 65``. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text that one vectorised step works on; a longer text is a step of its own.
STEP_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of each 64-bit value (the finaliser of splitmix64)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def randoms(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed)) | U(1)


_NEAR, _FAR = randoms(4096, 11), randoms(4096, 12)
_BYTE = randoms(256, 13)


def byte_values(skip: np.ndarray, lower: bool = True) -> np.ndarray:
    """One 64-bit value for each byte; 0 for those to skip, and one for both cases of a letter."""
    values = _BYTE.copy()
    if lower:
        values[65:91] = values[97:123]
    values[skip] = 0
    return values


LOWER = byte_values(SPACE)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def steps(batch: pa.RecordBatch, column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each, and one row at least."""
    _, at = utf8(batch.column(column))
    row = 0
    while row < batch.num_rows:
        until = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield batch.slice(row, until - row)
        row = until


def spans(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs of bytes marked ``inside`` in each row."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[1:-1]
    edges = edges[edges < n]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges[edges > 0] - 1] = inside[edges[edges > 0] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = LOWER) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, spans being disjoint and ascending.

    Bytes between spans must have the value 0. Long inputs are hashed in pieces, so that
    the memory follows the step size and not the length of a text.
    """
    out = np.zeros(len(starts), U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + STEP_BYTES // 2)))
        base, stop = starts[i], ends[j - 1]
        own = starts[i:j] - base
        position = np.arange(stop - base) - np.repeat(own, np.diff(np.append(own, stop - base)))
        terms = values[data[base:stop]] * _NEAR[position & 4095]
        if position.size and position.max() > 4095:
            terms *= _FAR[(position >> 12) & 4095]
        out[i:j] = mix(np.add.reduceat(terms, own) + (ends[i:j] - starts[i:j]).astype(U))
        i = j
    return out


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column, and the offsets of the rows in them."""
    data, at = utf8(column)
    starts, ends, rows = spans(data, at, ~SPACE[data])
    return span_hashes(data, starts, ends), np.searchsorted(rows, np.arange(len(at)))


def shingles(hashes: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words in each row, in order, and the rows' offsets in them.

    A row with fewer words has its whole sequence as its one shingle; a row without words none.
    """
    times = randoms(size, 21)
    counts = np.diff(at)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out_at = np.concatenate([[0], np.cumsum(made)])
    full = np.zeros(max(len(hashes) - size + 1, 0), U)
    for k in range(size):
        full += hashes[k : k + len(full)] * times[k]
    full = mix(full)
    rows = np.repeat(np.arange(len(made)), made)
    first = at[:-1][rows] + (np.arange(out_at[-1]) - out_at[:-1][rows])
    out = np.zeros(len(first), U)
    whole = counts[rows] >= size
    out[whole] = full[first[whole]]
    for i in np.flatnonzero(~whole):
        own = hashes[at[rows[i]] : at[rows[i] + 1]]
        out[i] = mix((own * times[: len(own)]).sum(dtype=U, keepdims=True) + U(len(own)))[0]
    return out, out_at


def distinct(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of each row, and the rows' offsets in them."""
    parts = [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    return (np.concatenate(parts) if parts else hashes[:0]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def shared(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray) -> np.ndarray:
    """For each row, how many hashes the two distinct sets have in common."""
    n = len(a_at) - 1
    rows = np.concatenate([np.repeat(np.arange(n), np.diff(a_at)), np.repeat(np.arange(n), np.diff(b_at))])
    both = np.concatenate([a, b])
    order = np.lexsort((both, rows))
    rows, both = rows[order], both[order]
    twice = (rows[1:] == rows[:-1]) & (both[1:] == both[:-1])
    return np.bincount(rows[1:][twice], minlength=n)


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's signed bigint."""
    return np.ascontiguousarray(h).view(np.int64)
