"""Array views of Arrow string batches, for use inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled at a time; arrays made from them take about a hundred times as much for a moment.
CHUNK_BYTES = 256 << 10
# multiplier of the position-weighted sums and its inverse modulo 2**64
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs only have equal outputs (it is a bijection)."""
    values = values ^ (values >> np.uint64(30))
    values = values * _MIX_A
    values = values ^ (values >> np.uint64(27))
    values = values * _MIX_B
    return values ^ (values >> np.uint64(31))


BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    if n:
        steps[0] = 1
    return np.multiply.accumulate(steps)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, row offsets, bytes) of runs of whole rows of about ``limit`` bytes; null is empty."""
    column = column.fill_null("") if column.null_count else column
    n = len(column)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, side="right")) - 1)
        yield row, at[row : end + 1] - at[row], raw[at[row] : at[end]]
        row = end


def text_pieces(column: pa.Array, overlap: int, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, first byte in it, row offsets, bytes): runs of whole rows as in ``text_chunks``; a
    row much longer than ``limit`` comes in pieces that share ``overlap`` bytes with the next."""
    for row, offsets, raw in text_chunks(column, limit):
        if len(raw) <= 2 * limit:
            yield row, 0, offsets, raw
        else:  # only a single row is so long
            for at in range(0, max(len(raw) - overlap, 1), limit):
                part = raw[at : at + limit + overlap]
                yield row, at, np.array([0, len(part)]), part


def _words(offsets: np.ndarray, raw: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and position-weighted sums of the words of a chunk."""
    n = len(raw)
    inside = ~outside[raw]
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    starts = np.flatnonzero(inside & ~before)
    last = np.zeros(n, dtype=bool)
    last[:-1] = ~inside[1:]
    last[offsets[1:][offsets[1:] > 0] - 1] = True
    ends = np.flatnonzero(inside & last) + 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODES[LOWERED[raw]] * powers(BASE, n), out=sums[1:])
    return starts, ends, (sums[ends] - sums[starts]) * powers(BASE_INVERSE, n + 1)[starts]


def word_hashes(offsets: np.ndarray, raw: np.ndarray, outside: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of a chunk, and each row's first word (n + 1 bounds).

    Words are maximal runs of bytes that ``outside`` does not mark; they end with their row.
    """
    starts, ends, sums = _words(offsets, raw, outside)
    return mixed(sums + (ends - starts).astype(np.uint64)), np.searchsorted(starts, offsets)


def streamed_word_hashes(parts: Iterable[np.ndarray], outside: np.ndarray = SPACES) -> Iterator[np.ndarray]:
    """``word_hashes`` of one text that comes in pieces; a word may run over any number of them."""
    open_sum, open_size = np.uint64(0), 0  # the word that the last piece ended in
    for part in parts:
        starts, ends, sums = _words(np.array([0, len(part)]), part, outside)
        sizes = ends - starts
        if open_size and len(starts) and starts[0] == 0:
            sums[:1] = open_sum + sums[:1] * np.uint64(pow(int(BASE), open_size, 1 << 64))
            sizes[0] += open_size
        elif open_size and len(part):
            sums, sizes = np.append(open_sum, sums), np.append(open_size, sizes)
        elif open_size:
            continue
        open_size = 0
        if len(ends) and ends[-1] == len(part):
            open_sum, open_size = sums[-1], int(sizes[-1])
            sums, sizes = sums[:-1], sizes[:-1]
        yield mixed(sums + sizes.astype(np.uint64))
    if open_size:
        yield mixed(np.array([open_sum]) + np.uint64(open_size))


def cut(raw: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[np.ndarray]:
    return (raw[at : at + limit] for at in range(0, len(raw), limit))
