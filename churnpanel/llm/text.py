"""Vectorised views of text columns: byte buffers, words, rolling hashes.

Everything here works on one Arrow batch inside a Spark task.  Batches are cut
into pieces of bounded size (``pieces``), so temporaries stay small however long
the texts of a batch are; one text is never cut."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once (a single longer text is handled alone).
PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        have = _powers[base] = np.cumprod(out, dtype=np.uint64)
    return have[:n]


class RangeHash:
    """Hashes of arbitrary ranges of a symbol sequence in O(1) each.

    ``P[i]`` sums symbol values times powers of an odd base modulo 2**64; a range
    is shifted back by the inverse power, so equal contents hash alike wherever
    they lie."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _power(_BASE, n), out=self.prefix[1:])
        self.back = _power(_INVERSE, n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.back[start])

    def rolling(self, k: int) -> np.ndarray:
        """Hash of each range of length ``k``."""
        n = len(self.prefix) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.prefix[k:] - self.prefix[:n]) * self.back[:n])


def byte_values(buf: np.ndarray) -> np.ndarray:
    return _BYTE_VALUE[buf]


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (null: empty) and their offsets, without a copy."""
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offs[0]: offs[-1]], offs - offs[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = PIECE
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of bounded size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        buf, offs = buffers(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offs, offs[at] + size, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at), buf[offs[at]: offs[to]], offs[at: to + 1] - offs[at]
            at = to


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and the index of each
    document's first word (one more entry at the end).  Words never cross documents."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inside = ~_SPACE[buf]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = offs[:-1][offs[:-1] < n]
    begins[edge] = inside[edge]
    starts = np.flatnonzero(begins)
    stops = np.zeros(n + 1, bool)
    stops[1:] = inside
    stops[1:n] &= ~inside[1:]
    last = offs[1:][offs[1:] > 0]
    stops[last] = inside[last - 1]
    return starts, np.flatnonzero(stops), np.searchsorted(starts, offs)


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, ... for each of the ranges, one after the other."""
    total = int(lengths.sum())
    out = np.ones(total, np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    if not total:
        return out
    out[0] = starts[0]
    at = np.cumsum(lengths)[:-1]
    out[at] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(out)


def sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """Position of the least of each ``width`` consecutive keys, the leftmost on ties.

    Order is by the upper 36 bits of the key; the lower 28 carry the position."""
    n = len(keys) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = np.uint64((1 << 28) - 1)
    packed = np.full(-(-len(keys) // width) * width, ~np.uint64(0))
    packed[: len(keys)] = (keys & ~low) | np.arange(len(keys), dtype=np.uint64)
    grid = packed.reshape(-1, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(right[:n], left[width - 1: width - 1 + n]) & low).astype(np.int64)


def contexts(values: np.ndarray, bounds: np.ndarray, length: int, k: int):
    """Group the windows of ``length`` symbols by their anchor.

    The anchor of a window is its least-hashed ``k``-gram.  Equal windows have
    equal anchors at equal places, so a repeated window is found by comparing only
    the contexts of one anchor.  Returns per context: sequence index, first window
    start (in the buffer), number of windows, anchor place after that start, anchor hash
    and hash of the whole context (``windows + length - 1`` symbols).  ``bounds`` are sequence offsets."""
    rh = RangeHash(values)
    grams = rh.rolling(k)
    at = sliding_argmin(grams, length - k + 1)
    n = len(at)
    seq = np.repeat(np.arange(len(bounds) - 1), np.maximum(np.diff(bounds), 0))
    ok = np.zeros(n, bool)
    if n:
        ok = seq[:n] == seq[length - 1: length - 1 + n]
    first = ok.copy()
    if n > 1:
        first[1:] &= ~(ok[:-1] & (at[1:] == at[:-1]))
    lo = np.flatnonzero(first)
    stop = np.ones(n + 1, bool)
    stop[:n] = first | ~ok
    edges = np.flatnonzero(stop)
    run = edges[np.searchsorted(edges, lo, "right")] - lo if len(lo) else lo
    anchor = at[lo]
    offset = (anchor - lo).astype(np.uint64)  # where the anchor lies is part of the content
    return seq[lo], lo, run, anchor - lo, grams[anchor], mix(rh(lo, lo + run + length - 1) ^ (offset << np.uint64(48)) ^ run.astype(np.uint64))
