"""Words of whole texts as arrays, for the operators that work on Arrow batches.

A word is a maximal run of characters other than space and U+0009 to U+000D.
Words are identified by a 64-bit hash of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes hashed at a time: bounds the memory that a very long text takes.
BLOCK_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_RUN_BASE = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits, one to one."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return values ^ (values >> np.uint64(33))


def powers(count: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=8)
def _kept_powers(base: np.uint64) -> np.ndarray:
    out = powers(BLOCK_BYTES + 1, base)
    out.flags.writeable = False
    return out


def _powers_both(count: int, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse; kept for blocks, made anew for longer texts."""
    bases = base, np.uint64(pow(int(base), -1, 1 << 64))
    if count > BLOCK_BYTES + 1:
        return powers(count, bases[0]), powers(count, bases[1])
    return _kept_powers(bases[0])[:count], _kept_powers(bases[1])[:count]


def _sums(values: np.ndarray, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the values before each place, weighted by the powers of a base, and the
    powers that move a difference of two sums to a common origin."""
    forth, back = _powers_both(len(values) + 1, base)
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * forth[:-1], out=out[1:])
    return out, back


@dataclass
class Words:
    """Words of some rows: bytes ``start`` to ``end`` of ``data``; row r has words
    ``first[r]`` to ``first[r + 1]``."""

    data: np.ndarray
    origin: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def characters(self, places: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Code points before each byte place, counted from the start of its row."""
        if self._count is None:
            return places - self.origin[rows]
        return (self._count.take(places) - self._count.take(self.origin[rows])).astype(np.int64)

    @cached_property
    def _count(self) -> np.ndarray | None:
        """Code points before each byte; None if every byte is one."""
        heads = self.data.view(np.int8) >= -64
        if heads.all():
            return None
        # The bytes of an Arrow string column are fewer than 2 ** 31.
        out = np.zeros(len(heads) + 1, dtype=np.int32)
        np.cumsum(heads, dtype=np.int32, out=out[1:])
        return out

    @cached_property
    def _run_sums(self) -> tuple[np.ndarray, np.ndarray]:
        return _sums(self.hashes, _RUN_BASE)

    def run_hashes(self, first: np.ndarray, past: np.ndarray) -> np.ndarray:
        """A hash, not yet mixed, of the words ``first`` to ``past`` of each run, wherever it is."""
        sums, back = self._run_sums
        return (sums[past] - sums[first]) * back[first]


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), dtype=np.uint64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + BLOCK_BYTES, side="right")))
        block = data[start[lo]:end[hi - 1]].astype(np.uint64)
        block += np.uint64(1)
        sums, back = _sums(block, _BASE)
        a, b = start[lo:hi] - start[lo], end[lo:hi] - start[lo]
        out[lo:hi] = (sums[b] - sums[a]) * back[a]
        lo = hi
    return mixed(out)


def words_of(column: pa.Array, outside: np.ndarray = _SPACE, folded: np.ndarray | None = None) -> Words:
    """Words of a string column; null and blank texts have none.  ``outside`` marks
    the bytes that belong to no word, ``folded`` gives what each byte counts as."""
    if column.type != pa.string():
        column = column.cast(pa.string())
    if not len(column):
        none = np.zeros(0, dtype=np.int64)
        return Words(none.astype(np.uint8), np.zeros(1, np.int64), none, none, none.astype(np.uint64), np.zeros(1, np.int64))
    _, offsets, values = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values or b"", dtype=np.uint8)[bounds[0]:bounds[-1]]
    bounds = bounds - bounds[0]
    if folded is not None:
        data = folded[data]
    inside = ~outside.take(data)
    opens = inside.copy()
    opens[1:] = inside[1:] > inside[:-1]
    heads = bounds[:-1][bounds[:-1] < len(data)]
    opens[heads] = inside[heads]
    closes = inside.copy()
    closes[:-1] = inside[:-1] > inside[1:]
    tails = bounds[1:][bounds[1:] > 0] - 1
    closes[tails] = inside[tails]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, bounds, start, end, _hashes(data, start, end), np.searchsorted(start, bounds))


def row_slices(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about ``limit`` bytes of text, without copying."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    reach = np.cumsum(sizes)
    lo = 0
    while lo < batch.num_rows:
        past = reach[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(reach, past + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def runs_of(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, the first word and the row of each.
    A row with fewer words, but one at least, has one run of all its words."""
    counts = np.diff(words.first)
    rows = np.repeat(np.arange(len(counts)), counts)
    left = words.first[1:][rows] - np.arange(len(rows)) if len(rows) else np.zeros(0, np.int64)
    whole = (left >= width) | (np.arange(len(rows)) == words.first[:-1][rows]) if len(rows) else left > 0
    at = np.flatnonzero(whole)
    held = np.minimum(left[at], width)
    return mixed(words.run_hashes(at, at + held) + held.astype(np.uint64)), at, rows[at]
