"""Vectorised word and n-gram kernels over blocks of texts (numpy, inside Spark tasks).

A block is a run of whole documents whose UTF-8 bytes lie in one array.  Nothing here ever
cuts a text: a document larger than the block size is a block of its own.  Null and empty
texts are documents without bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_P = 0x9E3779B97F4A7C15  # odd multipliers of the two rolling hashes (any odd 64-bit value works)
_Q = 0xC2B2AE3D27D4EB4F
BLOCK_BYTES = 1 << 20
RANGE = 1 << 18  # bytes (or words) hashed at once

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _pow_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (grown by doubling and kept per worker)."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inv = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inv):
            t = np.full(size, b, dtype=U64)
            t[0] = 1
            out.append(np.multiply.accumulate(t))
        _powers[base] = have = (out[0], out[1])
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (avalanche) of every element."""
    h = h ^ U64(seed & 0xFFFFFFFFFFFFFFFF)
    h ^= h >> U64(33)
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def byte_table(keep) -> np.ndarray:
    """Boolean table over the 256 byte values from a predicate."""
    return np.array([bool(keep(b)) for b in range(256)])


# Words of non-blank characters: anything but space and \x09-\x0D (UTF-8 keeps both ASCII).
NON_BLANK = byte_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
# Letters-and-digits words: digits, a-z and every non-ASCII character, after lower-casing A-Z.
ALNUM = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 or 0x41 <= b <= 0x5A)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty.  No copy for null-free columns."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, off, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(off, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def split_blocks(offs: np.ndarray, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [lo, hi) of whole documents of about ``block_bytes`` bytes each."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + block_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


class Words:
    """Words of one block: byte starts/ends and, per document, the range of its words."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, table: np.ndarray):
        self.buf, self.offs = buf, offs
        m = table[buf]
        edge = np.zeros(len(m) + 1, dtype=bool)  # a document begins at this byte
        edge[offs] = True
        before = np.empty(len(m), dtype=bool)
        before[:1] = False
        before[1:] = m[:-1]
        after = np.empty(len(m), dtype=bool)
        after[-1:] = False
        after[:-1] = m[1:]
        self.starts = np.flatnonzero(m & (~before | edge[:-1]))
        self.ends = np.flatnonzero(m & (~after | edge[1:])) + 1
        self.ranges = np.searchsorted(self.starts, offs)  # words of document d: ranges[d]:ranges[d+1]

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ranges)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offs) - 1), self.counts)

    def hashes(self, range_bytes: int = RANGE) -> np.ndarray:
        """A 64-bit hash of every word's bytes.

        Read in ranges of about ``range_bytes``, so the arrays of powers and sums stay that small
        however long a text is; a longer word is summed piece by piece.
        """
        n = len(self.starts)
        out = np.empty(n, U64)
        lo = 0
        while lo < n:
            first = int(self.starts[lo])
            hi = max(lo + 1, int(np.searchsorted(self.ends, first + range_bytes, side="right")))
            last = int(self.ends[hi - 1])
            if last - first > range_bytes:  # one long word
                out[lo] = self._long_sum(first, last, range_bytes)
            else:
                up, down = _pow_tables(_P, last - first)
                total = np.zeros(last - first + 1, U64)
                np.cumsum((self.buf[first:last].astype(U64) + U64(1)) * up, out=total[1:])
                at = self.starts[lo:hi] - first
                out[lo:hi] = (total[self.ends[lo:hi] - first] - total[at]) * down[at]
            lo = hi
        return mix(out + (self.ends - self.starts).astype(U64))

    def _long_sum(self, first: int, last: int, range_bytes: int) -> np.uint64:
        total, power = 0, 1
        for at in range(first, last, range_bytes):
            piece = self.buf[at:min(last, at + range_bytes)].astype(U64) + U64(1)
            total += int((piece * _pow_tables(_P, len(piece))[0]).sum()) * power
            power = power * pow(_P, range_bytes, 1 << 64) & (1 << 64) - 1
        return U64(total & (1 << 64) - 1)


def ngram_hashes(h: np.ndarray, ranges: np.ndarray, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows, and for every window the index of its first word.

    Windows never cross documents (``ranges`` are the documents' word ranges).
    """
    if len(h) < n:
        return np.empty(0, U64), np.empty(0, np.int64)
    ok = np.ones(len(h), dtype=bool)
    ends = ranges[1:]
    for back in range(1, n):  # the last n-1 words of a document start no window
        at = ends - back
        ok[at[at >= ranges[:-1]]] = False
    at = np.flatnonzero(ok)
    out = np.empty(len(at), U64)
    up, down = _pow_tables(_Q, min(len(h), RANGE + n))
    for lo in range(0, len(h), RANGE):  # windows that start in this range of words
        part = slice(*np.searchsorted(at, [lo, lo + RANGE]))
        own = h[lo:lo + RANGE + n - 1]
        total = np.zeros(len(own) + 1, U64)
        np.cumsum(own * up[:len(own)], out=total[1:])
        start = at[part] - lo
        out[part] = (total[start + n] - total[start]) * down[start]
    return mix(out, seed), at


def sums_by_doc(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over every range offs[d]:offs[d+1] (empty ranges give 0)."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]
