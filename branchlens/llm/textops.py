"""Vectorised helpers on Arrow text columns, used inside Spark tasks.

Text stays UTF-8 bytes: a word is a maximal run of bytes other than space and
0x09-0x0D, which in UTF-8 are always whole characters. All hashes are 64-bit
polynomial hashes over numpy arrays with a final mix, so a task never loops over
words in Python. Functions work on slices of bounded bytes (``slices``); a single
longer document is one slice of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_U = np.uint64
_MULT = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (two xor-shift-multiply rounds)."""
    h = h ^ (h >> _U(31))
    h = h * _U(0x7FB5D329728EA185)
    h = h ^ (h >> _U(27))
    h = h * _U(0x81DADEF4BC2DD44D)
    return h ^ (h >> _U(33))


def _table(fold_case: bool) -> np.ndarray:
    codes = np.arange(256)
    if fold_case:
        codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    return mix((codes + 1).astype(np.uint64) * _U(_MULT))


_EXACT, _FOLDED = _table(False), _table(True)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class _Powers:
    """Growing tables of p**i and p**-i modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, b in (("up", self.base), ("down", self.inverse)):
                a = np.full(size, b, dtype=np.uint64)
                a[0] = 1
                setattr(self, name, np.cumprod(a))
        return self.up, self.down

    def span_hashes(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Polynomial hash of values[s:e] for every span."""
        up, down = self.upto(len(values) + 1)
        total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[: len(values)], out=total[1:])
        return (total[ends] - total[starts]) * down[starts]


_BYTE_POWERS = _Powers(0x5851F42D4C957F2D)
_GRAM_POWERS = (_Powers(0xD1342543DE82EF95), _Powers(0xAF251AF3B0F025B5))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n+1 offsets of a text column; null counts as empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # pyarrow keeps a chunked array when the data exceed one chunk
        column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks])
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]: offs[-1]] if len(offs) else raw, offs - (offs[0] if len(offs) else 0)


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges (i, j) of at most ``limit`` bytes each (at least one row)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


class Words:
    """Words of a slice of documents: byte spans, hashes and each document's word range."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fold_case: bool = False):
        self.data, self.offsets = data, offsets
        n = len(data)
        inside = ~_SPACE[data]
        before = np.zeros(n + 1, dtype=bool)
        before[1:] = inside
        before[offsets] = False          # a document's first byte follows nothing
        after = np.zeros(n + 1, dtype=bool)
        after[:n] = inside
        after[offsets] = False           # its last byte precedes nothing
        self.starts = np.flatnonzero(inside & ~before[:n])
        self.ends = np.flatnonzero(inside & ~after[1:]) + 1
        self.first = np.searchsorted(self.starts, offsets)  # n_docs + 1 word offsets
        self.counts = np.diff(self.first)
        table = _FOLDED if fold_case else _EXACT
        self.hashes = np.empty(len(self.starts), dtype=np.uint64)
        i = 0
        while i < len(self.starts):  # by runs of words of about SLICE_BYTES, for bounded temporary arrays
            low = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.starts, low + SLICE_BYTES)))
            s, e = self.starts[i:j], self.ends[i:j]
            h = _BYTE_POWERS.span_hashes(table[data[low: e[-1]]], s - low, e - low)
            self.hashes[i:j] = mix(h + (e - s).astype(np.uint64) * _U(_MULT))
            i = j

    def docs(self) -> np.ndarray:
        """Document index of every word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def gram_hashes(hashes: np.ndarray, first: np.ndarray, n: int, which: int = 0):
    """Hashes of all n-grams inside documents: (start word, document, hash)."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    docs = np.repeat(np.arange(len(counts)), counts)
    base = np.cumsum(counts) - counts
    starts = np.arange(int(counts.sum())) - base[docs] + first[:-1][docs]
    return starts, docs, span_hashes(hashes, starts, n, which)


def span_hashes(hashes: np.ndarray, starts: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Hash of the n words from each start; ``which`` chooses one of two independent hashes."""
    values = hashes if which == 0 else mix(hashes ^ _U(0xA5A5A5A5A5A5A5A5))
    return mix(_GRAM_POWERS[which].span_hashes(values, starts, starts + n) + _U(n))


def pack(values: np.ndarray) -> bytes:
    """Sorted uint64 values as byte planes of their differences (exact round trip)."""
    if not len(values):
        return b""
    deltas = np.diff(values, prepend=_U(0))
    width = max(1, (int(deltas.max()).bit_length() + 7) // 8)
    planes = deltas.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + planes.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, dtype=np.uint64)
    planes = np.frombuffer(blob, dtype=np.uint8, offset=1).reshape(blob[0], -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, : planes.shape[0]] = planes.T
    return np.cumsum(out.reshape(-1).view("<u8"), dtype=np.uint64)


def planes(values: np.ndarray) -> bytes:
    """Integers as byte planes of their distance to the smallest (exact round trip)."""
    if not len(values):
        return b""
    least = int(values.min())
    rest = (values.astype(np.int64).view(np.uint64) - np.int64(least).view(np.uint64))
    width = max(1, (int(rest.max()).bit_length() + 7) // 8)
    body = rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + np.int64(least).astype("<i8").tobytes() + body.tobytes()


def unplanes(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, dtype=np.int64)
    body = np.frombuffer(blob, dtype=np.uint8, offset=9).reshape(blob[0], -1)
    out = np.zeros((body.shape[1], 8), dtype=np.uint8)
    out[:, : body.shape[0]] = body.T
    least = np.frombuffer(blob, dtype="<i8", count=1, offset=1).view(np.uint64)
    return (out.reshape(-1).view("<u8") + least).view(np.int64)
