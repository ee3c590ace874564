"""Vectorised word hashing over Arrow string columns, shared by the operators on word sequences.

Words are maximal runs of bytes other than space and \\x09-\\x0D; a word's 64-bit hash depends on its
bytes alone, so equal words hash alike in any document, batch, task or run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLOCK = 1 << 18  # bytes hashed at once; documents are cut between words
_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(n, _BLOCK), dtype=np.uint64)
        have[1:] = np.uint64(base)
        _POWERS[base] = have = np.multiply.accumulate(have)
    return have


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over an array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(texts) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    a = pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary())
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] is not None and a.buffers()[2].size else np.zeros(0, np.uint8)
    return data, offsets


def pieces(column, most: int = 4 * _BLOCK):
    """An Arrow string column in slices of some megabytes of text (or one row), so that work on a batch stays small."""
    _, off = utf8(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, side="right")) - 1)
        yield column.slice(at, to - at)
        at = to


def _hash_block(data: np.ndarray, breaks: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of one block; a word also ends at each position in breaks."""
    n = len(data)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    breaks = breaks[(breaks > 0) & (breaks < n)]
    begins[breaks] = inside[breaks]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[breaks - 1] = inside[breaks - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(table[data] * _powers(_R, n)[:n], out=total[1:])
    h = (total[end] - total[start]) * _powers(_R_INV, n)[start]
    return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), start, end


def hash_words(texts, lower: bool = False, spans: bool = False):
    """Word hashes of every document of an Arrow string column.

    Returns (hashes uint64, offsets) with document i's words at ``hashes[offsets[i]:offsets[i+1]]``;
    with ``spans`` also each word's first and past-the-end byte within its document.
    ``lower`` hashes A-Z as a-z.  Null and empty texts have no words.
    """
    data, off = utf8(texts)
    table = _BYTE[_LOWER] if lower else _BYTE
    hashes, starts, ends = [], [], []
    at, stop = int(off[0]), int(off[-1])
    while at < stop:
        to = min(at + _BLOCK, stop)
        if to < stop:  # cut at the last document border or blank of the block, else after this word
            border = off[np.searchsorted(off, to, side="right") - 1]
            if border > at:
                to = int(border)
            else:
                blanks = np.flatnonzero(_SPACE[data[at:to]])
                if len(blanks):
                    to = at + int(blanks[-1]) + 1
                else:
                    limit = int(off[np.searchsorted(off, to, side="right")])
                    step, found = to, None
                    while found is None and step < limit:
                        more = np.flatnonzero(_SPACE[data[step : min(step + _BLOCK, limit)]])
                        found = step + int(more[0]) + 1 if len(more) else None
                        step += _BLOCK
                    to = found if found is not None else limit
        i, j = np.searchsorted(off, [at, to], side="left")
        h, s, e = _hash_block(data[at:to], off[i : j + 1] - at, table)
        hashes.append(h)
        starts.append(s + at)
        ends.append(e + at)
        at = to
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    words = np.searchsorted(s, off, side="left")
    if not spans:
        return h, words
    e = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    doc_start = np.repeat(off[:-1], np.diff(words))
    return h, words, s - doc_start, e - doc_start


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive word hashes (empty if there are fewer)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    # runs of doubling length, so that a run of n costs log2(n) passes
    out, length, have = np.zeros(m, np.uint64), 1, h
    at = 0
    for bit in range(n.bit_length()):
        if n >> bit & 1:
            out = mix64(out * np.uint64(_R) + have[at : at + m])
            at += length
        if n >> (bit + 1):
            k = len(have) - length
            have = mix64(have[:k] * np.uint64(0xC2B2AE3D27D4EB4F) + have[length:])
            length *= 2
    return out
