"""Word and shingle hashes of Arrow text columns, by Karp-Rabin prefix sums.

A batch's UTF-8 bytes are hashed with one running polynomial sum (modulo 2^64); a
word's hash is the difference of two sums, scaled back by its start, so all words
of a block of texts are hashed by a few array operations. A shingle's
hash combines the hashes of its words by position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time (longer words extend a block). The arrays of a block, with the tables
#: of powers, take some 50 times as much, which a worker keeps for its later tasks.
BLOCK = 1 << 17
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"n": 0}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n + 1, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
        _powers["n"] = n
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def blank_table() -> np.ndarray:
    """Word bytes when words are runs of anything but blank, tab and line ends."""
    t = np.ones(256, dtype=bool)
    t[[0x20, *range(0x09, 0x0E)]] = False
    return t


def alphanumeric_table() -> np.ndarray:
    """Word bytes when words are runs of digits, letters and characters outside ASCII."""
    t = np.zeros(256, dtype=bool)
    t[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
    return t


def _hash_span(data: np.ndarray, word: np.ndarray, text_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of one span, in which texts start at ``text_starts``."""
    inside = word[data]
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    before[text_starts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = False, inside[1:] & before[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    up, down = _power_tables(len(data))
    lower = data + np.uint8(32) * ((data >= 65) & (data <= 90))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return starts, hashes


def hashed_words(texts: pa.Array, word: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For blocks of rows ``(first row, row after the last, hash of each word, row of each word)``.

    A-Z are lowered. Null counts as empty. A block holds about ``BLOCK`` bytes, or
    one longer text, which is hashed span by span."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        lo, hi = int(offsets[row]), int(offsets[stop])
        hashes, rows, at = [], [], lo
        while at < hi:
            end, size = hi, BLOCK
            while at + size < hi:  # a span ends between words
                gaps = np.flatnonzero(~word[data[at + 1:at + size]])
                if len(gaps):
                    end = at + 1 + int(gaps[-1])
                    break
                size *= 2
            cuts = offsets[row:stop + 1]
            starts, h = _hash_span(data[at:end], word, cuts[(cuts > at) & (cuts < end)] - at)
            hashes.append(h)
            rows.append(np.searchsorted(cuts, starts + at, "right") - 1)
            at = end
        yield (row, stop, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64),
               np.concatenate(rows) if rows else np.zeros(0, np.int64))
        row = stop


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each word on (the last ones are left out)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    scale = 1
    for i in range(width):
        scale = scale * _BASE % (1 << 64)
        out += words[i:i + n] * np.uint64(scale)
    return mix(out + np.uint64(width))
