"""Word shingles of many texts as sorted 64-bit hashes, computed with NumPy."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are hashed together up to about so many bytes.
CHUNK_BYTES = 2_000_000
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Byte strings up to this size are hashed as three numbers, longer ones by a digest.
SHORT = 24
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_STEP = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    done = 1
    while done < n:  # base ** (done + k) = base ** done * base ** k, modulo 2 ** 64
        factor = np.uint64(pow(base, done, 1 << 64))
        more = min(done, n - done)
        np.multiply(out[:more], factor, out=out[done : done + more])
        done += more
    return out


class _Powers:
    up = _powers(_BASE, 1)
    down = _powers(pow(_BASE, -1, 1 << 64), 1)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return cls.up, cls.down


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the hash base, and of its inverse."""
    return _Powers.upto(n)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(_STEP[0])
    x ^= x >> np.uint64(27)
    x *= np.uint64(_STEP[1])
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of 64 bits of each ``data[start:stop]``.

    All bytes and the size go through steps that mix every bit, not through a sum over
    powers, under which texts made for it fall together.
    """
    size = stops - starts
    room = np.concatenate([data, np.zeros(SHORT, np.uint8)])
    cells = np.lib.stride_tricks.sliding_window_view(room, SHORT)[starts].view("<u8").astype(np.uint64, copy=False)
    a, b, c = (cells[:, k] & _MASKS[np.clip(size - 8 * k, 0, 8)] for k in range(3))
    n = size.astype(np.uint64)
    one = mix(a + mix(b + mix(c + n * np.uint64(_BASE))))
    two = mix(c ^ mix((b ^ mix((a + n) * np.uint64(_STEP[2]))) * np.uint64(_BASE)))
    for k in np.flatnonzero(size > SHORT).tolist():
        digest = hashlib.blake2b(data[starts[k] : stops[k]].tobytes(), digest_size=16).digest()
        one[k], two[k] = int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little")
    return one, two


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the joined texts, and the index of each text's first word."""
    n = len(data)
    if n == 0:
        return np.empty(0, np.uint64), np.zeros(len(offsets), dtype=np.int64)
    letter = ~_SPACE[data]
    begins, ends = letter.copy(), np.zeros(n + 1, dtype=bool)
    begins[1:] &= ~letter[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < n]
    begins[inner] = letter[inner]
    ends[1:n] = letter[:-1] & ~letter[1:]
    ends[n] = letter[n - 1]
    cut = inner[inner > 0]
    ends[cut] = letter[cut - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends)
    return span_hashes(_LOWER[data], starts, stops)[0], np.searchsorted(starts, offsets)


def _sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    if len(data) == 0:
        for _ in range(len(offsets) - 1):
            yield np.empty(0, dtype=np.uint64)
        return
    words, first = word_hashes(data, offsets)
    factors = [np.uint64(pow(_STEP[2], k + 1, 1 << 64)) for k in range(size)]
    grams = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for k, factor in enumerate(factors):
        grams += words[k : k + len(grams)] * factor
    mix(grams)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= size:
            yield np.unique(grams[a : b - size + 1])
        elif b > a:
            few = np.array([b - a], dtype=np.uint64)
            for k in range(b - a):
                few += words[a + k : a + k + 1] * factors[k]
            yield mix(few)
        else:
            yield np.empty(0, dtype=np.uint64)


def joined_texts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The UTF-8 bytes of some texts at a time, their bounds, and the index of the first."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if len(texts) == 0:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at
        at = to


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order.

    A-Z count as a-z; words are runs of characters other than ASCII white space. A text
    of fewer words than ``size`` has its whole sequence as its one shingle; a text
    without words, or a missing one, has none.
    """
    for data, bounds, _ in joined_texts(texts):
        yield from _sets(data, bounds, size)
