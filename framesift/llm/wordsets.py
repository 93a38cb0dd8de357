"""Words, 5-word shingles and their 64-bit hashes, for whole Arrow buffers at once.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, after A-Z became a-z. Bytes of a text are hashed by a
prefix polynomial modulo 2^64, so that a word's hash is a difference of two prefix values; no Python loop over words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

WORDS = 5  # words in a shingle
PIECE = 1 << 20  # bytes of texts hashed at once; a longer text is hashed alone
_P, _M = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_INV = np.uint64(pow(int(_P), -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int, known: dict) -> np.ndarray:
    """base^0 .. base^n, kept in known."""
    have = known.get(int(base))
    if have is None or len(have) <= n:
        steps = np.full(max(n, PIECE) + 1, base, dtype=np.uint64)
        steps[0] = 1
        have = known[int(base)] = np.multiply.accumulate(steps)
    return have[: n + 1]


def text_buffers(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, bytes and validity of an Arrow string array; null texts have no bytes."""
    import pyarrow as pa

    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).fill_null("")
    column = column.cast(pa.large_string())
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return offsets, np.frombuffer(data, dtype=np.uint8) if data and data.size else np.zeros(0, np.uint8)


def shingle_sets(column) -> Iterator[np.ndarray]:
    """The distinct shingle hashes, ascending, of each text of an Arrow string array, in order."""
    return (x for x, _ in _all_sets(column, False))


def sets_and_words(column) -> Iterator[tuple[np.ndarray, bytes | None]]:
    """shingle_sets() and, of each text, the SHA-256 of its words with one space behind each; None without words."""
    return _all_sets(column, True)


def _all_sets(column, digests: bool) -> Iterator[tuple[np.ndarray, bytes | None]]:
    offsets, data = text_buffers(column)
    known: dict = {}
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, side="right")) - 1)
        j = min(j, n)
        yield from _sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], known, digests)
        i = j


def _sets(data: np.ndarray, offsets: np.ndarray, known: dict, digests: bool) -> Iterator[tuple[np.ndarray, bytes | None]]:
    n, none = len(data), (np.zeros(0, np.uint64), None)
    if not n:
        yield from (none for _ in range(len(offsets) - 1))
        return
    upper = (data >= 65) & (data <= 90)
    low = data + (upper.view(np.uint8) << 5)
    inside = np.ones(n + 2, dtype=bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    # a text's first byte always begins a new word if it is in one
    first = np.unique(offsets[:-1][offsets[:-1] < offsets[1:]])
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    cut = first[(first > 0) & inside[first + 1] & inside[first]]
    if len(cut):
        starts = np.union1d(starts, cut)
    ends = np.flatnonzero(~inside[1:] & inside[:-1])
    if len(cut):
        ends = np.union1d(ends, cut)
    if not len(starts):
        yield from (none for _ in range(len(offsets) - 1))
        return
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * powers(_P, n, known)[:n], out=prefix[1:])
    words = (prefix[ends] - prefix[starts]) * powers(_INV, n, known)[starts]
    words = mixed(words + (ends - starts).astype(np.uint64) * _M)
    of = np.searchsorted(starts, offsets)  # the words of text k are of[k]:of[k + 1]
    if len(words) >= WORDS:
        grams = words[: len(words) - WORDS + 1].copy()
        for k in range(1, WORDS):
            grams *= _M
            grams += words[k : len(words) - WORDS + 1 + k]
        grams = mixed(grams)
    if digests:  # the words' bytes, a space behind each: the bytes of word k begin at place[k]
        lengths = ends - starts
        place = np.concatenate(([0], np.cumsum(lengths + 1)))
        plain = np.full(int(place[-1]), 32, dtype=np.uint8)
        real = inside[1:-1]
        at = np.ones(len(plain), dtype=bool)
        at[place[1:] - 1] = False
        plain[at] = low[real]
        plain = memoryview(plain)
    for a, b in zip(of[:-1].tolist(), of[1:].tolist(), strict=True):
        if b == a:
            yield none
            continue
        digest = hashlib.sha256(plain[int(place[a]) : int(place[b])]).digest() if digests else None
        if b - a >= WORDS:
            x = np.sort(grams[a : b - WORDS + 1])
            yield x[np.concatenate(([True], x[1:] != x[:-1]))], digest
        else:
            h = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    h = h * _M + w
            yield mixed(np.array([h], dtype=np.uint64) ^ np.uint64(0x5555)), digest
