"""Ids of many texts at once for vocabularies with word ends: words are split and looked up by array operations.

A chunk of texts is an array of code points. Tables over the code points give the class of each (space, letter, digit,
other), so that words start where it changes; a polynomial hash of 63 bits over prefix sums finds each word in a table of
words and their ids, filled by the encoder as words come up. What is found is compared letter by letter: a chunk in which
a word meets another one's hash goes to the encoder. The table is emptied when half full, so that its size is bounded.
Texts with code points that these tables do not cover go to the encoder.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np

CHUNK = 1 << 18  # code points looked up at once; longer texts go to the encoder
SLOTS = 1 << 20
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)


def _tables(odd: re.Pattern) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each code point of the basic plane: its class, its lower case, whether a text with it is left to the encoder."""
    kind, low, left = np.full(1 << 16, _OTHER, np.uint8), np.arange(1 << 16, dtype=np.uint16), np.zeros(1 << 16, bool)
    space, letter, digit = (re.compile(p).fullmatch for p in (r"\s", r"[^\W\d_]", r"\d"))
    for n in range(1 << 16):
        c = chr(n)
        lowered = c.replace("Σ", "σ").lower()
        if 0xD800 <= n < 0xE000 or len(lowered) != 1 or ord(lowered) >= 1 << 16 or n == 0 or odd.search(c) or c.isnumeric() and not c.isascii():
            left[n] = True
            continue
        low[n] = ord(lowered)
        kind[n] = _SPACE if space(lowered) else _LETTER if letter(lowered) else _DIGIT if digit(lowered) else _OTHER
    return kind, low, left


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... n[0] of them, then those from start[1], and so on."""
    before = np.cumsum(n) - n
    return np.repeat(start - before, n) + np.arange(int(n.sum()))


class WordIds:
    """ids_of(texts) as encoder.ids() gives them one by one. encode: the ids of words and their numbers; special: finds special strings."""

    def __init__(self, odd: re.Pattern, special, encode, one_text):
        self.kind, self.low, self.left = _tables(odd)
        self.special, self.encode, self.one_text = special, encode, one_text
        rng = np.random.default_rng(20)
        value = rng.integers(1, 1 << 63, 1 << 16, dtype=np.uint64)
        self.value = value[self.low]
        base = np.uint64(int(rng.integers(1 << 60, 1 << 62)) * 8 + 5)
        self.power = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(CHUNK, base, np.uint64)]))
        self._empty()

    def _empty(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.at, self.n_ids, self.n_points = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        self.flat, self.used, self.words = np.zeros(1 << 16, np.uint32), 0, 0
        self.letters, self.letters_at, self.letters_used = np.zeros(1 << 16, np.uint16), np.zeros(SLOTS, np.int64), 0

    def _slots(self, h: np.ndarray) -> np.ndarray:
        """The slot of each hash, or the free one where it would go."""
        slot = (h >> np.uint64(44)).astype(np.int64)
        found = self.keys[slot]
        j = np.flatnonzero((found != h) & (found != 0))
        while len(j):
            slot[j] = (slot[j] + 1) & (SLOTS - 1)
            found = self.keys[slot[j]]
            j = j[(found != h[j]) & (found != 0)]
        return slot

    def _learn(self, words: list[str], h: np.ndarray, points: np.ndarray, letters: np.ndarray) -> None:
        """Puts words of different hashes into the table, with their numbers of letters and these, one after another."""
        ids, n = self.encode(words)
        if self.letters_used + len(letters) > len(self.letters):
            self.letters = np.concatenate([self.letters, np.zeros(max(len(self.letters), len(letters)), np.uint16)])
        self.letters[self.letters_used : self.letters_used + len(letters)] = letters
        letters_at = self.letters_used + np.cumsum(points) - points
        self.letters_used += len(letters)
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(ids)), np.uint32)])
        self.flat[self.used : self.used + len(ids)] = ids
        at = self.used + np.cumsum(n) - n
        self.used, self.words = self.used + len(ids), self.words + len(words)
        todo = np.arange(len(words))
        while len(todo):
            slot = self._slots(h[todo])
            slot, first = np.unique(slot, return_index=True)  # of words that want one free slot the first takes it
            j = todo[first]
            self.keys[slot], self.at[slot], self.n_ids[slot], self.n_points[slot], self.letters_at[slot] = h[j], at[j], n[j], points[j], letters_at[j]
            todo = np.delete(todo, first)

    def ids_of(self, texts: list[str | None]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        held, size = [], 0
        for k, t in enumerate(texts):
            t = t or ""
            if not t.isascii():
                t = unicodedata.normalize("NFC", t)
            if len(t) >= CHUNK:
                out[k] = self.one_text(texts[k])
                continue
            if size + len(t) + 1 > CHUNK:
                self._chunk(held, texts, out)
                held, size = [], 0
            held.append((k, t))
            size += len(t) + 1
        self._chunk(held, texts, out)
        return out

    def _chunk(self, held: list[tuple[int, str]], texts: list[str | None], out: list) -> None:
        if not held:
            return
        joined = "\n".join([t for _, t in held]) + "\n"
        ends = np.cumsum([len(t) + 1 for _, t in held])
        c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        left = self.left[c & 0xFFFF]
        if not joined.isascii():
            left |= c > 0xFFFF
        alone = {int(d) for d in np.searchsorted(ends, np.flatnonzero(left), side="right")}
        if self.special(joined):
            alone |= {d for d, (_, t) in enumerate(held) if self.special(t)}
        if alone:  # all else again, without them
            for d in alone:
                out[held[d][0]] = self.one_text(texts[held[d][0]])
            return self._chunk([x for d, x in enumerate(held) if d not in alone], texts, out)
        kind = self.kind[c]
        word = kind != _SPACE
        begins = np.empty(len(c), bool)
        begins[0] = word[0]
        np.not_equal(kind[1:], kind[:-1], out=begins[1:])
        begins |= kind == _DIGIT
        a = np.flatnonzero(begins & (c == 39))  # an apostrophe that begins a word: 's 't 're 've 'm 'll 'd are words of their own
        if len(a):
            low = lambda i: self.low[c[np.minimum(i, len(c) - 1)]]
            one, two = low(a + 1), low(a + 2)
            short = np.isin(one, [ord(x) for x in "stmd"])
            long = (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
            begins[a[short | long] + 1] = False
            after = np.concatenate([a[short] + 2, a[long] + 3])
            begins[after[word[after]]] = True
        cut = np.flatnonzero(begins)
        start, end = cut, np.append(cut[1:], len(c))
        real = word[cut]
        start, end = start[real], end[real]
        sums = np.zeros(len(c) + 1, np.uint64)
        np.cumsum(self.value[c] * self.power[: len(c)], out=sums[1:])
        h = ((sums[end] - sums[start]) * self.power[CHUNK - start]) | np.uint64(1)
        slot = self._slots(h)
        new = np.flatnonzero(self.keys[slot] != h)
        if len(new):
            _, first = np.unique(h[new], return_index=True)
            if self.words + len(first) > SLOTS // 2:
                self._empty()
                new = np.arange(len(h))
                _, first = np.unique(h, return_index=True)
            i = new[first]
            self._learn([joined[s:e] for s, e in zip(start[i].tolist(), end[i].tolist(), strict=True)], h[i], end[i] - start[i], self.low[c[_ranges(start[i], end[i] - start[i])]])
            slot = self._slots(h)
        same = np.array_equal(self.n_points[slot], end - start)
        if not same or not np.array_equal(self.letters[_ranges(self.letters_at[slot], end - start)], self.low[c[word]]):  # one hash for two words
            for k, _ in held:
                out[k] = self.one_text(texts[k])
            return None
        n = self.n_ids[slot]
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
        ids = self.flat[_ranges(self.at[slot], n)]
        cuts = total[np.searchsorted(start, ends)]
        for (k, _), x in zip(held, np.split(ids, cuts[:-1]), strict=True):
            out[k] = x
        return None
