"""Token ids of whole texts as the tokenizers library gives them, by the merge engine of tiktoken, which is faster.

Both merge by rank, and a token's rank is its id. A vocabulary with word ends is the same to the engine once each word
carries an end mark: U+0000 stands for the mark, and the pair of a last byte and the mark merges before all others.
Texts with white space or numerals that the libraries' patterns class differently, with U+0000, or with the strings of
special tokens that the split here does not cover, go to the tokenizers library itself. So do texts with a run of white
space of RUN characters: the engine's pattern gives up (a panic) on runs of about a million.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

from framesift.llm.wordids import WordIds

ODD = re.compile("[\x0b\x0c\x1c-\x1f\x85\u00a0\u1680\u180e\u2000-\u200a\u200b-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
END = "\0"
RUN = 50_000
SPACES = re.compile(rf"\s{{{RUN}}}")
# The patterns by which the two vocabularies split texts.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+"""


def _byte_of() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones are themselves, others follow U+00FF."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """ids(text) by the contents of a tokenizers JSON file, byte-level BPE with or without word ends."""

    def __init__(self, model: bytes):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(model.decode("utf-8"))
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(model)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        suffix = spec["model"]["end_of_word_suffix"] or ""
        self.words = bool(suffix)
        byte_of, ranks = _byte_of(), {}
        for token, n in spec["model"]["vocab"].items():
            if token in self.special:
                continue
            ended = self.words and token.endswith(suffix)
            raw = bytes(byte_of[c] for c in (token[: -len(suffix)] if ended else token))
            ranks[raw + END.encode() if ended else raw] = n
        self.engine = tiktoken.Encoding("own", pat_str=rf"[^{END}]*{END}" if self.words else BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.last = np.zeros(max(ranks.values()) + 1, bool)
        self.last[[n for raw, n in ranks.items() if raw.endswith(END.encode())]] = True
        self.split = re.compile(WORD_PATTERN).findall
        self.table: WordIds | None = None
        self.found = re.compile("|".join(map(re.escape, self.special)) or r"(?!)").search

    def _exact(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if self.found(text) or not text.isascii() and ODD.search(text) or text.isascii() and re.search("[\x0b\x0c\x1c-\x1f]", text):
            return np.array(self._exact(text), dtype=np.uint32)
        if len(text) > RUN and SPACES.search(text):
            return np.array(self._exact(text), dtype=np.uint32)
        if not self.words:
            return np.array(self.engine.encode_ordinary(text), dtype=np.uint32)
        if END in text:
            return np.array(self._exact(text), dtype=np.uint32)
        if text.isascii():
            parts = self.split(text.lower())
        else:
            low = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            parts = self.split(low)
            if any(not p.isascii() and not p.isalpha() for p in parts) and any(c.isnumeric() and not c.isascii() for c in set(low)):
                return np.array(self._exact(text), dtype=np.uint32)
        return np.array(self.engine.encode_ordinary(END.join(parts) + END) if parts else [], dtype=np.uint32)


    def _of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one after another, and how many each has: a word's last token carries the mark."""
        ids = np.array(self.engine.encode_ordinary(END.join(words).replace("Σ", "σ").lower() + END), dtype=np.uint32)
        return ids, np.diff(np.flatnonzero(self.last[ids]), prepend=-1)

    def many(self, texts: list[str | None]) -> list[np.ndarray]:
        """ids() of each text."""
        if not self.words:
            return [self.ids(t) for t in texts]
        if self.table is None:
            self.table = WordIds(ODD, self.found, self._of_words, self.ids)
        return self.table.ids_of(texts)


def vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        model = f.read()
    assert len(model) < 64 << 20, "the vocabulary is sent to every task"
    return model
