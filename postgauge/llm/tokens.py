"""Token ids of whole texts by a public tokenizer, in bounded memory."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np

# Punctuation that may follow a word and neither shortens words nor marks special tokens.
_TAIL = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
_PROBES = ["abcdefghijklm", "nopqrstuvwxyz", "ABCDEFGHIJKLM", "NOPQRSTUVWXYZ", "the", "The", "Zebra"]
_COST = 190  # bytes of a remembered piece besides its characters and ids, as measured
# Letters of Latin and Cyrillic script: no two of them compose, and none changes its lower case by what is around it.
_LETTERS = [c for c in map(chr, [*range(0xC0, 0x250), *range(0x400, 0x530)]) if c.isalpha()]
# The characters that stand for bytes in the vocabulary: for some not those of the same number. A whole table, since
# characters that a dict lacks are slow to translate.
_MOVED = {b: 256 + k for k, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}
_BYTES = "".join(chr(_MOVED.get(b, b)) for b in range(256))


class _Remembered(dict):
    """Pieces with their ids; those of a new piece come from `make`."""

    __slots__ = ("make",)

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__({"": b""})
        self.make = make

    def __missing__(self, piece: str) -> bytes:
        return self.make(piece)


class Encoder:
    """Ids of texts, remembering the pieces between blanks that were met before.

    White space ends every token of the tokenizers this is meant for (`splits` tells
    whether that holds for the file), so the ids of a text are those of its pieces
    between blanks and line ends, one after the other. New pieces that are plain words, perhaps
    with punctuation after them, go to the tokenizer's model directly, in lower case and, beyond ASCII,
    with the characters that stand for their bytes: words of letters for which that was seen to give
    what the whole tokenizer gives.

    Most pieces of a corpus are met once. So a new piece is held as `recent`, which is forgotten after half
    of `keep` bytes, and is `known` from its second time on. Memory is bounded by bytes: known pieces of
    `keep` bytes become the recent ones. Pieces of over `longest` characters aren't remembered.
    """

    def __init__(self, path: str, keep: int = 32 << 20, longest: int = 64):
        from tokenizers import Tokenizer

        self.tokenizer, self.keep, self.longest = Tokenizer.from_file(path), keep, longest
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.model = self.tokenizer.model
        self.tokenize = self.model.tokenize
        self.known: dict[str, bytes] = _Remembered(self._new)
        self.recent: dict[str, bytes] = {}
        self.older = 0  # recent pieces that were known ones
        mark = getattr(self.model, "end_of_word_suffix", None)
        self.plain = bool(mark) and array("I").itemsize == 4 and all(map(self._is_plain, _PROBES))
        seen = "".join(c for c in _LETTERS if self.plain and self._is_plain(f"a{c}a"))
        self.letters = re.compile(f"[A-Za-z{seen}]+" if seen else r"(?!)").fullmatch
        self.splits = self._whole("a b\nc d").tobytes() == b"".join(self._whole(x).tobytes() for x in "abcd")

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _alone(self, word: str) -> bytes:
        """Ids that the model alone gives to a word in lower case."""
        low = word.lower()
        if not low.isascii():
            low = low.encode().decode("latin-1").translate(_BYTES)
        return array("I", [t.id for t in self.tokenize(low)]).tobytes()

    def _is_plain(self, word: str) -> bool:
        return self._whole(word).tobytes() == self._alone(word)

    def _new(self, piece: str) -> bytes:
        """Ids of a piece that isn't known yet."""
        recent = self.recent
        if (ids := recent.get(piece)) is not None:
            self.known[piece] = ids
            return ids
        if len(piece) > self.longest:
            return self._whole(piece).tobytes()
        word = piece.rstrip(_TAIL)
        ascii = word.isascii()
        if not (word.isalpha() if ascii else self.letters(word)):  # others may end in a mark, as İ does in lower case
            ids = self._whole(piece).tobytes()
        else:  # most words before a mark are met once, and aren't held by themselves
            marked = len(word) < len(piece)
            if not marked or not (ids := self.known.get(word) or recent.get(word)):
                if not self.plain:
                    ids = self._whole(word).tobytes()
                elif ascii:
                    ids = array("I", [t.id for t in self.tokenize(word.lower())]).tobytes()
                else:
                    ids = self._alone(word)
            if marked:
                ids += self.known[piece[len(word) :]]
        recent[piece] = ids
        return ids

    def many(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers; a null text has none."""
        return map(self.ids, texts)

    def ids(self, text: str | None) -> np.ndarray:
        text = text or ""
        if not self.splits:
            return self._whole(text)
        if _COST * len(self.known) > self.keep:
            self.known, self.recent = _Remembered(self._new), self.known
            self.older = len(self.recent)
        elif 2 * _COST * (len(self.recent) - self.older) > self.keep:
            self.recent, self.older = {}, 0
        pieces = text.replace("\n", " ").split(" ")
        return np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), "<u4")
