"""Token counts by a shortcut: pre-tokens that are one token are counted, only the rest is merged.

Byte-pair encoding works on each pre-token apart. Before any text is read, every vocabulary
string is encoded alone by the tokenizer's model; those that come out as one token, and whose
text maps back to the very same string, are proved whole (`whole_tokens`). A pre-token among them
counts one; the model merges only the others, each once as long as it is remembered.

Pre-tokens are found by the published pattern with the `regex` library, whose Unicode
tables may be of another version than the tokenizer's. So a character beyond ASCII is proved,
too, when it is first met: both must cut a few strings around it alike. Texts with a character
that fails are cut by the tokenizer itself.

Null text counts as empty and has no tokens. Rows are judged one by one, so repeated rows and null
ids have results of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from postgauge.llm.tables import Work, map_beside

REMEMBERED_BYTES = 32 << 20  # of merged pre-tokens that a task remembers, as `_COST` has it
LONGEST = 64  # characters of a pre-token that is remembered
_COST = 120  # bytes of a remembered pre-token besides its characters
_AROUND = "a{0}a {0}a 1{0}1 {0}1 !{0}! {0}! {0} x {0}{0}  {0}\n"
# Code points whose UTF-8 holds every byte that UTF-8 can hold.
_EVERY_BYTE = [*range(0x800), *range(0x800, 0xD800, 64), *range(0xE000, 0x10000, 64), *range(0x10000, 0x110000, 4096)]


class ByteLevel:
    """A byte-level tokenizer file: how it cuts texts, writes bytes and marks special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        cut = parts["pre_tokenizer"] or {}
        plain = all(not t[k] for t in parts["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
        if cut.get("type") != "ByteLevel" or not cut["use_regex"] or cut["add_prefix_space"] or parts["normalizer"] or not plain:
            raise ValueError(f"{path} is not a byte-level tokenizer without normalizer")
        self.tokenizer = Tokenizer.from_file(path)
        self.cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        special = sorted((t["content"] for t in parts["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        # The letter that stands for each byte, read off the library's own alphabet.
        write = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        text = "".join(map(chr, _EVERY_BYTE))
        self.letters = dict(zip(text.encode(), write(text)[0][0]))

    def written(self, piece: str) -> str:
        """A text as the vocabulary writes it."""
        return piece.encode().decode("latin-1").translate(self.letters)

    def merged(self, piece: str) -> int:
        return len(self.tokenizer.model.tokenize(self.written(piece)))


def whole_tokens(path: str) -> frozenset[str]:
    """The texts of all vocabulary strings that the model, given nothing else, leaves as one token."""
    level = ByteLevel(path)
    byte_of = {letter: byte for byte, letter in level.letters.items()}
    proved = []
    for written in level.tokenizer.get_vocab(with_added_tokens=False):
        try:
            text = bytes(map(byte_of.__getitem__, written)).decode()
        except (KeyError, UnicodeDecodeError):  # part of a character: never a pre-token by itself
            continue
        if level.written(text) == written and level.merged(text) == 1:
            proved.append(text)
    return frozenset(proved)


class TokenCounter:
    """Numbers of tokens of texts; what it remembers is bounded by bytes."""

    def __init__(self, path: str, whole: frozenset[str], remembered: int = REMEMBERED_BYTES):
        self.level, self.remembered = ByteLevel(path), remembered
        self.whole, self.known, self.size = dict.fromkeys(whole, 1), {}, 0
        self.find = regex.compile(public_tokenizers.PATTERN)
        self.alike, self.unlike = set(), set()
        self.ascii = self._cuts_alike("".join(map(chr, range(128))))

    def _new(self, piece: str) -> int:
        n = self.level.merged(piece)
        if len(piece) <= LONGEST:
            if self.size > self.remembered:
                self.known, self.size = {}, 0
            self.known[piece] = n
            self.size += _COST + len(piece) * (1 if piece.isascii() else 4)
        return n

    def _cuts_alike(self, text: str) -> bool:
        """Whether the pattern may cut this text: all of its characters are proved, new ones now."""
        letters = set(text)
        for letter in letters - self.alike - self.unlike:
            around = _AROUND.format(letter)
            same = [span for _, span in self.level.cut(around)] == [m.span() for m in self.find.finditer(around)]
            (self.alike if same else self.unlike).add(letter)
        return letters.isdisjoint(self.unlike)

    def _stretch(self, text: str) -> int:
        if not text:
            return 0
        if not (self.ascii and text.isascii() or self._cuts_alike(text)):
            # The library's letters stand for bytes, so its pieces are merged as they are.
            return sum(len(self.level.tokenizer.model.tokenize(piece)) for piece, _ in self.level.cut(text))
        pieces = self.find.findall(text)
        ones = list(map(self.whole.get, pieces))
        n = len(pieces)
        if None in ones:
            for piece, one in zip(pieces, ones):
                if one is None:
                    n += (self.known.get(piece) or self._new(piece)) - 1
        return n

    def count(self, text: str | None) -> int:
        """As many tokens as the library gives; a special string inside the text is one."""
        if not text:
            return 0
        if self.level.special is None:
            return self._stretch(text)
        stretches = self.level.special.split(text)
        return sum(map(self._stretch, stretches)) + len(stretches) - 1


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int = 512, text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """The struct `row` (all columns of `docs`, or those in `carry`), n_bytes, n_tokens, over_limit.

    The proof runs once, on the driver, over the vocabulary; texts are read once and don't move.
    """
    whole = whole_tokens(tokenizer)

    def start() -> Work:
        counter = TokenCounter(tokenizer, whole)

        def work(arrays: list[pa.Array]) -> list[pa.Array]:
            n_bytes = pc.fill_null(pc.cast(pc.binary_length(arrays[0]), pa.int64()), 0)
            n_tokens = np.fromiter(map(counter.count, _texts(arrays[0])), np.int64, len(arrays[0]))
            return [n_bytes, pa.array(n_tokens), pa.array(n_tokens > limit)]

        return work

    return map_beside(docs, [F.col(f"`{text}`").cast("string")], start, "n_bytes bigint, n_tokens bigint, over_limit boolean", carry)


def _texts(array: pa.Array) -> Iterator[str | None]:
    return (value.as_py() for value in array)
